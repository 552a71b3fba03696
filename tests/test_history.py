import datetime

import pytest
from pyspark.sql import functions as F

from wattline.operators.readings import explode_readings, rejected_messages, valid_messages
from wattline.sources import history as H
from wattline.sources.dimensions import DIMENSIONS, read_dimensions

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    from wattline.plans import fixtures

    path = str(tmp_path_factory.mktemp("history") / "store")
    H.write_history(fixtures.history(spark, SF), path)
    return path


def plan(df):
    text = df._jdf.queryExecution().toString()
    return text[text.index("Physical Plan"):]


def test_scan_reaches_the_files(spark, stored):
    df = H.scan_history(H.read_history(spark, stored), "SN0001", "1", "1", "2024-01-05 13:12:00", "2024-01-08 17:12:00")
    text = plan(df)
    assert "PartitionFilters: [isnotnull(day" in text and "EqualTo(sn,SN0001)" in text
    assert "GreaterThanOrEqual(time," in text and "LessThan(time," in text
    assert df.count() > 0
    days = {r[0] for r in df.select("day").distinct().collect()}
    assert days <= {datetime.date(2024, 1, d) for d in range(5, 9)}


def row(spark, *times, status=0):
    rows = [("s", "1", "1", t, status, i) for i, t in enumerate(times)]
    df = spark.createDataFrame(rows, "sn string, type string, addr string, w string, status int, arrival bigint")
    from wattline.functions.timefn import seconds_of

    ts = F.col("w").cast("timestamp_ntz")
    return df.withColumn("time", seconds_of(ts) - 8 * 3600).withColumn("day", ts.cast("date"))


def test_start_is_in_and_end_is_out(spark):
    df = row(spark, "2020-05-11 13:11:59", "2020-05-11 13:12:00", "2020-05-11 17:11:59", "2020-05-11 17:12:00")
    got = H.scan_history(df, "s", "1", "1", "2020-05-11 13:12:00", "2020-05-11 17:12:00").collect()
    assert [r["arrival"] for r in got] == [1, 2]


def test_status(spark):
    statuses = [(0,), (1,), (None,)]
    assert H.status_filter(spark.createDataFrame(statuses, "status int")).count() == 2


def requests(spark, *rows):
    df = spark.createDataFrame(rows, "request string, sn string, type string, addr string, s string, e string")
    return df.select(
        "request", "sn", "type", "addr",
        F.col("s").cast("timestamp_ntz").alias("stime"), F.col("e").cast("timestamp_ntz").alias("etime"),
    )


def test_ranges_overlap_touch_and_end_at_midnight(spark):
    df = row(spark, "2020-05-10 23:59:59", "2020-05-11 00:00:00", "2020-05-11 12:00:00", "2020-05-12 00:00:00")
    wanted = requests(
        spark,
        ("a", "s", "1", "1", "2020-05-10 00:00:00", "2020-05-11 00:00:00"),
        ("b", "s", "1", "1", "2020-05-11 00:00:00", "2020-05-12 00:00:00"),
        ("c", "s", "1", "1", "2020-05-10 23:59:59", "2020-05-12 00:00:01"),
        ("empty", "s", "1", "1", "2020-05-11 12:00:00", "2020-05-11 12:00:00"),
        ("other", "s", "11", "", "2020-05-10 00:00:00", "2020-05-13 00:00:00"),
    )
    got = {(r["request"], r["arrival"]) for r in H.backfill_ranges(df, wanted).collect()}
    assert got == {("a", 0), ("b", 1), ("b", 2), ("c", 0), ("c", 1), ("c", 2), ("c", 3)}


def test_ranges_equal_scans_one_by_one(spark, stored):
    from wattline.plans import fixtures

    history = H.read_history(spark, stored)
    wanted = fixtures.backfill_requests(spark, SF)
    together = {(r["request"], r["arrival"]) for r in H.backfill_ranges(history, wanted).collect()}
    alone = set()
    for q in wanted.collect():
        scan = H.scan_history(history, q["sn"], q["type"], q["addr"], str(q["stime"]), str(q["etime"]))
        alone |= {(q["request"], r["arrival"]) for r in scan.collect()}
    assert together == alone and together


def test_ranges_prune_day_partitions(spark, stored):
    wanted = requests(spark, ("a", "SN0001", "1", "1", "2024-01-03 00:00:00", "2024-01-04 00:00:00"))
    text = plan(H.backfill_ranges(H.read_history(spark, stored), wanted))
    assert "dynamicpruning" in text or "day" in text.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_ranges_covering_everything_give_everything(spark, stored):
    history = H.read_history(spark, stored)
    meters = history.select("sn", "type", "addr").distinct().collect()
    wanted = requests(
        spark, *[(f"{m[0]}-{m[2]}", m[0], m[1], m[2], "2024-01-01 00:00:00", "2024-02-02 00:00:00") for m in meters]
    )
    assert H.backfill_ranges(history, wanted).count() == H.status_filter(history).count()


def test_payload_becomes_readings(spark):
    df = row(spark, "2020-05-11 10:10:00").withColumns(
        {"payload": F.lit('[{"code":"B2","value":3.5},{"code":"C2","value":"4"}]'), "topic": F.lit("t"), "delay": F.lit(1)}
    )
    assert df.first()["time"] == 1589163000
    got = explode_readings(H.decode_history_payload(df)).collect()
    assert [(r["code"], r["value"], r["origin"], r["delay"], str(r["ts"])) for r in got] == [
        ("B2", 3.5, 1, 1, "2020-05-11 10:10:00"),
        ("C2", 4.0, 1, 1, "2020-05-11 10:10:00"),
    ]


@pytest.mark.parametrize("payload", ["not json", '[{"code":"B2","value":"abc"}]', "[]", None])
def test_bad_payloads_are_rejected_not_metered(spark, payload):
    df = row(spark, "2020-05-11 10:10:00").withColumns(
        {"payload": F.lit(payload).cast("string"), "topic": F.lit("t"), "delay": F.lit(None).cast("int")}
    )
    messages = H.decode_history_payload(df)
    assert valid_messages(messages).count() == 0
    (bad,) = rejected_messages(messages).collect()
    assert bad["value"] == payload and bad["reason"] in ("bad json", "bad value", "no data")


def test_peek_is_the_first_rows_by_key(spark, stored):
    history = H.read_history(spark, stored)
    rows = H.peek(history).collect()
    keys = [(r["sn"][::-1], r["type"], r["addr"], r["time"], r["arrival"]) for r in rows]
    everything = sorted(
        (r["sn"][::-1], r["type"], r["addr"], r["time"], r["arrival"]) for r in history.collect()
    )
    assert keys == everything[:10]


def test_dimensions_are_read_with_their_columns(spark, tmp_path):
    from wattline.plans import fixtures

    for name, rows in fixtures.dimensions(spark, SF).items():
        rows.write.parquet(f"{tmp_path}/{name}")
    dims = read_dimensions(spark, str(tmp_path))
    assert {n: d.columns for n, d in dims.items()} == DIMENSIONS
