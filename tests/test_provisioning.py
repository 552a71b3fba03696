import pytest
from metering import seconds
from pyspark.sql import functions as F

from wattline.operators import provisioning as V

T = seconds("2024-01-10 01:10:00")
READING = "meter_key string, sn string, code string, type string, addr string, topic string, t bigint, arrival bigint, value double"


def reading(sn, code, arrival, addr="1", topic="t", value=1.0):
    return (f"{sn}_{code}_1_{addr}", sn, code, "1", addr, topic, T + arrival, arrival, float(value))


def dims(spark, **rows):
    schemas = {
        "registry": "meter_key string, input_id string, feed_id string",
        "key_schema": "ds_schema string, dev_seri_no string",
        "iot_device": "ds_schema string, id string, dev_seri_no string, is_del int",
        "topic": "ds_schema string, id string, device_id string, value string, is_del int",
        "instrument": "ds_schema string, id string, addr string, device_id string, type string",
        "input": "ds_schema string, id string, prop string, inst_addr string, inst_type string, inst_id string",
        "feed": "ds_schema string, id string, device_id string, num int, input_id string, feed_type string, feed_value_type string",
        "iot_bsn": "ds_schema string, inst_id string, status string",
    }
    return {name: spark.createDataFrame(rows.get(name, []), schema) for name, schema in schemas.items()}


def one_device(**extra):
    return dict(
        key_schema=[("ten", "a")],
        iot_device=[("ten", "d", "a", 0)],
        topic=[("ten", "top", "d", "t", 0)],
        **extra,
    )


def resolved(spark, rows, **extra):
    d = dims(spark, **one_device(**extra))
    return V.resolve_new_meters(spark.createDataFrame(rows, READING), d), d


def test_first_reading_of_each_meter(spark):
    rows = [reading("a", "B2", 5, topic="u", value=5), reading("a", "B2", 3, value=3), reading("a", "C2", 9, value=9)]
    got = {r["code"]: (r["arrival"], r["value"], r["topic"]) for r in V.first_seen(spark.createDataFrame(rows, READING)).collect()}
    assert got == {"B2": (3, 3.0, "t"), "C2": (9, 9.0, "t")}


def test_everything_new(spark):
    meters, d = resolved(spark, [reading("a", "B2", 2), reading("a", "C2", 1, value=7), reading("a", "B2", 4)])
    out = V.provision(meters, d)
    (instrument,) = out["instrument"].collect()
    assert (instrument["device_id"], instrument["topic_id"], instrument["addr"]) == ("d", "top", "1")
    inputs = {r["prop"]: r for r in out["input"].collect()}
    assert inputs["C2"]["value"] == 7.0 and inputs["C2"]["value_time"] == "2024-01-10 01:10:01"
    assert {r["inst_id"] for r in inputs.values()} == {instrument["id"]}
    feeds = {r["feed_num"]: r for r in out["feed"].collect()}
    assert set(feeds) == {"a00001", "a00002"}
    first = feeds["a00001"]
    assert first["input_id"] == inputs["C2"]["id"] and first["name"] == f"C2_{first['id']}"
    assert (first["feed_type"], first["feed_value_type"], first["interval_unit_type"]) == ("NORMAL", "ORI", "DAY")
    assert {tuple(r) for r in out["registry"].collect()} == {
        ("a_C2_1_1", inputs["C2"]["id"], first["id"]),
        ("a_B2_1_1", inputs["B2"]["id"], feeds["a00002"]["id"]),
    }
    (bsn,) = out["iot_bsn"].collect()
    (schema,) = out["bsn_schema"].collect()
    assert bsn["status"] == "VALID" and schema["bsn"] == bsn["bsn"] and schema["ds_schema"] == "ten"
    assert all(len(r["id"]) == 32 for r in inputs.values())


def test_known_rows_are_found_not_made(spark):
    meters, d = resolved(
        spark,
        [reading("a", "B2", 1), reading("a", "C2", 2)],
        instrument=[("ten", "inst", "1", "d", "1")],
        input=[("ten", "in", "B2", "1", "1", "inst")],
        feed=[("ten", "fd", "d", 4, "in", "NORMAL", "ORI"), ("ten", "fv", "d", 9, "in", "VIRTUAL", "VAL")],
        iot_bsn=[("ten", "inst", "VALID")],
    )
    out = V.provision(meters, d)
    assert out["instrument"].isEmpty() and out["iot_bsn"].isEmpty() and out["bsn_schema"].isEmpty()
    assert [r["prop"] for r in out["input"].collect()] == ["C2"]
    # Numbered after the highest normal feed, whatever virtual feeds hold.
    assert [r["feed_num"] for r in out["feed"].collect()] == ["a00005"]
    registry = {r["meter_key"]: (r["input_id"], r["feed_id"]) for r in out["registry"].collect()}
    assert registry["a_B2_1_1"] == ("in", "fd") and len(registry) == 2


def test_other_tenants_rows_do_not_match(spark):
    meters, d = resolved(spark, [reading("a", "B2", 1)], instrument=[("other", "inst", "1", "d", "1")])
    assert V.new_instruments(meters).count() == 1


@pytest.mark.parametrize(
    "rows",
    [
        [reading("x", "B2", 1)],
        [reading("a", "B2", 1, topic="unknown")],
    ],
)
def test_unknown_device_or_topic_is_left_out(spark, rows):
    assert resolved(spark, rows)[0].isEmpty()


def test_deleted_device_and_topic(spark):
    rows = spark.createDataFrame([reading("a", "B2", 1)], READING)
    parts = one_device()
    gone = dict(parts, iot_device=[("ten", "d", "a", 1)])
    assert V.resolve_new_meters(rows, dims(spark, **gone)).isEmpty()
    gone = dict(parts, topic=[("ten", "top", "d", "t", 1)])
    assert V.resolve_new_meters(rows, dims(spark, **gone)).isEmpty()


def test_registered_meters_are_skipped(spark):
    meters, _ = resolved(spark, [reading("a", "B2", 1), reading("a", "C2", 2)], registry=[("a_B2_1_1", "i", "f")])
    assert [r["code"] for r in meters.collect()] == ["C2"]


@pytest.mark.parametrize("ranges", [1, 30])
def test_numbers_of_a_device_with_most_inputs(spark, ranges):
    rows = spark.range(200).select(
        F.lit("ten").alias("ds_schema"),
        F.when(F.col("id") % 4 == 0, "small").otherwise("hot").alias("device_id"),
        F.col("id").alias("arrival"),
    )
    feed = dims(spark, feed=[("ten", "x", "hot", 99990, "i", "NORMAL", "ORI")])["feed"]
    got = V.next_feed_number(rows, feed, ranges).orderBy("arrival").collect()
    assert [r["num"] for r in got if r["device_id"] == "hot"] == list(range(99991, 99991 + 150))
    assert [r["num"] for r in got if r["device_id"] == "small"] == list(range(1, 51))


def test_numbers_over_five_digits_are_not_cut(spark):
    meters, d = resolved(spark, [reading("a", "B2", 1)], feed=[("ten", "x", "d", 123456, "i", "NORMAL", "ORI")])
    assert V.new_feeds(meters, d["feed"]).first()["feed_num"] == "a123457"


def test_same_ids_on_every_run(spark):
    rows = [reading("a", "B2", 1), reading("a", "C2", 2)]
    runs = [{tuple(r) for r in V.registry_upserts(resolved(spark, rows[::d])[0]).collect()} for d in (1, -1)]
    assert runs[0] == runs[1]
