from decimal import Decimal

import brute
import pytest
from metering import random_readings, readings, seconds
from pyspark.sql import Window
from pyspark.sql import functions as F

from wattline.functions.timefn import epoch_seconds
from wattline.operators import usage as U
from wattline.operators.running import running
from wattline.operators.windows import assign_closed_windows, half_hour_right_closed
from wattline.schemas import USAGE_STEPS

EIGHT = 8 * 3600


def documents(df, with_arrival=False):
    key = ("feed_id", "step", "start_time", "end_time") + (("arrival",) if with_arrival else ())
    rows = df.collect()
    out = {tuple(r[k] for k in key): round(r["data_value"], 6) for r in rows}
    assert len(out) == len(rows)
    return out


def expected(values):
    return {(f, s, ws - EIGHT, we - EIGHT): round(v, 6) for (f, s, ws, we), v in values.items()}


@pytest.mark.parametrize(
    "time,step,starts",
    [
        ("2024-01-10 01:00:00", "30m", ["2024-01-10 01:00:00", "2024-01-10 00:30:00"]),
        ("2024-01-10 01:30:00", "30m", ["2024-01-10 01:30:00", "2024-01-10 01:00:00"]),
        ("2024-01-10 01:10:00", "30m", ["2024-01-10 01:00:00"]),
        ("2024-01-10 02:00:00", "1h", ["2024-01-10 02:00:00", "2024-01-10 01:00:00"]),
        ("2024-01-10 02:30:00", "1h", ["2024-01-10 02:00:00"]),
        ("2020-05-05 00:00:00", "1d", ["2020-05-05 00:00:00", "2020-05-04 00:00:00"]),
        ("2020-06-01 00:00:00", "1n", ["2020-06-01 00:00:00", "2020-05-01 00:00:00"]),
        ("2020-01-01 00:00:00", "1n", ["2020-01-01 00:00:00", "2019-12-01 00:00:00"]),
        ("2020-06-02 00:00:00", "1n", ["2020-06-01 00:00:00"]),
    ],
)
def test_boundary_readings_close_the_window_before(spark, time, step, starts):
    rows = assign_closed_windows(readings(spark, [("f", time, 1, 1)]), [step]).collect()
    assert {r["ws"] for r in rows} == {seconds(s) for s in starts} and len(rows) == len(starts)
    assert all(r["ws"] <= r["t"] <= r["we"] for r in rows)


def test_right_closed_half_hours(spark):
    times = ["00:00:00", "00:10:00", "00:20:00", "00:30:00", "00:40:00", "00:50:00"]
    rows = readings(spark, [("f", f"2024-01-01 {t}", i, 1) for i, t in enumerate(times)])
    got = [(r["start_text"][11:16], r["end_text"][11:16]) for r in half_hour_right_closed(rows).orderBy("t").collect()]
    assert got == [("23:30", "00:00")] + 3 * [("00:00", "00:30")] + 2 * [("00:30", "01:00")]


def test_published_epochs_are_at_plus_eight(spark):
    t = seconds("2020-05-11 10:10:00")
    assert spark.range(1).select(epoch_seconds(F.lit(t))).first()[0] == 1589163000


def test_single_reading_is_zero(spark):
    got = documents(U.usage(readings(spark, [("f", "2024-01-10 01:10:00", 1, 7.5)])))
    assert set(got.values()) == {0.0} and len(got) == 4


def test_late_and_tied_readings(spark):
    base = [("f", "2024-01-10 01:10:00", 1, 10), ("f", "2024-01-10 01:20:00", 2, 15)]

    def half(rows):
        return documents(U.usage(readings(spark, base + rows), ["30m"]))

    (value,) = half([]).values()
    assert value == 5.0
    # Earlier in time: becomes the start for its windows.
    assert sorted(half([("f", "2024-01-10 01:00:00", 3, 8)]).values()) == [0.0, 7.0]
    # In between: changes nothing.
    assert half([("f", "2024-01-10 01:15:00", 3, 99)]) == half([])
    # Equal times: the later arrival wins at either end.
    assert list(half([("f", "2024-01-10 01:20:00", 3, 18)]).values()) == [8.0]
    assert list(half([("f", "2024-01-10 01:10:00", 3, 11)]).values()) == [4.0]


def test_decimal_difference_is_exact(spark):
    rows = [("f", "2024-01-10 01:10:00", 1, 0.1), ("f", "2024-01-10 01:20:00", 2, 0.3)]
    assert U.usage(readings(spark, rows), ["30m"]).first()["data_value"] == 0.2


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_usage_equals_reading_by_reading(spark, seed):
    rows = random_readings(1500, seed=seed)
    assert documents(U.usage(readings(spark, rows))) == expected(brute.final(brute.changelog(rows, USAGE_STEPS)))


def test_steps_alone_equal_steps_together(spark):
    df = readings(spark, random_readings(600))
    together = documents(U.usage(df))
    alone = {}
    for step in USAGE_STEPS:
        alone.update(documents(U.usage(df, [step])))
    assert alone == together


def test_row_order_does_not_matter(spark):
    rows = random_readings(600)
    assert documents(U.usage(readings(spark, rows))) == documents(U.usage(readings(spark, rows[::-1])))


@pytest.mark.parametrize("ranges", [1, 7, 20])
def test_changelog_equals_reading_by_reading(spark, ranges):
    rows = random_readings(700)
    want = {
        (f, s, ws - EIGHT, we - EIGHT, a): round(v, 6)
        for f, s, ws, we, a, v in brute.changelog(rows, USAGE_STEPS)
    }
    assert documents(U.usage_changelog(readings(spark, rows), ranges=ranges), True) == want


def test_last_changelog_row_is_the_usage(spark):
    df = readings(spark, random_readings(500))
    log = U.usage_changelog(df, ranges=10)
    last = log.groupBy("doc_id").agg(F.max_by("data_value", "arrival").alias("v"))
    final = U.usage(df).select("doc_id", F.col("data_value").alias("v"))
    assert last.exceptAll(final).isEmpty() and final.exceptAll(last).isEmpty()


@pytest.mark.parametrize("ranges", [1, 9])
def test_out_of_order_delta_and_start(spark, ranges):
    rows = random_readings(900, seed=5)
    df = readings(spark, rows)
    kept = {r["arrival"] for r in U.drop_out_of_order(df, ranges).collect()}
    assert kept == {r[2] for r in brute.in_order(rows)} and len(kept) < len(rows)
    assert documents(U.usage_delta(df, ranges=ranges)) == expected(brute.delta(rows, ["30m", "1h"]))
    assert documents(U.usage_from_start(df, ranges=ranges)) == expected(brute.from_start(rows, ["1d", "1n"]))


@pytest.mark.parametrize("ranges", [1, 5, 30])
@pytest.mark.parametrize("current", [True, False])
def test_running_equals_one_window_per_key(spark, ranges, current):
    df = readings(spark, random_readings(400)).withColumn("high", F.col("value")).withColumn("sum", F.col("value"))
    frame = Window.partitionBy("feed_id").orderBy("arrival").rowsBetween(
        Window.unboundedPreceding, 0 if current else -1
    )
    carry = {"high": F.max("high"), "sum": F.sum("sum")}
    want = df.select("arrival", F.max("high").over(frame).alias("high"), F.round(F.sum("sum").over(frame), 6).alias("sum"))
    got = running(df, ["feed_id"], carry, current, ranges=ranges).select(
        "arrival", "high", F.round("sum", 6).alias("sum")
    )
    assert sorted(got.collect()) == sorted(want.collect())


def test_phase_keeps_one_document_per_feed_and_time(spark):
    rows = readings(spark, [("f", "2024-01-10 01:10:00", 1, 1), ("f", "2024-01-10 01:10:00", 2, 3)])
    (doc,) = U.usage_phase(rows.withColumn("code", F.lit("B2"))).collect()
    assert (doc["doc_id"], doc["prop"], doc["data_value"]) == ("f_2024-01-10 01:10:00", "B2", 3.0)


def test_rollup_steps(spark):
    rows = readings(spark, [("f", "2024-02-29 23:59:30", 1, 1), ("f", "2024-02-29 23:50:00", 2, 3)])
    got = {r["step"]: r for r in U.feed_rollup(rows).groupBy("step").agg(F.max("ws").alias("ws"), F.max("sum_value").alias("s")).collect()}
    assert got["1n"]["ws"] == seconds("2024-02-01 00:00:00") and got["1y"]["ws"] == seconds("2024-01-01 00:00:00")
    assert got["10m"]["s"] == 4.0 and got["1m"]["s"] == 3.0


def test_rollup_sums_are_exact_in_any_order(spark):
    values = [0.1, 0.2, -0.3, 1e9, 123456.789, -1e9, 1e300, 0.7, 0.000000001] * 40
    rows = [("f" if i % 3 else "g", f"2024-{1 + i % 12:02d}-{1 + i % 28:02d} {i % 24:02d}:{i % 60:02d}:00", i, v) for i, v in enumerate(values)]
    rows = [r for r in rows if r[0] == "f" or r[3] != 1e300]
    got = {(r["feed_id"], r["step"], r["ws"]): r for r in U.feed_rollup(readings(spark, rows)).collect()}
    for feed, start, length in (("g", "2024-01-01 00:00:00", 31_622_400), ("f", "2024-05-01 00:00:00", 2_678_400)):
        own = [v for f, t, _, v in rows if f == feed and 0 <= seconds(t) - seconds(start) < length]
        row = got[feed, "1y" if length > 3e6 else "1n", seconds(start)]
        assert (row["max_value"], row["min_value"]) == (max(own), min(own))
        if 1e300 not in own:
            total = sum(map(Decimal, map(repr, own)))
            assert (row["sum_value"], row["avg_value"]) == (float(total), float(total) / len(own))
    assert sorted(map(repr, got.values())) == sorted(map(repr, U.feed_rollup(readings(spark, rows[::-1]).repartition(5)).collect()))


def test_rollup_exchanges_readings_once(spark):
    rows = readings(spark, random_readings(500)).repartition(4)
    rollup = U.feed_rollup(rows)
    rollup.collect()
    plan = rollup._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    # One exchange of readings, read twice; the other one is of the days' states.
    made = [x for x in final.splitlines() if "Exchange hashpartitioning" in x and "ReusedExchange" not in x]
    assert sorted("REPARTITION_BY_COL" in x for x in made) == [False, True] and "ReusedExchange" in final


def test_outputs_split_by_step(spark):
    parts = U.split_outputs(U.usage(readings(spark, random_readings(100))))
    assert list(parts) == USAGE_STEPS
    for step, part in parts.items():
        assert {r["step"] for r in part.select("step").distinct().collect()} == {step}


def test_merged_batches_equal_one_run(spark):
    rows = random_readings(600, seed=9)
    whole = documents(U.usage(readings(spark, rows)))
    parts = [U.batch_ends(readings(spark, rows[i::3])) for i in range(3)]
    assert documents(U.merge_ends(parts[0].unionByName(parts[1]).unionByName(parts[2]))) == whole
    # Folding some batches first changes nothing.
    folded = U.fold_ends(parts[0].unionByName(parts[1]))
    assert documents(U.merge_ends(folded.unionByName(parts[2]))) == whole


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Shanghai"])
def test_session_zone_changes_nothing(spark, zone):
    rows = readings(spark, [("f", "2024-03-10 02:00:00", 1, 1), ("f", "2024-03-10 02:30:00", 2, 4), ("f", "2024-03-10 03:00:00", 3, 9)])
    want = sorted(U.usage(rows).collect())
    spark.conf.set("spark.sql.session.timeZone", zone)
    assert sorted(U.usage(rows).collect()) == want


def test_usage_plan_combines_before_every_shuffle(spark):
    plan = U.usage(readings(spark, random_readings(10)))._jdf.queryExecution().toString()
    physical = plan[plan.index("Physical Plan"):]
    assert "SortAggregate" not in physical and "Window" not in physical
    assert physical.count("Exchange hashpartitioning") == 3 and physical.count("partial_max_by") == 3
