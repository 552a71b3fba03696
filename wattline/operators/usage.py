"""Usage per feed and closed window: last register value minus first."""

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions.numbers import subtract
from wattline.functions.textfn import phase_id, usage_id
from wattline.functions.timefn import STEP_SECONDS, epoch_seconds, step_after, step_start, text_of
from wattline.operators.running import in_ranges, running
from wattline.operators.windows import assign_closed_windows, with_seconds
from wattline.schemas import ALL_STEPS, USAGE_STEPS

WINDOW = ["feed_id", "step", "ws", "we"]


def latest_per_instant(readings: DataFrame) -> DataFrame:
    """One row per feed and instant, with its arrival: of equal times the later one wins.

    Order and value are fixed-width, so both halves are hash aggregates, and the
    partial half runs before the shuffle whatever the share of a single feed.
    """
    winner = [F.max_by("value", "arrival").alias("value"), F.max("arrival").alias("arrival")]
    return with_seconds(readings).groupBy("feed_id", "t").agg(*winner)


def window_ends(readings: DataFrame, steps: list[str] = USAGE_STEPS, also_by: list[str] = ()) -> DataFrame:
    """Earliest and latest reading of every closed window, from readings without ties.

    Plain min_by / max_by over time: no sort, and combined before the shuffle.
    """
    carried = [c for c in ("value", "arrival") if c in readings.columns]
    return (
        assign_closed_windows(readings, steps)
        .groupBy(*WINDOW, *also_by)
        .agg(
            F.min("t").alias("first_t"),
            F.max("t").alias("last_t"),
            *[F.min_by(c, "t").alias(f"first_{c}") for c in carried],
            *[F.max_by(c, "t").alias(f"last_{c}") for c in carried],
        )
    )


def widen(ends: DataFrame, steps: list[str]) -> DataFrame:
    """Ends of wider windows from the ends of the windows they are made of."""
    start = F.col("ws")
    wider = [
        F.struct(
            F.lit(s).alias("step"),
            step_start(start, s).alias("ws"),
            step_after(step_start(start, s), s).alias("we"),
        )
        for s in steps
    ]
    kept = ["first_t", "last_t", "first_value", "last_value"]
    return (
        ends.select("feed_id", *kept, F.inline(F.array(*wider)))
        .groupBy(*WINDOW)
        .agg(
            F.min_by("first_value", "first_t").alias("first_value"),
            F.max_by("last_value", "last_t").alias("last_value"),
        )
    )


def usage(readings: DataFrame, steps: list[str] = USAGE_STEPS) -> DataFrame:
    """Usage documents, final per feed and window; ``steps`` go from narrow to wide.

    With ties settled first, time alone orders a window's readings.  Only the
    narrowest windows are made from readings; wider ones are made from them.
    """
    ends = window_ends(latest_per_instant(readings), steps[:1])
    if len(steps) > 1:
        ends = widen(ends, steps)
    return usage_documents(ends, subtract(F.col("last_value"), F.col("first_value")))


def batch_ends(readings: DataFrame, steps: list[str] = USAGE_STEPS) -> DataFrame:
    """Window ends of one batch, with the arrivals needed to merge them with other batches."""
    return window_ends(latest_per_instant(readings), steps)


def fold_ends(ends: DataFrame) -> DataFrame:
    """Window ends of any number of batches as those of one; of equal times the later arrival counts."""
    first = F.struct("first_t", (-F.col("first_arrival")).alias("o"), "first_value")
    last = F.struct("last_t", "last_arrival", "last_value")
    folded = ends.groupBy(*WINDOW).agg(F.min(first).alias("first"), F.max(last).alias("last"))
    return folded.select(
        *WINDOW,
        "first.first_t",
        (-F.col("first.o")).alias("first_arrival"),
        "first.first_value",
        "last.last_t",
        "last.last_arrival",
        "last.last_value",
    )


def merge_ends(ends: DataFrame) -> DataFrame:
    """Usage documents from the window ends of any number of batches."""
    return usage_documents(fold_ends(ends), subtract(F.col("last_value"), F.col("first_value")))


def usage_documents(windows: DataFrame, value) -> DataFrame:
    """Published shape of usage rows, with the id they are upserted under."""
    start, end = epoch_seconds(F.col("ws")), epoch_seconds(F.col("we"))
    return windows.select(
        usage_id(F.col("feed_id"), start, end).alias("doc_id"),
        "feed_id",
        "step",
        start.alias("start_time"),
        end.alias("end_time"),
        text_of(F.col("we")).alias("data_time"),
        value.alias("data_value"),
        *[c for c in ("arrival",) if c in windows.columns],
    )


def usage_changelog(readings: DataFrame, steps: list[str] = USAGE_STEPS, ranges: int | None = None) -> DataFrame:
    """Every version of every usage document, in arrival order.

    Per window the earliest and the latest reading so far are carried along;
    of equal times the later arrival replaces the earlier one at both ends.
    """
    ranged = in_ranges(with_seconds(readings).select("feed_id", "t", "value", "arrival"), ranges=ranges)
    rows = assign_closed_windows(ranged, steps).select(
        *WINDOW, "_chunk", "arrival", *_ends_so_far(F.col("t"), F.col("arrival"), F.col("value"), F.col("arrival"), F.col("value"))
    )
    carry = {"first": F.min("first"), "last": F.max("last")}
    ends = running(rows, WINDOW, carry, totals=_range_ends(ranged, steps))
    return usage_documents(ends, subtract(F.col("last.v"), F.col("first.v")))


def _ends_so_far(t, first_arrival, first_value, last_arrival, last_value, last_t=None):
    """Both ends as structs that sort by time, then by who wins a tie."""
    return (
        F.struct(t.alias("t"), (-first_arrival).alias("o"), first_value.alias("v")).alias("first"),
        F.struct((t if last_t is None else last_t).alias("t"), last_arrival.alias("o"), last_value.alias("v")).alias("last"),
    )


def _range_ends(ranged: DataFrame, steps: list[str]) -> DataFrame:
    """Both ends per window and range: ties first, so that fixed-width hash aggregates do it."""
    ties = (
        ranged.groupBy("feed_id", "t", "_chunk")
        .agg(F.max_by("value", "arrival").alias("value"), F.max("arrival").alias("arrival"))
    )
    ends = window_ends(ties, steps, ["_chunk"])
    first = [F.col(c) for c in ("first_t", "first_arrival", "first_value")]
    last = [F.col(c) for c in ("last_arrival", "last_value", "last_t")]
    return ends.select(*WINDOW, "_chunk", *_ends_so_far(*first, *last))


def usage_phase(readings: DataFrame) -> DataFrame:
    """Accepted grid readings as documents keyed by feed and time; the later arrival wins and is returned."""
    latest = (
        with_seconds(readings)
        .groupBy("feed_id", "t")
        .agg(F.max_by(F.struct("code", "value"), "arrival").alias("r"), F.max("arrival").alias("arrival"))
    )
    time = text_of(F.col("t"))
    return latest.select(
        phase_id(F.col("feed_id"), time).alias("doc_id"),
        "feed_id",
        F.col("r.code").alias("prop"),
        F.col("r.value").alias("data_value"),
        time.alias("data_time"),
        "arrival",
    )


def drop_out_of_order(readings: DataFrame, ranges: int | None = None) -> DataFrame:
    """Drops readings older than the newest of their feed that arrived before; equal times pass."""
    rows = with_seconds(readings).withColumn("newest", F.col("t"))
    seen = running(rows, ["feed_id"], {"newest": F.max("newest")}, include_current=False, ranges=ranges)
    return seen.where(F.col("newest").isNull() | (F.col("t") >= F.col("newest"))).drop("newest")


def feed_last_time(readings: DataFrame) -> DataFrame:
    """Time of the newest accepted reading per feed."""
    return with_seconds(readings).groupBy("feed_id").agg(F.max("t").alias("t"))


def usage_delta(readings: DataFrame, steps: list[str] = ("30m", "1h"), ranges: int | None = None) -> DataFrame:
    """Sum of differences to the feed's previous reading, a window's first reading adding 0.

    Once out-of-order readings are gone, a window's readings are neighbours in
    the feed's arrival order, so the differences add up to last minus first.
    """
    ends = (
        assign_closed_windows(drop_out_of_order(readings, ranges), list(steps))
        .groupBy(*WINDOW)
        .agg(F.min_by("value", "arrival").alias("first_value"), F.max_by("value", "arrival").alias("last_value"))
    )
    return usage_documents(ends, subtract(F.col("last_value"), F.col("first_value")))


def usage_from_start(readings: DataFrame, steps: list[str] = ("1d", "1n"), ranges: int | None = None) -> DataFrame:
    """Newest arrival minus the window's start value.

    The start is the last reading exactly on the window start, or else the first to arrive.
    """
    on_start = F.when(F.col("t") == F.col("ws"), F.col("arrival"))
    ends = (
        assign_closed_windows(drop_out_of_order(readings, ranges), list(steps))
        .groupBy(*WINDOW)
        .agg(
            F.coalesce(F.max_by("value", on_start), F.min_by("value", "arrival")).alias("start_value"),
            F.max_by("value", "arrival").alias("last_value"),
        )
    )
    return usage_documents(ends, subtract(F.col("last_value"), F.col("start_value")))


def _partial() -> list[Column]:
    """A mergeable state of many values. Those that 18 digits hold with nine places add up as whole numbers, units and
    billionths apart, which no order of adding changes; others, as doubles."""
    return [
        F.max("value").alias("max_value"), F.min("value").alias("min_value"), F.count("value").alias("n"),
        F.sum("units").alias("units"), F.sum("nanos").alias("nanos"), F.sum("other").alias("other"),
    ]


def _merged() -> list[Column]:
    sums = ("n", "units", "nanos", "other")
    return [F.max("max_value").alias("max_value"), F.min("min_value").alias("min_value"), *(F.sum(c).alias(c) for c in sums)]


def feed_rollup(readings: DataFrame, steps: list[str] = ALL_STEPS) -> DataFrame:
    """Largest, smallest, mean and total value of a feed per half-open step.

    Readings are exchanged once and one row each, by feed and day. Steps within a day are aggregated where the day
    lies, without another exchange; longer ones are merged from the days' states.
    """
    exact = F.col("value").try_cast("decimal(18,9)")
    whole = F.coalesce(exact.cast("double") == F.col("value"), F.lit(False))
    scaled = (exact * F.lit(10**9).cast("decimal(10,0)")).cast("bigint")
    rows = with_seconds(readings).select(
        "feed_id",
        "t",
        step_start(F.col("t"), "1d").alias("day"),
        "value",
        F.when(whole, exact.cast("bigint")).alias("units"),
        F.when(whole, scaled - exact.cast("bigint") * 10**9).alias("nanos"),
        F.when(~whole, F.col("value")).alias("other"),
    )
    rows = rows.repartition("feed_id", "day")
    within = [s for s in steps if 86400 % STEP_SECONDS.get(s, 86401) == 0]
    longer = [s for s in steps if s not in within]
    starts = lambda of, names: F.inline(F.array(*[F.struct(F.lit(s).alias("step"), step_start(F.col(of), s).alias("ws")) for s in names]))
    parts = []
    if within:
        each = rows.select("*", starts("t", within)).groupBy("feed_id", "day", "step", "ws")
        parts.append(each.agg(*_partial()).drop("day"))
    if longer:
        # By ``t`` again, so that both readers of the exchange want the same columns of it and share it.
        days = rows.groupBy("feed_id", "day", step_start(F.col("t"), "1d").alias("start")).agg(*_partial())
        parts.append(days.select("*", starts("start", longer)).groupBy("feed_id", "step", "ws").agg(*_merged()))
    states = reduce(DataFrame.unionByName, parts)
    billionth = F.lit(Decimal("0.000000001"))
    total = F.coalesce("units", F.lit(0)).cast("decimal(20,0)") + F.coalesce("nanos", F.lit(0)).cast("decimal(20,0)") * billionth
    total = F.when(F.col("n") > 0, total.cast("double") + F.coalesce("other", F.lit(0.0)))
    return states.select("feed_id", "step", "ws", "max_value", "min_value", F.try_divide(total, F.col("n")).alias("avg_value"), total.alias("sum_value"))


def split_outputs(documents: DataFrame) -> dict[str, DataFrame]:
    """One output per step, all of one computation; persist ``documents`` when writing more than one."""
    return {step: documents.where(F.col("step") == step) for step in USAGE_STEPS}
