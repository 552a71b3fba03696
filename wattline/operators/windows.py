"""Closed windows: a reading on a boundary ends one window and begins the next."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.functions.timefn import seconds_of, step_after, step_before, step_start, text_of
from wattline.schemas import USAGE_STEPS


def with_seconds(readings: DataFrame) -> DataFrame:
    """Adds ``t``, the wall-clock seconds of ``ts``."""
    return readings if "t" in readings.columns else readings.withColumn("t", seconds_of(F.col("ts")))


def assign_closed_windows(readings: DataFrame, steps: list[str] = USAGE_STEPS) -> DataFrame:
    """One row per reading and window [ws, we] with ws <= t <= we.

    All steps come out of one pass over the readings.  A window that does not
    apply is a null element and is filtered right behind the generator, within
    the same generated code; filtering the array itself would be interpreted.
    """
    rows, t = with_seconds(readings), F.col("t")
    windows = []
    for step in steps:
        start = step_start(t, step)
        windows.append(_window(step, start))
        windows.append(F.when(start == t, _window(step, step_before(start, step))))
    return rows.select(*rows.columns, F.inline(F.array(*windows))).where(F.col("step").isNotNull())


def _window(step, start):
    return F.struct(F.lit(step).alias("step"), start.alias("ws"), step_after(start, step).alias("we"))


def half_hour_right_closed(readings: DataFrame) -> DataFrame:
    """Adds the half hour (start, end] a grid reading lies in, as text."""
    t = F.col("t")
    end = t + F.pmod(-t, F.lit(1800))
    return (
        with_seconds(readings)
        .withColumn("start_text", text_of(end - 1800))
        .withColumn("end_text", text_of(end))
    )
