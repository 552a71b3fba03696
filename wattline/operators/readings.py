"""Messages to readings, and row-level rules on readings."""

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions.textfn import meter_key
from wattline.functions.timefn import parse_time
from wattline.operators.windows import with_seconds
from wattline.schemas import METERED_CODES

# Readings of one message that the arrival order tells apart; a longer message is rejected.
MESSAGE_SLOTS = 1_000_000


def _bad_value(item: Column) -> Column:
    return (F.length(item["value"]) > 0) & item["value"].try_cast("double").isNull()


def check_messages(messages: DataFrame) -> DataFrame:
    """Adds ``reason``: null for a good message, otherwise the first rule it breaks."""
    empty = lambda c: F.coalesce(F.length(c), F.lit(0)) == 0
    reason = (
        F.when(F.col("corrupt").isNotNull(), "bad json")
        .when(empty(F.col("sn")), "no sn")
        .when(empty(F.col("add")), "no add")
        .when(F.coalesce(F.size("data"), F.lit(0)) <= 0, "no data")
        .when(F.size("data") > MESSAGE_SLOTS, "too many readings")
        .when(F.exists("data", _bad_value), "bad value")
        .when(parse_time(F.col("time")).isNull(), "bad time")
    )
    return messages.withColumn("reason", reason)


def valid_messages(messages: DataFrame) -> DataFrame:
    return check_messages(messages).where(F.col("reason").isNull()).drop("reason")


def rejected_messages(messages: DataFrame) -> DataFrame:
    """The other side of ``valid_messages``: bad records with their reason and text."""
    return check_messages(messages).where(F.col("reason").isNotNull()).select("arrival", "reason", "value")


def reading_order(message_order: Column, position: Column) -> Column:
    """Place of a reading in the arrival order: its message's, then its own within the message.

    A decimal, since the order of a live message takes up to 32 digits; out of range raises. Formula
    versions that are to be compared with it go through the same, at position 0.
    """
    return message_order.cast("decimal(32,0)") * F.lit(Decimal(MESSAGE_SLOTS)) + position.cast("decimal(6,0)")


def explode_readings(messages: DataFrame) -> DataFrame:
    """One row per (code, value) of a message, keyed and with a total arrival order.

    A value or flag given as text counts as its number, a missing one as 0.
    """
    flag = lambda c: F.coalesce(F.col(c).cast("string").try_cast("double").try_cast("int"), F.lit(0)).alias(c)
    items = messages.select("*", F.posexplode("data").alias("pos", "item"))
    value = F.coalesce(F.col("item.value").try_cast("double"), F.lit(0.0))
    return items.select(
        "sn",
        "topic",
        parse_time(F.col("time")).alias("ts"),
        "type",
        F.col("add").alias("addr"),
        F.col("item.code").alias("code"),
        value.alias("value"),
        flag("from").alias("origin"),
        flag("delay"),
        reading_order(F.col("arrival"), F.col("pos")).alias("arrival"),
        meter_key(F.col("sn"), F.col("item.code"), F.col("type"), F.col("add")).alias("meter_key"),
    )


def metered_codes(readings: DataFrame) -> DataFrame:
    return readings.where(F.col("code").isin(METERED_CODES))


def ten_minute_grid(readings: DataFrame) -> DataFrame:
    return with_seconds(readings).where(F.pmod("t", F.lit(600)) == 0)


def grid_readings(readings: DataFrame) -> DataFrame:
    """What usage is computed from: metered codes on the 10-minute grid."""
    return ten_minute_grid(metered_codes(readings))


def nonempty_code(readings: DataFrame) -> DataFrame:
    return readings.where(F.length("code") > 0)


def merge_origins(live: DataFrame, history: DataFrame) -> DataFrame:
    """Live and historical readings as one, told apart by ``origin`` (0 live, 1 history)."""
    return live.withColumn("origin", F.lit(0)).unionByName(
        history.withColumn("origin", F.lit(1)), allowMissingColumns=True
    )


def in_cohort(readings: DataFrame, cohort: DataFrame) -> DataFrame:
    """Readings the new job takes over during a rollout."""
    return readings.join(cohort.select("sn"), "sn", "left_semi")


def outside_cohort(readings: DataFrame, cohort: DataFrame) -> DataFrame:
    """Readings the old job keeps during a rollout."""
    return readings.join(cohort.select("sn"), "sn", "left_anti")


def reconcile(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """Compares two outputs document by document; keys are unique on each side."""
    left = old.select(key, F.col(value).alias("old_value"), F.lit(True).alias("_old"))
    right = new.select(key, F.col(value).alias("new_value"), F.lit(True).alias("_new"))
    status = (
        F.when(F.col("_new").isNull(), "only old")
        .when(F.col("_old").isNull(), "only new")
        .when(F.col("old_value").eqNullSafe(F.col("new_value")), "equal")
        .otherwise("different")
    )
    return left.join(right, key, "full").select(key, "old_value", "new_value", status.alias("status"))
