"""The historical store: messages partitioned by day, scanned by meter and time range."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.functions.timefn import seconds_from_epoch, seconds_of, text_of
from wattline.schemas import HISTORY_PAYLOAD, ZONE_OFFSET_HOURS


def write_history(history: DataFrame, path: str) -> None:
    """Partitioned by day and, within a day, written in row-key order so that file statistics prune."""
    (
        history.repartitionByRange("day", "sn", "time")
        .sortWithinPartitions("day", "sn", "type", "addr", "time")
        .write.mode("overwrite")
        .partitionBy("day")
        .parquet(path)
    )


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def status_filter(history: DataFrame) -> DataFrame:
    """Rows in order, and rows that carry no status."""
    return history.where((F.col("status") == 0) | F.col("status").isNull())


def scan_history(history: DataFrame, sn: str, type_: str, addr: str, stime: str, etime: str) -> DataFrame:
    """Good rows of one meter with stime <= time < etime; day and key filters reach the files."""
    start, end = (_wall(t) for t in (stime, etime))
    offset = ZONE_OFFSET_HOURS * 3600
    return status_filter(history).where(
        (F.col("sn") == sn)
        & (F.col("type") == type_)
        & (F.col("addr") == addr)
        & F.col("day").between(F.to_date(F.lit(stime[:10])), F.to_date(F.lit(etime[:10])))
        & (F.col("time") >= start - offset)
        & (F.col("time") < end - offset)
    )


def _wall(text: str):
    return seconds_of(F.lit(text).cast("timestamp_ntz"))


def backfill_ranges(history: DataFrame, requests: DataFrame) -> DataFrame:
    """All requests in one pass: rows matching several requests appear once for each.

    Requests are spelt out per day they touch.  The join is then an equality on
    meter and day, which spreads a busy meter over its days, prunes day
    partitions, and leaves only the range's ends to a filter.
    """
    offset = ZONE_OFFSET_HOURS * 3600
    last = F.timestamp_add("SECOND", F.lit(-1), F.col("etime")).cast("date")
    days = F.sequence(F.col("stime").cast("date"), last)
    wanted = requests.where(F.col("stime") < F.col("etime")).select(
        "request",
        "sn",
        "type",
        "addr",
        (seconds_of(F.col("stime")) - offset).alias("_from"),
        (seconds_of(F.col("etime")) - offset).alias("_until"),
        F.explode(days).alias("day"),
    )
    in_range = (F.col("time") >= F.col("_from")) & (F.col("time") < F.col("_until"))
    return (
        status_filter(history).join(wanted, ["sn", "type", "addr", "day"]).where(in_range).drop("_from", "_until")
    )


def peek(history: DataFrame, rows: int = 10) -> DataFrame:
    """The first rows in row-key order."""
    return history.orderBy(F.reverse("sn"), "type", "addr", "time", "arrival").limit(rows)


def decode_history_payload(history: DataFrame) -> DataFrame:
    """Stored rows as messages: payload parsed, epoch seconds as local time, origin 1.

    As on the topics, an unparsable payload lands in ``corrupt``; the rules on messages reject it, and values
    that are no numbers.
    """
    data = F.from_json("payload", HISTORY_PAYLOAD)
    seconds = seconds_from_epoch(F.col("time"))
    return history.select(
        "sn",
        "topic",
        text_of(seconds).alias("time"),
        "type",
        F.col("addr").alias("add"),
        data.alias("data"),
        F.lit(1).alias("from"),
        "delay",
        F.when(data.isNull(), F.col("payload")).alias("corrupt"),
        F.col("payload").alias("value"),
        "arrival",
    )


