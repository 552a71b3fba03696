"""Message and formula topics: reading the envelopes, decoding the text."""

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.schemas import ENVELOPE, FORMULA, MESSAGE


def kafka_options(
    servers: str, topics: list[str], starting_timestamp_ms: int = 0, starting_offsets: str = "latest"
) -> dict[str, str]:
    """Options of one Kafka source over several topics; a start time of 0 means the default offsets."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": ",".join(topics)}
    if starting_timestamp_ms:
        options["startingTimestamp"] = str(starting_timestamp_ms)
        options["startingOffsetsByTimestampStrategy"] = "latest"
    else:
        options["startingOffsets"] = starting_offsets
    return options


# Digits that a record's offset and its topic and partition take in the arrival order.
OFFSET_DIGITS, SOURCE_DIGITS = 14, 5


def _within(value: Column, digits: int, what: str) -> Column:
    """``value`` as a decimal of so many digits; anything else stops the job rather than repeat an order."""
    value = value.cast("bigint")
    fits = (value >= 0) & (value < F.lit(10**digits))
    return F.when(fits, value).otherwise(F.raise_error(F.lit(f"{what} is out of the arrival order's range"))).cast(
        f"decimal({digits},0)"
    )


def record_order(topics: list[str]) -> Column:
    """Place of a topic record in the arrival order: broker time, then offset, then topic and partition.

    Whole offsets and partitions go into it, so no two records share a place.
    """
    names = sorted(set(topics))
    topic = F.array_position(F.array(*[F.lit(t) for t in names]), F.col("topic")) - 1
    source = F.when(topic >= 0, F.col("partition") * len(names) + topic)
    millis = F.greatest(F.coalesce(F.unix_millis("timestamp"), F.lit(0)), F.lit(0))
    return (
        _within(millis, 13, "time") * F.lit(Decimal(10 ** (OFFSET_DIGITS + SOURCE_DIGITS)))
        + _within(F.col("offset"), OFFSET_DIGITS, "offset") * F.lit(Decimal(10**SOURCE_DIGITS))
        + _within(source, SOURCE_DIGITS, "topic or partition")
    ).cast("decimal(32,0)")


def record_envelopes(records: DataFrame, topics: list[str]) -> DataFrame:
    """Topic records as Spark's Kafka source gives them, as envelopes."""
    return records.select(
        F.col("value").cast("string").alias("value"),
        record_order(topics).alias("arrival"),
        F.col("timestamp").alias("ingest_ts"),
    )


def read_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Topics as a stream of envelopes; needs Spark's Kafka package on the class path."""
    records = spark.readStream.format("kafka").options(**options).load()
    return record_envelopes(records, options["subscribe"].split(","))


def read_message_stream(spark: SparkSession, paths: list[str], files_per_trigger: int = 1000) -> DataFrame:
    """Envelope files of several topics as one stream."""
    streams = [
        spark.readStream.schema(ENVELOPE).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
        for path in paths
    ]
    merged = streams[0]
    for stream in streams[1:]:
        merged = merged.unionByName(stream)
    return merged


def replay_from(envelopes: DataFrame, start, column: str = "arrival") -> DataFrame:
    """Envelopes from a point on; no start means all of them."""
    return envelopes if not start else envelopes.where(F.col(column) >= F.lit(start))


def decode_messages(envelopes: DataFrame) -> DataFrame:
    """Envelope text to message columns; unparsable text lands in ``corrupt``, empty text is dropped."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt"}
    # A generated row is a barrier: later filters cannot pull copies of from_json below it.
    parsed = F.inline(F.array(F.from_json("value", MESSAGE, options)))
    return envelopes.where(F.length(F.trim("value")) > 0).select(*envelopes.columns, parsed)


def decode_formulas(envelopes: DataFrame) -> DataFrame:
    """Formula text to ``input_id, feed_id, steps, operands, version``; unparsable text is dropped."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt"}
    entries = F.transform(
        F.coalesce("f.computeInputList", F.array().cast(FORMULA["computeInputList"].dataType)),
        lambda o: F.struct(o["inputId"].alias("key"), o["value"].try_cast("double").alias("value")),
    )
    # A repeated operand keeps its last value, as a map filled in order would.
    ids = F.array_distinct(F.transform(F.filter(entries, lambda o: o["key"].isNotNull()), lambda o: o["key"]))
    last = F.map_from_arrays(
        ids, F.transform(ids, lambda i: F.element_at(F.filter(entries, lambda o: o["key"] == i), -1)["value"])
    )
    parsed = F.explode(F.array(F.from_json("value", FORMULA, options))).alias("f")
    return (
        envelopes.select("arrival", parsed)
        .where(F.col("f.corrupt").isNull() & F.col("f.inputId").isNotNull())
        .select(
            F.col("f.inputId").alias("input_id"),
            F.col("f.feedId").alias("feed_id"),
            F.col("f.steps").alias("steps"),
            last.alias("operands"),
            F.col("arrival").alias("version"),
        )
    )
