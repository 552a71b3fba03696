"""Master data for meters seen for the first time."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.functions.textfn import bsn_encode, bsn_source, surrogate_id
from wattline.functions.timefn import text_of
from wattline.operators.running import running
from wattline.operators.windows import with_seconds
from wattline.schemas import BSN_VALID, NEW_FEED, ORI

METER = ["meter_key", "sn", "code", "type", "addr"]


def unregistered(readings: DataFrame, registry: DataFrame) -> DataFrame:
    return readings.join(registry.select("meter_key"), "meter_key", "left_anti")


def first_seen(readings: DataFrame) -> DataFrame:
    """The first reading of every meter.

    Per meter and topic it is a hash aggregate of fixed-width values; choosing
    among a meter's few topics is left for the second, small aggregate.
    """
    per_topic = (
        with_seconds(readings)
        .groupBy(*METER, "topic")
        .agg(
            F.min("arrival").alias("arrival"),
            F.min_by("t", "arrival").alias("t"),
            F.min_by("value", "arrival").alias("value"),
        )
    )
    rest = F.struct("sn", "code", "type", "addr", "topic", "t", "value")
    return (
        per_topic.groupBy("meter_key")
        .agg(F.min("arrival").alias("first"), F.min_by(rest, "arrival").alias("r"))
        .select("meter_key", "r.*", F.col("first").alias("arrival"))
    )


def tenant_lookup(meters: DataFrame, key_schema: DataFrame) -> DataFrame:
    """Adds the tenant of the device; devices without one are dropped."""
    tenants = key_schema.where(F.length("ds_schema") > 0).groupBy(F.col("dev_seri_no").alias("sn"))
    return meters.join(tenants.agg(F.min("ds_schema").alias("ds_schema")), "sn")


def known_device(meters: DataFrame, iot_device: DataFrame) -> DataFrame:
    """Adds ``device_id``; unknown and deleted devices are dropped."""
    devices = iot_device.where(F.col("is_del") == 0).groupBy("ds_schema", F.col("dev_seri_no").alias("sn"))
    return meters.join(devices.agg(F.min("id").alias("device_id")), ["ds_schema", "sn"])


def known_topic(meters: DataFrame, topic: DataFrame) -> DataFrame:
    """Adds ``topic_id``; unknown and deleted topics are dropped."""
    topics = topic.where(F.col("is_del") == 0).groupBy("ds_schema", "device_id", F.col("value").alias("topic"))
    return meters.join(topics.agg(F.min("id").alias("topic_id")), ["ds_schema", "device_id", "topic"])


def instrument_match(meters: DataFrame, instrument: DataFrame) -> DataFrame:
    """Adds ``inst_id``, found or new, and ``inst_missing``."""
    key = ["ds_schema", "device_id", "addr", "type"]
    found = instrument.groupBy(*key).agg(F.min("id").alias("found_inst"))
    new_id = surrogate_id("instrument", F.col("device_id"), F.col("addr"), F.col("type"))
    return (
        meters.join(found, key, "left")
        .withColumn("inst_missing", F.col("found_inst").isNull())
        .withColumn("inst_id", F.coalesce("found_inst", new_id))
        .drop("found_inst")
    )


def input_match(meters: DataFrame, input_: DataFrame, feed: DataFrame) -> DataFrame:
    """Adds ``input_id`` and ``feed_id``, found or new, and ``input_missing``."""
    key = ["ds_schema", "inst_id", "code", "addr", "type"]
    inputs = input_.select(
        "ds_schema",
        "inst_id",
        F.col("prop").alias("code"),
        F.col("inst_addr").alias("addr"),
        F.col("inst_type").alias("type"),
        "id",
    )
    found_inputs = inputs.groupBy(*key).agg(F.min("id").alias("found_input"))
    found_feeds = (
        feed.where(F.col("feed_value_type") == ORI)
        .groupBy("ds_schema", F.col("input_id").alias("found_input"))
        .agg(F.min("id").alias("found_feed"))
    )
    return (
        meters.join(found_inputs, key, "left")
        .join(found_feeds, ["ds_schema", "found_input"], "left")
        .withColumn("input_missing", F.col("found_input").isNull())
        .withColumn("input_id", F.coalesce("found_input", surrogate_id("input", F.col("meter_key"))))
        .withColumn("feed_id", F.coalesce("found_feed", F.md5("meter_key")))
        .drop("found_input", "found_feed")
    )


def bsn_match(instruments: DataFrame, iot_bsn: DataFrame) -> DataFrame:
    """Instruments without a valid serial number."""
    valid = iot_bsn.where(F.col("status") == BSN_VALID).select("ds_schema", "inst_id")
    return instruments.join(valid, ["ds_schema", "inst_id"], "left_anti")


def next_feed_number(new_inputs: DataFrame, feed: DataFrame, ranges: int | None = None) -> DataFrame:
    """Adds ``num``: one more per new input of a device, on top of its highest number.

    The count is carried in arrival order, so a device with very many new inputs
    is numbered by several tasks.
    """
    highest = (
        feed.where(F.col("feed_type") == NEW_FEED["feed_type"])
        .groupBy("ds_schema", "device_id")
        .agg(F.max("num").alias("highest"))
    )
    counted = running(
        new_inputs.withColumn("nth", F.lit(1).cast("bigint")),
        ["ds_schema", "device_id"],
        {"nth": F.sum("nth")},
        ranges=ranges,
    )
    return (
        counted.join(highest, ["ds_schema", "device_id"], "left")
        .withColumn("num", F.coalesce("highest", F.lit(0)) + F.col("nth"))
        .drop("nth", "highest")
    )


def resolve_new_meters(readings: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Unregistered meters of known devices and topics, with all their ids.

    The registry comes first: in a running system it removes nearly every
    reading before anything is aggregated.
    """
    meters = first_seen(unregistered(readings, dims["registry"]))
    meters = tenant_lookup(meters, dims["key_schema"])
    meters = known_topic(known_device(meters, dims["iot_device"]), dims["topic"])
    return input_match(instrument_match(meters, dims["instrument"]), dims["input"], dims["feed"])


def new_instruments(meters: DataFrame) -> DataFrame:
    return (
        meters.where("inst_missing")
        .groupBy("ds_schema", "inst_id", "device_id", "addr", "type")
        .agg(F.min_by("topic_id", "arrival").alias("topic_id"))
        .withColumnRenamed("inst_id", "id")
    )


def new_inputs(meters: DataFrame) -> DataFrame:
    return meters.where("input_missing").select(
        "ds_schema",
        F.col("input_id").alias("id"),
        F.col("code").alias("prop"),
        "value",
        text_of(F.col("t")).alias("value_time"),
        F.col("addr").alias("inst_addr"),
        F.col("type").alias("inst_type"),
        "inst_id",
    )


def new_feeds(meters: DataFrame, feed: DataFrame, ranges: int | None = None) -> DataFrame:
    """One original, daily, instant feed per new input, numbered within its device."""
    numbered = next_feed_number(meters.where("input_missing"), feed, ranges)
    # Padded to five digits, never cut.
    digits = F.col("num").cast("string")
    padded = F.when(F.length(digits) < 5, F.lpad(digits, 5, "0")).otherwise(digits)
    return numbered.select(
        "ds_schema",
        F.col("feed_id").alias("id"),
        "device_id",
        F.concat("sn", padded).alias("feed_num"),
        "num",
        F.concat_ws("_", "code", "feed_id").alias("name"),
        F.col("value").alias("last_value"),
        text_of(F.col("t")).alias("update_time"),
        "input_id",
        F.lit(True).alias("is_auto"),
        F.lit(1).alias("interval_value"),
        *[F.lit(v).alias(k) for k, v in NEW_FEED.items()],
        "inst_id",
        F.lit(True).alias("is_default"),
    )


def registry_upserts(meters: DataFrame) -> DataFrame:
    return meters.select("meter_key", "input_id", "feed_id")


def new_bsns(meters: DataFrame, iot_bsn: DataFrame) -> DataFrame:
    """A valid serial number per instrument that has none."""
    instruments = meters.select("ds_schema", "inst_id", "sn", "addr", "type").distinct()
    bsn = bsn_encode(bsn_source(F.col("sn"), F.col("addr"), F.col("type")))
    return bsn_match(instruments, iot_bsn).select(
        "ds_schema",
        surrogate_id("bsn", F.col("inst_id")).alias("id"),
        bsn.alias("bsn"),
        F.lit(BSN_VALID).alias("status"),
        F.lit("new").alias("remarks"),
        "inst_id",
    )


def new_bsn_schemas(bsns: DataFrame) -> DataFrame:
    return bsns.select(surrogate_id("bsn-schema", F.col("id")).alias("id"), "ds_schema", "bsn")


def provision(meters: DataFrame, dims: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Rows to add per table, from ``resolve_new_meters`` (write or persist it first: it is read several times)."""
    bsns = new_bsns(meters, dims["iot_bsn"])
    return {
        "instrument": new_instruments(meters),
        "input": new_inputs(meters),
        "feed": new_feeds(meters, dims["feed"]),
        "registry": registry_upserts(meters),
        "iot_bsn": bsns,
        "bsn_schema": new_bsn_schemas(bsns),
    }
