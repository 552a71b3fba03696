"""Metering inputs derived from the given tables, one row from one row.

Readings, messages and history come from ``events``, devices and what hangs on
them from ``supplier``, meters from ``customer`` and formula messages from
``part``.  A third of the events is of devices 0 to 4, so that some keys are hot; the
rest is of half the devices, which grow with the data.  The others are silent.
``oracle.py`` states the same derivation in SQL.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.functions.textfn import meter_key, surrogate_id
from wattline.functions.timefn import seconds_of, text_of, time_of

CODES = ["A29", "B2", "C2", "D4", "A10"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sn(number) -> Column:
    """``SN`` and the number, padded to four digits, never cut."""
    digits = number.cast("string")
    return F.concat(F.lit("SN"), F.when(F.length(digits) < 4, F.lpad(digits, 4, "0")).otherwise(digits))


def _meter(number) -> dict[str, Column]:
    """Columns of the meter with this number: ten meters per device, five codes at two addresses."""
    sn = _sn(F.floor(number / 10))
    code = F.get(F.array(*[F.lit(c) for c in CODES]), (number % 5).cast("int"))
    addr = F.when(number % 10 < 5, "1").otherwise("2")
    key = meter_key(sn, code, F.lit("1"), addr)
    return {"sn": sn, "code": code, "type": F.lit("1"), "addr": addr, "meter_key": key}


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw readings of devices with two addresses, one register per code."""
    e = F.col("event_id")
    raw = seconds_of(F.col("ts"))
    code = (
        F.when(F.col("event_type") == "view", "A29")
        .when(F.col("event_type") == "click", "B2")
        .when(F.col("event_type") == "purchase", "C2")
        .when(F.col("event_type") == "error", "D4")
        .otherwise("A10")
    )
    user = F.col("user_id")
    sn = _sn(F.when(e % 3 == 0, user % 5).otherwise(F.expr("user_id DIV 3")))
    addr = F.when(user % 7 == 0, "2").otherwise("1")
    return table(spark, sf_dir, "events").select(
        "event_id",
        sn.alias("sn"),
        F.concat(F.lit("meters/"), sn, F.when(addr == "2", "/sub").otherwise("")).alias("topic"),
        code.alias("code"),
        F.lit("1").alias("type"),
        addr.alias("addr"),
        F.when(e % 4 != 0, raw - F.pmod(raw, F.lit(600))).otherwise(raw).alias("t"),
        (e * 2 + F.when(e % 11 == 0, 81).otherwise(0)).alias("arrival"),
        ((e * 25 + F.round(F.col("value") * 100).cast("bigint")) / 100.0).alias("value"),
        F.col("ts").alias("ingest_ts"),
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat readings with their own (original) feed."""
    key = meter_key(F.col("sn"), F.col("code"), F.col("type"), F.col("addr"))
    return _events(spark, sf_dir).select(
        "event_id",
        "sn",
        "topic",
        "code",
        "type",
        "addr",
        key.alias("meter_key"),
        F.md5(key).alias("feed_id"),
        "t",
        time_of(F.col("t")).alias("ts"),
        "arrival",
        "value",
    )


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device messages as text with their time of ingestion: mostly one reading each, some two, some broken."""
    e = F.col("event_id")
    own = F.struct("code", F.when(e % 97 == 0, "abc").otherwise(F.col("value").cast("string")).alias("value"))
    extra = F.struct(F.lit("A10").alias("code"), F.when(e % 2 == 0, "12.5").alias("value"))
    data = F.when(e % 71 == 0, F.array().cast("array<struct<code:string,value:string>>")).otherwise(
        F.when(e % 5 == 0, F.array(own, extra)).otherwise(F.array(own))
    )
    body = F.struct(
        F.when(e % 73 == 0, "").otherwise(F.col("sn")).alias("sn"),
        "topic",
        F.when(e % 101 == 0, "yesterday").otherwise(text_of(F.col("t"))).alias("time"),
        "type",
        F.when(e % 79 != 0, F.col("addr")).alias("add"),
        data.alias("data"),
        F.when(e % 11 == 0, 1).otherwise(0).alias("from"),
        F.when(e % 11 == 0, 1).alias("delay"),
    )
    text = F.when(e % 83 == 0, "not json").when(e % 89 == 0, "").otherwise(F.to_json(body))
    return _events(spark, sf_dir).select(text.alias("value"), "arrival", "ingest_ts")


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The historical store: one row per message with its payload, epoch time and status."""
    e = F.col("event_id")
    payload = F.to_json(F.array(F.struct("code", F.col("value").cast("string").alias("value"))))
    return _events(spark, sf_dir).select(
        "sn",
        "type",
        "addr",
        (F.col("t") - 8 * 3600).alias("time"),
        time_of(F.col("t")).cast("date").alias("day"),
        "topic",
        F.when(e % 11 == 0, 1).otherwise(0).alias("delay"),
        F.when(e % 7 == 0, None).when(e % 5 == 0, 1).otherwise(0).alias("status"),
        payload.alias("payload"),
        "arrival",
    )


def meters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (device, code, address) that can report."""
    number = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.floor(number / 10).alias("device"), *[c.alias(name) for name, c in _meter(number).items()]
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known meters: all but code D4 and all but those of every fifth device."""
    known = meters(spark, sf_dir).where((F.col("code") != "D4") & (F.col("device") % 5 != 2))
    return known.select(
        "meter_key",
        surrogate_id("input", F.col("meter_key")).alias("input_id"),
        F.md5("meter_key").alias("feed_id"),
    )


def formula_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formula messages, four versions for each of as many meters as there are parts for.

    They take turns: ``*1.5`` for A29 and ``/0`` for B2, then ``*1.5,+input<B2 of the device>`` and
    ``-input<B2 of the device>,/4``, the other way round for every other device; C2 has empty steps,
    and messages for the other codes are broken.  The operand is the part's price.
    """
    number, version = F.expr("p_partkey DIV 4"), F.col("p_partkey") % 4
    meter = _meter(number)
    odd = (version + F.expr("p_partkey DIV 40")) % 2 == 1
    partner = surrogate_id("input", meter_key(meter["sn"], F.lit("B2"), F.lit("1"), F.lit("1")))
    steps = (
        F.when(meter["code"] == "A29", F.when(odd, F.concat(F.lit("*1.5,+input"), partner)).otherwise("*1.5"))
        .when(meter["code"] == "B2", F.when(odd, F.concat(F.lit("-input"), partner, F.lit(",/4"))).otherwise("/0"))
        .otherwise("")
    )
    operand = F.struct(partner.alias("inputId"), F.col("p_retailprice").cast("string").alias("value"))
    body = F.struct(
        surrogate_id("input", meter["meter_key"]).alias("inputId"),
        F.md5(F.concat(F.lit("val"), meter["meter_key"])).alias("feedId"),
        steps.alias("steps"),
        F.array(operand).alias("computeInputList"),
    )
    text = F.when(meter["code"].isin("A29", "B2", "C2"), F.to_json(body)).otherwise("{broken")
    arrival = version * 501 + number * 40 + 101
    return table(spark, sf_dir, "part").select(text.alias("value"), arrival.alias("arrival"))


def compound_formulas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formulas whose steps are whole expressions, one shape per code."""
    steps = (
        F.when(F.col("code") == "A29", "+12*(3+5)/7")
        .when(F.col("code") == "B2", "*2+3*4-1,-(1.5-4)")
        .when(F.col("code") == "C2", "/(2-2)")
        .otherwise("+-1*(-3E-2)-(-1),*0.5")
    )
    return meters(spark, sf_dir).select(
        surrogate_id("input", F.col("meter_key")).alias("input_id"),
        F.md5(F.concat(F.lit("val"), F.col("meter_key"))).alias("feed_id"),
        steps.alias("steps"),
        F.create_map().cast("map<string,double>").alias("operands"),
        F.lit(1).cast("bigint").alias("version"),
    )


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("s_suppkey")
    sn = _sn(number)
    return table(spark, sf_dir, "supplier").select(
        number.alias("device"),
        (number % 5).alias("kind"),
        sn.alias("sn"),
        F.concat(F.lit("tenant_"), (number % 2).cast("string")).alias("ds_schema"),
        surrogate_id("device", sn).alias("device_id"),
    )


def dimensions(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Relational dimensions, per tenant where the column ``ds_schema`` says so.

    By device number modulo 5: 4 has no tenant, 3 is deleted, 2 has no sub topic
    and 1 a deleted one; 0 and 1 have an instrument at address 1, and that of 0
    an input and feed for D4.
    """
    known = devices(spark, sf_dir)
    r = F.col("kind")
    suffix = F.explode(F.array(F.lit(""), F.lit("/sub"))).alias("suffix")
    topics = known.select("*", suffix).where((r != 2) | (F.col("suffix") == ""))
    deleted_topic = (r == 1) & (F.col("suffix") == "/sub")
    has_instrument = known.where(r <= 1)
    instrument_id = surrogate_id("instrument", F.col("device_id"), F.lit("1"), F.lit("1"))
    input_id = F.md5(F.concat(F.lit("kept-input"), F.col("sn")))
    numbers = F.explode(F.array(F.struct(F.lit("NORMAL").alias("feed_type"), F.lit(7).alias("num")),
                                F.struct(F.lit("VIRTUAL").alias("feed_type"), F.lit(90).alias("num"))))
    return {
        "registry": registry(spark, sf_dir),
        "key_schema": known.where(r != 4).select("ds_schema", F.col("sn").alias("dev_seri_no")),
        "iot_device": known.select(
            "ds_schema",
            F.col("device_id").alias("id"),
            F.col("sn").alias("dev_seri_no"),
            F.when(r == 3, 1).otherwise(0).alias("is_del"),
        ),
        "topic": topics.select(
            "ds_schema",
            surrogate_id("topic", F.col("sn"), F.col("suffix")).alias("id"),
            "device_id",
            F.concat(F.lit("meters/"), "sn", "suffix").alias("value"),
            F.when(deleted_topic, 1).otherwise(0).alias("is_del"),
        ),
        "instrument": has_instrument.select(
            "ds_schema", instrument_id.alias("id"), F.lit("1").alias("addr"), "device_id", F.lit("1").alias("type")
        ),
        "input": has_instrument.where(r == 0).select(
            "ds_schema",
            input_id.alias("id"),
            F.lit("D4").alias("prop"),
            F.lit("1").alias("inst_addr"),
            F.lit("1").alias("inst_type"),
            instrument_id.alias("inst_id"),
        ),
        "feed": has_instrument.where(r == 0)
        .select("*", numbers.alias("n"))
        .select(
            "ds_schema",
            F.md5(F.concat(F.lit("kept-feed"), F.col("sn"), F.col("n.num"))).alias("id"),
            "device_id",
            F.col("n.num").alias("num"),
            F.when(F.col("n.feed_type") == "NORMAL", input_id).alias("input_id"),
            F.col("n.feed_type").alias("feed_type"),
            F.lit("ORI").alias("feed_value_type"),
        ),
        "iot_bsn": has_instrument.select(
            "ds_schema",
            instrument_id.alias("inst_id"),
            F.when(r == 0, "VALID").otherwise("INVALID").alias("status"),
        ),
    }


def backfill_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day of address 1 per device, and half of the next day overlapping it for even devices."""
    start = F.lit("2024-01-02 13:12:00").cast("timestamp_ntz")
    at = F.timestamp_add("DAY", F.col("device") % 25, start)
    spans = F.array(
        F.struct(F.lit("day").alias("part"), at.alias("stime"), F.timestamp_add("DAY", F.lit(1), at).alias("etime")),
        F.struct(
            F.lit("overlap").alias("part"),
            F.timestamp_add("HOUR", F.lit(12), at).alias("stime"),
            F.timestamp_add("HOUR", F.lit(36), at).alias("etime"),
        ),
    )
    return (
        devices(spark, sf_dir)
        .select("device", "sn", F.lit("1").alias("type"), F.lit("1").alias("addr"), F.inline(spans))
        .where((F.col("part") == "day") | (F.col("device") % 2 == 0))
        .select(F.concat_ws("-", "sn", "part").alias("request"), "sn", "type", "addr", "stime", "etime")
    )
