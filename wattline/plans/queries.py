"""The registered queries: operators run over the given tables."""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.functions import numbers as N
from wattline.functions import textfn as S
from wattline.functions import timefn as D
from wattline.functions.expressions import step_list, substitute
from wattline.operators import calibration as C
from wattline.operators import provisioning as V
from wattline.operators import readings as R
from wattline.operators import usage as U
from wattline.operators import windows as W
from wattline.plans import fixtures as X
from wattline.schemas import VAL
from wattline.sinks import keyed, outputs
from wattline.sinks.workspace import workspace
from wattline.sources import history as H
from wattline.sources import messages as M
from wattline.sources.dimensions import read_dimensions as read_stored
from wattline.streaming import jobs, state

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Doubles to six places, where both sides of a comparison agree."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


def text(seconds: str = "t") -> Column:
    return D.text_of(F.col(seconds)).alias("time")


# Usage -------------------------------------------------------------------


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.grid_readings(X.readings(spark, sf_dir))


def _usage(step: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(U.usage(_grid(spark, sf_dir), [step]), "data_value")

    return run


for _step in ("30m", "1h", "1d", "1n"):
    _QUERIES[f"usage_{_step}"] = _usage(_step)


@query
def usage_all(spark, sf_dir):
    return rounded(U.usage(_grid(spark, sf_dir)), "data_value")


@query
def usage_calibrated(spark, sf_dir):
    calibrated = C.calibrate(
        X.readings(spark, sf_dir), X.registry(spark, sf_dir), _formulas(spark, sf_dir)
    )
    return rounded(U.usage(R.grid_readings(calibrated)), "data_value")


@query
def usage_changelog(spark, sf_dir):
    return rounded(U.usage_changelog(_grid(spark, sf_dir)), "data_value")


@query
def usage_phase(spark, sf_dir):
    return U.usage_phase(_grid(spark, sf_dir)).drop("arrival")


@query
def usage_delta(spark, sf_dir):
    return rounded(U.usage_delta(_grid(spark, sf_dir)), "data_value")


@query
def usage_from_start(spark, sf_dir):
    return rounded(U.usage_from_start(_grid(spark, sf_dir)), "data_value")


@query
def drop_out_of_order(spark, sf_dir):
    return U.drop_out_of_order(_grid(spark, sf_dir)).select("feed_id", "arrival", text(), "value")


@query
def feed_last_time(spark, sf_dir):
    return U.feed_last_time(_grid(spark, sf_dir)).select("feed_id", text())


@query
def feed_rollup(spark, sf_dir):
    rollup = U.feed_rollup(X.readings(spark, sf_dir))
    start = D.text_of(F.col("ws")).alias("start")
    return rounded(
        rollup.select("feed_id", "step", start, "max_value", "min_value", "avg_value", "sum_value"),
        "avg_value",
        "sum_value",
    )


@query
def split_outputs(spark, sf_dir):
    """The documents of every output, all of one computation."""
    path = workspace(spark, "usage")
    rounded(U.usage(_grid(spark, sf_dir)), "data_value").write.parquet(path)
    parts = U.split_outputs(spark.read.parquet(path))
    named = [part.select(F.lit(step).alias("step"), "doc_id", "data_value") for step, part in parts.items()]
    return reduce(DataFrame.unionByName, named)


@query
def partition_bulk(spark, sf_dir):
    """Documents written one folder per step, read back."""
    path = workspace(spark, "bulk")
    outputs.write_documents(rounded(U.usage(_grid(spark, sf_dir)), "data_value"), path)
    return spark.read.parquet(path).select("step", "doc_id", "data_value")


@query
def assign_closed_windows(spark, sf_dir):
    rows = W.assign_closed_windows(_grid(spark, sf_dir))
    return rows.select(
        "event_id", "step", D.text_of(F.col("ws")).alias("ws"), D.text_of(F.col("we")).alias("we")
    )


@query
def half_hour_right_closed(spark, sf_dir):
    return W.half_hour_right_closed(_grid(spark, sf_dir)).select("event_id", "start_text", "end_text")


# Readings ----------------------------------------------------------------


def _messages(spark, sf_dir):
    return M.decode_messages(X.envelopes(spark, sf_dir))


def _decoded(spark, sf_dir):
    return jobs.decode_readings(X.envelopes(spark, sf_dir))


# Arrivals of decoded readings are decimals; those of the test tables fit a bigint.
_READING = ["meter_key", "topic", "code", "value", "origin", "delay"]


def _arrival():
    return F.col("arrival").cast("bigint").alias("arrival")


@query
def decode_messages(spark, sf_dir):
    return _messages(spark, sf_dir).select(
        "arrival", "sn", "topic", "time", "type", "add", F.size("data").alias("items"), "corrupt"
    )


@query
def valid_messages(spark, sf_dir):
    return R.valid_messages(_messages(spark, sf_dir)).select("arrival", "sn", "add", "time")


@query
def quarantine_sink(spark, sf_dir):
    path = workspace(spark, "quarantine")
    outputs.write_quarantine(_messages(spark, sf_dir), path, 0)
    return keyed.read_batches(spark, path).select("arrival", "reason")


@query
def explode_readings(spark, sf_dir):
    rows = _decoded(spark, sf_dir)
    return rows.select(*_READING, _arrival(), D.format_time(F.col("ts")).alias("time"))


@query
def meter_key(spark, sf_dir):
    """Keys of valid messages' readings; a missing part reads null."""
    parts = _decoded(spark, sf_dir).withColumn("type", F.when(F.col("code") != "A10", F.col("type")))
    key = S.meter_key(F.col("sn"), F.col("code"), F.col("type"), F.col("addr"))
    return parts.groupBy(key.alias("meter_key")).agg(F.count("*").alias("readings"))


@query
def metered_codes(spark, sf_dir):
    return R.metered_codes(X.readings(spark, sf_dir)).select("event_id", "code")


@query
def ten_minute_grid(spark, sf_dir):
    return R.ten_minute_grid(X.readings(spark, sf_dir)).select("event_id", text())


@query
def nonempty_code(spark, sf_dir):
    rows = X.readings(spark, sf_dir).withColumn("code", F.when(F.col("code") == "A10", "").otherwise(F.col("code")))
    return R.nonempty_code(rows).select("event_id", "code")


@query
def origin_flags(spark, sf_dir):
    live = X.readings(spark, sf_dir).select("sn", "code", "value")
    stored = R.explode_readings(R.valid_messages(H.decode_history_payload(X.history(spark, sf_dir))))
    both = R.merge_origins(live, stored.select("sn", "code", "value", "delay"))
    return both.groupBy("origin", "sn", "code").agg(
        F.count("*").alias("readings"),
        F.sum(F.coalesce("delay", F.lit(0))).cast("bigint").alias("delayed"),
        F.round(F.sum("value"), 4).alias("total"),
    )


@query
def doc_ids(spark, sf_dir):
    rows = W.assign_closed_windows(_grid(spark, sf_dir))
    start, end = D.epoch_seconds(F.col("ws")), D.epoch_seconds(F.col("we"))
    return rows.select(
        "event_id",
        S.phase_id(F.col("feed_id"), D.text_of(F.col("t"))).alias("phase_id"),
        S.usage_id(F.col("feed_id"), start, end).alias("usage_id"),
    )


def _cohort(spark, sf_dir):
    """Devices with an even number."""
    return X.devices(spark, sf_dir).where(F.col("device") % 2 == 0).select("sn")


@query
def sn_cohort(spark, sf_dir):
    rows, cohort = X.readings(spark, sf_dir), _cohort(spark, sf_dir)
    new = R.in_cohort(rows, cohort).select("event_id", "sn", F.lit("new").alias("job"))
    return new.unionByName(R.outside_cohort(rows, cohort).select("event_id", "sn", F.lit("old").alias("job")))


@query
def reconcile(spark, sf_dir):
    """Daily usage against daily usage without out-of-order readings and without code D4, hourly only there."""
    grid = _grid(spark, sf_dir)
    old = rounded(U.usage(grid, ["1d"]), "data_value")
    new = rounded(U.usage_delta(grid.where(F.col("code") != "D4"), ["1h", "1d"]), "data_value")
    return R.reconcile(old, new, "doc_id", "data_value")


@query
def date_functions(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    other = F.date_add(day, (F.col("o_orderkey") % 801 - 400).cast("int"))
    orders = X.table(spark, sf_dir, "orders").select("o_orderkey", day.alias("a"), other.alias("b"))
    a, b = F.col("a"), F.col("b")
    at, till = a.cast("timestamp_ntz"), F.timestamp_add("SECOND", F.col("o_orderkey") % 86400, b.cast("timestamp_ntz"))
    seconds = D.seconds_of(till)
    return orders.select(
        "o_orderkey",
        D.format_time(till).alias("time_text"),
        D.format_date(a).alias("date_text"),
        D.format_compact(till).alias("compact_text"),
        D.format_time(D.parse_time(D.format_time(till))).alias("parsed_time"),
        D.format_date(D.parse_date(D.format_date(a))).alias("parsed_date"),
        D.format_time(D.parse_compact(D.format_compact(till))).alias("parsed_compact"),
        D.epoch_seconds(seconds).alias("epoch_s"),
        D.epoch_millis(seconds).alias("epoch_ms"),
        D.millis_text(D.epoch_millis(seconds)).alias("millis_text"),
        D.period_days(a, b).cast("bigint").alias("period_days"),
        D.whole_units_between(at, till, 3600).alias("hours"),
        D.whole_units_between(at, till, 60).alias("minutes"),
        D.millis_between(at, till).alias("millis"),
        D.is_same_day(a, b).cast("int").alias("same_day"),
        D.format_date(D.first_day_of_month(a)).alias("first_day"),
        D.format_date(D.last_day_of_month(a)).alias("last_day"),
        D.format_date(D.first_monday_of_month(a)).alias("first_monday"),
        D.format_date(D.weeks_later(a)).alias("two_weeks"),
        D.format_date(D.months_later(a, 6)).alias("six_months"),
        D.format_date(D.months_later(a, 60)).alias("five_years"),
        D.format_date(D.months_later(a, 240)).alias("twenty_years"),
    )


@query
def rounding(spark, sf_dir):
    items = X.table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice")
    return items.select(
        "l_orderkey",
        "l_linenumber",
        N.round_half_up(price, 0).alias("whole"),
        N.round_half_up(price, 1).alias("tenths"),
    )


@query
def exact_arithmetic(spark, sf_dir):
    items = X.table(spark, sf_dir, "lineitem")
    price, rate = F.col("l_extendedprice"), F.col("l_discount")
    parts = items.select(
        "l_orderkey",
        "l_linenumber",
        N.add(price, rate).alias("added"),
        N.subtract(price, rate).alias("subtracted"),
        N.multiply(price, rate).alias("multiplied"),
        N.divide(price, rate).alias("divided"),
    )
    return rounded(parts, "added", "subtracted", "multiplied", "divided")


# Formulas ----------------------------------------------------------------


def _formulas(spark, sf_dir):
    return M.decode_formulas(X.formula_envelopes(spark, sf_dir))


def _registered(spark, sf_dir):
    return C.registry_lookup(X.readings(spark, sf_dir), X.registry(spark, sf_dir))


def _with_result(spark, sf_dir):
    latest = C.latest_formulas(_formulas(spark, sf_dir))
    return C.apply_formula(C.formula_lookup(_registered(spark, sf_dir), latest))


def _emitted(rows):
    return rounded(rows.select("event_id", "kind", "feed_id", "input_id", "value"), "value")


@query
def read_formula_feed(spark, sf_dir):
    rows = _formulas(spark, sf_dir)
    operand, value = F.map_keys("operands")[0], F.map_values("operands")[0]
    return rows.select("input_id", "feed_id", "steps", "version", operand.alias("operand"), value.alias("price"))


@query
def latest_formulas(spark, sf_dir):
    return C.latest_formulas(_formulas(spark, sf_dir)).select("input_id", "feed_id", "steps", "version")


@query
def registry_lookup(spark, sf_dir):
    return _registered(spark, sf_dir).select("event_id", "input_id", "feed_id", "value")


@query
def formula_lookup(spark, sf_dir):
    return _with_result(spark, sf_dir).select("event_id", "input_id", "val_feed_id")


@query
def substitute_inputs(spark, sf_dir):
    rows = _formulas(spark, sf_dir).select(
        "input_id", "version", "operands", F.posexplode(step_list(F.col("steps"))).alias("pos", "step")
    )
    return rows.select("input_id", "version", "pos", substitute(F.col("step"), F.col("operands")).alias("step"))


@query
def apply_steps(spark, sf_dir):
    return rounded(_with_result(spark, sf_dir).where("has_formula").select("event_id", "result"), "result")


@query
def eval_expression(spark, sf_dir):
    rows = C.apply_formula(C.formula_lookup(_registered(spark, sf_dir), X.compound_formulas(spark, sf_dir)))
    return rounded(rows.select("event_id", "code", "result"), "result")


@query
def nan_fallback(spark, sf_dir):
    """VAL rows of readings whose newest formula has no result: a division by zero."""
    hopeless = _with_result(spark, sf_dir).where(F.col("has_formula") & F.col("result").isNull())
    return _emitted(C.emit(hopeless).where(F.col("kind") == VAL))


@query
def emit_original(spark, sf_dir):
    return _emitted(C.emit(_with_result(spark, sf_dir)).where(F.col("kind") == "ORI"))


@query
def emit_calibrated(spark, sf_dir):
    return _emitted(C.emit(_with_result(spark, sf_dir)).where(F.col("kind") == VAL))


@query
def calibrate(spark, sf_dir):
    return _emitted(
        C.calibrate(X.readings(spark, sf_dir), X.registry(spark, sf_dir), _formulas(spark, sf_dir))
    )


@query
def formula_as_of(spark, sf_dir):
    return _emitted(
        C.calibrate_as_of(X.readings(spark, sf_dir), X.registry(spark, sf_dir), _formulas(spark, sf_dir))
    )


# History -----------------------------------------------------------------


_STORED = ["sn", "type", "addr", "time", "arrival"]


@query
def replay_from_time(spark, sf_dir):
    """Envelopes taken in from the middle of the month on."""
    return M.replay_from(X.envelopes(spark, sf_dir), "2024-01-15 12:00:00", "ingest_ts").select("arrival")


@query
def scan_history(spark, sf_dir):
    rows = H.scan_history(
        X.history(spark, sf_dir), "SN0001", "1", "1", "2024-01-05 13:12:00", "2024-01-08 17:12:00"
    )
    return rows.select(*_STORED)


@query
def backfill_ranges(spark, sf_dir):
    rows = H.backfill_ranges(X.history(spark, sf_dir), X.backfill_requests(spark, sf_dir))
    return rows.select("request", *_STORED)


@query
def status_filter(spark, sf_dir):
    return H.status_filter(X.history(spark, sf_dir)).select(*_STORED)


@query
def peek(spark, sf_dir):
    return H.peek(X.history(spark, sf_dir)).select(*_STORED)


@query
def decode_history_payload(spark, sf_dir):
    rows = R.explode_readings(R.valid_messages(H.decode_history_payload(X.history(spark, sf_dir))))
    return rows.select(*_READING, _arrival(), D.format_time(F.col("ts")).alias("time"))


@query
def backfill(spark, sf_dir):
    """Requested ranges calibrated and metered like live readings."""
    wanted = H.backfill_ranges(X.history(spark, sf_dir), X.backfill_requests(spark, sf_dir))
    # A row asked for twice counts once: usage takes the latest arrival per instant.
    readings = R.explode_readings(R.valid_messages(H.decode_history_payload(wanted)))
    calibrated = C.calibrate(readings, X.registry(spark, sf_dir), _formulas(spark, sf_dir))
    return rounded(U.usage(R.grid_readings(calibrated)), "data_value")


# Provisioning ------------------------------------------------------------


def _new_meters(spark, sf_dir):
    return V.resolve_new_meters(X.readings(spark, sf_dir), X.dimensions(spark, sf_dir))


def _first(spark, sf_dir):
    return V.first_seen(X.readings(spark, sf_dir))


def _joined(columns: list[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns])


@query
def read_dimensions(spark, sf_dir):
    """Every row of the dimensions, read from where they are stored."""
    root = workspace(spark, "dimensions")
    for name, rows in X.dimensions(spark, sf_dir).items():
        rows.write.parquet(f"{root}/{name}")
    parts = [
        rows.select(F.lit(name).alias("dimension"), _joined(rows.columns).alias("content"))
        for name, rows in read_stored(spark, root).items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def first_seen(spark, sf_dir):
    return _first(spark, sf_dir).select("meter_key", "topic", text(), "value", "arrival")


@query
def unregistered(spark, sf_dir):
    rows = V.unregistered(X.readings(spark, sf_dir), X.registry(spark, sf_dir))
    return rows.select("event_id", "meter_key")


@query
def tenant_lookup(spark, sf_dir):
    rows = V.tenant_lookup(X.readings(spark, sf_dir), X.dimensions(spark, sf_dir)["key_schema"])
    return rows.select("event_id", "sn", "ds_schema")


def _of_device(spark, sf_dir):
    dims = X.dimensions(spark, sf_dir)
    return V.known_device(V.tenant_lookup(_first(spark, sf_dir), dims["key_schema"]), dims["iot_device"])


@query
def known_device(spark, sf_dir):
    return _of_device(spark, sf_dir).select("meter_key", "ds_schema", "device_id")


@query
def known_topic(spark, sf_dir):
    rows = V.known_topic(_of_device(spark, sf_dir), X.dimensions(spark, sf_dir)["topic"])
    return rows.select("meter_key", "topic", "topic_id")


@query
def instrument_match(spark, sf_dir):
    rows = V.instrument_match(_of_device(spark, sf_dir), X.dimensions(spark, sf_dir)["instrument"])
    return rows.select("meter_key", "inst_id", F.col("inst_missing").cast("int").alias("missing"))


@query
def input_match(spark, sf_dir):
    return _new_meters(spark, sf_dir).select(
        "meter_key", "input_id", "feed_id", F.col("input_missing").cast("int").alias("missing")
    )


@query
def bsn_match(spark, sf_dir):
    """Instruments of known devices that lack a valid serial number."""
    dims = X.dimensions(spark, sf_dir)
    rows = V.instrument_match(_of_device(spark, sf_dir), dims["instrument"])
    lacking = V.bsn_match(rows.select("ds_schema", "inst_id", "sn", "addr").distinct(), dims["iot_bsn"])
    return lacking.select("sn", "addr", "inst_id")


@query
def next_feed_number(spark, sf_dir):
    rows = V.next_feed_number(
        _new_meters(spark, sf_dir).where("input_missing"), X.dimensions(spark, sf_dir)["feed"]
    )
    return rows.select("meter_key", "num")


@query
def new_instruments(spark, sf_dir):
    return V.new_instruments(_new_meters(spark, sf_dir)).select("ds_schema", "id", "device_id", "topic_id", "addr")


@query
def new_inputs(spark, sf_dir):
    return V.new_inputs(_new_meters(spark, sf_dir)).select("id", "prop", "value", "value_time", "inst_addr", "inst_id")


@query
def new_feeds(spark, sf_dir):
    rows = V.new_feeds(_new_meters(spark, sf_dir), X.dimensions(spark, sf_dir)["feed"])
    return rows.select(
        "id", "feed_num", "num", "name", "last_value", "update_time", "input_id", "feed_type", "interval_value",
        "interval_unit_type", "feed_value_type", "feed_log_value_type",
    )


@query
def registry_upserts(spark, sf_dir):
    return V.registry_upserts(_new_meters(spark, sf_dir))


@query
def new_bsns(spark, sf_dir):
    rows = V.new_bsns(_new_meters(spark, sf_dir), X.dimensions(spark, sf_dir)["iot_bsn"])
    return rows.select("ds_schema", "bsn", "status", "inst_id")


@query
def new_bsn_schemas(spark, sf_dir):
    rows = V.new_bsns(_new_meters(spark, sf_dir), X.dimensions(spark, sf_dir)["iot_bsn"])
    return V.new_bsn_schemas(rows).select("ds_schema", "bsn")


@query
def bsn_encode(spark, sf_dir):
    rows = X.table(spark, sf_dir, "customer")
    source = S.bsn_source(F.col("c_name"), F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string"))
    return rows.select("c_custkey", S.bsn_encode(source).alias("bsn"))


@query
def surrogate_ids(spark, sf_dir):
    keys = X.readings(spark, sf_dir).select("meter_key").distinct()
    return keys.select("meter_key", S.surrogate_id("input", F.col("meter_key")).alias("id"))


# Sinks -------------------------------------------------------------------


@query
def point_sink(spark, sf_dir):
    path = workspace(spark, "points")
    keyed.write_batch(outputs.points(X.readings(spark, sf_dir)), path, 0)
    return keyed.read_keyed(spark, path, ["measurement", "feedid", "time"], "arrival").select(
        "measurement", "feedid", "value", "time"
    )


@query
def six_second_batches(spark, sf_dir):
    return rounded(outputs.six_second_batches(X.readings(spark, sf_dir)), "total")


@query
def document_sink(spark, sf_dir):
    """Documents of the five indexes as upserted: of the earlier half of the readings, of all, and of all once more."""
    path, checkpoint = workspace(spark, "grid"), workspace(spark, "checkpoint")
    table = outputs.document_table(workspace(spark, "documents"))
    grid = _grid(spark, sf_dir)
    half = grid.approxQuantile("arrival", [0.5], 0.01)[0] if grid.head(1) else 0

    def upsert(batch_rows, batch):
        rows = spark.read.schema(batch_rows.schema).parquet(path)
        table(outputs.index_rows(U.usage_phase(rows), rounded(U.usage(rows), "data_value"), batch), batch)

    for part in (F.col("arrival") <= half, F.col("arrival") > half):
        grid.where(part).write.mode("append").parquet(path)
        jobs.start(_stream(spark, path, grid.schema), upsert, checkpoint).awaitTermination()
    upsert(spark.read.parquet(path), 1)
    return table.rows(spark).select("_id", "source", "index")


@query
def registry_sink(spark, sf_dir):
    """Known meters as batch 0, upserts as batch 1, newest per key."""
    path = workspace(spark, "registry")
    keyed.write_batch(X.registry(spark, sf_dir), path, 0)
    keyed.write_batch(V.registry_upserts(_new_meters(spark, sf_dir)), path, 1)
    return keyed.read_keyed(spark, path, ["meter_key"]).select("meter_key", "input_id", "feed_id")


@query
def formula_sink(spark, sf_dir):
    path = workspace(spark, "formulas")
    rows = _formulas(spark, sf_dir)
    keyed.write_batch(rows.where(F.col("version") % 2 == 0), path, 0)
    keyed.write_batch(rows.where(F.col("version") % 2 == 1), path, 1)
    return jobs.read_formulas(spark, path).select("input_id", "feed_id", "steps", "version")


# What is compared of each table's inserts: key, content, value.
_INSERTS = {
    "instrument": ("id", ["ds_schema", "device_id", "topic_id", "addr", "type"], None),
    "input": ("id", ["ds_schema", "prop", "value_time", "inst_addr", "inst_type", "inst_id"], "value"),
    "feed": ("id", ["ds_schema", "device_id", "feed_num", "num", "name", "input_id", "inst_id"], "last_value"),
    "registry": ("meter_key", ["input_id", "feed_id"], None),
    "iot_bsn": ("id", ["ds_schema", "bsn", "status", "inst_id"], None),
    "bsn_schema": ("id", ["ds_schema", "bsn"], None),
}


@query
def table_inserts(spark, sf_dir):
    """Rows added to every table."""
    root, met = workspace(spark, "tables"), workspace(spark, "new-meters")
    _new_meters(spark, sf_dir).write.parquet(met)
    outputs.write_tables(V.provision(spark.read.parquet(met), X.dimensions(spark, sf_dir)), root, 0)
    parts = [
        keyed.read_batches(spark, f"{root}/{name}").select(
            F.lit(name).alias("name"),
            F.col(key).alias("id"),
            _joined(columns).alias("content"),
            (F.col(value) if value else F.lit(None)).cast("double").alias("value"),
        )
        for name, (key, columns, value) in _INSERTS.items()
    ]
    return reduce(DataFrame.unionByName, parts)


# Streams -----------------------------------------------------------------


def _feed(spark, rows: DataFrame, name: str) -> str:
    """Envelopes as files for a stream to read."""
    path = workspace(spark, name)
    rows.write.parquet(path)
    return path


@query
def read_message_stream(spark, sf_dir):
    """Live and re-sent envelopes as two topics of one stream."""
    rows = X.envelopes(spark, sf_dir)
    resent = F.col("arrival") % 2 == 1
    topics = [_feed(spark, rows.where(~resent), "live"), _feed(spark, rows.where(resent), "restream")]
    out = workspace(spark, "decoded")
    readings = jobs.decode_readings(M.read_message_stream(spark, topics))
    jobs.start(readings, jobs.to_table(out), workspace(spark, "checkpoint")).awaitTermination()
    return keyed.read_batches(spark, out).select("meter_key", _arrival(), "value")


def _in_order(spark, rows: DataFrame, run: Callable[[str], None], name: str, parts: int = 3) -> None:
    """Appends ``rows`` to a folder in so many parts in the order of arrival and runs a job after each."""
    path = workspace(spark, name)
    # What makes the rows runs once, not for the bounds and for each part.
    rows = spark.read.schema(rows.schema).parquet(_feed(spark, rows, f"{name}-whole"))
    bounds = rows.approxQuantile("arrival", [i / parts for i in range(1, parts)], 0.01)
    part = reduce(lambda n, b: n + (F.col("arrival") > b).cast("int"), bounds, F.lit(0))
    for i in range(parts):
        rows.where(part == i).write.mode("append").parquet(path)
        run(path)


def _stream(spark, path: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def _stream_of_readings(spark, sf_dir, files_per_trigger=4):
    # Enough files for several micro-batches.
    path = _feed(spark, X.readings(spark, sf_dir).repartition(3 * files_per_trigger), "readings")
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def _usage_stream(*steps: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = workspace(spark, "usage")
        revised = state.usage_stream(R.grid_readings(_stream_of_readings(spark, sf_dir)), list(steps))
        jobs.start(revised, jobs.to_table(out), workspace(spark, "checkpoint"), "update").awaitTermination()
        return rounded(jobs.read_usage(spark, out), "data_value")

    return run


_QUERIES["usage_stream"] = _usage_stream("1h")
_QUERIES["usage_stream_all"] = _usage_stream("30m", "1h", "1d", "1n")
for _step in ("30m", "1d", "1n"):
    _QUERIES[f"usage_stream_{_step}"] = _usage_stream(_step)


@query
def first_seen_stream(spark, sf_dir):
    """First readings of unregistered meters, whole, over three runs of the job."""
    out, checkpoint = workspace(spark, "first"), workspace(spark, "checkpoint")
    rows, registry = X.readings(spark, sf_dir), X.registry(spark, sf_dir)

    def run(path):
        first = state.first_seen_stream(_stream(spark, path, rows.schema), registry)
        jobs.start(first, jobs.to_table(out), checkpoint).awaitTermination()

    _in_order(spark, rows, run, "readings")
    found = keyed.read_batches(spark, out)
    return found.select("event_id", "meter_key", "sn", "code", "type", "addr", "topic", "feed_id", text(), "value", "arrival")


@query
def drop_out_of_order_stream(spark, sf_dir):
    """Grid readings in order, over three runs of the job."""
    out, checkpoint = workspace(spark, "accepted"), workspace(spark, "checkpoint")
    rows = _grid(spark, sf_dir)

    def run(path):
        accepted = state.drop_out_of_order_stream(_stream(spark, path, rows.schema))
        jobs.start(accepted, jobs.to_table(out), checkpoint).awaitTermination()

    _in_order(spark, rows, run, "readings")
    return keyed.read_batches(spark, out).select("feed_id", "arrival", text(), "value")


@query
def formula_as_of_stream(spark, sf_dir):
    """ORI and VAL rows under the formulas current on arrival, over three runs of the job."""
    out, checkpoint = workspace(spark, "calibrated"), workspace(spark, "checkpoint")
    readings = _registered(spark, sf_dir)
    formulas = _formulas(spark, sf_dir)
    changes = formulas.withColumn("arrival", F.col("version"))
    both = readings.unionByName(changes.withColumnRenamed("feed_id", "formula_feed"), allowMissingColumns=True)

    def run(path):
        rows = _stream(spark, path, both.schema)
        own = rows.where(F.col("version").isNull()).select(readings.columns)
        feed = rows.where(F.col("version").isNotNull()).select("input_id", F.col("formula_feed").alias("feed_id"), "steps", "operands", "version")
        calibrated = C.emit(C.apply_formula(state.formula_as_of_stream(own, feed)))
        jobs.start(calibrated, jobs.to_table(out), checkpoint).awaitTermination()

    _in_order(spark, both, run, "readings-and-formulas")
    return _emitted(keyed.read_batches(spark, out))


@query
def formula_stream(spark, sf_dir):
    out = workspace(spark, "formulas")
    feed = M.read_message_stream(spark, [_feed(spark, X.formula_envelopes(spark, sf_dir), "formula-feed")])
    jobs.start(jobs.formula_stream(feed), jobs.to_cleared_table(out), workspace(spark, "checkpoint")).awaitTermination()
    return jobs.read_formulas(spark, out).select("input_id", "feed_id", "steps", "version")


@query
def online(spark, sf_dir):
    """The whole pipeline on the message stream in two batches: documents, points and rejects."""
    path, root, checkpoint = (workspace(spark, n) for n in ("live", "online", "checkpoint"))
    job = jobs.Online(lambda: X.dimensions(spark, sf_dir), lambda: _formulas(spark, sf_dir), root)
    rows, half = X.envelopes(spark, sf_dir), F.col("arrival") % 4 < 2
    for part in (rows.where(half), rows.where(~half)):
        part.write.mode("append").parquet(path)
        job.start(M.read_message_stream(spark, [path]), checkpoint).awaitTermination()
    field = lambda name: F.get_json_object("source", f"$.{name}")
    none = F.lit(None).cast("string")
    documents = job.documents(spark).select(
        F.col("index").alias("output"),
        F.col("_id").alias("id"),
        field("feed_id").alias("feed_id"),
        field("data_time").alias("detail"),
        field("data_value").cast("double").alias("value"),
    )
    points = job.points(spark).select(
        F.lit("points").alias("output"), F.col("time").cast("string").alias("id"), F.col("feedid").alias("feed_id"),
        none.alias("detail"), "value",
    )
    rejects = keyed.read_batches(spark, f"{root}/quarantine").select(
        F.lit("quarantine").alias("output"), F.col("arrival").cast("string").alias("id"), none.alias("feed_id"),
        F.col("reason").alias("detail"), F.lit(None).cast("double").alias("value"),
    )
    return rounded(documents.unionByName(points).unionByName(rejects), "value")


@query
def recoverable_stream(spark, sf_dir):
    """Hourly usage when half of the input comes after a restart from the checkpoint."""
    rows = X.readings(spark, sf_dir)
    half = F.col("event_id") % 2 == 0
    path, out, checkpoint = (workspace(spark, n) for n in ("readings", "usage", "checkpoint"))
    for part in (rows.where(half), rows.where(~half)):
        part.write.mode("append").parquet(path)
        revised = state.usage_stream(R.grid_readings(_stream(spark, path, part.schema)), ["1h"])
        jobs.start(revised, jobs.to_table(out), checkpoint, "update").awaitTermination()
    return rounded(jobs.read_usage(spark, out), "data_value")
