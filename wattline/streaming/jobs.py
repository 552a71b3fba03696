"""Structured Streaming jobs: stateful operators and the online pipeline.

Every sink writes micro-batch N to its own folder, so with a checkpoint a job
that is killed and restarted repeats its last batch without doubling it.
"""

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wattline.operators.calibration import calibrate, latest_formulas
from wattline.operators.provisioning import provision, resolve_new_meters
from wattline.operators.readings import explode_readings, grid_readings, valid_messages
from wattline.operators.usage import WINDOW, batch_ends, fold_ends, merge_ends, usage_phase
from wattline.sinks.keyed import Log, inserts, latest_by_key, read_batches, read_keyed, write_batch
from wattline.sinks.outputs import at_once, documents, points, stamped, write_quarantine
from wattline.sources.messages import decode_formulas, decode_messages

POINT_TRIGGER = "6 seconds"

# State on local disk with changelog checkpoints, for state larger than executor memory.
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

NO_DATA_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


def start(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    every: str | None = None,
) -> StreamingQuery:
    """Starts a job on a checkpoint: continuously every ``every``, or until the input is used up.

    State goes to local disk with its changes in the checkpoint.
    """
    settings = stream.sparkSession.conf
    for key, value in ROCKSDB.items():
        settings.set(key, value)
    # A live job wakes up for state that has outlived its time; one that runs until its input is used up would
    # wait for that instead of ending.
    settings.set(NO_DATA_BATCHES, "true" if every else "false")
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .foreachBatch(write)
        .start()
    )


def to_table(path: str) -> Callable[[DataFrame, int], None]:
    return lambda rows, batch: write_batch(rows, path, batch)


def to_cleared_table(path: str) -> Callable[[DataFrame, int], None]:
    """Like ``to_table``, but a job's first batch removes what earlier jobs left there."""

    def write(rows: DataFrame, batch: int) -> None:
        if batch:
            write_batch(rows, path, batch)
        else:
            rows.withColumn("batch", F.lit(0)).write.mode("overwrite").partitionBy("batch").parquet(path)

    return write


def decode_readings(envelopes: DataFrame) -> DataFrame:
    return explode_readings(valid_messages(decode_messages(envelopes)))


def read_usage(spark: SparkSession, path: str) -> DataFrame:
    """Usage documents as last revised."""
    return read_keyed(spark, path, ["step", "doc_id"]).drop("batch")


def formula_stream(envelopes: DataFrame) -> DataFrame:
    return decode_formulas(envelopes)


def read_formulas(spark: SparkSession, path: str) -> DataFrame:
    return latest_formulas(read_batches(spark, path).drop("batch"))


def _month(seconds: Column) -> Column:
    """A month's number: no more of them than four-digit years have."""
    day = F.date_from_unix_date(F.floor(seconds / 86400).cast("int"))
    return (F.year(day) * 12 + F.month(day)).alias("month")


def _fold_registry(rows: DataFrame) -> DataFrame:
    return latest_by_key(rows, ["meter_key"], "batch")


def _fold_months(ends: DataFrame) -> DataFrame:
    folded = fold_ends(ends)
    return folded.select("*", _month(F.col("ws")))


class Online:
    """The online pipeline on envelope micro-batches.

    Each batch registers its new meters first and calibrates afterwards, so the
    first readings of a new meter are kept.  Dimensions and formulas are read
    again per batch: a reading sees the formula current when it is processed.

    Written are points, rejects, new master data and the documents of five indexes (phase and four
    usage steps), upserted under their id.  A batch revises the windows that its readings fall into,
    however late, from the ends that earlier batches left in the same months.  What it reads of earlier
    batches is one epoch of each table, which begins with a snapshot.
    """

    def __init__(
        self,
        dims: Callable[[], dict[str, DataFrame]],
        formulas: Callable[[], DataFrame],
        root: str,
        every: int = 50,
    ):
        self.dims, self.formulas, self.root = dims, formulas, root
        folds = {"registry": _fold_registry}
        names = ("registry", "instrument", "input", "feed", "iot_bsn", "bsn_schema")
        self.tables = {n: Log(f"{root}/{n}", every, folds.get(n, inserts)) for n in names}
        self.ends = Log(f"{root}/ends", every, _fold_months, by=["month"])

    def start(self, envelopes: DataFrame, checkpoint: str, live: bool = False) -> StreamingQuery:
        """Starts on a stream of envelopes: every six seconds when live, or until the input is used up."""
        return start(envelopes, self, checkpoint, every=POINT_TRIGGER if live else None)

    def _earlier(self, name: str, base: DataFrame, batch: int) -> DataFrame:
        """A dimension with what earlier batches added; this batch's own rows are not looked at."""
        if batch == 0 or name not in self.tables:
            return base
        added = self.tables[name].before(base.sparkSession, batch)
        if name == "registry":
            added = latest_by_key(added.select(*base.columns, "batch"), ["meter_key"], "batch")
        return base.unionByName(added.select(base.columns))

    def _usage(self, ends: DataFrame, batch: int) -> DataFrame:
        """The windows that this batch touches, with all readings so far."""
        if batch == 0:
            return merge_ends(ends)
        months = [r["month"] for r in ends.select("month").distinct().collect()]
        earlier = self.ends.before(ends.sparkSession, batch, ends.schema).where(F.col("month").isin(months))
        touched = earlier.drop("batch").join(ends.select(*WINDOW), WINDOW, "left_semi")
        return merge_ends(ends.unionByName(touched))

    def __call__(self, envelopes: DataFrame, batch: int) -> None:
        spark = envelopes.sparkSession
        messages = decode_messages(envelopes).persist()
        readings = explode_readings(valid_messages(messages))

        for table in self.tables.values():
            table.begin(spark, batch)
        dims = {name: self._earlier(name, rows, batch) for name, rows in self.dims().items()}
        meters = resolve_new_meters(readings, dims).persist()
        # Most batches bring no new meter; the first one lays the tables down either way.
        if meters.count() or batch == 0:
            added = provision(meters, dims)
            at_once([partial(self.tables[n].write, stamped(rows), batch) for n, rows in added.items()])

        registry = dims["registry"].unionByName(meters.select(dims["registry"].columns))
        calibrated = calibrate(readings, registry, self.formulas()).persist()
        grid = grid_readings(calibrated)
        ends = batch_ends(grid).select("*", _month(F.col("ws"))).persist()
        self.ends.begin(spark, batch, ends.schema)
        writes = {
            "points": points(calibrated),
            "phase": documents(usage_phase(grid), keep=["arrival"]),
            "usage": documents(self._usage(ends, batch).withColumn("index", F.col("step")), keep=["index"]),
        }
        at_once(
            [partial(write_quarantine, messages, f"{self.root}/quarantine", batch), partial(self.ends.write, ends, batch)]
            + [partial(write_batch, rows, f"{self.root}/{name}", batch) for name, rows in writes.items()]
        )
        for held in (messages, meters, calibrated, ends):
            held.unpersist()

    def usage(self, spark: SparkSession) -> DataFrame:
        """Usage documents over all batches: the ends of each batch, merged."""
        return merge_ends(self.ends.rows(spark))

    def points(self, spark: SparkSession) -> DataFrame:
        """Points over all batches."""
        return latest_by_key(read_batches(spark, f"{self.root}/points").drop("batch"), ["measurement", "feedid", "time"], "arrival")

    def documents(self, spark: SparkSession) -> DataFrame:
        """(index, _id, source) of each document as last upserted; of two readings of an instant the later arrival."""
        phase = latest_by_key(read_batches(spark, f"{self.root}/phase").drop("batch"), ["_id"], "arrival")
        usage = latest_by_key(read_batches(spark, f"{self.root}/usage"), ["index", "_id"], "batch")
        return phase.select(F.lit("phase").alias("index"), "_id", "source").unionByName(usage.select("index", "_id", "source"))
