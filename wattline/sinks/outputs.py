"""What is written: points, documents, per-step outputs, rejects and table rows."""

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.functions.numbers import PLACES
from wattline.functions.timefn import epoch_millis
from wattline.operators.readings import rejected_messages
from wattline.operators.usage import latest_per_instant
from wattline.sinks.keyed import write_batch
from wattline.sinks.upserts import Upserts

POINT_BATCH_SECONDS = 6


def points(readings: DataFrame, measurement: str = "feed_value") -> DataFrame:
    """One point per feed and instant, the later arrival winning; it says which of several batches' points wins."""
    return latest_per_instant(readings).select(
        F.lit(measurement).alias("measurement"),
        F.col("feed_id").alias("feedid"),
        "value",
        epoch_millis(F.col("t")).alias("time"),
        "arrival",
    )


def six_second_batches(readings: DataFrame) -> DataFrame:
    """Points per six-second batch of reading time."""
    start = F.col("time") - F.pmod("time", F.lit(POINT_BATCH_SECONDS * 1000))
    return (
        points(readings)
        .groupBy(start.alias("batch_start"))
        .agg(F.count("*").alias("points"), F.round(F.sum("value"), PLACES).alias("total"))
    )


def documents(rows: DataFrame, doc_id: str = "doc_id", keep: list[str] = ()) -> DataFrame:
    """Rows as (_id, JSON source), with the columns in ``keep`` beside the source instead of in it."""
    fields = [c for c in rows.columns if c != doc_id and c not in keep]
    return rows.select(F.col(doc_id).alias("_id"), F.to_json(F.struct(*fields)).alias("source"), *keep)


def index_rows(phase: DataFrame, usage: DataFrame, batch: int) -> DataFrame:
    """Documents of the five indexes as the table of ``document_table`` takes them: (index, day, _id, source, version).

    The index of usage is its step. Of two readings of an instant the later arrival's document stays, of a window's
    documents the later batch's.
    """
    day = F.substring("data_time", 1, 10).alias("day")
    arrival, order = "decimal(38,0)", F.lit(batch).cast("decimal(38,0)")
    phase = phase.withColumn("version", F.col("arrival").cast(arrival)).select("*", day, F.lit("phase").alias("index")).drop("arrival")
    usage = usage.select("*", day, F.col("step").alias("index"), order.alias("version"))
    kept = ["index", "day", "version"]
    return documents(phase, keep=kept).unionByName(documents(usage, keep=kept)).select("index", "day", "_id", "source", "version")


def document_table(path: str) -> Upserts:
    """Five indexes of documents, upserted by id, in folders per index and day."""
    schema = "index string, day string, _id string, source string, version decimal(38,0)"
    return Upserts(path, schema, ("index", "day", "_id"), ("index", "day"))


def write_documents(rows: DataFrame, path: str) -> None:
    """All steps in one job, one folder per step."""
    rows.write.mode("overwrite").partitionBy("step").parquet(path)


def write_quarantine(messages: DataFrame, path: str, batch: int) -> None:
    write_batch(rejected_messages(messages), path, batch)


def stamped(rows: DataFrame) -> DataFrame:
    """Inserts with their times and version."""
    now = F.current_timestamp()
    return rows.withColumns({"create_time": now, "modify_time": now, "version": F.lit(0)})


def write_tables(tables: dict[str, DataFrame], root: str, batch: int) -> None:
    """Inserts per table as one folder per batch, so a repeated batch inserts once."""
    at_once([partial(write_batch, stamped(rows), f"{root}/{name}", batch) for name, rows in tables.items()])


def at_once(writes: list[Callable[[], None]]) -> None:
    """Independent writes as concurrent jobs: small ones do not wait for each other's last tasks."""
    with ThreadPoolExecutor(len(writes)) as pool:
        for done in [pool.submit(write) for write in writes]:
            done.result()


def write_jdbc(rows: DataFrame, table: str, options: dict[str, str]) -> None:
    """Appends to a database table; needs the JDBC driver on the class path."""
    rows.write.format("jdbc").options(dbtable=table, **options).mode("append").save()


