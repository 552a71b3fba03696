"""What several corpus operators share: reading tables, shared storage, words, prefix sums."""

import os
import tempfile
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: ASCII white space, and a run of anything else.
SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder path under the folder that driver and executors share.

    It is the one that ``spark.checkpoint.dir`` names. Only a local session that names none, as in
    tests, gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = os.path.join(tempfile.gettempdir(), f"wattline-llm-{os.getpid()}")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again.

    Cuts the lineage, so a lost executor costs no more than the tasks it ran, and gives the planner the
    real size, by which it decides about broadcasting.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str, name: str) -> DataFrame:
    """``df`` written to the shared folder in as many buckets of ``key`` as there are shuffle partitions, and read again.

    Grouping by ``key`` then reads it where it lies. The table's name is dropped at once, its files stay.
    """
    spark, path = df.sparkSession, shared_folder(df.sparkSession, name)
    known = "bucketed_" + path[-32:]
    df.write.format("parquet").bucketBy(partitions(spark), key).option("path", path).saveAsTable(known)
    rows = spark.table(known)
    spark.sql(f"DROP TABLE {known}")
    return rows


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def n_words(text: str | Column = "text") -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """32 hex digits that stand for a document's id and whole text; even over any rows."""
    return F.md5(
        F.concat(
            F.coalesce(F.col(doc_id).cast("string"), F.lit("~")), F.lit(":"), F.md5(F.coalesce(F.col(text), F.lit("")))
        )
    )


def prefix_sums(df: DataFrame, order: Sequence[Column], sums: dict[str, Column], name: str, small: bool = False) -> DataFrame:
    """``df`` with running sums over all earlier rows in ``order``, the row itself excluded.

    Rows are range-partitioned by ``order`` and written, so that both readings see the same ranges; one
    total per range is summed up, and each range continues from the total before it. ``order`` should
    tell rows apart: equal ones stay in one range. If rows are ``small``, adaptive execution merges ranges of
    too few bytes, so a short table is one file and not one for each row.
    """
    count = [] if small else [partitions(df.sparkSession)]
    ranged = df.repartitionByRange(*count, *order).withColumn("_range", F.spark_partition_id())
    ranged = stored(ranged, f"{name}-ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_range").agg(*(F.sum(c).alias(f"_{k}_total") for k, c in sums.items()))
    totals = totals.select("_range", *(F.coalesce(F.sum(f"_{k}_total").over(before), F.lit(0)).alias(f"_{k}_before") for k in sums))
    totals = stored(totals, f"{name}-totals")
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranged.join(totals, "_range")
        .withColumns({k: F.col(f"_{k}_before") + F.coalesce(F.sum(c).over(within), F.lit(0)) for k, c in sums.items()})
        .drop("_range", *(f"_{k}_before" for k in sums))
    )


#: 64-bit words of a membership filter: at most so many rows of two numbers are broadcast, whatever it is of.
FILTER_WORDS = 1 << 18


def _filter_word(key: Column) -> Column:
    return F.shiftright(key, 6).bitwiseAND(F.lit(FILTER_WORDS - 1))


def members(keys: DataFrame, key: Column) -> DataFrame:
    """A filter of 64-bit hashes, stored: (_word, _mask), FILTER_WORDS rows at most."""
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), key.bitwiseAND(F.lit(63)).cast("int"))
    words = keys.groupBy(_filter_word(key).alias("_word")).agg(F.bit_or(bit).alias("_mask"))
    return stored(words, "filter")


def might_be_in(df: DataFrame, key: Column, filtered: DataFrame) -> DataFrame:
    """``df`` with ``_might``: false only where ``key`` is certainly none of the filter's. What a join has to
    move is so reduced to little more than its matches; a full filter only lets more rows into the join."""
    hit = F.call_function("shiftrightunsigned", F.col("_mask"), key.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1
    joined = df.join(F.broadcast(filtered), _filter_word(key) == F.col("_word"), "left")
    return joined.withColumn("_might", F.coalesce(hit, F.lit(False))).drop("_word", "_mask")


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to at most ``rows`` rows, so that what Python makes of them stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
