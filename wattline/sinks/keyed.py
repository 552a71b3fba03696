"""Keyed tables on plain files: upserts as appended batches, newest row per key on read.

Each micro-batch overwrites its own ``batch=N`` folder, so a batch run twice
after a failure leaves one copy.  A ``Log`` also folds them into snapshots.
"""

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType


def write_batch(rows: DataFrame, path: str, batch: int) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path).withColumn("batch", F.col("batch").cast("bigint"))


def latest_by_key(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per key: the one with the greatest ``order``, which is unique within a key.

    Column by column, so that rows of fixed-width values stay in a hash aggregate.
    """
    rest = [c for c in rows.columns if c not in keys and c != order]
    return rows.groupBy(*keys).agg(F.max(order).alias(order), *[F.max_by(c, order).alias(c) for c in rest])


def read_keyed(spark: SparkSession, path: str, keys: list[str], order: str = "batch") -> DataFrame:
    return latest_by_key(read_batches(spark, path), keys, order)


def inserts(rows: DataFrame) -> DataFrame:
    """The fold of a table whose rows are inserted once."""
    return rows


@dataclass(frozen=True)
class Log:
    """A table that a job writes and reads in every micro-batch, in epochs of ``every`` batches.

    An epoch's first entry holds what ``fold`` makes of all earlier ones, so a batch reads one epoch
    however many there were: a snapshot and less than ``every`` batches.  ``fold`` takes rows of any
    batches with the column ``batch`` (a snapshot's is the least) and may leave that column in.
    ``by`` names columns whose values get folders of their own.
    """

    path: str
    every: int
    fold: Callable[[DataFrame], DataFrame] = inserts
    by: Sequence[str] = ()

    def _write(self, rows: DataFrame, epoch: int, entry: int) -> None:
        writer = rows.drop("epoch", "batch").write.mode("overwrite")
        (writer.partitionBy(*self.by) if self.by else writer).parquet(f"{self.path}/epoch={epoch}/batch={entry}")

    def _epoch(self, spark: SparkSession, epoch: int, schema: StructType | None) -> DataFrame:
        folder = f"{self.path}/epoch={epoch}"
        reader = spark.read.option("basePath", folder)
        if schema is not None:
            reader = reader.schema(StructType([*schema, StructField("batch", LongType())]))
        return reader.parquet(folder).withColumn("batch", F.col("batch").cast("bigint"))

    def write(self, rows: DataFrame, batch: int) -> None:
        self._write(rows, batch // self.every, batch)

    def begin(self, spark: SparkSession, batch: int, schema: StructType | None = None) -> None:
        """Makes the snapshot where the batch is an epoch's first; run again, it makes the same one.

        ``schema`` is needed with ``by``, where a batch without rows leaves no file to take it from.
        """
        epoch, place = divmod(batch, self.every)
        if epoch and not place:
            self._write(self.fold(self._epoch(spark, epoch - 1, schema)), epoch, -1)

    def before(self, spark: SparkSession, batch: int, schema: StructType | None = None) -> DataFrame:
        """Rows of all batches before this one, which is not the first, with the column ``batch``."""
        return self._epoch(spark, batch // self.every, schema).where(F.col("batch") < batch)

    def rows(self, spark: SparkSession) -> DataFrame:
        """The rows of all batches, as the newest epoch holds them."""
        rows = spark.read.option("basePath", self.path).parquet(self.path)
        newest = rows.agg(F.max("epoch")).first()[0]
        return rows if newest is None else rows.where(F.col("epoch") == newest).drop("epoch")
