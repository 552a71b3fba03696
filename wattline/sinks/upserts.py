"""Tables whose rows are upserted by key where they lie."""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Upserts:
    """A Parquet table with one row per key, the one of the greatest ``version``, in folders of ``by``.

    ``schema`` names all columns; ``by`` belongs to the key: a row never changes its folder, and a batch rewrites only the folders that its rows
    fall into. So batches should meet few of them (days, say), and the number of files does not grow with the number
    of batches. A version is a number that later rows have more of; of equal ones the later batch's row stays.

    A batch is merged beside the table first and then put in place. One that is killed before the merge is whole
    leaves the table as it was; one killed while folders are replaced is put in place again when it is repeated,
    from what was merged. A batch that is repeated as a whole changes nothing.
    """

    path: str
    schema: str
    keys: tuple[str, ...]
    by: tuple[str, ...]
    version: str = "version"

    def __call__(self, rows: DataFrame, batch: int) -> None:
        spark, merged = rows.sparkSession, f"{self.path}/merged/batch={batch}"
        if not _exists(spark, f"{merged}/_SUCCESS"):
            self._merge(rows).write.mode("overwrite").parquet(merged)
        self._put_in_place(spark.read.schema(self.schema).parquet(merged))
        _remove(spark, merged)

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.schema).parquet(f"{self.path}/rows")

    def _merge(self, rows: DataFrame) -> DataFrame:
        spark, new = rows.sparkSession, rows.withColumn("_batch", F.lit(1))
        if _exists(spark, f"{self.path}/rows"):
            new = new.unionByName(self.rows(spark).where(self._touched(rows)).withColumn("_batch", F.lit(0)))
        order = F.struct(self.version, "_batch")
        rest = [c for c in rows.columns if c not in self.keys]
        merged = new.groupBy(*self.keys).agg(*[F.max_by(c, order).alias(c) for c in rest])
        return merged.select(rows.columns).hint("rebalance", *self.by)

    def _touched(self, rows: DataFrame) -> Column:
        """What prunes the table's folders: one row per folder comes to the driver, no more than there are days."""
        folders = rows.select(*self.by).distinct().collect()
        one = lambda r: reduce(Column.__and__, [F.col(c) == r[c] for c in self.by])
        return reduce(Column.__or__, map(one, folders), F.lit(False))

    def _put_in_place(self, merged: DataFrame) -> None:
        writer = merged.hint("rebalance", *self.by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*self.by).parquet(f"{self.path}/rows")


def _path(spark: SparkSession, path: str):
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()), there


def _exists(spark: SparkSession, path: str) -> bool:
    files, there = _path(spark, path)
    return files.exists(there)


def _remove(spark: SparkSession, path: str) -> None:
    files, there = _path(spark, path)
    files.delete(there, True)
