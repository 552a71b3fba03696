"""Running aggregates over groups of any size.

A window over ``partitionBy(key).orderBy(arrival)`` puts a whole key into one
task.  Here the rows are cut into ranges of the order, chosen from how the order is
spread, whatever the width of its numbers.  Totals per key and range are
pre-aggregated and added up per key, of which there are no more than ranges, and every
range then starts with one seed row holding what all earlier ones add up to.  The window
runs per (key, range), so a hot key is spread over as many tasks as there are ranges.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.sinks.workspace import workspace


def in_ranges(rows: DataFrame, order: Sequence[str] = ("arrival",), ranges: int | None = None) -> DataFrame:
    """``rows`` with ``_chunk``, the number of their range of the order; equal places share a range.

    Written once to the shared folder: totals and rows are then of the same ranges, and what
    made the rows is not computed for each of them.
    """
    spark = rows.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = workspace(spark, "ranges")
    ranged = rows.repartitionByRange(ranges, *order).withColumn("_chunk", F.spark_partition_id())
    ranged.write.parquet(path)
    return spark.read.schema(ranged.schema).parquet(path)


def running(
    rows: DataFrame,
    keys: list[str],
    carry: dict[str, Column],
    include_current: bool = True,
    order: Sequence[str] = ("arrival",),
    ranges: int | None = None,
    totals: DataFrame | None = None,
) -> DataFrame:
    """Replaces the columns in ``carry`` by their running aggregates per key.

    ``carry`` maps a column of ``rows`` to an associative aggregate over columns
    in ``carry`` (max, min, sum, max_by ...).  With ``include_current=False`` a
    row sees only the rows before it.  Rows that come from ``in_ranges`` keep their
    ranges, and ``totals`` may then give the aggregates per key and ``_chunk`` where
    there is a cheaper way to them.
    """
    if "_chunk" not in rows.columns:
        rows = in_ranges(rows, order, ranges)
    if totals is None:
        totals = rows.groupBy(*keys, "_chunk").agg(*[agg.alias(name) for name, agg in carry.items()])
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    seeds = (
        totals.select(*keys, "_chunk", *[agg.over(earlier).alias(name) for name, agg in carry.items()])
        .where(F.coalesce(*[F.when(F.col(name).isNotNull(), True) for name in carry]))
        .withColumn("_seed", F.lit(0))
    )
    seeded = rows.withColumn("_seed", F.lit(1)).unionByName(seeds, allowMissingColumns=True)
    upto = (
        Window.partitionBy(*keys, "_chunk")
        .orderBy("_seed", *order)
        .rowsBetween(Window.unboundedPreceding, 0 if include_current else -1)
    )
    kept = [F.col(c) for c in rows.columns if c not in carry and c != "_chunk"]
    return (
        seeded.select(*kept, "_seed", *[agg.over(upto).alias(name) for name, agg in carry.items()])
        .where(F.col("_seed") == 1)
        .drop("_seed")
    )
