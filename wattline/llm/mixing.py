"""Mixing sources to target weights: hash-random order, prefix sums, exact cuts."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.llm.common import n_words, partitions, prefix_sums, row_key, stored

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: The mix has this share of all words, and takes no document more often than MOST.
SHARE, MOST = 1.5, 2
#: Copies of a row that one task makes.
TOGETHER = 4096


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size) to (source, source_size, target).

    Sources in code point order, null last, take ``weights`` in turn and share ``share`` of all sizes. A
    target stops at ``most`` times its source's size and the excess goes to the others by weight. That
    water level is found in one pass (where ``share`` is above ``most``, every target stops): sources sorted by the level at which they are full, with prefix
    sums of what the full ones take. Only three numbers reach the driver.
    """
    code_points = [F.col("source").asc_nulls_last()]
    numbered = prefix_sums(sizes, code_points, {"_at": F.lit(1)}, "mix-sources", small=True)
    turn = F.array(*(F.lit(w) for w in weights))
    weighed = numbered.withColumn("_weight", F.get(turn, F.pmod(F.col("_at"), F.lit(len(weights))).cast("int")))
    weighed = weighed.withColumn("_full_at", F.lit(float(most)) * F.col("source_size") / F.col("_weight"))
    by_level = prefix_sums(
        weighed,
        [F.col("_full_at"), F.col("source").asc_nulls_last()],
        {"_size_before": F.col("source_size"), "_weight_before": F.col("_weight")},
        "mix-levels",
        small=True,
    )
    by_level = stored(by_level, "mix-levels")
    size, weight = by_level.agg(F.sum("source_size"), F.sum("_weight")).first()
    if not size:
        return by_level.select("source", "source_size", F.lit(0.0).alias("target"))
    level = (F.lit(share * size) - F.lit(float(most)) * F.col("_size_before")) / (F.lit(weight) - F.col("_weight_before"))
    place = F.struct("_full_at", F.col("source").isNull(), "source")
    at = by_level.filter(level <= F.col("_full_at")).agg(F.min_by(level, place)).first()[0]
    at = float("inf") if at is None else at
    return by_level.select(
        "source",
        "source_size",
        F.least(F.lit(float(most)) * F.col("source_size"), F.lit(float(at)) * F.col("_weight")).alias("target"),
    )


def _clamp(value: Column, most: str) -> Column:
    return F.greatest(F.lit(0), F.least(value, F.col(most))).cast("bigint")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST, apart: Column | None = None) -> DataFrame:
    """How many words of each document the mix takes.

    Takes (doc_id, source, text, ...) and returns one row per document: (doc_id, source, size,
    source_size, target, taken, row_key, apart); other columns are ignored. Each source is sorted by a hash of
    its documents and read until its budget, the target's whole words: full passes first, then the
    documents up to the cut, the last of them in part. So a source takes its budget exactly, and a
    document ``most`` times its size at most.

    A null text has size 0 and takes nothing; a null source is one source; null ids are kept. Documents
    that repeat id and text, and ``apart`` if given, are one row with a count until the end; they are then
    dealt out in ranges of TOGETHER copies, so that no group of them meets in one task; each copy is cut by
    its own place. An empty table gives no rows.
    """
    apart = (F.lit("") if apart is None else apart).alias("apart")
    narrow = docs.select("source", "doc_id", row_key().alias("row_key"), n_words().alias("size"), apart)
    rows = stored(narrow.groupBy(*narrow.columns).agg(F.count(F.lit(1)).alias("_copies")), "mix-rows")
    words = F.col("size") * F.col("_copies")
    sizes = rows.groupBy("source").agg(F.sum(words).alias("source_size"))
    targets = source_targets(sizes, weights, share, most)  # of a written table

    # Hash-random: each source in as many even parts as there are partitions, in the order of the key.
    chunk = F.shiftright(F.conv(F.substring("row_key", 1, 8), 16, 10).cast("bigint") * partitions(docs.sparkSession), 32)
    chunked = rows.withColumn("_chunk", chunk)
    before = Window.partitionBy("source").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunked.groupBy("source", "_chunk").agg(F.sum(words).alias("_total"))
    chunks = chunks.select(
        F.col("source").alias("_source"),
        F.col("_chunk").alias("_c"),
        F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_chunk_before"),
    )
    chunks = stored(chunks, "mix-chunks")
    within = Window.partitionBy("source", "_chunk").orderBy("row_key", "doc_id", "size", "apart")
    sorted_rows = chunked.repartitionByRange(partitions(docs.sparkSession), "source", "_chunk").withColumn(
        "_within", F.coalesce(F.sum(words).over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    placed = sorted_rows.join(chunks, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_chunk") == F.col("_c")))
    placed = placed.drop("_source")
    targets = targets.withColumnRenamed("source", "_source")
    placed = placed.join(targets, F.col("source").eqNullSafe(F.col("_source")))
    ranges = placed.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1, F.lit(TOGETHER).cast("bigint"))))
    dealt = ranges.repartition(partitions(docs.sparkSession), "row_key", "_from")
    last = F.least(F.col("_from") + TOGETHER, F.col("_copies")) - 1
    copy = dealt.withColumn("_copy", F.explode(F.sequence(F.col("_from"), last)))
    start = F.col("_chunk_before") + F.col("_within") + F.col("_copy") * F.col("size")
    budget = F.floor("target").cast("bigint")
    passes = F.expr("CAST(floor(target) AS BIGINT) DIV greatest(source_size, 1)")
    rest = budget - passes * F.col("source_size")
    return copy.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (passes * F.col("size") + _clamp(rest - start, "size")).cast("bigint").alias("taken"),
        "row_key",
        "apart",
    )


def mixed_documents(docs: DataFrame, **parameters) -> DataFrame:
    """The mix itself: the columns of ``docs``, a row for each pass over a document.

    A document that the cut falls into ends with its last word taken; one that takes no word is left out,
    which also leaves out documents without words.
    """
    own = docs.columns
    others = F.to_json(F.struct(*(F.col(f"`{c}`") for c in own if c not in ("doc_id", "text", "source"))), {"ignoreNullFields": "false"})
    apart = F.md5(others) if set(own) - {"doc_id", "text", "source"} else F.lit("")
    taken = mix(docs, **parameters, apart=apart).filter("taken > 0").select("row_key", "apart", F.col("source").alias("_source"), "size", "taken")
    taken = taken.groupBy("row_key", "apart", "_source", "size").agg(F.sum("taken").alias("taken"))
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in own)).alias("_doc"), row_key().alias("row_key"), apart.alias("apart"))
    # Rows of one key are equal in all columns.
    copies = keyed.groupBy("row_key", "apart", F.col("_doc.source").alias("_source")).agg(F.any_value("_doc").alias("_doc"))
    same = (copies["row_key"] == taken["row_key"]) & (copies["apart"] == taken["apart"]) & copies["_source"].eqNullSafe(taken["_source"])
    joined = copies.join(taken, same)
    passes = F.ceil(F.col("taken") / F.col("size")).cast("int")
    copy = joined.select("_doc", "size", "taken", F.explode(F.sequence(F.lit(1), passes)).alias("_pass"))
    left = F.least(F.col("size"), F.col("taken") - (F.col("_pass") - 1) * F.col("size")).cast("int")
    spaced = F.regexp_extract_all(F.col("_doc.text"), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    text = F.when(left == F.col("size"), F.col("_doc.text")).otherwise(F.array_join(F.slice(spaced, F.lit(1), left), ""))
    return copy.select(*(text.alias(c) if c == "text" else F.col(f"_doc.`{c}`").alias(c) for c in own))
