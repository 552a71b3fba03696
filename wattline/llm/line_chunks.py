"""Line deduplication by content-defined chunks of lines."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import WORD, members, might_be_in, row_key, stored

#: Lines that the rolling hash spans, lines of a chunk on average, modulus and factor of the hash.
SPAN, AVERAGE, MODULUS, FACTOR = 2, 3, 2_147_483_647, 31_337
#: Lines with a word that a chunk has at least to be removed, and words of a line that is a chunk by itself.
LEAST_LINES, LONG_LINE = 2, 50


def line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 7), 16, 10).cast("bigint")


def with_parts(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_parts``, their chunks in order: (body, n_lines, passage).

    A rolling hash over SPAN line hashes ends a chunk where it is divisible by AVERAGE, so boundaries depend on
    nearby lines alone and move with them. A line of LONG_LINE words or more is cut off on both sides: it is a
    passage wherever it stands. So is a chunk of LEAST_LINES lines with a word. Chunks cover the whole text;
    joined by newlines they give it back.
    """
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    rows = docs.withColumn("_lines", lines)
    long = F.transform("_lines", lambda x: F.regexp_count(x, F.lit(WORD)) >= LONG_LINE)
    rows = rows.withColumns({"_hashes": F.transform("_lines", line_hash), "_long": long})
    rolled = F.transform(F.sequence(F.lit(1), F.size("_hashes")), lambda i: sum((F.coalesce(F.get("_hashes", i - 1 - j), F.lit(0)) * (FACTOR**j % MODULUS) for j in range(SPAN)), F.lit(0)) % MODULUS)
    ends = lambda h, i: (h % AVERAGE == 0) | (i + 1 == F.size("_hashes")) | F.get("_long", i) | F.coalesce(F.get("_long", i + 1), F.lit(False))
    rows = rows.withColumn("_ends", F.filter(F.transform(rolled, lambda h, i: F.when(ends(h, i), i + 1)), lambda i: i.isNotNull()))
    begins = F.concat(F.array(F.lit(0)), F.slice("_ends", 1, F.size("_ends") - 1))

    def part(begin: Column, end: Column) -> Column:
        own = F.slice("_lines", begin + 1, end - begin)
        full = F.size(F.filter(own, lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
        body = F.array_join(own, "\n")
        # Counted again in the body: an array read at one place of a lambda would be made anew for every element.
        passage = (full >= LEAST_LINES) | ((end - begin == 1) & (F.regexp_count(body, F.lit(WORD)) >= LONG_LINE))
        return F.struct(body.alias("body"), (end - begin).alias("n_lines"), passage.alias("passage"))

    return rows.withColumn("_parts", F.zip_with(begins, "_ends", part)).drop("_lines", "_hashes", "_long", "_ends")


def chunks(docs: DataFrame) -> DataFrame:
    """(row_key, doc_id, chunk, n_lines, passage, body) of each chunk of each document."""
    rows = with_parts(docs.select(row_key().alias("row_key"), F.col("doc_id").cast("bigint").alias("doc_id"), "text"))
    # Outer, though no text is without chunks: a plain generator makes a filter of its input, which is then computed
    # element by element.
    placed = rows.select("row_key", "doc_id", F.posexplode_outer("_parts").alias("chunk", "_part"))
    return placed.select("row_key", "doc_id", "chunk", "_part.n_lines", "_part.passage", "_part.body")


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """(row_key, chunk) of the chunks to remove: passages that are equal in every byte to one in an earlier document or earlier in the same, by doc_id (null last), row_key and place.

    Hashes come first: only chunks whose 64-bit hash and length occur twice are carried on, past a filter
    of fixed size that spares the others the shuffle, and these are grouped by their text. All groupings
    combine before the shuffle.
    """
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key", "chunk").alias("place")
    every = chunks(docs).filter("passage").select(F.xxhash64("body").alias("hash"), place, "body")
    light = stored(every.select("hash", F.octet_length("body").alias("bytes"), "place"), "line-chunks")
    twice = light.groupBy("hash", "bytes").agg(F.min("place").alias("least"), F.max("place").alias("most"))
    twice = stored(twice.filter("least != most").select(F.col("hash").alias("_hash"), F.col("bytes").alias("_bytes")), "line-chunks-twice")
    same = (F.col("hash") == F.col("_hash")) & (F.octet_length("body") == F.col("_bytes"))
    likely = might_be_in(every, F.col("hash"), members(twice, F.col("_hash"))).filter("_might").drop("_might")
    held = stored(likely.join(twice, same, "left_semi"), "line-chunks-held")
    first = stored(held.groupBy("hash", "body").agg(F.min("place").alias("first")).withColumnsRenamed({"hash": "_hash", "body": "_body"}), "line-chunks-first")
    later = held.join(first, (F.col("hash") == F.col("_hash")) & (F.col("body") == F.col("_body"))).filter("place != first")
    return later.select("place.row_key", "place.chunk")


def dedup_lines(docs: DataFrame) -> DataFrame:
    """Each document without the chunks of lines that came before.

    Takes (doc_id, text, ...) and returns (doc_id, n_lines, n_chunks, n_removed, lines_removed, text). The
    first place of a chunk stays, all later ones go, also within a document. A null text has one empty
    line and becomes empty; rows that repeat id and text are one place and keep the same. Extra columns are
    ignored; an empty table gives no rows.
    """
    removed = repeated_chunks(docs).groupBy("row_key").agg(F.collect_set("chunk").alias("gone"))
    removed = stored(removed.withColumnRenamed("row_key", "_key"), "line-chunks-removed")
    rows = docs.select(row_key().alias("row_key"), F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    hashed = F.xxhash64("_key")
    rows = might_be_in(rows, F.xxhash64("row_key"), members(removed, hashed))
    likely = rows.filter("_might").join(removed, F.col("row_key") == F.col("_key"), "left")
    lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("n_lines")
    none = (F.lit(0).alias("n_removed"), F.lit(0).alias("lines_removed"), F.coalesce("text", F.lit("")).alias("text"))
    whole = rows.filter("NOT _might").select("row_key", "doc_id", lines, *none)
    whole = whole.unionByName(likely.filter("gone IS NULL").select("row_key", "doc_id", lines, *none))
    hit = with_parts(likely.filter("gone IS NOT NULL").select("row_key", "doc_id", "text", "gone"))
    out = F.filter("_parts", lambda _, i: F.array_contains("gone", i))
    kept = F.filter("_parts", lambda _, i: ~F.array_contains("gone", i))
    count = lambda parts: F.aggregate(parts, F.lit(0), lambda n, x: n + x["n_lines"])
    cut = hit.select(
        "row_key",
        "doc_id",
        count(F.col("_parts")).alias("n_lines"),
        F.size(out).alias("n_removed"),
        count(out).alias("lines_removed"),
        F.array_join(F.transform(kept, lambda x: x["body"]), "\n").alias("text"),
    )
    return whole.unionByName(cut).drop("row_key")
