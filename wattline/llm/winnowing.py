"""Benchmark decontamination by winnowed k-gram fingerprints, extended to exact hits."""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import row_key, slices, stored

#: Words of a window that counts as a copy; k-grams of K words, the least hash of every KEEP consecutive
#: ones is kept. K + KEEP - 1 = WINDOW, so any shared WINDOW words share a kept k-gram.
WINDOW, K = 10, 5
KEEP = WINDOW - K + 1
#: Bits of the filter that item fingerprints set. Its size is fixed, however many items there are.
FILTER_BITS = 1 << 23
#: Bytes of text that are hashed together.
TOGETHER = 2 << 20

#: Lower-cases A-Z and turns every byte that is no part of a word into a space. UTF-8 beyond ASCII is.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP, _MIX = np.uint64(0xD1342543DE82EF95), np.uint64(0xBF58476D1CE4E5B9)


def fold(text: str | None) -> bytes:
    return (text or "").encode().translate(_FOLD)


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, base, np.uint64)]), dtype=np.uint64)


def word_hashes(folded: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of all texts, and where each text's words begin (with the end)."""
    data = np.frombuffer(b" ".join(folded) + b" ", np.uint8)
    inside = data != 32
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    sums = np.concatenate([[np.uint64(0)], np.cumsum(data * _powers(_BASE, len(data) - 1), dtype=np.uint64)])
    hashes = (sums[ends] - sums[starts]) * _powers(_BASE_INVERSE, len(data) - 1)[starts]
    text_starts = np.cumsum([0, *(len(x) + 1 for x in folded)])
    return _mixed(hashes), np.searchsorted(starts, text_starts)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    return x ^ (x >> np.uint64(31))


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each ``k`` consecutive words."""
    n = max(0, len(hashes) - k + 1)
    out = np.full(n, k, np.uint64)
    for j in range(k):
        out = out * _STEP + hashes[j : j + n]
    return _mixed(out)


def _inside(bounds: np.ndarray, n: int, span: int) -> np.ndarray:
    """Places from which ``span`` words are of one text."""
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    return np.flatnonzero(text[: max(0, n - span + 1)] == text[span - 1 :]) if n >= span else np.empty(0, np.int64)


def winnow(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of kept k-grams: in each window within a text the last of the least."""
    at = _inside(bounds, len(hashes), WINDOW)
    if not len(at):
        return at, np.empty(0, np.uint64)
    gram = grams(hashes, K)
    place, least = at.copy(), gram[at]
    for j in range(1, KEEP):
        other = gram[at + j]
        lower = other <= least
        place[lower] = at[lower] + j
        least = np.where(lower, other, least)
    kept = np.unique(place)
    return kept, gram[kept]


def _groups(texts: list[str | None]) -> Iterator[list[bytes]]:
    group, size = [], 0
    for x in map(fold, texts):
        group.append(x)
        size += len(x)
        if size >= TOGETHER:
            yield group
            group, size = [], 0
    if group:
        yield group


def items_of(benchmark: DataFrame) -> DataFrame:
    """Distinct item texts with words: (words, ids, n, prints); ids are sorted texts, without null."""

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = [b" ".join(fold(x).split()).decode() for x in batch.column("text").to_pylist()]
            found = []
            for x in words:
                hashes, bounds = word_hashes([x.encode()])
                own = winnow(hashes, bounds)[1] if len(hashes) >= WINDOW else grams(hashes, len(hashes))
                found.append(np.unique(own).view(np.int64).tolist() if x else [])
            columns = [
                batch.column("item"),
                pa.array(words, pa.string()),
                pa.array([len(x.split()) for x in words], pa.int32()),
                pa.array(found, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["item", "words", "n", "prints"])

    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), "text").distinct()
    rows = rows.mapInArrow(prints, "item string, words string, n int, prints array<bigint>").filter("n > 0")
    ids = F.array_sort(F.collect_set("item")).alias("ids")
    return stored(rows.groupBy("words", "n", "prints").agg(ids), "items")


def print_filter(prints: DataFrame) -> np.ndarray:
    """The filter's 64-bit words; at most FILTER_BITS / 64 rows reach the driver, whatever the items."""
    bit = F.col("print").bitwiseAND(F.lit(FILTER_BITS - 1))
    mask = F.expr(f"shiftleft(1L, CAST(print & {63} AS INT))")
    rows = prints.groupBy(F.shiftright(bit, 6).alias("word")).agg(F.bit_or(mask).alias("mask"))
    out = np.zeros(FILTER_BITS // 64, np.uint64)
    for row in rows.collect():
        out[row["word"]] = np.uint64(row["mask"] & 0xFFFFFFFFFFFFFFFF)
    return out


def _in_filter(filtered: np.ndarray, prints: np.ndarray) -> np.ndarray:
    bit = prints & np.uint64(FILTER_BITS - 1)
    word = filtered[(bit >> np.uint64(6)).astype(np.int64)]
    return (word >> (bit & np.uint64(63))) & np.uint64(1) == 1


def _candidates(docs: DataFrame, filtered: np.ndarray, short: list[int]) -> DataFrame:
    """(doc_id, row_key, n_words, prints, words) per document: the kept prints that pass the filter, each with
    its place and the length of the windows it stands for, and the words where there are any prints. Items of
    fewer than WINDOW words are looked up by all grams of their length."""
    sent = docs.sparkSession.sparkContext.broadcast(filtered)
    found_type = pa.list_(pa.struct([("print", pa.int64()), ("at", pa.int32()), ("n", pa.int32())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sent.value
        for batch in slices(batches):
            counts, found, words = [], [], []
            for group in _groups(batch.column("text").to_pylist()):
                hashes, bounds = word_hashes(group)
                kept = [(*winnow(hashes, bounds), WINDOW)]
                for n in short:
                    at = _inside(bounds, len(hashes), n)
                    kept.append((at, grams(hashes, n)[at], n))
                places, prints = (np.concatenate([x[i] for x in kept]) for i in (0, 1))
                spans = np.repeat([n for *_, n in kept], [len(at) for at, *_ in kept])
                passed = _in_filter(bits, prints)
                places = places[passed]
                text = np.searchsorted(bounds, places, "right") - 1
                own: list[list[dict]] = [[] for _ in group]
                rows = zip(text.tolist(), prints[passed].view(np.int64).tolist(), (places - bounds[text]).tolist(), spans[passed].tolist(), strict=True)
                for t, p, at, n in rows:
                    own[t].append({"print": p, "at": at, "n": n})
                counts += np.diff(bounds).tolist()
                found += own
                words += [b" ".join(x.split()).decode() if o else None for x, o in zip(group, own, strict=True)]
            columns = [
                batch.column("doc_id"),
                batch.column("row_key"),
                pa.array(counts, pa.int64()),
                pa.array(found, found_type),
                pa.array(words, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row_key", "n_words", "prints", "words"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), row_key().alias("row_key"), "text")
    schema = "doc_id bigint, row_key string, n_words bigint, prints array<struct<print:bigint,at:int,n:int>>, words string"
    return stored(rows.mapInArrow(scan, schema), "decontaminate-candidates")


def windows_around(words: list[str], hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(place, length) of the windows that hits (place of the print, length) stand for: a short item's own gram, and
    the windows of WINDOW words that a kept print lies in, KEEP of them at most."""
    out = set()
    for at, n in hits:
        first = at if n < WINDOW else max(0, at - KEEP + 1)
        out.update((i, n) for i in range(first, min(at, len(words) - n) + 1))
    return sorted(out)


def _windows(found: DataFrame) -> DataFrame:
    """(row_key, at, n, window): what of each document is to be compared with windows of items."""

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            (key,), (text,), (hits,) = (batch.column(c).to_pylist() for c in ("row_key", "words", "hits"))
            words = text.split(" ")
            spans = windows_around(words, [(x["at"], x["n"]) for x in hits])
            for start in range(0, len(spans), 10_000):
                some = spans[start : start + 10_000]
                columns = [
                    pa.array([key] * len(some), pa.string()),
                    pa.array([at for at, _ in some], pa.int32()),
                    pa.array([n for _, n in some], pa.int32()),
                    pa.array([" ".join(words[at : at + n]) for at, n in some], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["row_key", "at", "n", "window"])

    return found.mapInArrow(extend, "row_key string, at int, n int, window string")


def windows_of(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct windows of items as (window, of), and the sets of item ids they are of as (of, ids)."""
    each, n = F.split("words", " "), F.least("n", F.lit(WINDOW))
    spans = F.transform(F.sequence(F.lit(1), F.col("n") - n + 1), lambda i: F.array_join(F.slice(each, i, n), " "))
    rows = items.select("ids", F.explode(F.array_distinct(spans)).alias("window"))
    rows = rows.groupBy("window").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("ids"))
    rows = stored(rows.withColumn("of", F.md5(F.to_json("ids"))), "item-windows")
    return rows.select("window", "of"), stored(rows.select("of", "ids").dropDuplicates(["of"]), "item-sets")


def _covered(spans: Column) -> Column:
    """How many words lie in any of the (at, n) spans."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("sum"))

    def add(x: Column, span: Column) -> Column:
        end = F.greatest(x["end"], span["at"] + span["n"])
        return F.struct(end.alias("end"), (x["sum"] + end - F.greatest(x["end"], span["at"])).alias("sum"))

    # A span inside the words so far adds nothing: its end is the old one, and so is the greater of both starts.
    inside = lambda x, span: F.when(span["at"] + span["n"] <= x["end"], x).otherwise(add(x, span))
    return F.aggregate(F.array_sort(spans), start, inside, lambda x: x["sum"])


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """What of each document is in the benchmark.

    Takes (doc_id, text, ...) and (item_id, text, ...); returns a row per document: (doc_id, n_words,
    n_hit, n_items, items_sha256, contaminated, row_key). A word is hit inside any occurrence of WINDOW
    consecutive words of an item, or of all words of a shorter item.

    Kept k-grams of documents first meet a filter of fixed size, then the items' by a join. Around a common
    print lie KEEP windows at most, and these are joined with the items' distinct windows, word by word. So
    no document meets an item without a common window, and a window that many items share is one row.
    Nulls and texts without words hit nothing. Rows with equal id and text are each returned. Items without
    id mark words and count no item; repeated items count once. Extra columns are ignored, empty tables
    give no hits.
    """
    items = items_of(benchmark)
    prints = items.select(F.explode("prints").alias("print"))
    short = [r.n for r in items.filter(F.col("n") < WINDOW).select("n").distinct().orderBy("n").collect()]
    rows = _candidates(docs, print_filter(prints), short)
    found = rows.filter("words IS NOT NULL").dropDuplicates(["row_key"])
    shared = found.select("row_key", F.inline("prints")).join(prints.distinct(), "print", "left_semi")
    hits = shared.groupBy("row_key").agg(F.collect_list(F.struct("at", "n")).alias("hits"))
    windows, sets = windows_of(items)
    matched = stored(_windows(found.select("row_key", "words").join(hits, "row_key")).join(windows, "window").drop("window"), "decontaminate-matched")
    cover = matched.groupBy("row_key").agg(_covered(F.collect_list(F.struct("at", "n"))).alias("n_hit"))
    ids = matched.select("row_key", "of").distinct().join(sets, "of").select("row_key", F.explode("ids").alias("id"))
    ids = ids.groupBy("row_key").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    digest = F.sha2(F.array_join("ids", ","), 256)
    hit = cover.join(ids, "row_key", "left").select("row_key", "n_hit", F.size("ids").cast("bigint").alias("n_items"), digest.alias("items_sha256"))
    none = hashlib.sha256(b"").hexdigest()
    return rows.join(hit, "row_key", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce(F.when(F.col("n_items") > 0, F.col("n_items")), F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("items_sha256", F.lit(none)).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        "row_key",
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a hit, columns as they are."""
    hit = stored(decontaminate(docs, benchmark).filter("contaminated").select(F.col("row_key").alias("_hit")), "contaminated")
    return docs.join(hit, row_key() == F.col("_hit"), "left_anti")
