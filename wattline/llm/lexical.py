"""Ranked lexical search: documents grouped by which of a query's terms they hold.

Documents pass in blocks. A block's presence of every query term is a bitmap; for each item the bitmaps of
its terms, laid side by side, give every document its mask. Documents of one mask share an upper bound of
their score, the sum of the most that each of the mask's terms adds to any document of the block. Masks are
evaluated from the highest bound down, and left alone once the bound is below the scores already found.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from wattline.llm.common import prefix_sums, row_key, slices, stored
from wattline.llm.winnowing import fold

#: Documents returned per item.
MOST = 20
#: Distinct terms of the items that are searched together; an item with more is searched alone.
TERMS_TOGETHER = 1 << 16
#: Cells (terms x documents) of a block, documents of it, and documents scored in one step.
CELLS, LEAST_DOCS, MOST_DOCS, STEP = 1 << 22, 64, 2048, 128
#: Groups that an item's candidates are first ranked in.
SALTS = 64


def terms_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of all that is not ASCII, A-Z in lower case; null has none."""
    return fold(text).split()


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        found = [np.unique(np.array(terms_of(x), object), return_counts=True) for x in batch.column("text").to_pylist()]
        terms = pa.array([t.tolist() for t, _ in found], pa.list_(pa.binary()))
        repeats = pa.array([r.tolist() for _, r in found], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column("_item"), batch.column("item_id"), terms, repeats], names=["_item", "item_id", "terms", "repeats"])


def item_blocks(items: DataFrame) -> DataFrame:
    """(_block, _item, item_id, terms, repeats) of the different (item_id, text) that have terms."""
    rows = items.select(row_key("item_id").alias("_item"), "item_id", "text").dropDuplicates(["_item"])
    kind = items.schema["item_id"].dataType.simpleString()
    found = stored(rows.mapInArrow(_item_rows, f"_item string, item_id {kind}, terms array<binary>, repeats array<bigint>"), "search-items")
    placed = prefix_sums(found.where(F.size("terms") > 0), [F.col("_item")], {"_before": F.size("terms").cast("bigint")}, "search-items")
    return stored(placed.withColumn("_block", F.floor(F.col("_before") / TERMS_TOGETHER)).drop("_before"), "search-item-blocks")


def index(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, counts) of every document: its number of terms, and those of the vocabulary it holds."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = vocabulary.get
        for batch in slices(batches):
            n, found = [], []
            for text in batch.column("text").to_pylist():
                words = terms_of(text)
                n.append(len(words))
                held = np.array([v for v in map(get, words) if v is not None], np.int32)
                found.append(np.unique(held, return_counts=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array([t for t, _ in found], pa.list_(pa.int32())), pa.array([c for _, c in found], pa.list_(pa.int64()))],
                names=["doc_id", "n", "terms", "counts"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(count, f"doc_id {kind}, n bigint, terms array<int>, counts array<bigint>")


class Best:
    """The best documents of one item so far: scores from high to low, equal ones by id, null ids last."""

    def __init__(self, most: int) -> None:
        self.most = most
        self.scores = self.ids = np.empty(0, np.int64)
        self.nulls = np.empty(0, bool)

    def floor(self) -> int:
        """The score below which no document counts."""
        return int(self.scores[-1]) if len(self.scores) == self.most else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        own = scores >= self.floor()
        scores, ids, nulls = (np.concatenate(x) for x in ((self.scores, scores[own]), (self.ids, ids[own]), (self.nulls, nulls[own])))
        kept = np.lexsort((ids, nulls, -scores))[: self.most]
        self.scores, self.ids, self.nulls = scores[kept], ids[kept], nulls[kept]


def search_block(best: list[Best], items: list[tuple[np.ndarray, np.ndarray]], values: np.ndarray, present: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> int:
    """Adds a block's documents to the ``best`` of each item; returns how many it had to score.

    ``items`` are (terms, repeats), ``values`` what a term adds to a document's score and ``present``
    whether the document holds it, both terms x documents.
    """
    most, scored = values.max(axis=1), 0
    for own, (terms, repeats) in zip(best, items, strict=True):
        terms, repeats = terms[most[terms] > 0], repeats[most[terms] > 0]
        if not len(terms) or int(repeats @ most[terms]) < own.floor():
            continue
        bitmaps = np.packbits(present[terms], axis=0)
        masks = np.ascontiguousarray(bitmaps.T).view(np.dtype((np.void, len(bitmaps)))).reshape(-1)
        masks, group, sizes = np.unique(masks, return_inverse=True, return_counts=True)
        bits = np.unpackbits(masks.view(np.uint8).reshape(len(masks), -1), axis=1, count=len(terms))
        bounds = bits.astype(np.int64) @ (repeats * most[terms])
        order = np.argsort(-bounds, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        documents, ends = np.argsort(place[group], kind="stable"), np.cumsum(sizes[order])
        at = begin = 0
        while at < len(order) and bounds[order[at]] >= own.floor():  # an equal score may still win by its id
            at = int(np.searchsorted(ends, begin + STEP)) + 1
            some = documents[begin : (begin := int(ends[min(at, len(ends)) - 1]))]
            own.add(repeats @ values[np.ix_(terms, some)], ids[some], nulls[some])
            scored += len(some)
    return scored


def _search(indexed: DataFrame, items: list[tuple], weights: np.ndarray, n_docs: int, n_terms: int, most: int, schema: StructType) -> DataFrame:
    """(_no, item_id, doc_id, score): the best documents of every task for each item."""
    pairs = [(terms, repeats) for _, terms, repeats in items]
    names = [item_id for item_id, _, _ in items]
    block_docs = max(LEAST_DOCS, min(MOST_DOCS, CELLS // max(1, len(weights))))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(most) for _ in pairs]
        for batch in slices(batches, block_docs):
            nulls = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            ids = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
            sizes = batch.column("terms").value_lengths().to_numpy(zero_copy_only=False)
            doc = np.repeat(np.arange(batch.num_rows), sizes)
            term = batch.column("terms").flatten().to_numpy(zero_copy_only=False)
            tf = batch.column("counts").flatten().to_numpy(zero_copy_only=False)
            m = 75 + (25 * batch.column("n").to_numpy(zero_copy_only=False) * n_docs) // max(1, n_terms)
            values = np.zeros((len(weights), batch.num_rows), np.int64)
            values[term, doc] = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc]))
            present = np.zeros(values.shape, bool)
            present[term, doc] = True
            search_block(best, pairs, values, present, ids, nulls)
        for no, own in enumerate(best):
            if len(own.scores):
                columns = ([no] * len(own.scores), [names[no]] * len(own.scores), [None if x else i for i, x in zip(own.ids.tolist(), own.nulls, strict=True)], own.scores.tolist())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=schema.names)

    kinds = [to_arrow_type(f.dataType) for f in schema]
    return indexed.mapInArrow(search, schema)


def best_documents(docs: DataFrame, items: DataFrame, most: int = MOST) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``most`` highest-scoring documents of each item.

    Takes (doc_id, text, ...) and (item_id, text, ...), integer doc_ids; other columns are ignored. Every
    row of ``docs`` is a document; rows of ``items`` that repeat id and text are one item, those that
    repeat only the id are items of their own. Null and empty texts have no terms: such documents count
    nowhere, such items have no rows. Null doc_ids come last among equal scores. An empty table on either
    side gives no rows. Weights and lengths are of all documents. Only the terms of TERMS_TOGETHER distinct
    item terms are with a task at a time; more items are searched in further passes.
    """
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    ids = StructField("item_id", items.schema["item_id"].dataType), StructField("doc_id", docs.schema["doc_id"].dataType)
    schema = StructType([StructField("_no", IntegerType()), *ids, StructField("score", LongType())])
    blocks, parts = item_blocks(items), []
    for (block,) in sorted(blocks.select("_block").distinct().collect()):
        rows = blocks.where(F.col("_block") == block).orderBy("_item").collect()
        vocabulary = {t: i for i, t in enumerate(sorted({bytes(t) for r in rows for t in r["terms"]}))}
        own = [(r["item_id"], np.array([vocabulary[bytes(t)] for t in r["terms"]], np.int64), np.array(r["repeats"], np.int64)) for r in rows]
        indexed = stored(index(docs, vocabulary), "search-index")
        n_docs, n_terms = indexed.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
        held = np.zeros(len(vocabulary), np.int64)
        for term, n in indexed.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            held[term] = n
        weights = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * held + 1))).astype(np.int64)
        found = _search(indexed, own, weights, n_docs, n_terms or 0, most, schema)
        found = found.withColumn("_salt", F.spark_partition_id() % SALTS).withColumn("_block", F.lit(block))
        parts.append(found)
    if not parts:
        return docs.sparkSession.createDataFrame([], StructType([ids[0], StructField("rank", IntegerType()), ids[1], schema["score"]]))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    for keys in (["_block", "_no", "_salt"], ["_block", "_no"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= most)
    return found.select("item_id", "rank", "doc_id", "score")
