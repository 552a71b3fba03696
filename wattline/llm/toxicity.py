"""Toxicity of whole texts by the recurrent network, learnt from labelled documents."""

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import slices, stored
from wattline.llm.recurrent import Network, Scorer, train

#: Labelled documents that the network is trained on, at most: those of the least hash of their id.
SAMPLE = 3_000
#: Score from which a document counts as toxic.
THRESHOLD = 0.3

_scorers: dict[str, Scorer] = {}


def held_out(doc_id: str = "doc_id"):
    """Documents that are never learnt from; a null id is not among them."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame) -> Network:
    """The network, from SAMPLE labelled documents at most that are not held out.

    Of rows that share an id, the least text counts, so that reruns train the same network."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
    known = stored(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE).select(F.col("doc_id").alias("_id"), "_toxic"), "toxicity-sample")
    rows = docs.join(known, F.col("doc_id") == F.col("_id")).groupBy("_id", "_toxic").agg(F.min("text").alias("_text"))
    rows = rows.orderBy("_id").collect()
    return train([r["_text"] for r in rows], [r["_toxic"] for r in rows])


def score(docs: DataFrame, network: Network) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each document.

    Every window of every whole text is scored, and the highest counts. Null and empty texts score 0,
    rows with equal or null ids are each returned, other columns are no input. An empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(network)
    key = uuid.uuid4().hex

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _scorers:  # a worker's tasks share the words it knows
            _scorers.clear()
            _scorers[key] = Scorer(sent.value)
        for batch in slices(batches):
            scores = _scorers[key].scores(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(scores.astype(np.float64))], ["doc_id", "held_out", "score"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out().alias("held_out"), "text")
    scored = rows.mapInArrow(compute, "doc_id bigint, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))
