"""Quality rules per document, and per host with rates shrunk by an empirical beta prior."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import slices, stored

#: Words of a window that may repeat; symbols that are counted.
WINDOW, SYMBOLS = 8, b"#*$%&|<>"
_BLANKS = b" \t\n\x0b\x0c\r"
#: A host is dropped for a rule that more than this share of its documents fails, after shrinking.
HOST_LIMIT = 0.5
#: Documents that the prior weighs as, at least and at most.
LEAST_PRIOR, MOST_PRIOR = 1.0, 10_000.0

#: Rules by name: whether a document fails, in SQL.
RULES = {
    "short": "n_words < 20",
    "repeated": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > 5 * n_words",
    "lines": "10 * n_dup_lines > 3 * n_lines",
    "word_length": "NOT coalesce(word_chars / nullif(n_words, 0), 0) BETWEEN 2 AND 15",
}
BASE = ("short", "repeated")

_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of WINDOW words that occur twice or more, compared exactly."""
    if len(words) <= WINDOW:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    if len(number) == len(words):
        return 0
    span = 1
    while span < WINDOW:  # numbers of twice as many words from pairs of numbers
        pairs = ids[:-span] * (ids.max() + 1) + ids[span:]
        ids = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
        span *= 2
    again = np.flatnonzero(np.bincount(ids)[ids] > 1)
    cover = np.zeros(len(words) + 1, np.int64)
    cover[again] += 1
    cover[again + WINDOW] -= 1
    return int((np.cumsum(cover) > 0).sum())


def measures_of(text: str | None) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines (with a word) of a whole text."""
    data = (text or "").encode()
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    blanks = len(data) - len(data.translate(None, _BLANKS))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    return len(words), len(text or "") - blanks, symbols, len(lines) - len(set(lines)), repeated_words(words), len(lines)


def measures(docs: DataFrame, host: str = "source") -> DataFrame:
    """(doc_id, host, measures ...) of each document."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            own = np.array([measures_of(x) for x in batch.column("text").to_pylist()], np.int64).reshape(-1, len(_MEASURES))
            columns = [batch.column("doc_id"), batch.column("host"), *(pa.array(own[:, i]) for i in range(len(_MEASURES)))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "host", *_MEASURES])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(host).cast("string").alias("host"), "text")
    return rows.mapInArrow(compute, "doc_id bigint, host string, " + ", ".join(f"{m} bigint" for m in _MEASURES))


def host_rates(measured: DataFrame) -> DataFrame:
    """(host, n, <rule>_rate ...): each host's share of failing documents, shrunk towards all hosts'.

    The beta prior of a rule has the mean and variance of the hosts' own rates (one vote a host). Failures
    are counted before the shuffle, so a host that holds most documents is one row like any other; the
    priors are one row.
    """
    counts = measured.groupBy("host").agg(F.count(F.lit(1)).alias("n"), *(F.count_if(F.expr(c)).alias(r) for r, c in RULES.items()))
    counts = stored(counts, "host-counts")
    moments = counts.agg(*(f(F.col(r) / F.col("n")).alias(f"{r}_{k}") for r in RULES for k, f in (("mean", F.mean), ("var", F.var_pop)))).first()
    rates = []
    for rule in RULES:
        mean, var = moments[f"{rule}_mean"] or 0.0, moments[f"{rule}_var"] or 0.0
        weight = min(MOST_PRIOR, max(LEAST_PRIOR, mean * (1 - mean) / var - 1)) if var > 0 else MOST_PRIOR
        rates.append(((F.col(rule) + F.lit(mean * weight)) / (F.col("n") + F.lit(weight))).alias(f"{rule}_rate"))
    return counts.select("host", "n", *rates)


def host_rules(docs: DataFrame, host: str = "source") -> DataFrame:
    """Measures, failed rules and verdict of each document.

    Takes (doc_id, text, <host>, ...) and returns a row per document: (doc_id, the measures, base_failed,
    host_failed, kept, failed_rules, host). A document is kept unless it fails a BASE rule itself or its
    host is dropped: some rule's shrunk failure rate there is over HOST_LIMIT. Null texts measure as empty
    ones and fail; a null host is one host; null ids and repeated rows are returned as they are, extra
    columns ignored. An empty table gives no rows.
    """
    measured = stored(measures(docs, host), "host-measures")
    dropped = F.greatest(*(F.col(f"{r}_rate") for r in RULES), F.lit(0.0)) > HOST_LIMIT
    verdicts = stored(host_rates(measured).select(F.col("host").alias("_host"), dropped.alias("host_failed")), "host-verdicts")
    base = F.expr(" OR ".join(RULES[r] for r in BASE))
    return measured.join(verdicts, F.col("host").eqNullSafe(F.col("_host"))).select(
        "doc_id",
        *_MEASURES,
        base.alias("base_failed"),
        "host_failed",
        (~base & ~F.col("host_failed")).alias("kept"),
        F.array_compact(F.array(*(F.when(F.expr(c), F.lit(r)) for r, c in RULES.items()))).alias("failed_rules"),
        "host",
    )
