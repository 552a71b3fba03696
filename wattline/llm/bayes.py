"""Quality by hierarchical empirical Bayes: document evidence, host and path posteriors."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, DoubleType

from wattline.llm.common import stored

#: Labelled documents that the classifier is fitted on, at most: those of the least hash of their id.
SAMPLE = 20_000
#: Ridge and steps of the fit.
RIDGE, STEPS = 1.0, 25
#: Log-odds at most in either direction, of the evidence and of the rates.
MOST_ODDS = 12.0
#: Documents that a prior weighs as, at least and at most.
LEAST_PRIOR, MOST_PRIOR = 1.0, 10_000.0

FEATURES = ("symbols", "exclaimed", "capitals", "distinct", "adjacent", "repeated_lines", "word_length", "digits", "length")
_SYMBOLS, _DIGITS, _BLANKS = b"#*$%&|<>", b"0123456789", b" \t\n\x0b\x0c\r"


def features_of(text: str | None) -> list[float]:
    """FEATURES of a whole text, all finite; zeros without words."""
    data = (text or "").encode()
    words = data.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    without = lambda drop: len(data) - len(data.translate(None, drop))
    chars = max(1, len(text) - without(_BLANKS))
    lines = [x for x in data.split(b"\n") if x.strip()]
    capitals = sum(a != b for a, b in zip(text, text.lower(), strict=False)) if not text.islower() else 0
    return [
        min(2.0, without(_SYMBOLS) / n),
        min(2.0, data.count(b"!") / n),
        min(1.0, capitals / chars),
        len(set(words)) / n ** 0.9,
        sum(map(bytes.__eq__, words, words[1:])) / n,
        1 - len(set(lines)) / len(lines),
        min(20.0, chars / n) / 10,
        without(_DIGITS) / chars,
        np.log1p(n) / 10,
    ]


@arrow_udf(ArrayType(DoubleType()))
def features(text: pa.Array) -> pa.Array:
    return pa.array([features_of(x) for x in text.to_pylist()], pa.list_(pa.float64()))


class Model:
    """Logistic regression: ``odds`` of the standardised features, and the log-odds of a good label."""

    def __init__(self, x: np.ndarray, good: np.ndarray) -> None:
        n, k = x.shape
        self.mean = x.mean(0) if n else np.zeros(k)
        self.scale = np.maximum(x.std(0), 1e-6) if n else np.ones(k)
        self.weights, self.base, self.prior = np.zeros(k), 0.0, 0.0
        if not 0 < good.sum() < n:
            return  # nothing to tell apart: no evidence
        z = np.column_stack([(x - self.mean) / self.scale, np.ones(n)])
        w = np.zeros(k + 1)
        for _ in range(STEPS):  # Newton's steps
            p = 1 / (1 + np.exp(-np.clip(z @ w, -MOST_ODDS, MOST_ODDS)))
            gradient = z.T @ (good - p) - RIDGE * np.append(w[:-1], 0)
            curvature = (z * (p * (1 - p) + 1e-6)[:, None]).T @ z + RIDGE * np.eye(k + 1)
            w += np.linalg.solve(curvature, gradient)
        self.weights, self.base = w[:-1], float(w[-1])
        self.prior = float(np.log(good.mean() / (1 - good.mean())))

    def odds(self, own: Column) -> Column:
        terms = [(own[i] - F.lit(float(m))) * F.lit(float(w / s)) for i, (w, m, s) in enumerate(zip(self.weights, self.mean, self.scale, strict=True))]
        return F.greatest(F.lit(-MOST_ODDS), F.least(F.lit(MOST_ODDS), sum(terms, F.lit(self.base))))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """The classifier, from SAMPLE labelled documents at most; labels other than 0 and 1 don't count.

    Of rows that share an id, the least text counts, so that reruns fit the same model."""
    known = labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").select("doc_id", "quality")
    known = known.groupBy("doc_id").agg(F.min("quality").alias("_good"))
    known = stored(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE).select(F.col("doc_id").alias("_id"), "_good"), "quality-sample")
    rows = docs.join(known, F.col("doc_id") == F.col("_id")).groupBy("_id", "_good").agg(F.min("text").alias("_text"))
    rows = rows.select("_id", features("_text").alias("own"), "_good").orderBy("_id").collect()
    return Model(np.array([r["own"] for r in rows]).reshape(-1, len(FEATURES)), np.array([r["_good"] for r in rows], float))


def _weight(mean: float, var: float) -> float:
    return min(MOST_PRIOR, max(LEAST_PRIOR, mean * (1 - mean) / var - 1)) if var > 1e-12 else MOST_PRIOR


def _odds(p: Column) -> Column:
    return F.greatest(F.lit(-MOST_ODDS), F.least(F.lit(MOST_ODDS), F.log(p / (1 - p))))


def path_rates(scored: DataFrame) -> DataFrame:
    """(_host, _path, _host_rate, _path_rate) from (host, path, p): shares of good documents.

    A host's rate shrinks towards that of all documents, a path's towards its host's; the priors weigh as
    much as the spread of the rates says. Sums are of whole millionths, so they don't depend on the order,
    and combine before the shuffle.
    """
    millionths = F.round(F.col("p") * 1_000_000).cast("bigint")
    paths = stored(scored.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum(millionths).alias("s")), "quality-paths")
    hosts = stored(paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s")), "quality-hosts")
    rate = F.col("host_s") / 1e6 / F.col("host_n")
    total = hosts.agg(F.sum("host_s") / 1e6 / F.sum("host_n"), F.var_pop(rate)).first()
    mean = min(max(total[0] or 0.5, 1e-6), 1 - 1e-6)
    weight = _weight(mean, total[1] or 0.0)
    host_rate = (F.col("host_s") / 1e6 + mean * weight) / (F.col("host_n") + weight)
    hosts = stored(hosts.select(F.col("host").alias("_host"), host_rate.alias("host_rate")), "quality-host-rates")
    both = stored(paths.join(hosts, F.col("host").eqNullSafe(F.col("_host"))).drop("_host"), "quality-path-counts")
    spread = both.agg(F.avg(F.pow(F.col("s") / 1e6 / F.col("n") - F.col("host_rate"), 2))).first()[0] or 0.0
    weight = _weight(mean, spread)
    path_rate = (F.col("s") / 1e6 + F.col("host_rate") * weight) / (F.col("n") + weight)
    return both.select(F.col("host").alias("_host"), F.col("path").alias("_path"), F.col("host_rate").alias("_host_rate"), path_rate.alias("_path_rate"))


def classify(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang") -> DataFrame:
    """``docs`` with _evidence, _host_rate, _path_rate, _score and _kept.

    The evidence is the classifier's log-odds less those of its sample; the score adds the log-odds of the
    path's rate of good documents, and is kept from 0.5. Columns of ``docs`` stay (they may not begin with
    an underscore). Null texts are as empty ones, null hosts and paths are groups like others, repeated
    rows and null ids stay. Without labels of both kinds there is no evidence and all is kept. An empty
    table gives no rows. The rates are read from storage and broadcast only where they are small.
    """
    model = fit(docs, labels)
    odds = model.odds(features("text"))
    scored = docs.select(F.col(host).cast("string").alias("host"), F.col(path).cast("string").alias("path"), (1 / (1 + F.exp(-odds))).alias("p"))
    rates = stored(path_rates(scored), "quality-rates")
    joined = docs.join(rates, F.col(host).cast("string").eqNullSafe(F.col("_host")) & F.col(path).cast("string").eqNullSafe(F.col("_path")))
    joined = joined.withColumn("_evidence", odds - F.lit(model.prior))
    total = F.col("_evidence") + _odds(F.col("_path_rate"))
    return joined.drop("_host", "_path").withColumn("_score", 1 / (1 + F.exp(-total))).withColumn("_kept", F.col("_score") >= 0.5)


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, columns as they are."""
    return classify(docs, labels).filter("_kept").select(*(F.col(f"`{c}`") for c in docs.columns))
