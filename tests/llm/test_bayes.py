"""Hierarchical Bayes: held-out accuracy, shrinkage, edges."""

import math
import random
import re

import numpy as np
import pytest
from corpus_rows import documents

from wattline.llm import bayes as B

SF = "/root/testdata/sf0.01"


def labels(spark, rows):
    return spark.createDataFrame([(i, q, 0, "x") for i, q in rows], "doc_id bigint, quality int, toxic int, text string")


def test_features_are_finite():
    for text in (None, "", " \n", "A", "ÄÖ!! 12", "İ" * 9, "a b\n\n", "x" * 10_000):
        own = B.features_of(text)
        assert len(own) == len(B.FEATURES) and all(abs(x) < 1000 for x in own)


def test_held_out_accuracy(spark):
    docs, known = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    judged = B.classify(docs, known.filter("doc_id % 2 = 0"))
    rows = judged.join(known.filter("doc_id % 2 = 1"), "doc_id").select("quality", "_kept").collect()
    good = [r._kept for r in rows if r.quality == 1]
    bad = [r._kept for r in rows if r.quality == 0]
    assert sum(good) / len(good) > 0.97 and sum(bad) / len(bad) < 0.15


def test_rates_shrink_to_host_and_all(spark):
    rng = random.Random(1)
    rows = [(h, p, min(1.0, max(0.0, m + rng.uniform(-0.05, 0.05)))) for h, m in (("a", 0.9), ("b", 0.5), ("c", 0.7)) for p in "xyz" for _ in range(200)]
    rows += [("a", "one", 0.0), ("lone", "x", 0.0), (None, None, 1.0)]
    got = {(r._host, r._path): r for r in B.path_rates(spark.createDataFrame(rows, "host string, path string, p double")).collect()}
    assert abs(got["a", "x"]._path_rate - 0.9) < 0.02 and abs(got["b", "x"]._host_rate - 0.5) < 0.02
    assert 0 < got["lone", "x"]._host_rate < got["c", "x"]._host_rate
    assert got["a", "one"]._path_rate > 0.3 and (None, None) in got


def test_edges(spark, edge, empty):
    good = [(5, 1), (6, 0), (8, 1), (1, 1), (1, None), (None, 0), (99, 0)]
    judged = B.classify(edge, labels(spark, good)).collect()
    assert len(judged) == 11 and all(0 <= r._score <= 1 for r in judged)
    kept = B.good_documents(edge, labels(spark, good))
    assert kept.columns == edge.columns
    assert B.good_documents(empty, labels(spark, good)).collect() == []


@pytest.mark.parametrize("known", [[], [(1, 1)], [(1, 5)]])
def test_without_both_labels_all_is_kept(spark, edge, known):
    assert B.good_documents(edge, labels(spark, known)).count() == 11


def restated(docs, known):
    """(evidence, host rate, path rate, score) per document, by loops: docs of (doc_id, text, path, host), known quality by doc_id."""

    def own(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        if not words:
            return [0.0] * 9
        chars, lines = sum(map(len, words)), [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        n, count = len(words), lambda marks: sum(c in marks for c in text)
        return [min(2, count("#*$%&|<>") / n), min(2, count("!") / n), min(1, sum(c != c.lower() for c in text) / chars), len(set(words)) / n**0.9,
                sum(words[i] == words[i + 1] for i in range(n - 1)) / n, 1 - len(set(lines)) / len(lines), min(20, chars / n) / 10, count("0123456789") / chars, math.log(1 + n) / 10]

    x = np.array([own(d[1]) for d in docs])
    at = [i for i, d in enumerate(docs) if d[0] in known]
    y = np.array([known[docs[i][0]] for i in at], float)
    mean, scale = x[at].mean(0), np.maximum(x[at].std(0), 1e-6)
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w, ridge = np.zeros(10), np.diag([1.0] * 9 + [0.0])
    for _ in range(200):  # the penalised likelihood has one greatest place
        p = 1 / (1 + np.exp(-z[at] @ w))
        w = w + np.linalg.solve(z[at].T @ (z[at] * (p * (1 - p))[:, None]) + ridge + 1e-3 * np.eye(10), z[at].T @ (y - p) - ridge @ w)
    odds = np.clip(z @ w, -12, 12)
    share = [round(1e6 / (1 + math.exp(-o))) / 1e6 for o in odds]

    def weight(m, var):
        return min(1e4, max(1.0, m * (1 - m) / var - 1)) if var > 1e-12 else 1e4

    hosts, paths = {}, {}
    for d, p in zip(docs, share):
        hosts.setdefault(d[3], []).append(p)
        paths.setdefault((d[3], d[2]), []).append(p)
    everyone = sum(share) / len(share)
    prior = weight(everyone, float(np.var([sum(v) / len(v) for v in hosts.values()])))
    host = {k: (sum(v) + everyone * prior) / (len(v) + prior) for k, v in hosts.items()}
    prior = weight(everyone, float(np.mean([(sum(v) / len(v) - host[k[0]]) ** 2 for k, v in paths.items()])))
    path = {k: (sum(v) + host[k[0]] * prior) / (len(v) + prior) for k, v in paths.items()}
    base = math.log(y.mean() / (1 - y.mean()))
    for d, o in zip(docs, odds):
        rate = path[d[3], d[2]]
        total = o - base + min(12, max(-12, math.log(rate / (1 - rate))))
        yield d[0], (o - base, host[d[3]], rate, 1 / (1 + math.exp(-total)))


def test_whole_posterior_equals_a_restatement(spark):
    rng = random.Random(3)
    docs = []
    for i in range(240):
        host, good = rng.choice(["a", "b", "c", None]), rng.random()
        junk = good < {"a": 0.1, "b": 0.4, "c": 0.8, None: 0.5}[host]
        words = [rng.choice(["Word", "some", "text", "of", "many", "lines"] if not junk or rng.random() < 0.6 else ["$$$", "BUY!", "99", "now"]) for _ in range(rng.randint(0, 60))]
        docs.append((i, "".join(w + rng.choice(" \n ") for w in words) if words else None, rng.choice(["en", "de", None]), host, junk))
    known = {d[0]: int(not d[4]) if rng.random() < 0.9 else int(d[4]) for d in docs[::2]}
    judged = B.classify(documents(spark, [d[:4] for d in docs]), labels(spark, known.items())).collect()
    want = dict(restated(docs, known))
    assert len(judged) == len(want)
    for r in judged:
        assert (r._evidence, r._host_rate, r._path_rate, r._score) == pytest.approx(want[r.doc_id], abs=1e-4)
        assert r._kept == (r._score >= 0.5)
