"""Ranked search against scoring every document."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from corpus_rows import EDGE, documents

from wattline.llm import lexical

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return WORD.findall((text or "").translate(_LOWER))


def every_score(docs, items, most):
    """(item_id, rank, doc_id, score) of all documents scored one by one."""
    held = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item_id, text in {(i, t or "") for i, t in items}:
        asked, scores = Counter(terms(text)), []
        for doc_id, c in held:
            m = 75 + (25 * sum(c.values()) * n_docs) // max(1, n_terms)
            score = sum(
                r * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                for t, r in asked.items() if t in c
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        out += [(item_id, k, None if null else i, -s) for k, (s, null, i) in enumerate(sorted(scores)[:most], 1)]
    return sorted(out, key=str)


def searched(spark, docs, items, most=lexical.MOST):
    rows = documents(spark, [(i, t, "en", "a") for i, t in docs])
    asked = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "'x' AS terms", "0 AS rank", "1 AS _item", "2 AS score")
    return sorted((tuple(r) for r in lexical.best_documents(rows, asked, most).collect()), key=str)


def corpus(n, seed):
    rng = np.random.default_rng(seed)
    words = np.array([f"w{i}" for i in range(60)])
    share = 1 / np.arange(1, 61)
    return [" ".join(rng.choice(words, rng.integers(0, 40), p=share / share.sum())) for _ in range(n)]


@pytest.mark.parametrize("cells", [lexical.CELLS, 64])
def test_equals_scoring_all(spark, monkeypatch, cells):
    monkeypatch.setattr(lexical, "CELLS", cells)
    docs = list(enumerate(corpus(300, 1)))
    docs += [(1000 + i, "w1 w2 w50 w51") for i in range(40)] + [(7, "w1 w2 w50 w51")] * 2  # ties and repeated ids
    items = list(enumerate(corpus(12, 2))) + [(3, "w1 W2, w50 w1"), (3, "w1 W2, w50 w1"), (99, "unknown"), (98, None), (97, "")]
    got = searched(spark, docs, items)
    assert got == every_score(docs, items, lexical.MOST)
    assert {r[0] for r in got} & {97, 98, 99} == set() and max(r[1] for r in got) == 20


def test_items_in_several_passes(spark, monkeypatch):
    monkeypatch.setattr(lexical, "TERMS_TOGETHER", 10)
    docs, items = list(enumerate(corpus(80, 3))), list(enumerate(corpus(6, 4)))
    assert searched(spark, docs, items, 5) == every_score(docs, items, 5)


def test_item_of_many_terms(spark):
    docs = [(i, " ".join(f"t{j}" for j in range(i, 200, 7))) for i in range(40)]
    items = [(1, " ".join(f"t{j}" for j in range(200)))]
    assert searched(spark, docs, items) == every_score(docs, items, 20)


def test_edge_rows(spark):
    docs = [(i, t) for i, t, _, _ in EDGE]
    items = [(1, "one two THREE words"), (None, "ÉT wörd 'll"), (None, None)]
    assert searched(spark, docs, items) == every_score(docs, items, 20)


def test_empty_tables(spark):
    assert searched(spark, [], [(1, "one")]) == [] == searched(spark, [(1, "one")], [])
    assert searched(spark, [(1, None), (2, "")], [(1, "one")]) == []


def test_masks_below_the_bound_are_left_alone():
    rng = np.random.default_rng(5)
    present = rng.random((8, 2000)) < 0.3
    values = present * np.array([1, 1, 1, 1, 1, 1, 1000, 2000])[:, None]
    best = [lexical.Best(20)]
    ids = np.arange(2000)
    scored = lexical.search_block(best, [(np.arange(8), np.ones(8, np.int64))], values, present, ids, np.zeros(2000, bool))
    whole = values.sum(axis=0)
    assert best[0].ids.tolist() == np.lexsort((ids, -whole))[:20].tolist()
    assert scored < 400
