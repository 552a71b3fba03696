"""Decontamination against brute force over all windows."""

import hashlib
import random
import re

import numpy as np
from corpus_rows import EDGE, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from wattline.llm import winnowing as W


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(text, items):
    doc, hit, ids = words(text), set(), set()
    for item_id, item in items:
        each = words(item)
        n = min(10, len(each))
        for i in range(len(each) - n + 1) if n else []:
            for at in range(len(doc) - n + 1):
                if doc[at : at + n] == each[i : i + n]:
                    hit.update(range(at, at + n))
                    if item_id is not None:
                        ids.add(str(item_id))
    return len(doc), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)


def bench(spark, items):
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, words string")


def check(spark, rows, items):
    got = W.decontaminate(documents(spark, rows), bench(spark, items)).collect()
    found = sorted(map(repr, ((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got)))
    assert found == sorted(map(repr, ((i, *brute(t, items)) for i, t, _, _ in rows)))


def test_random_texts(spark):
    rng = random.Random(5)
    vocabulary = ["a", "b", "Été", "d1", "E"]
    item = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, item(rng.choice([1, 4, 9, 10, 11, 25]) if i % 3 else 30)) for i in range(12)]
    rows = []
    for i in range(80):
        text = item(rng.randrange(0, 60))
        for _ in range(rng.randrange(3)):
            of = rng.choice(items)[1].split()
            a = rng.randrange(len(of))
            text += ",\n" + "; ".join(of[a : a + rng.randrange(5, 30)]).upper().replace("ÉTÉ", "Été")
        rows.append((i, text, "en", "s"))
    check(spark, rows, items)


def test_edges(spark, edge, empty):
    items = [(1, "one two three"), (1, "one two three"), (None, "four five"), (3, None), (4, "  "), (5, "LONG line of words here long line of words here long"), (6, "six"), (2, "ONE; two\tthree")]
    check(spark, EDGE, items)
    assert W.decontaminate(empty, bench(spark, items)).collect() == []
    assert {r.n_hit for r in W.decontaminate(edge, bench(spark, [])).collect()} == {0}


def test_a_common_passage(spark):
    passage = "the quick brown fox jumps over the lazy dog and then runs away home"
    check(spark, [(i, f"start{i} {passage} end", "en", "s") for i in range(200)], [(i, passage) for i in range(20)])


def test_a_phrase_makes_no_pairs(spark):
    """2,000 documents and 2,000 items share a phrase shorter than a window, and a few a window."""
    phrase = "which of the following statements is the best"
    items = W.items_of(bench(spark, [(i, f"{phrase} answer{i} a{i} b{i} c{i} d{i} e{i}") for i in range(2000)]))
    assert W.windows_of(items)[0].count() == 2000 * 5
    rows = [(i, f"doc{i} {phrase} reply{i} x y z {'answer%d a%d b%d' % (i, i, i) if i < 5 else ''}", "en", "s") for i in range(2000)]
    rows += [(3000 + i, f"doc{i} {phrase} answer{i} a{i} tail", "en", "s") for i in range(5)]
    got = W.decontaminate(documents(spark, rows), bench(spark, [(i, f"{phrase} answer{i} a{i} b{i} c{i} d{i} e{i}") for i in range(2000)])).collect()
    assert {r.doc_id: (r.n_hit, r.n_items) for r in got if r.contaminated} == {3000 + i: (10, 1) for i in range(5)}


def test_windows_around_a_print():
    assert W.windows_around(["w"] * 30, [(12, 10)]) == [(i, 10) for i in range(7, 13)]
    assert W.windows_around(["w"] * 12, [(0, 10), (7, 10)]) == [(0, 10), (2, 10)]
    assert W.windows_around(["w"] * 4, [(1, 3), (1, 3)]) == [(1, 3)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from("abcd"), min_size=10, max_size=10), st.lists(st.sampled_from("abcd"), max_size=25), st.lists(st.sampled_from("abcd"), max_size=25))
def test_every_shared_window_shares_a_print(span, before, after):
    own = set(W.winnow(*W.word_hashes([" ".join(span).encode()]))[1].tolist())
    other = set(W.winnow(*W.word_hashes([b"q r s", " ".join([*before, *span, *after]).encode()]))[1].tolist())
    assert own & other


def test_word_hashes_tell_texts_apart():
    hashes, bounds = W.word_hashes([W.fold(x) for x in ("Ab c", "", "c ab", None, "c")])
    assert bounds.tolist() == [0, 2, 2, 4, 4, 5]
    assert hashes[0] == hashes[3] and hashes[1] == hashes[2] == hashes[4] != hashes[0]
    assert len(np.unique(hashes)) == 2


def test_clean_documents(spark, edge):
    kept = W.clean_documents(edge, bench(spark, [(1, "one two three")]))
    assert kept.columns == edge.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 2, 3, 4, 5, 6, 7]
