"""Mixing against a plain model: sources, targets, cuts."""

import hashlib
import random
import re
from collections import defaultdict

from corpus_rows import EDGE, documents
from pyspark.sql import functions as F

from wattline.llm import common, mixing


def water(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Targets by resharing until none is above its stop."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, left = {}, set(order)
    while True:
        rest = share * sum(sizes.values()) - sum(full.values())
        level = rest / sum(weight[s] for s in left) if left else 0
        over = [s for s in left if level * weight[s] > most * sizes[s]]
        if not over:
            return full | {s: level * weight[s] for s in left}
        for s in over:
            full[s] = most * sizes[s]
            left.discard(s)


def check(rows, got):
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _, _ in rows]
    sizes = defaultdict(int)
    for (_, _, _, s), n in zip(rows, size):
        sizes[s] += n
    want = water(sizes)
    taken = defaultdict(int)
    assert sorted((r.doc_id is None, r.doc_id or 0, r["size"]) for r in got) == sorted(
        (i is None, i or 0, n) for (i, _, _, _), n in zip(rows, size)
    )
    for r in got:
        assert r.source_size == sizes[r.source]
        assert abs(r.target - want[r.source]) < 1e-6 * max(1, r.target)
        assert 0 <= r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
    for s in sizes:
        assert taken[s] == int(want[s] + 1e-9)


def test_edges(spark, edge):
    check(EDGE, mixing.mix(edge).collect())


def test_random_sources(spark):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randrange(0, 40), "en", "hot" if rng.random() < 0.4 else rng.choice("abcdefg") * 2) for i in range(600)]
    first = mixing.mix(documents(spark, rows)).collect()
    check(rows, first)
    again = mixing.mix(documents(spark, rows[::-1]).repartition(5)).collect()
    assert sorted((r.doc_id, r.taken) for r in first) == sorted((r.doc_id, r.taken) for r in again)


def test_order_within_a_source_is_that_of_the_hash(spark):
    rows = [(i, f"x{i} y", "en", s) for i, s in enumerate("aaaaaaaaaabbbbbbbbbb")]
    got = {r.doc_id: r.taken for r in mixing.mix(documents(spark, rows)).collect()}
    key = lambda i: hashlib.md5(f"{i}:{hashlib.md5(rows[i][1].encode()).hexdigest()}".encode()).hexdigest()
    for source in (range(10), range(10, 20)):
        took = [got[i] for i in sorted(source, key=key)]
        assert took == sorted(took, reverse=True)


def test_copies_of_one_row_are_cut_by_place(spark):
    rows = [(7, "a b c", "en", "x")] * 50 + [(8, "a b", "en", "y")] * 50
    check(rows, mixing.mix(documents(spark, rows)).collect())


def test_empty(spark, empty):
    assert mixing.mix(empty).collect() == []
    assert mixing.mixed_documents(empty).collect() == []
    assert [r.target for r in mixing.mix(documents(spark, [(1, None, None, None)])).collect()] == [0.0]


def test_mixed_documents_hold_the_words_taken(spark, edge):
    taken, copies = defaultdict(int), defaultdict(int)
    for r in mixing.mix(edge).collect():
        taken[r.doc_id] += r.taken
    mixed = mixing.mixed_documents(edge)
    assert mixed.columns == edge.columns
    for r in mixed.collect():
        copies[r.doc_id] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
        assert r.size == "other"
    assert {k: v for k, v in taken.items() if v} == dict(copies)


def test_rows_that_share_id_and_text_keep_their_own_columns(spark):
    rows = spark.createDataFrame([(1, "a b c", "en", "s"), (1, "a b c", "de", "s"), (1, "a b c", "de", "s")], "doc_id bigint, text string, lang string, source string")
    got = sorted((r["lang"], r["text"]) for r in mixing.mixed_documents(rows, share=1.0).collect())
    assert got == [("de", "a b c"), ("de", "a b c"), ("en", "a b c")]


def test_a_share_above_most_stops_every_target(spark):
    rows = documents(spark, [(1, "a b", "en", "s"), (2, "c", "en", "t"), (3, "d e f", "en", None)])
    got = {r["doc_id"]: (r["target"], r["taken"]) for r in mixing.mix(rows, share=2.5, most=2).collect()}
    assert got == {1: (4.0, 4), 2: (2.0, 2), 3: (6.0, 6)}


def test_a_group_of_copies_is_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(mixing, "TOGETHER", 10)
    rows = documents(spark, [(7, "a b", "en", "s")] * 500 + [(i, "c d e", "en", "s") for i in range(100, 600)])
    mixed = mixing.mix(rows)
    assert mixed.count() == 1000 and mixed.selectExpr("sum(taken)").first()[0] == 3750
    spread = mixed.where("doc_id = 7").groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) == 4 and max(r["count"] for r in spread) < 300


def test_a_short_table_of_sources_is_written_once_as_one_file(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(common, "shared_folder", lambda _, name: f"{tmp_path}/{name}")
    rows = [(i, "a b c " * (i % 7), "en", f"s{i % 23:02d}") for i in range(300)]
    check(rows, mixing.mix(documents(spark, rows)).collect())
    files = {p.name: len([*p.glob("part-*")]) for p in tmp_path.iterdir()}
    assert {k: n for k, n in files.items() if k not in ("mix-rows", "mix-chunks")} == dict.fromkeys(
        ("mix-sources-ranges", "mix-sources-totals", "mix-levels-ranges", "mix-levels-totals", "mix-levels"), 1
    )


def test_sources_in_several_ranges_have_the_same_targets(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(common, "shared_folder", lambda _, name: f"{tmp_path}/{name}")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(i, "a b c " * (i % 7), "en", f"s{i % 23:02d}" if i % 29 else None) for i in range(300)]
        check(rows, mixing.mix(documents(spark, rows)).collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len([*tmp_path.glob("mix-sources-ranges/part-*")]) == 4
