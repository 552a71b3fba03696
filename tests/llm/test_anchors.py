"""SimHash components against all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash
from corpus_rows import EDGE, documents
from pyspark.sql import functions as F

from wattline.llm import anchors as A
from wattline.llm.components import stars


def simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(fps):
    """The least index that each reaches over pairs within two bits."""
    label = list(range(len(fps)))
    x = np.array(fps, np.uint64)
    todo, seen = [], set()
    for i in range(len(fps)):
        if i in seen:
            continue
        todo = [i]
        seen.add(i)
        while todo:
            j = todo.pop()
            label[j] = i
            for k in np.flatnonzero(np.bitwise_count(x ^ x[j]) <= 2).tolist():
                if k not in seen:
                    seen.add(k)
                    todo.append(k)
    return label


def families(rng, n):
    """Fingerprints in chains and clusters of a few bits' distance, and unrelated ones."""
    out = []
    while len(out) < n:
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 5, 30])):
            out.append(x)
            for _ in range(rng.choice([0, 1, 2, 2, 3, 4])):
                x ^= 1 << rng.randrange(64)
    return out


def reached(links):
    """What the links connect, as sets."""
    sets = {}
    for a, b in links:
        one = sets.get(a, {a}) | sets.get(b, {b})
        sets.update(dict.fromkeys(one, one))
    return {frozenset(s) for s in sets.values()}


def components(spark, fps):
    signed = [x - (1 << 64) if x >> 63 else x for x in dict.fromkeys(fps)]
    nodes = spark.createDataFrame([(x,) for x in signed], "fp bigint")
    root = {r.u: r.v for r in stars(A.links(nodes)).collect()}
    return [root.get(x, x) for x in (y - (1 << 64) if y >> 63 else y for y in fps)]


@pytest.mark.parametrize("together", [2048, 8, 1])
def test_links_against_all_pairs(spark, monkeypatch, together):
    monkeypatch.setattr(A, "TOGETHER", together)
    if together == 1:
        monkeypatch.setattr(A, "PAIRS", 16)
    fps = families(random.Random(together), 1500)
    got, want = components(spark, fps), groups(fps)
    first = {}
    assert [first.setdefault(g, i) for i, g in enumerate(got)] == want


@pytest.mark.parametrize("pairs", [5, 9, 64, 1 << 22])
def test_parts_that_end_within_a_run_lose_no_link(monkeypatch, pairs):
    monkeypatch.setattr(A, "PAIRS", pairs)
    x, y, z, q = 0, 0b11, 0b1111, 0b111111
    u, v = A._linked(np.array([q, x, y, z], np.uint64), np.zeros(4, np.int32), np.array([False, True, True, True]))
    assert reached(zip(u.tolist(), v.tolist())) == {frozenset((x, y, z, q))}
    rng = random.Random(pairs)
    fps = []
    for _ in range(6):
        at = rng.getrandbits(64)
        for _ in range(40):
            fps.append(at)
            at ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
    rng.shuffle(fps)
    fps = list(dict.fromkeys(fps))
    u, v = A._linked(np.array(fps, np.uint64), np.zeros(len(fps), np.int32), np.ones(len(fps), bool))
    label, want = groups(fps), {}
    for f, g in zip(fps, label):
        want.setdefault(g, set()).add(f)
    assert reached(zip(u.tolist(), v.tolist())) == {frozenset(s) for s in want.values() if len(s) > 1}


def test_large_anchors_are_split_in_task(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(A, "TOGETHER", 4)
    fp = np.arange(30, dtype=np.int64)
    anchor = np.array([1] * 3 + [2] * 20 + [3] * 7, np.int32)
    batches = [pa.RecordBatch.from_arrays([pa.array(anchor[i : i + 3]), pa.array(fp[i : i + 3]), pa.array([True] * 3)], ["anchor", "fp", "home"]) for i in range(0, 30, 3)]
    rows = [r for b in A._met(iter(batches)) for r in b.to_pylist()]
    linked = {r["u"] for r in rows if r["v"] is not None}
    held = {r["u"] for r in rows if r["v"] is None}
    assert linked | held >= set(range(5, 30)) and {1, 2} <= linked | held


def test_the_code_covers():
    errors = A._errors()
    assert len(errors[0][0]) == 2**11 and (np.diff(errors[0][1]) == 1).all()
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2**63, 200, dtype=np.uint64)
    y = x ^ (np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64))
    xi, xa, xh = A.replicas(x, errors)
    yi, ya, _ = A.replicas(y, errors)
    for i in range(200):
        assert xh[xi == i].sum() == 1
        assert xa[(xi == i) & xh][0] in ya[yi == i]
        assert len(set(ya[yi == i].tolist())) == (yi == i).sum()


def test_fingerprints():
    for text in (None, "", " \n", "One", "one two", "a b c", "A b c d é Ü" * 50, *(" ".join(map(str, range(n))) for n in (3, 4, 50))):
        assert A.fingerprint(text) == simhash(text)


def test_edges(spark, edge, empty):
    got = A.near_duplicates(edge).collect()
    fps = [simhash(t) for _, t, _, _ in EDGE]
    label = groups(fps)
    least = {}
    for (i, _, _, _), g in zip(EDGE, label):
        least[g] = min(x for x in (least.get(g), i) if x is not None) if (i is not None or g in least and least[g] is not None) else None
    want = sorted((str(i), f"{x:016x}", str(least[g])) for (i, _, _, _), x, g in zip(EDGE, fps, label))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want
    assert A.near_duplicates(empty).collect() == []


def test_distinct_documents(spark, edge, empty):
    kept = A.distinct_documents(edge)
    assert kept.columns == edge.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 5, 6, 7]
    assert A.distinct_documents(empty).collect() == []


def test_chains_and_hubs(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 300)] + [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(300)]
    star = {r.u: r.v for r in stars(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    assert all(star.get(x, x) == find(x) for x in list(parent))
    assert stars(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_shingle_hash_is_sparks(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("one two thrée")).alias("h")).first()
    assert row.h % (1 << 64) == xxhash.xxh64_intdigest("one two thrée".encode(), 42)
