"""Line chunks against a plain model."""

import hashlib
import random
import re
from collections import defaultdict

import pytest
from corpus_rows import EDGE, documents

from wattline.llm import line_chunks as L


def long(line):
    return len(re.findall(r"[^\x20\x09-\x0D]+", line)) >= 50


def model_chunks(text):
    lines = (text or "").split("\n")
    hashes = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in lines]
    out, begin = [], 0
    for i in range(len(lines)):
        rolled = (hashes[i] + (31_337 * hashes[i - 1] if i else 0)) % 2_147_483_647
        if rolled % 3 == 0 or i + 1 == len(lines) or long(lines[i]) or long(lines[i + 1]):
            out.append(lines[begin : i + 1])
            begin = i + 1
    return out


def model(rows):
    key = lambda i, t: hashlib.md5(f"{'~' if i is None else i}:{hashlib.md5((t or '').encode()).hexdigest()}".encode()).hexdigest()
    first = {}
    places = defaultdict(set)
    for i, t, _, _ in rows:
        for n, chunk in enumerate(model_chunks(t)):
            places["\n".join(chunk)].add((i is None, i or 0, key(i, t), n))
    first = {body: min(p) for body, p in places.items()}
    out = []
    for i, t, _, _ in rows:
        cut = model_chunks(t)
        gone = [(long(c[0]) or sum(bool(x.strip(" \t\n\x0b\x0c\r")) for x in c) >= 2) and first["\n".join(c)] != (i is None, i or 0, key(i, t), n) for n, c in enumerate(cut)]
        out.append((i, sum(map(len, cut)), sum(gone), sum(len(c) for c, g in zip(cut, gone) if g), "\n".join("\n".join(c) for c, g in zip(cut, gone) if not g)))
    return sorted(map(repr, out))


def check(spark, rows):
    assert sorted(repr(tuple(r)) for r in L.dedup_lines(documents(spark, rows)).collect()) == model(rows)


def test_edges(spark, empty):
    check(spark, [(i, t and t[:5000], lang, s) for i, t, lang, s in EDGE])
    check(spark, [(1, "a\nb\nc\nd\ne\nf" * 3, "en", "s"), (1, "a\nb\nc\nd\ne\nf" * 3, "en", "s"), (2, "\n\n\n", "en", "s"), (3, "\n\n\n", "en", "s")])
    assert L.dedup_lines(empty).collect() == []


def test_shared_passages(spark):
    rng = random.Random(4)
    passage = [f"shared line {i}" for i in range(12)]
    rows = []
    for i in range(120):
        lines = [f"own {i} {j} {rng.random()}" for j in range(rng.randrange(0, 9))]
        if i % 2:
            at = rng.randrange(len(lines) + 1)
            lines[at:at] = passage[rng.randrange(3) : 12 - rng.randrange(3)]
        rows.append((i, "\n".join(lines), "en", "s"))
    check(spark, rows)


def test_a_long_line_is_a_passage_by_itself(spark):
    rng = random.Random(9)
    line = " ".join(f"w{i}" for i in range(50))
    rows = [(i, "\n".join([*(f"own {i} {rng.random()}" for _ in range(i % 4)), line, f"after {i}"]), "en", "s") for i in range(60)]
    rows += [(100, " ".join(line.split()[1:]), "en", "s"), (101, " ".join(line.split()[1:]), "en", "s"), (102, f"{line}\n{line}", "en", "s")]
    check(spark, rows)
    left = {r.doc_id: r.text for r in L.dedup_lines(documents(spark, rows)).collect()}
    assert line in left[0] and not any(line in left[i] for i in (*range(1, 60), 102)) and left[101]


def test_chunks_give_the_text_back(spark, edge):
    for r in L.chunks(edge.filter("doc_id >= 5")).groupBy("doc_id").agg({"n_lines": "sum"}).collect():
        assert r["sum(n_lines)"] == len(dict((i, t) for i, t, _, _ in EDGE)[r.doc_id].split("\n"))


@pytest.mark.parametrize("lead", [0, 1, 7])
def test_boundaries_move_with_their_lines(lead):
    lines = [f"line {i}" for i in range(60)]
    moved = model_chunks("\n".join([f"new {i}" for i in range(lead)] + lines))
    assert len({tuple(c) for c in moved} & {tuple(c) for c in model_chunks("\n".join(lines))}) >= len(moved) - lead - 2
