"""Product codes against distances computed one by one."""

import hashlib

import numpy as np
import pytest

import __spark_entry__ as entrypoint
from wattline.llm import value_codes

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def one_by_one(rows, parts=16, entries=64, rounds=2):
    """{row: (code, error)} and the codebooks, by plain loops; rows are (vec_id, vector, label)."""
    kept = [(i, [int(np.floor(256 * x)) for x in np.array(v, np.float32).astype(float).tolist()], lb) for i, v, lb in rows]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]
    nearest = lambda v, p: min(range(len(books[p])), key=lambda e: (far(cut(v, p), books[p][e]), e))
    for _ in range(rounds):
        new = []
        for p in range(parts):
            own = {}
            for _, v, _ in kept:
                own.setdefault(nearest(v, p), []).append(cut(v, p))
            new.append([[sum(c) // len(own[e]) for c in zip(*own[e], strict=True)] if e in own else b for e, b in enumerate(books[p])])
        books = new
    out = []
    for i, v, lb in kept:
        codes = [nearest(v, p) for p in range(parts)]
        out.append((i, lb, "".join(f"{c:02x}" for c in codes), sum(far(cut(v, p), books[p][c]) for p, c in enumerate(codes))))
    return sorted(out, key=str), books


def compressed(spark, rows, **parameters):
    given = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS code", "2 AS error", "3 AS v", "4 AS _label").repartition(3)
    coded, books = value_codes.compress(given, **parameters)
    return coded, books


@pytest.mark.parametrize("spread", [0.1, 0.004])  # the second has many equal distances
def test_equals_plain_loops(spark, spread):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(0, spread, 32).astype(np.float32).tolist(), int(rng.integers(0, 3))) for i in range(150)]
    coded, books = compressed(spark, rows)
    want, want_books = one_by_one(rows)
    assert sorted((tuple(r) for r in coded.collect()), key=str) == want
    assert books.tolist() == want_books


def test_edge_rows(spark):
    good = [float(x) / 100 for x in range(-8, 8)]
    rows = [(3, good, 1), (3, good, 1), (1, [0.5] * 16, None), (None, [-0.001] * 16, None), (9, None, 1), (8, [None] * 16, 1),
            (7, [float("nan")] * 16, 1), (6, [float("-inf")] + [0.0] * 15, 1), (5, [0.0] * 8, 1), (4, [], 2), (2, [1e30] * 16, 5)]
    coded, books = compressed(spark, rows)
    found = value_codes.with_label_error(coded).collect()
    kept = [(i, [min(x, value_codes.FARTHEST / 256) for x in v], lb) for i, v, lb in rows if i in (1, 2, 3, None)]
    want, want_books = one_by_one(kept)
    assert sorted(((r["vec_id"], r["label"], r["code"], r["error"]) for r in found), key=str) == want
    assert books.tolist() == want_books
    sums = {}
    for _, lb, _, error in want:
        sums[lb] = sums.get(lb, 0) + error
    assert {r["label"]: r["label_error"] for r in found} == sums


def test_empty_and_uneven(spark):
    coded, books = compressed(spark, [(1, None, 1)])
    assert coded.collect() == [] and value_codes.books_sha256(books) == hashlib.sha256(b"").hexdigest()
    with pytest.raises(ValueError):
        compressed(spark, [(1, [1.0] * 9, 1)], parts=4)


def test_fewer_parts_more_entries(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(0, 0.3, 6).astype(np.float32).tolist(), 0) for i in range(80)]
    coded, books = compressed(spark, rows, parts=2, entries=10, rounds=3)
    want, want_books = one_by_one(rows, 2, 10, 3)
    assert sorted((tuple(r) for r in coded.collect()), key=str) == want and books.tolist() == want_books


def test_query_columns(spark):
    found = entrypoint.queries()["op13_value_codes"](spark, "/root/testdata/sf0.001")
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
