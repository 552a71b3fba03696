"""Fixity audit against comparing all records."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from wattline.llm import fixity as X


def records(spark, rows):
    return spark.createDataFrame([(o, n, d, "x") for o, n, d in rows], "offset bigint, length bigint, digest string, status string")


def brute(a, b):
    a, b = {o: (n, d) for o, n, d in a}, {o: (n, d) for o, n, d in b}
    out = []
    for o in a.keys() | b.keys():
        if a.get(o) != b.get(o):
            status = "missing" if o not in b else "extra" if o not in a else "corrupt"
            out.append((o, (a.get(o) or b[o])[0], o >> X.FILE, status))
    return sorted(out)


@pytest.mark.parametrize("damage", [0, 1, 40])
def test_random_damage(spark, damage):
    rng = random.Random(damage)
    rows, at = [], 0
    for i in range(3000):
        n = rng.choice([1, 50, 900, 5000, 200_000])
        rows.append((at, n, f"d{i}"))
        at += n
    other = [list(r) for r in rows]
    for i in rng.sample(range(3000), damage):
        other[i] = rng.choice([[rows[i][0], rows[i][1], "rot"], [rows[i][0], rows[i][1] + 1, rows[i][2]], [at + i, 5, "new"], [rows[i][0], rows[i][1], None]])
    got = X.audit(records(spark, rows), records(spark, other)).collect()
    assert sorted((r.offset, r.length, r.file, r.status) for r in got) == brute(rows, other)


def test_empty(spark):
    assert X.audit(records(spark, []), records(spark, [])).collect() == []
    assert [r.status for r in X.audit(records(spark, [(0, 5, "a")]), records(spark, [])).collect()] == ["missing"]
    assert [r.status for r in X.audit(records(spark, []), records(spark, [(1 << 40, 5, "a")])).collect()] == ["extra"]


def test_only_differing_branches_are_read(spark, monkeypatch):
    rows = [(i * 70_000, 70_000, f"d{i}") for i in range(500)]
    other = [*rows[:250], (250 * 70_000, 70_000, "rot"), *rows[251:]]
    kept = []
    plain = X.stored
    monkeypatch.setattr(X, "stored", lambda df, name: kept.append((name, out := plain(df, name))) or out)
    assert X.audit(records(spark, rows), records(spark, other)).count() == 1
    assert [df.count() for name, df in kept if name == "merkle-differing"] == [1] * len([1 for name, _ in kept if name == "merkle-differing"])


def test_archive(spark):
    pages = [(2, "u", "<p>é</p>"), (None, None, None), (1, "v", ""), (2, "u", "<p>é</p>"), (3, "w", "x" * 100_000)]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id bigint, url string, html string, offset string").repartition(3)
    got = sorted(X.archive(df, replica=F.lit("z")).collect(), key=lambda r: r.offset)
    assert [r.page_id for r in got] == [None, 1, 2, 2, 3]
    at = 0
    for r in got:
        i, u, h = (r.page_id if r.page_id is not None else ""), r.url or "", dict((p[0], p[2]) for p in pages)[r.page_id] or ""
        data = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{i}>\r\nWARC-Target-URI: {u}\r\nContent-Type: text/html\r\nContent-Length: {len(h.encode())}\r\n\r\n{h}\r\n\r\n".encode()
        assert (r.offset, r.length, r.digest) == (at, len(data), hashlib.sha256(data).hexdigest())
        at += len(data)
    assert X.archive(df.limit(0)).count() == 0
