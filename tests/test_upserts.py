"""Upserted tables: newest rows, repeated and killed batches, files."""

import glob
import os
import shutil

import pytest

from wattline.sinks.upserts import Upserts
from wattline.sinks.workspace import workspace

ROW = "index string, day string, _id string, source string, version bigint"


def table(spark):
    return Upserts(workspace(spark, "documents"), ROW, ("index", "day", "_id"), ("index", "day"))


def held(spark, upserts):
    return {(r["index"], r["_id"]): r["source"] for r in upserts.rows(spark).collect()}


def rows(spark, *found):
    return spark.createDataFrame(list(found), ROW)


def test_newest_rows_stay(spark):
    upserts = table(spark)
    upserts(rows(spark, ("1h", "2024-01-01", "a", "old", 0), ("1h", "2024-01-02", "b", "old", 0), ("phase", "2024-01-01", "a", "p5", 5)), 0)
    upserts(rows(spark, ("1h", "2024-01-01", "a", "new", 1), ("1h", "2024-01-01", "c", "first", 1), ("phase", "2024-01-01", "a", "p4", 4)), 1)
    want = {("1h", "a"): "new", ("1h", "b"): "old", ("1h", "c"): "first", ("phase", "a"): "p5"}
    assert held(spark, upserts) == want
    upserts(rows(spark, ("phase", "2024-01-01", "a", "again", 5)), 2)
    assert held(spark, upserts) == want | {("phase", "a"): "again"}
    upserts(rows(spark), 3)
    assert upserts.rows(spark).count() == 4


def test_untouched_folders_and_the_number_of_files_stay(spark):
    upserts = table(spark)
    files = lambda: sorted(glob.glob(f"{upserts.path}/rows/*/*/*.parquet"))
    for batch in range(6):
        upserts(rows(spark, ("1h", "2024-01-01", f"k{batch % 2}", str(batch), batch), *([("1h", "2023-05-05", "x", "y", 0)] if not batch else [])), batch)
        if not batch:
            untouched = [f for f in files() if "2023-05-05" in f]
    assert held(spark, upserts) == {("1h", "k0"): "4", ("1h", "k1"): "5", ("1h", "x"): "y"}
    assert [f for f in files() if "2023-05-05" in f] == untouched and len(files()) == 2
    assert not os.listdir(f"{upserts.path}/merged")


@pytest.mark.parametrize("lost", [False, True])
def test_a_killed_batch_is_made_whole(spark, monkeypatch, lost):
    upserts = table(spark)
    upserts(rows(spark, ("1h", "2024-01-01", "a", "old", 0), ("1h", "2024-01-01", "b", "kept", 0), ("1h", "2024-01-03", "c", "kept", 0)), 0)

    def dies(self, merged):
        if lost:  # as when folders are being replaced
            shutil.rmtree(f"{self.path}/rows/index=1h/day=2024-01-01")
        raise RuntimeError("killed")

    second = rows(spark, ("1h", "2024-01-01", "a", "new", 1))
    with monkeypatch.context() as patched, pytest.raises(RuntimeError):
        patched.setattr(Upserts, "_put_in_place", dies)
        upserts(second, 1)
    for _ in range(2):
        upserts(second, 1)
        assert held(spark, upserts) == {("1h", "a"): "new", ("1h", "b"): "kept", ("1h", "c"): "kept"}
