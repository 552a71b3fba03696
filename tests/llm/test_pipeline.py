"""Stages one after another, against applying each to the one before; every registered query runs."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entrypoint
import corpus_pipeline
import oraclecheck
from wattline.llm import anchors, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.queries()))
def test_query_equals_sql(spark, name):
    assert oraclecheck.compare(spark, oraclecheck.connect(SF), name, SF) is None


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns
        seen.append(docs)
    good, single, clean, mixed = ({r.doc_id: r.text for r in x.collect()} for x in seen[1:])
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert sum(labels.get(i) == 1 for i in good) >= 0.97 * sum(labels.get(r.doc_id) == 1 for r in seen[0].collect())
    parts = {}
    for i, t in good.items():
        f = anchors.fingerprint(t)
        near = [r for r in parts if any(bin(f ^ g).count("1") <= 2 for g, _ in parts[r])]
        merged = [(f, i)] + [x for r in near for x in parts.pop(r)]
        parts[min(j for _, j in merged)] = merged
    assert set(single) == set(parts)
    assert set(clean) <= set(single) and set(mixed) <= set(clean)
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for r in seen[-1].collect():
        ids = [*whole.encode(r.text, add_special_tokens=False).ids, 2]
        want.append((r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    got = entrypoint.queries()["pipeline"](spark, SF).collect()
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == sorted(want)
