"""Packed id files: exact round trips, random access, whole-text encoding."""

import io
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from corpus_rows import EDGE, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from wattline.llm import packing
from wattline.llm.tokens import Encoder

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("width", [1, 3, 7, 8, 15, 16, 17, 29, 32])
@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 1000])
def test_round_trip(width, n):
    ids = np.random.default_rng(width).integers(0, 2**width, n, dtype=np.uint64).astype(np.uint32)
    data = packing.pack(ids, width)
    assert len(data) == -(-n // 64) * width * 8
    assert (packing.unpack(data, n, width) == ids).all()


def test_fewest_bits():
    assert [packing.bits(n) for n in (1, 2, 3, 256, 257, 49_408, 65_536, 65_537)] == [1, 1, 2, 8, 9, 16, 16, 17]


class Memory(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def test_random_access():
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 50_000, n).astype(np.uint32) for n in (0, 5, 700_000, 1, 0, 9000, 8192)]
    stream = Memory()
    writer = packing.Writer(stream, 16)
    for i, ids in enumerate(docs):
        writer.add(None if i == 3 else i - 2, ids)
    writer.close()
    reader = packing.Reader(stream)
    everything = np.concatenate(docs)
    for start, end in ((0, 0), (0, 1), (8191, 8193), (5, 700_001), (699_000, len(everything)), (len(everything) - 1, len(everything))):
        assert (reader.ids(start, end) == everything[start:end]).all()
    found = list(reader.documents())
    assert [d for d, _, _ in found] == [-2, -1, 0, None, 2, 3, 4]
    assert all((a == b).all() for (_, _, a), b in zip(found, docs, strict=True))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from(" \n\t'<|>slltreé́Σς ​한"), st.characters(exclude_categories=["Cs"])), max_size=60), max_size=6))
def test_encoder_equals_whole_texts(texts):
    encoder, whole = Encoder(PATH), Tokenizer.from_file(PATH)
    texts = [*texts, "can't <|endoftext|>x they'll 123 Été d'où"]
    assert [x.tolist() for x in encoder.encode(texts)] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_encoder_forgets(monkeypatch):
    monkeypatch.setattr("wattline.llm.tokens.REMEMBERED", 4)
    encoder, whole = Encoder(PATH), Tokenizer.from_file(PATH)
    for text in ("a b c d", "c d e f g", "a", "a b", ""):
        assert encoder.encode([text])[0].tolist() == whole.encode(text, add_special_tokens=False).ids


def test_remembered_pieces_are_small():
    """Pieces lie in Arrow, not in a dictionary of Python strings, which took 110 bytes a piece here."""
    words = [f"{a}{b}{c}{d}" for a in "abcdefghij" for b in "klmnopqrst" for c in "uvwxyzabcd" for d in "efghijklmnopqrstuvwx"]
    encoder, whole = Encoder(PATH), Tokenizer.from_file(PATH)
    encoder.encode(["a"])
    tracemalloc.start()
    before = pa.total_allocated_bytes()
    found = [x.tolist() for x in encoder.encode([" ".join(words[:15_000]), " ".join(words[10_000:])])]
    assert found == [whole.encode(" ".join(x), add_special_tokens=False).ids for x in (words[:15_000], words[10_000:])]
    del found
    kept = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before
    tracemalloc.stop()
    assert len(encoder.known) == len(words) + 2
    assert kept < 75 * len(words), kept / len(words)


def test_long_pieces_are_forgotten(monkeypatch):
    """Texts without spaces are one piece each: not only pieces count, but also their bytes."""
    monkeypatch.setattr("wattline.llm.tokens.REMEMBERED_BYTES", 1000, raising=False)
    encoder, whole = Encoder(PATH), Tokenizer.from_file(PATH)
    for text in [*("한국어"[i % 3] * (200 + i) for i in range(9)), "b" * 600, "b" * 600 + " ab", "c"]:
        assert encoder.encode([text])[0].tolist() == whole.encode(text, add_special_tokens=False).ids
        assert len(encoder.known) <= 4
    assert encoder.encode(["d" * 2000])[0].tolist() == whole.encode("d" * 2000, add_special_tokens=False).ids


def test_words_cost_their_distinct_pieces():
    """Letters and symbols are learnt once, in whatever case and beside whichever others they stand."""
    letters = [a + b for a in "abcdefghij" for b in "klmnopqrsté"]
    symbols = [a + b for a in ".,;:!?)" for b in "\"-_|"]
    texts = [" ".join(f(x) + s for f in (str, str.title, str.upper) for x in letters) for s in ["", *symbols]]
    encoder, whole = Encoder(PATH), Tokenizer.from_file(PATH)
    found = encoder.encode(texts)
    assert [x.tolist() for x in found] == [whole.encode(t, add_special_tokens=False).ids for t in texts]
    # 110 runs of letters, 28 of symbols and the empty one stand for some 9,500 words.
    assert len(encoder.known) == 110 + 28 + 1


def test_letters_and_symbols_alone():
    """Every visible character below U+0180 before, behind, between and beside letters."""
    characters = [chr(i) for i in range(0x21, 0x180)]
    texts = [f.format(c) for c in characters for f in ("{0}", "a{0}", "{0}a", "a{0}a", "{0}{0} {0}.", "É{0}, 'S{0}'s")]
    encoder, whole = Encoder(PATH), Tokenizer.from_file(PATH)
    wanted = [whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in encoder.encode(texts)] == wanted
    assert [x.tolist() for x in encoder.encode(pa.array(["", *texts, None], pa.large_string()).slice(1))] == [*wanted, []]


@pytest.mark.parametrize("most", [1, 7, 1000])
def test_runs_of_text_hold_every_row(monkeypatch, most):
    monkeypatch.setattr(packing, "TEXT_BYTES", most)
    texts = ["ab", None, "", "é" * 5, "x" * 50, None, "a", "b", ""]
    batch = pa.RecordBatch.from_pydict({"doc_id": range(len(texts)), "text": texts})
    runs = list(packing.runs_of_text(iter([batch.slice(0, 0), batch, batch.slice(3)])))
    assert [x for r in runs for x in r.column("text").to_pylist()] == [*texts, *texts[3:]]
    assert all(r.num_rows == 1 or sum(len((x or "").encode()) for x in r.column("text").to_pylist()) <= most for r in runs)


def expected(rows):
    whole, start, out = Tokenizer.from_file(PATH), 0, []
    for doc_id, text in rows:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_against_whole_encoding(spark):
    rows = [(i, t) for i, (_, t, _, _) in enumerate(EDGE)][::-1]
    got = packing.encoded(documents(spark, [(i, t, "en", "s") for i, t in rows]).repartition(3), PATH, 2).collect()
    assert sorted(tuple(r) for r in got) == sorted(expected(sorted(rows)))


def test_edges(spark, edge, empty):
    got = packing.encoded(edge, PATH, 2).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, None, 1, 1, 2, 3, 4, 5, 6, 7, 8]
    assert [r.start for r in got][1:] == [r.start + r.n_tokens for r in got][:-1]
    assert packing.encoded(empty, PATH, 2).collect() == []


def test_a_lost_attempts_file_is_no_part(spark):
    manifest = packing.write(documents(spark, [(1, "a b", "en", "s"), (2, "c", "en", "s")]), PATH, 2)
    path = manifest.first().path
    with open(path, "rb") as file:
        data = file.read()
    with open(path.replace("part-", "part-9-lost-"), "wb") as file:
        file.write(data[: len(data) // 2])
    assert packing.read(manifest).count() == 2
