"""Byte-level BPE by a global shuffle of distinct words.

1. Texts are split into pre-tokens in place. A block of documents keeps its pre-tokens as numbers in order of
   position, and leaves each word it holds once, in the bucket of the word's hash.
2. Buckets meet: a task encodes each of its distinct words once, and every block gets its words' ids back.
3. Each block puts ids in place of numbers, position by position.

Only words and ids travel packed, bucket by bucket; a frequent word is one entry of a block, so no word is hot.
Decoding looks each id up in the table of token bytes, which has as many rows as the vocabulary.
"""

import base64
import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import bucketed, partitions, slices

#: UTF-8 bytes of text in a block: it ends with the document that reaches them.
BLOCK_BYTES = 16 << 20
#: Buckets of words per shuffle partition: a task holds the words of one bucket at a time.
BUCKETS = 8

_BLOCK = "block bigint, doc_ids array<{kind}>, lengths array<bigint>, numbers binary, buckets binary, groups array<struct<bucket:int,words:binary>>"


def _squeeze(values: np.ndarray) -> bytes:
    """Numbers below 2**32, byte by byte of all of them, compressed."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _expand(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], 4 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").reshape(-1)


def _pack_words(words: list[bytes]) -> bytes:
    data = b"".join(words)
    lengths = _squeeze(np.array([len(w) for w in words], np.uint32))
    return len(lengths).to_bytes(8, "little") + lengths + len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _unpack_words(packed: bytes) -> list[bytes]:
    cut = 8 + int.from_bytes(packed[:8], "little")
    ends = np.cumsum(_expand(packed[8:cut])).tolist()
    data = pa.decompress(packed[cut + 8 :], int.from_bytes(packed[cut : cut + 8], "little"), codec="zstd", asbytes=True)
    return [data[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def gather(flat: np.ndarray, starts: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces ``flat[starts[c]:starts[c + 1]]`` of each ``c`` in ``chosen``, joined, and their lengths."""
    sizes = starts[chosen + 1] - starts[chosen]
    ends = np.cumsum(sizes, dtype=starts.dtype)
    at = np.arange(ends[-1] if len(ends) else 0, dtype=ends.dtype) + np.repeat(starts[chosen] - ends + sizes, sizes)
    return flat[at], sizes


@functools.cache
def token_bytes(path: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all tokens of a rank file in the order of their ids, and where each one's begin."""
    with open(path, "rb") as file:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, file)}
    tokens = [ranks.get(i, b"") for i in range(max(ranks) + 1)]
    return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum([0, *map(len, tokens)])


@functools.cache
def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def split(docs: DataFrame, pattern: str, buckets: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of documents: pre-tokens as numbers in order of position, distinct words by bucket.

    Words of a block are numbered as they first appear. A first appearance is stored as 0, any other one as
    the number and 1, so that words that appear once take next to no room.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, base, made = regex.compile(pattern).findall, TaskContext.get().partitionId() << 32, 0
        doc_ids, sequences, number, size = [], [], {}, 0

        def packed(doc_id: pa.DataType) -> pa.RecordBatch:
            words = [w.encode() for w in number]
            bucket = np.array([zlib.crc32(w) % buckets for w in words], np.uint32)
            groups = [{"bucket": b, "words": _pack_words([words[i] for i in np.flatnonzero(bucket == b)])} for b in np.unique(bucket).tolist()]
            every = np.concatenate(sequences) + np.uint32(1)
            known = np.concatenate([np.zeros(1, np.uint32), np.maximum.accumulate(every)])[:-1]
            fields = [
                ("block", pa.int64(), base + made), ("doc_ids", pa.list_(doc_id), doc_ids), ("lengths", pa.list_(pa.int64()), [len(s) for s in sequences]),
                ("numbers", pa.binary(), _squeeze(np.where(every > known, np.uint32(0), every))), ("buckets", pa.binary(), _squeeze(bucket)),
                ("groups", pa.list_(pa.struct([("bucket", pa.int32()), ("words", pa.binary())])), groups),
            ]
            return pa.RecordBatch.from_arrays([pa.array([value], kind) for _, kind, value in fields], names=[name for name, _, _ in fields])

        for batch in slices(batches):
            kind = batch.column("doc_id").type
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                add = number.setdefault
                doc_ids.append(doc_id)
                sequences.append(np.array([add(w, len(number)) for w in find(text or "")], np.uint32))
                size += len(text or "")
                if size >= block_bytes:
                    yield packed(kind)
                    doc_ids, sequences, number, size, made = [], [], {}, 0, made + 1
        if doc_ids:
            yield packed(kind)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(blocks, _BLOCK.format(kind=kind))


def encode_words(words: DataFrame, path: str, pattern: str) -> DataFrame:
    """(block, bucket, words) to (block, bucket, ids): a task encodes each word of a bucket once."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, bucket, known = _encoding(path, pattern), None, {}
        for batch in slices(batches):
            out = []
            for own, packed in zip(batch.column("bucket").to_pylist(), batch.column("words").to_pylist(), strict=True):
                if own != bucket:
                    bucket, known = own, {}
                held = _unpack_words(packed)
                for word in held:
                    if word not in known:
                        known[word] = np.array(encoding.encode_ordinary(word.decode()), "<u4").tobytes()
                ids = [known[word] for word in held]
                lengths = _squeeze(np.array([len(x) // 4 for x in ids], np.uint32))
                out.append(len(lengths).to_bytes(8, "little") + lengths + _squeeze(np.frombuffer(b"".join(ids), "<u4")))
            yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("bucket"), pa.array(out, pa.binary())], names=["block", "bucket", "ids"])

    parts = partitions(words.sparkSession)
    met = words.repartition(parts, "bucket").sortWithinPartitions("bucket")
    return met.mapInArrow(encode, "block bigint, bucket int, ids binary")


def _reassembled(block: pa.Table, encoded: pa.Table) -> pa.Table:
    """A block's documents with their ids, from its numbers and its words' ids."""
    (row,) = block.select(["doc_ids", "lengths", "numbers", "buckets"]).to_pylist()
    parts = [x["ids"] for x in sorted(encoded.select(["bucket", "ids"]).to_pylist(), key=lambda x: x["bucket"])]
    cuts = [8 + int.from_bytes(x[:8], "little") for x in parts]
    sizes = np.concatenate([np.empty(0, np.uint32), *(_expand(x[8:c]) for x, c in zip(parts, cuts, strict=True))]).astype(np.int32)
    flat = np.concatenate([np.empty(0, np.uint32), *(_expand(x[c:]) for x, c in zip(parts, cuts, strict=True))]).astype(np.int32)
    starts = np.concatenate([[0], np.cumsum(sizes, dtype=np.int32)]).astype(np.int32)
    # Words came bucket by bucket, within one in the order of their numbers.
    place = np.empty(len(sizes), np.int32)
    place[np.argsort(_expand(row["buckets"]), kind="stable")] = np.arange(len(sizes), dtype=np.int32)
    stored_numbers = _expand(row["numbers"])
    first = stored_numbers == 0
    numbers = stored_numbers - np.uint32(1)
    numbers[first] = np.arange(np.count_nonzero(first), dtype=np.uint32)
    texts, ends, joined, n = np.cumsum([0, *row["lengths"]]), [0], [], 0
    for begin, end in zip(texts[:-1].tolist(), texts[1:].tolist(), strict=True):
        joined.append(gather(flat, starts, place[numbers[begin:end]])[0])
        ends.append(n := n + len(joined[-1]))
    kept = pa.array(row["doc_ids"], block.schema.field("doc_ids").type.value_type)
    ids = pa.array(np.concatenate([np.empty(0, np.int32), *joined]))
    return pa.Table.from_arrays([kept, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids)], names=["doc_id", "ids"])


def encode(docs: DataFrame, path: str, pattern: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, ids) of every document's whole text, as the ranks and pattern encode it.

    Takes (doc_id, text, ...); other columns are ignored. Null and empty texts have no ids, null and
    repeated doc_ids and repeated rows stay rows of their own, in no order. An empty table gives no rows.
    The pattern must match every character, and a match alone as it does within its text.
    """
    buckets = BUCKETS * partitions(docs.sparkSession)
    blocks = bucketed(split(docs, pattern, buckets, block_bytes), "block", "bpe-blocks")
    words = encode_words(blocks.select("block", F.inline("groups")), path, pattern)
    kind = docs.schema["doc_id"].dataType.simpleString()
    kept = blocks.drop("groups").groupBy("block").cogroup(words.groupBy("block"))
    return kept.applyInArrow(_reassembled, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with the bytes that its ``ids`` stand for, as ``decoded``; null ids have none.

    Ids that the vocabulary has not stop the job.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, starts = token_bytes(path)
        for batch in slices(batches, 32):
            out = [gather(flat, starts, ids)[0].tobytes() for ids in _lists(batch.column("ids"))]
            columns = [batch.column(c) for c in batch.schema.names if c != "decoded"]
            names = [c for c in batch.schema.names if c != "decoded"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out, pa.binary())], names=[*names, "decoded"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema if f.name != "decoded")
    return encoded.mapInArrow(join, f"{kinds}, decoded binary")


def _lists(column: pa.ListArray) -> Iterator[np.ndarray]:
    """Each row's ids without a detour over Python numbers."""
    flat = column.values.to_numpy(zero_copy_only=False)
    offsets = column.offsets.to_numpy()
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    for start, end, real in zip(offsets[:-1], offsets[1:], valid, strict=True):
        yield flat[start : end if real else start].astype(np.int64)
