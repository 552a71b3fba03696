"""Token ids in files of fixed-width bit-packed blocks.

A file holds, in this order and little-endian: 8 bytes of magic; the blocks, each BLOCK_IDS ids in the
fewest bits that hold the vocabulary, the last one shorter; the byte offset of each block (u64) and of the
end; the first id of each document (u64) and the end; the doc_ids (i64) and a byte per document that is 0
where its id is null; then FOOTER. Files are written from front to back, so any store will do.
"""

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattline.llm.common import partitions, shared_folder, stored
from wattline.llm.tokens import encoder as shared_encoder

MAGIC = b"WTPACK01"
#: bits per id, ids per block, blocks, documents, ids, magic
FOOTER = struct.Struct("<IIQQQ8s")
BLOCK_IDS = 8192
#: Blocks that are packed or read together.
RUN = 64
#: Bytes of text that are encoded together, and at least one text.
TEXT_BYTES = 4 << 20


def bits(vocabulary: int) -> int:
    """The fewest bits that hold ids below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids below 2**width, 64 of them in ``width`` 64-bit words; the last group is padded with zeros."""
    groups = -(-len(ids) // 64)
    lanes = np.zeros(groups * 64, np.uint64)
    lanes[: len(ids)] = ids
    lanes = np.ascontiguousarray(lanes.reshape(groups, 64).T)
    words = np.zeros((width, groups), np.uint64)
    for lane in range(64):
        word, shift = divmod(lane * width, 64)
        words[word] |= lanes[lane] << np.uint64(shift)
        if shift + width > 64:
            words[word + 1] |= lanes[lane] >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.T).astype("<u8", copy=False).tobytes()


def unpack(data: bytes, n: int, width: int) -> np.ndarray:
    """The first ``n`` ids of what ``pack`` made, as unsigned 32-bit integers."""
    groups = -(-n // 64)
    words = np.ascontiguousarray(np.frombuffer(data, "<u8", groups * width).reshape(groups, width).T)
    lanes = np.empty((64, groups), np.uint32)
    mask = np.uint64((1 << width) - 1)
    for lane in range(64):
        word, shift = divmod(lane * width, 64)
        value = words[word] >> np.uint64(shift)
        if shift + width > 64:
            value = value | (words[word + 1] << np.uint64(64 - shift))
        lanes[lane] = value & mask
    return np.ascontiguousarray(lanes.T).reshape(-1)[:n]


class Writer:
    """Writes one file; ``add`` takes a document's ids, ``close`` what follows the blocks."""

    def __init__(self, stream, width: int) -> None:
        self.stream, self.width = stream, width
        self.pending: list[np.ndarray] = []
        self.waiting = self.n_ids = 0
        self.starts, self.doc_ids, self.offsets = [0], [], [len(MAGIC)]
        stream.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.n_ids += len(ids)
        self.starts.append(self.n_ids)
        self.pending.append(ids)
        self.waiting += len(ids)
        if self.waiting >= RUN * BLOCK_IDS:
            self._flush(self.waiting // BLOCK_IDS * BLOCK_IDS)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.pending) if self.pending else np.empty(0, np.uint32)
        for at in range(0, n, RUN * BLOCK_IDS):
            run = ids[at : min(n, at + RUN * BLOCK_IDS)]
            self.stream.write(pack(run, self.width))
            for start in range(0, len(run), BLOCK_IDS):
                size = -(-min(BLOCK_IDS, len(run) - start) // 64) * self.width * 8
                self.offsets.append(self.offsets[-1] + size)
        self.pending, self.waiting = [ids[n:]], len(ids) - n

    def close(self) -> None:
        self._flush(self.waiting)
        known = np.array([x is not None for x in self.doc_ids], np.uint8)
        for values, kind in ((self.offsets, "<u8"), (self.starts, "<u8"), ([x or 0 for x in self.doc_ids], "<i8")):
            self.stream.write(np.array(values, kind).tobytes())
        self.stream.write(known.tobytes())
        footer = (self.width, BLOCK_IDS, len(self.offsets) - 1, len(self.doc_ids), self.n_ids, MAGIC)
        self.stream.write(FOOTER.pack(*footer))


class Reader:
    """Random access to one file: any range of ids, reading only the blocks that hold it."""

    def __init__(self, file) -> None:
        self.file = file
        size = file.size()
        self.width, self.block_ids, blocks, docs, self.n_ids, magic = FOOTER.unpack(self._read(size - FOOTER.size, FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a file of packed ids")
        sizes = [8 * (blocks + 1), 8 * (docs + 1), 8 * docs, docs]
        tail = self._read(size - FOOTER.size - sum(sizes), sum(sizes))
        ends = np.cumsum(sizes)
        self.offsets = np.frombuffer(tail[: ends[0]], "<u8").astype(np.int64)
        self.starts = np.frombuffer(tail[ends[0] : ends[1]], "<u8").astype(np.int64)
        known = np.frombuffer(tail[ends[2] :], np.uint8)
        self.doc_ids = [x if k else None for x, k in zip(np.frombuffer(tail[ends[1] : ends[2]], "<i8").tolist(), known, strict=True)]

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids ``start`` to ``end``, the end excluded."""
        if start >= end:
            return np.empty(0, np.uint32)
        first, last = start // self.block_ids, (end - 1) // self.block_ids
        data = self._read(self.offsets[first], int(self.offsets[last + 1] - self.offsets[first]))
        base = first * self.block_ids
        return unpack(data, min(self.n_ids, (last + 1) * self.block_ids) - base, self.width)[start - base : end - base]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, first id's place, ids) of each document, read by runs of blocks."""
        run, at, have = np.empty(0, np.uint32), 0, 0
        for i, doc_id in enumerate(self.doc_ids):
            start, end = int(self.starts[i]), int(self.starts[i + 1])
            if end > have:
                more = min(self.n_ids, max(end, have + RUN * self.block_ids) // self.block_ids * self.block_ids)
                more = max(more, end)
                run, at = np.concatenate([run[start - at :], self.ids(have, more)]), start
                have = more
            yield doc_id, start, run[start - at : end - at]


def runs_of_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to at most TEXT_BYTES of text or one row, so that what a longer batch takes stays small."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column("text")).fill_null(0).to_numpy().astype(np.int64))
        start, before = 0, 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(ends, before + TEXT_BYTES, "right")))
            yield batch.slice(start, end - start)
            start, before = end, int(ends[end - 1])


def write(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None) -> DataFrame:
    """Encodes whole texts and writes one file per range of doc_id; returns the manifest.

    Takes (doc_id, text, ...), other columns are ignored. Null and empty texts have the end id alone. Null
    doc_ids come first. Rows that share an id are in the order of a hash of their text, and equal rows are
    told apart by where they are read, so any group of them spreads over ranges. An empty table gives an
    empty manifest. A file's name has its task attempt; only files in the manifest, which Spark commits,
    count, so a repeated task does no harm. Manifest: (part, path, n_docs, n_ids), parts in id order.
    """
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "packed")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, encoder, writer, path = context.partitionId(), None, None, ""
        store, root = fs.FileSystem.from_uri(folder)
        for batch in runs_of_text(batches):
            if writer is None:
                encoder = shared_encoder(tokenizer)
                store.create_dir(root)
                path = f"{root}/part-{part:06d}-{context.taskAttemptId()}.ids"
                stream = store.open_output_stream(path)
                writer = Writer(stream, bits(max(encoder.vocabulary, end_id + 1)))
            end = np.array([end_id], np.uint32)
            ids = encoder.encode(batch.column("text"))
            for doc_id, own in zip(batch.column("doc_id").to_pylist(), ids, strict=True):
                writer.add(doc_id, np.concatenate([own, end]))
            pa.default_memory_pool().release_unused()  # workers live on, and what they keep adds up with later tasks'
        if writer is not None:
            writer.close()
            stream.close()
            row = {"part": [part], "path": [path], "n_docs": [len(writer.doc_ids)], "n_ids": [writer.n_ids]}
            yield pa.RecordBatch.from_pydict(row, pa.schema([("part", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "text",
        F.xxhash64("text").alias("_hash"),
        F.monotonically_increasing_id().alias("_row"),
    )
    order = ["doc_id", "_hash", "_row"]
    ranged = rows.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order).select("doc_id", "text")
    return stored(ranged.mapInArrow(encode, "part int, path string, n_docs bigint, n_ids bigint"), "packed-manifest")


def read(manifest: DataFrame, folder: str | None = None) -> DataFrame:
    """Reads the files of a manifest: (doc_id, start, n_tokens, ids_crc32) per document.

    ``start`` counts the ids of all documents before it, ``ids_crc32`` is of the ids as little-endian
    unsigned 32-bit integers. ``folder`` is the one they were written to, if it isn't on the local mount.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = fs.FileSystem.from_uri(folder)[0] if folder else fs.LocalFileSystem()
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
                with store.open_input_file(path) as file:
                    found = [(d, base + s, len(x), zlib.crc32(x.astype("<u4", copy=False).tobytes())) for d, s, x in Reader(file).documents()]
                columns = dict(zip(("doc_id", "start", "n_tokens", "ids_crc32"), zip(*found, strict=True), strict=True))
                yield pa.RecordBatch.from_pydict(columns, pa.schema([(c, pa.int64()) for c in columns]))

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).select("part", "path", "base")
    dealt = files.repartition(partitions(manifest.sparkSession), "part").select("path", "base")
    return dealt.mapInArrow(decode, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def encoded(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Writes ``docs`` to packed files in the shared folder and reads them back."""
    folder = shared_folder(docs.sparkSession, "packed")
    return read(write(docs, tokenizer, end_id, folder), folder)
