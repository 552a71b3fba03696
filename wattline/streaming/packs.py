"""Packs: the Arrow columns of many rows as one binary value.

Python's side of a keyed state takes rows one by one and asks for state one call at a time, which costs far more
than what is done with them.  Streams therefore pack rows before they shuffle them by a coarse key, keep packs as
state, and work on whole columns in between.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

# Rows are packed, and packs opened, by so many bytes of columns at a time.
PACK_BYTES = 32 << 20

Batches = Iterator[pa.RecordBatch]


def pack(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as out:
        out.write_table(rows)
    return sink.getvalue().to_pybytes()


def unpack(value: bytes) -> pa.Table:
    return pa.ipc.open_stream(value).read_all()


def buffered(batches: Batches) -> Iterator[pa.Table]:
    """The same rows in tables of about ``PACK_BYTES``, each column in one piece."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= PACK_BYTES:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def codes(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A number for each value: the same for the same value, a missing one too."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return whole.dictionary_encode("encode").indices.to_numpy(zero_copy_only=False).astype("int64")


def joint_codes(rows: pa.Table, columns: list[str]) -> np.ndarray:
    """A number for each combination of values."""
    joint = np.zeros(rows.num_rows, "int64")
    for c in columns:
        own = codes(rows[c])
        joint = joint * (own.max(initial=0) + 1) + own
        if joint.max(initial=0) > 2**40:  # so that the next product fits
            joint = np.unique(joint, return_inverse=True)[1]
    return joint


def sort_order(keys: dict[str, np.ndarray | pa.ChunkedArray], descending: tuple[str, ...] = ()) -> np.ndarray:
    by = [(c, "descending" if c in descending else "ascending") for c in keys]
    return pc.sort_indices(pa.table(keys).combine_chunks(), sort_keys=by).to_numpy()


def run_starts(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin in columns that are sorted together."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def packed_runs(rows: pa.Table, by: list[str], name: str) -> pa.RecordBatch | None:
    """Of rows that lie sorted by ``by`` one row per run: ``by`` and the other columns as a pack."""
    if not rows.num_rows:
        return None
    starts = run_starts(*(codes(rows[c]) for c in by))
    rest, ends = rows.drop_columns(by), [*starts[1:], rows.num_rows]
    packs = [pack(rest.slice(a, b - a)) for a, b in zip(starts, ends, strict=True)]
    keys = rows.select(by).take(starts).combine_chunks()
    columns = {c: keys[c].combine_chunks() for c in by} | {name: pa.array(packs, pa.binary())}
    return pa.RecordBatch.from_arrays([*columns.values()], names=[*columns])


def packed_by(rows: DataFrame, by: list[str], name: str) -> DataFrame:
    """The rows of each task packed by ``by``; a key has several packs."""

    def packed(batches: Batches) -> Batches:
        for table in buffered(batches):
            order = sort_order({"k": joint_codes(table, by)})
            if (batch := packed_runs(table.take(order), by, name)) is not None:
                yield batch

    kinds = StructType([rows.schema[c] for c in by]).add(name, "binary")
    return rows.mapInArrow(packed, kinds)


def opened(packs: DataFrame, name: str, schema: StructType) -> DataFrame:
    """The rows of packs in the column ``name``."""
    names = schema.names

    def tables(batches: Batches) -> Batches:
        for batch in batches:
            for value in batch.column(batch.schema.get_field_index(name)):
                yield from unpack(value.as_buffer()).select(names).to_batches()

    def rows(batches: Batches) -> Batches:
        for table in buffered(tables(batches)):
            yield from table.to_batches()

    return packs.select(name).mapInArrow(rows, schema)
