"""Product codes of vectors by per-dimension value dictionaries.

Components become integers. In a batch of vectors each dimension has few different ones: they are its
dictionary, and their squared differences to all entries of the dimension's codebook are tabulated once. The
distances of a part are then rows of these tables, gathered by dictionary code and added up.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import slices, stored

#: Parts of a vector, entries of a part's codebook, rounds of refinement, integer steps of 1.
PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Components beyond this many steps count as so many; squares of all dimensions then add up within 64 bits.
FARTHEST = 1 << 27
#: Vectors whose dictionaries are made together.
TOGETHER = 4096


def integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v) of the vectors without null, NaN or infinite components, v as integers rounded down."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    step = lambda x: F.greatest(F.lit(-FARTHEST), F.least(F.lit(FARTHEST), F.floor(x.cast("double") * scale)))
    good = vectors.where(F.col("embedding").isNotNull() & F.forall("embedding", finite))
    return good.select("vec_id", "label", F.transform("embedding", lambda x: step(x).cast("int")).alias("v"))


def dictionaries(x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per dimension the different integers, and the code of each vector's among them."""
    return [np.unique(x[:, d], return_inverse=True) for d in range(x.shape[1])]


def assign(coded: list[tuple[np.ndarray, np.ndarray]], books: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of every part and its squared distance, rows x parts; of equal ones the lower index.

    ``books`` are the codebooks, parts x entries x dimensions of a part.
    """
    parts, entries, width = books.shape
    nearest, least = np.empty((rows, parts), np.int64), np.empty((rows, parts), np.int64)
    for part in range(parts):
        distance = np.zeros((rows, entries), np.int64)
        for d in range(width):
            values, codes = coded[part * width + d]
            distance += ((values[:, None] - books[part, None, :, d]) ** 2)[codes]
        nearest[:, part] = distance.argmin(axis=1)
        least[:, part] = np.take_along_axis(distance, nearest[:, part, None], 1)[:, 0]
    return nearest, least


def _batches(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in slices(batches, TOGETHER):
        yield batch, batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(batch.num_rows, dims)


def _sums(kept: DataFrame, books: np.ndarray) -> DataFrame:
    """(part, entry, place, n, total): how many parts are nearest to each entry, and their sums."""
    parts, entries, width = books.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for batch, x in _batches(batches, parts * width):
            nearest, _ = assign(dictionaries(x), books, len(x))
            for part in range(parts):
                n[part] += np.bincount(nearest[:, part], minlength=entries)
                np.add.at(total[part], nearest[:, part], x[:, part * width : (part + 1) * width])
        part, entry, place = np.nonzero(np.repeat(n[:, :, None] > 0, width, axis=2))
        columns = (part, entry, place, n[part, entry], total[part, entry, place])
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["part", "entry", "place", "n", "total"])

    found = kept.select("v").mapInArrow(add, "part bigint, entry bigint, place bigint, n bigint, total bigint")
    return found.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))


def refined(kept: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: each used entry becomes its parts' mean, rounded down."""
    books = books.copy()
    for r in _sums(kept, books).collect():  # one row per number in the codebooks, at most
        books[r["part"], r["entry"], r["place"]] = int(r["total"]) // r["n"]
    return books


def books_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) of every kept vector, and the codebooks (parts x entries x width).

    Takes (vec_id, embedding, label, ...); other columns are ignored. Codebooks start as the parts of the
    ``entries`` vectors of smallest vec_id (of equal ids the smaller components, null ids last); fewer
    vectors make smaller codebooks. Vectors of another length than the smallest id's are dropped. ``code`` is the chosen entries' numbers in hex, two digits at least, part
    by part; ``error`` the squared distances added up. Repeated rows stay, null labels and ids are kept.
    An empty table gives no rows and empty codebooks. The length of vectors must be a multiple of ``parts``.
    """
    kept = stored(integers(vectors, scale), "vector-integers")
    order = [F.col("vec_id").asc_nulls_last(), F.col("v")]
    least = kept.orderBy(*order).first()
    dims = len(least["v"]) if least else 0
    kept = kept.where(F.size("v") == dims)
    first = kept.orderBy(*order).limit(entries).collect()
    if dims % parts:
        raise ValueError(f"vectors of {dims} components have no {parts} equal parts")
    width = dims // parts
    start = np.array([r["v"] for r in first], np.int64).reshape(len(first), parts, width)
    books = np.ascontiguousarray(start.transpose(1, 0, 2))
    if first:
        for _ in range(rounds):
            books = refined(kept, books)
    digits = max(2, len(f"{max(1, len(first)) - 1:x}"))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([f"{e:0{digits}x}" for e in range(max(1, books.shape[1]))])
        for batch, x in _batches(batches, dims):
            nearest, least = assign(dictionaries(x), books, len(x))
            codes = ["".join(r) for r in names[nearest].tolist()]
            columns = [batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()), pa.array(least.sum(axis=1), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "code", "error"])

    ids, label = (kept.schema[c].dataType.simpleString() for c in ("vec_id", "label"))
    return kept.mapInArrow(code, f"vec_id {ids}, label {label}, code string, error bigint"), books


def with_label_error(coded: DataFrame) -> DataFrame:
    """Adds ``label_error``, the error summed over equal labels; nulls are equal."""
    sums = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    sums = stored(sums, "vector-label-errors")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
