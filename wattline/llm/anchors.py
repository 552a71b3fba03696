"""SimHash near-duplicates found by anchor-point covering.

The anchors are the words of a covering code: two binary Golay codes side by side, over 46 of the 64 bits.
The Golay code is perfect with radius 3, so every fingerprint has one home anchor within 3 bits in each half.
A fingerprint within LINK bits of it is then within 3 + i and 3 + LINK - i bits of the same anchor for some i.
Each fingerprint goes to all such anchors (about 61 of 2^24), where it meets those at home there.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import partitions, row_key, slices, stored
from wattline.llm.components import stars

#: Words of a shingle, the hash's seed, and the most bits in which linked fingerprints differ.
SHINGLE, SEED, LINK = 3, 42, 2
#: Bits, covering radius and generator polynomial of the Golay code.
BITS, RADIUS, GENERATOR = 23, 3, 0b110001110101
#: Members of an anchor that are compared in memory; larger anchors are compared by a join.
TOGETHER = 2048
#: Comparisons made at once.
PAIRS = 1 << 22

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None) -> int:
    """64 bits, each set if it is set in more than half of the shingles' hashes."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    n = min(SHINGLE, len(words))
    hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in map(b" ".join, zip(*(words[i:] for i in range(n)), strict=False))], "<u8")
    set_bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int32)
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, row_key, fp) of each document; fp is the fingerprint's 64 bits as a signed number."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            own = np.array([fingerprint(x) for x in batch.column("text").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row_key"), pa.array(own)], ["doc_id", "row_key", "fp"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), row_key().alias("row_key"), "text")
    return rows.mapInArrow(compute, "doc_id bigint, row_key string, fp bigint")


def _syndromes(x: np.ndarray) -> np.ndarray:
    """The remainder of each 23-bit word by the generator."""
    x = x.copy()
    for bit in range(BITS - 1, 10, -1):
        x ^= ((x >> bit) & 1) * (GENERATOR << (bit - 11))
    return x


def _errors() -> list[tuple[np.ndarray, np.ndarray]]:
    """For 3, 4 and 5 bits away: errors in the order of their syndromes, and where each syndrome's begin."""
    out = []
    for weights in (range(RADIUS + 1), *([RADIUS + i] for i in range(1, LINK + 1))):
        found = np.array([sum(1 << b for b in bits) for w in weights for bits in combinations(range(BITS), w)])
        order = np.argsort(syndromes := _syndromes(found), kind="stable")
        out.append((found[order], np.searchsorted(syndromes[order], np.arange(2**11 + 1))))
    return out


def replicas(fp: np.ndarray, errors: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the fingerprint, anchor, whether at home) for every anchor it goes to."""
    halves = [(fp >> np.uint64(BITS * i)).astype(np.int64) & (2**BITS - 1) for i in (0, 1)]
    syndromes = [_syndromes(h) for h in halves]
    index, anchors, home = [], [], []
    for i in range(LINK + 1):
        for j in range(LINK + 1 - i):
            (left, left_at), (right, right_at) = errors[i], errors[j]
            n_left = left_at[syndromes[0] + 1] - left_at[syndromes[0]]
            n_right = right_at[syndromes[1] + 1] - right_at[syndromes[1]]
            own = np.repeat(np.arange(len(fp)), n_left * n_right)
            place = np.arange(len(own)) - np.repeat(np.cumsum(n_left * n_right) - n_left * n_right, n_left * n_right)
            a = halves[0][own] ^ left[left_at[syndromes[0][own]] + place // n_right[own]]
            b = halves[1][own] ^ right[right_at[syndromes[1][own]] + place % n_right[own]]
            index.append(own)
            anchors.append(((a >> 11) << 12 | b >> 11).astype(np.int32))  # 12 bits tell a code's words apart
            home.append(np.full(len(own), i == j == 0))
    return np.concatenate(index), np.concatenate(anchors), np.concatenate(home)


def _linked(fp: np.ndarray, run: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is near within a run. ``run`` ascends.

    Parts of PAIRS comparisons may end inside a run, so each part links from labels of its own: every pair that
    it finds is connected by its own links, whatever other parts do with the labels."""
    begin = np.searchsorted(run, run, "left")
    size = np.searchsorted(run, run, "right") - begin
    mine = np.flatnonzero(home & (size > 1))
    cost = np.cumsum(size[mine])
    u, v = [fp[:0]], [fp[:0]]
    for part in np.split(mine, np.searchsorted(cost, np.arange(PAIRS, cost[-1], PAIRS)) if len(mine) else []):
        a = np.repeat(part, size[part])
        b = np.arange(len(a)) - np.repeat(np.cumsum(size[part]) - size[part], size[part]) + begin[a]
        near = (np.bitwise_count(fp[a] ^ fp[b]) <= LINK) & (a != b)
        a, b = a[near], b[near]
        label = np.arange(len(fp))
        while len(a):
            least = np.minimum(label[a], label[b])
            if (label[a] == least).all() and (label[b] == least).all():
                break
            np.minimum.at(label, a, least)
            np.minimum.at(label, b, least)
        moved = np.flatnonzero(label != np.arange(len(fp)))
        u.append(fp[moved])
        v.append(fp[label[moved]])
    return np.concatenate(u), np.concatenate(v)


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within each anchor, from rows in the order of anchors; (fp, null) for members of large anchors."""

    def batch_of(u: np.ndarray, v: np.ndarray | None) -> pa.RecordBatch:
        other = pa.nulls(len(u), pa.int64()) if v is None else pa.array(v.view(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), other], ["u", "v"])

    rest = (np.empty(0, np.int32), np.empty(0, np.uint64), np.empty(0, bool))
    large = None  # the anchor that has had more than TOGETHER members
    for batch in batches:
        new = (batch.column("anchor").to_numpy(), batch.column("fp").to_numpy().view(np.uint64), batch.column("home").to_numpy(zero_copy_only=False))
        anchor, fp, home = (np.concatenate(x) for x in zip(rest, new, strict=True))
        if not len(anchor):
            continue
        at = np.searchsorted(anchor, anchor, "left")
        big = (np.searchsorted(anchor, anchor, "right") - at > TOGETHER) | (anchor == large)
        if big.any():
            yield batch_of(fp[big], None)
            large = anchor[big][-1]
            anchor, fp, home = anchor[~big], fp[~big], home[~big]
        last = anchor == anchor[-1] if len(anchor) else np.empty(0, bool)
        rest = (anchor[last], fp[last], home[last])
        u, v = _linked(fp[~last], anchor[~last], home[~last])
        if len(u):
            yield batch_of(u, v)
    u, v = _linked(rest[1], rest[0], rest[2])
    if len(u):
        yield batch_of(u, v)


def links(nodes: DataFrame) -> DataFrame:
    """(u, v) links that connect whatever is connected by pairs of ``nodes``' fp within LINK bits."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        errors = _errors()
        for batch in slices(batches, 4096):
            fp = batch.column("fp").to_numpy()
            index, anchor, home = replicas(fp.view(np.uint64), errors)
            yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(fp[index]), pa.array(home)], ["anchor", "fp", "home"])

    placed = nodes.select("fp").mapInArrow(spread, "anchor int, fp bigint, home boolean")
    placed = placed.repartition(partitions(nodes.sparkSession), "anchor").sortWithinPartitions("anchor")
    met = stored(placed.mapInArrow(_met, "u bigint, v bigint"), "anchor-links")
    # Members of large anchors: two fingerprints differ in 2 bits at most if both are a bit at most from one
    # word. Each goes to its 65 words and is linked to the least one there; a word has 65 members at most.
    members = met.filter("v IS NULL").select("u").distinct()
    flips = F.expr("transform(sequence(0, 63), i -> u ^ shiftleft(1L, i))")
    balls = stored(members.select("u", F.explode(F.concat(F.array("u"), flips)).alias("word")), "anchor-large")
    least = stored(balls.groupBy("word").agg(F.min("u").alias("v"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "anchor-large-least")
    return met.filter("v IS NOT NULL").unionByName(balls.join(least, "word").filter("u != v").select("u", "v").distinct())


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, row_key, fp, fingerprint, component_id) of each document.

    Takes (doc_id, text, ...). Documents whose fingerprints differ in LINK bits at most are linked;
    component_id is the least doc_id of all that are reached. Null, empty and blank texts have fingerprint
    zero and are linked as any other. Null ids count last and are a component's id only where it has no
    other. Equal rows are each returned, other columns ignored; an empty table gives no rows.

    Equal fingerprints are one node, so copies cost a row of a combined minimum.
    """
    rows = stored(fingerprints(docs), "fingerprints")
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprint-nodes")
    star = stars(links(nodes)).select(F.col("u").alias("fp"), F.col("v").alias("root"))
    rooted = stored(nodes.join(star, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root")), "fingerprint-roots")
    ids = stored(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "fingerprint-components")
    members = stored(rooted.join(ids, "root").select("fp", "component_id"), "fingerprint-members")
    text = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return rows.join(members, "fp").select("doc_id", "row_key", "fp", text, "component_id")


def distinct_documents(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` of each component, columns as they are: of the least doc_id, then of the least hash
    of id and text. Rows equal in both are one."""
    found = stored(near_duplicates(docs), "near-duplicates")
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")
    one = found.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("fp")).alias("_fp")).agg(F.min(place).alias("at"))
    first = stored(one.select(F.col("at.row_key").alias("_first")), "near-duplicates-first")
    kept = docs.withColumn("_key", row_key()).join(first, F.col("_key") == F.col("_first"), "left_semi")
    return kept.dropDuplicates(["_key"]).drop("_key")
