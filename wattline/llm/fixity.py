"""Merkle fixity audit of replicas of a WARC archive."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import prefix_sums, stored

#: Bytes of a leaf's offset range and of a file, and children of an inner node, each as a power of two.
LEAF, FILE, FAN = 16, 26, 4


def record(page_id: Column, url: Column, body: Column) -> Column:
    """A WARC response record. Nulls are empty; the length is that of the body's bytes."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    head = F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), text(page_id), F.lit(">\r\nWARC-Target-URI: "), text(url))
    return F.concat(head, F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(text(body)).cast("string"), F.lit("\r\n\r\n"), text(body), F.lit("\r\n\r\n"))


def archive(pages: DataFrame, **copies: Column) -> DataFrame:
    """(page_id, url, offset, length, digest, <copy> ...): the records in archive order.

    Records are in the order of page_id (null first), url and digest; offsets are distributed prefix sums of
    their lengths. Each of ``copies`` is a body as a replica holds it, and becomes that record's digest.
    Equal records are told apart by where they are read.
    """
    own = record(F.col("page_id"), F.col("url"), F.col("html"))
    digests = [F.sha2(record(F.col("page_id"), F.col("url"), body), 256).alias(name) for name, body in copies.items()]
    rows = pages.select("page_id", "url", F.octet_length(own).cast("bigint").alias("length"), F.sha2(own, 256).alias("digest"), *digests)
    rows = stored(rows.withColumn("_row", F.monotonically_increasing_id()), "warc-records")
    order = [F.col(c) for c in ("page_id", "url", "digest", "_row")]
    return prefix_sums(rows, order, {"offset": F.col("length")}, "warc-offsets").drop("_row")


def levels(records: DataFrame, top: int, name: str) -> list[DataFrame]:
    """The tree of (offset, length, digest) records, leaves' ranges first: (node, hash) tables.

    A leaf hashes the records that begin in its range of 2**LEAF offsets, in order; an inner node hashes
    its 2**FAN children. Both have bounded members. ``top`` is the last level.
    """
    leaf = F.concat_ws(":", "offset", "length", "digest")
    rows = records.groupBy(F.shiftright("offset", LEAF).alias("node")).agg(F.array_sort(F.collect_list(F.struct("offset", leaf.alias("own")))).alias("kids"))
    out = []
    for level in range(top + 1):
        hashed = rows.select("node", F.sha2(F.array_join(F.transform("kids", lambda k: k["own"]), ","), 256).alias("hash"))
        out.append(stored(hashed, f"{name}-{level}"))
        kids = F.array_sort(F.collect_list(F.struct("node", F.concat_ws(":", "node", "hash").alias("own"))))
        rows = out[-1].groupBy(F.shiftright("node", FAN).alias("parent")).agg(kids.alias("kids")).withColumnRenamed("parent", "node")
    return out


def audit(original: DataFrame, replica: DataFrame) -> DataFrame:
    """Where two replicas differ: (offset, length, file, status), status corrupt, missing or extra.

    Takes (offset, length, digest) records, the offsets of one replica distinct. Roots are compared first;
    below, only children of nodes that differ are read. Equal replicas, also empty ones, give no rows; nulls
    in a digest or length are a value. Extra columns are ignored.
    """
    most = [r.agg(F.max("offset")).first()[0] or 0 for r in (original, replica)]
    top = max(0, -(-max(0, max(most).bit_length() - LEAF) // FAN))
    trees = [levels(r, top, n) for r, n in ((original, "merkle"), (replica, "merkle-replica"))]
    bad = None
    for mine, theirs in zip(*(reversed(t) for t in trees), strict=True):
        if bad is not None:
            parent = F.shiftright("node", FAN) == F.col("bad")
            mine, theirs = mine.join(bad, parent, "left_semi"), theirs.join(bad, parent, "left_semi")
        both = mine.join(theirs.withColumnsRenamed({"node": "other", "hash": "other_hash"}), F.col("node") == F.col("other"), "full")
        differ = both.filter(~F.col("hash").eqNullSafe(F.col("other_hash")))
        bad = stored(differ.select(F.coalesce("node", "other").alias("bad")), "merkle-differing")
    inside = F.shiftright("offset", LEAF) == F.col("bad")
    mine = original.select("offset", "length", "digest").join(bad, inside, "left_semi")
    theirs = replica.select("offset", "length", "digest").join(bad, inside, "left_semi")
    theirs = theirs.withColumnsRenamed({"offset": "_offset", "length": "_length", "digest": "_digest"})
    both = mine.join(theirs, F.col("offset") == F.col("_offset"), "full")
    same = F.col("length").eqNullSafe(F.col("_length")) & F.col("digest").eqNullSafe(F.col("_digest"))
    status = F.when(F.col("_offset").isNull(), "missing").when(F.col("offset").isNull(), "extra").otherwise("corrupt")
    place = F.coalesce("offset", "_offset")
    return both.filter(F.col("offset").isNull() | F.col("_offset").isNull() | ~same).select(
        place.alias("offset"), F.coalesce("length", "_length").alias("length"), F.shiftright(place, FILE).alias("file"), status.alias("status")
    )
