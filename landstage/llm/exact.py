"""Exact duplicates by polynomial fingerprints that compose.

A text is its UTF-8 bytes with A-Z lower-cased.  It is cut into chunks of CHUNK bytes whose
polynomial hashes are taken side by side (one lane per chunk, over all texts of a batch at
once).  Hashes of neighbours combine by length-shifted arithmetic,
``h(xy) = h(x) * base ** len(y) + h(y)``, in a tree over each text's chunks, so the
fingerprint does not depend on how a text is cut.  ``fingerprints_of_parts`` combines the
parts of a document that lie in many rows in the same way, hashed wherever they are.

Equal fingerprints (and lengths) are only candidates.  Their texts are compared as a stream
of chunks of PART bytes: of each chunk number the least and the greatest content are taken,
first within a salted share of the group, then over the shares; a group is one class if they
agree everywhere.  A group in which a chunk differs (a collision) is split by the sequence of
its texts' distinct chunk contents, so the classes are exact whatever the hash does.  That
second pass is planned only if there is such a group; without one it would change nothing.

At scale: two scans of the texts, one shuffle of them (none if the candidate groups are few
enough for Spark to broadcast them) and one of the candidates' chunks.  A group of any size is
dealt over SALTS shares before anything of it meets.  A task holds a slice of a batch, its
lanes' arrays in steps of STEP bytes, and one text at most.

Nulls and special cases: a null text is an empty text, and empty texts are one group.  A null
id is smaller than every other id.  Of equal rows one stays.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landstage.llm import common as C

CHUNK = 4096            # bytes in a lane: 8 + 31 + 12 bits stay below 63
STEP = 1 << 20          # bytes whose weights are in memory at once
PART = 1 << 16          # bytes in a compared chunk
SALTS = 1024
# The two largest primes below 2**31 and a base for each.
PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 1664525019)


def _power(base: int, exponent: np.ndarray, prime: int) -> np.ndarray:
    """base ** exponent modulo prime, for an array of exponents."""
    out, square, left = np.ones(len(exponent), np.int64), base % prime, exponent.copy()
    while left.any():
        out = np.where(left & 1, out * square % prime, out)
        square = square * square % prime
        left >>= 1
    return out


def combine(h: np.ndarray, n: np.ndarray, owner: np.ndarray, base: int, prime: int) -> np.ndarray:
    """The hash of each owner's byte string from the hashes ``h`` and lengths ``n`` of its pieces, in order.

    Neighbours are combined in pairs until one piece is left per owner (owners ascend).
    """
    while len(owner) and (owner[1:] == owner[:-1]).any():
        first = np.append(True, owner[1:] != owner[:-1])
        place = np.arange(len(owner)) - np.maximum.accumulate(np.where(first, np.arange(len(owner)), 0))
        left = np.flatnonzero(place % 2 == 0)
        right = np.minimum(left + 1, len(owner) - 1)
        pair = (right > left) & (owner[right] == owner[left])
        shifted = (h[left] * _power(base, n[right], prime) + h[right]) % prime
        h, n, owner = np.where(pair, shifted, h[left]), n[left] + np.where(pair, n[right], 0), owner[left]
    return h


def lane_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, base: int, prime: int) -> np.ndarray:
    """Polynomial hash of each byte range (of at most CHUNK bytes, in order, none empty)."""
    out = np.zeros(len(start), np.int64)
    weight = np.append(_power(base, np.arange(CHUNK), prime), 0)      # the last one is for bytes between ranges
    at = 0
    while at < len(start):
        to = max(at + 1, int(np.searchsorted(end, start[at] + STEP, side="right")))
        lo, hi = start[at], end[to - 1]
        span = np.diff(np.append(start[at:to], hi))
        place = np.repeat(end[at:to] - 1, span) - np.arange(lo, hi)
        values = (buf[lo:hi].astype(np.int64) + 1) * weight[np.maximum(place, -1)]
        out[at:to] = np.add.reduceat(values, start[at:to] - lo) % prime
        at = to
    return out


def fingerprints(buf: np.ndarray, start: np.ndarray, end: np.ndarray, primes: tuple[int, int] = PRIMES, chunk: int = CHUNK) -> np.ndarray:
    """Fingerprint of each text: its two polynomial hashes in one number."""
    lanes = -(-(end - start) // chunk)
    owner = np.repeat(np.arange(len(start)), lanes)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    lo = start[owner] + number * chunk
    hi = np.minimum(lo + chunk, end[owner])
    out = np.zeros(len(start), np.int64)
    for base, prime in zip(BASES, primes, strict=True):
        whole = np.zeros(len(start), np.int64)
        whole[np.unique(owner)] = combine(lane_hashes(buf, lo, hi, base, prime), hi - lo, owner, base, prime)
        out = (out << 31) | whole
    return out


def _normal(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of a batch with their normalised bytes and where each text starts and ends."""
    for part in C.chunks(batch):
        t = C.flat(part.column(part.schema.get_field_index("text")))
        yield part, C.LOWER[t.buf], t.start, t.end


def prints(docs: DataFrame, primes: tuple[int, int] = PRIMES) -> DataFrame:
    """doc_id, n_bytes, fp and text_sha256 of every row of docs (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, buf, start, end in _normal(batch):
                sha = [hashlib.sha256(buf[a:b]).hexdigest() for a, b in zip(start.tolist(), end.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(end - start), pa.array(fingerprints(buf, start, end, primes)), pa.array(sha)],
                                                 ["doc_id", "n_bytes", "fp", "text_sha256"])

    return docs.mapInArrow(run, "doc_id bigint, n_bytes bigint, fp bigint, text_sha256 string")


def parts(docs: DataFrame, primes: tuple[int, int] = PRIMES, size: int = PART) -> DataFrame:
    """The chunks of every text under its fingerprint: doc_id, n_bytes, fp, text_sha256, number, content.

    An empty text has no chunk (all empty texts are equal).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, buf, start, end in _normal(batch):
                fp, ids = fingerprints(buf, start, end, primes), part.column(0)
                n = -(-(end - start) // size)
                owner = np.repeat(np.arange(len(start)), n)
                number = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
                sha = [hashlib.sha256(buf[a:b]).hexdigest() for a, b in zip(start.tolist(), end.tolist(), strict=True)]
                lo = start[owner] + number * size
                hi = np.minimum(lo + size, end[owner])
                most = max(1, STEP // size) if len(start) == 1 else len(owner)        # a very long text goes on in steps
                for at in range(0, len(owner), max(most, 1)):
                    o = owner[at:at + most]
                    content = [buf[a:b].tobytes() for a, b in zip(lo[at:at + most].tolist(), hi[at:at + most].tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(o)), pa.array((end - start)[o]), pa.array(fp[o]), pa.array([sha[i] for i in o.tolist()], pa.string()), pa.array(number[at:at + most]), pa.array(content, pa.binary())],
                        ["doc_id", "n_bytes", "fp", "text_sha256", "number", "content"])

    return docs.mapInArrow(run, "doc_id bigint, n_bytes bigint, fp bigint, text_sha256 string, number bigint, content binary")


def _share() -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")


def classes(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Size and last row (by id, then ``tie``) of every class, once per share that has rows of it."""
    shares = rows.groupBy(*keys, "share").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("doc_id", "tie")).alias("top"))
    whole = shares.groupBy(*keys).agg(F.sum("n").cast("bigint").alias("group_size"), F.max("top").alias("top"), F.collect_set("share").alias("shares"))
    return whole.select(*keys, "group_size", "top", F.explode("shares").alias("share"))


def collisions(chunks: DataFrame, groups: DataFrame) -> DataFrame:
    """(fp, n_bytes) of the groups whose texts are not all equal, by a comparison chunk by chunk."""
    mine = chunks.withColumn("share", _share()).join(groups.hint("shuffle_hash"), ["fp", "n_bytes", "share"], "left_semi")
    # the join's partitioning by share serves this first comparison
    near = mine.groupBy("fp", "n_bytes", "share", "number").agg(F.min("content").alias("lo"), F.max("content").alias("hi"))
    near = near.select("fp", "n_bytes", "number", "lo", (F.col("lo") != F.col("hi")).alias("differ"))
    far = near.groupBy("fp", "n_bytes", "number").agg(F.min("lo").alias("a"), F.max("lo").alias("b"), F.max("differ").alias("differ"))
    return far.where("differ or a != b").select("fp", "n_bytes").distinct()


def split(chunks: DataFrame, broken: DataFrame) -> DataFrame:
    """The class of every text in a broken group: the numbers of its chunks' contents, in order.

    A group has as many contents per chunk number as it has different texts at most; those
    are numbered, not the documents.
    """
    mine = chunks.join(broken, ["fp", "n_bytes"], "left_semi")
    contents = mine.select("fp", "n_bytes", "number", "content").distinct()
    lower = contents.groupBy("fp", "n_bytes", "number").agg(F.array_sort(F.collect_list("content")).alias("all"))
    named = mine.join(lower, ["fp", "n_bytes", "number"]).select("doc_id", "fp", "n_bytes", "text_sha256", "number", F.array_position("all", F.col("content")).alias("place"))
    found = named.groupBy("doc_id", "fp", "n_bytes", "text_sha256").agg(F.array_sort(F.collect_set(F.struct("number", "place"))).alias("way"))
    return found.select("doc_id", "fp", "n_bytes", "text_sha256", F.array_join(F.transform("way", lambda x: x["place"].cast("string")), ",").alias("class"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", primes: tuple[int, int] = PRIMES) -> DataFrame:
    """One row per document: doc_id, keep_id (largest id of its class), group_size, kept, text_sha256, n_bytes, fp."""
    C.ship_package()
    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    rows = C.materialise(prints(d, primes).withColumns({"share": _share(), "tie": F.monotonically_increasing_id()}), "fingerprints")
    keys = ["fp", "n_bytes"]
    groups = C.materialise(classes(rows, keys), "groups")
    chunks = parts(d, primes)
    broken = C.materialise(collisions(chunks, groups.where("group_size > 1")), "collisions")
    if not broken.isEmpty():
        ways = C.materialise(split(chunks, broken), "split").withColumnsRenamed({"doc_id": "i", "fp": "f", "n_bytes": "b", "text_sha256": "s"})
        same = F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("fp") == F.col("f")) & (F.col("n_bytes") == F.col("b")) & (F.col("text_sha256") == F.col("s"))
        rows = rows.join(ways, same, "left").select(*rows.columns, F.coalesce("class", F.lit("")).alias("class"))
        keys = [*keys, "class"]
        groups = classes(rows, keys)
    found = rows.join(groups, [*keys, "share"])
    return found.select("doc_id", F.col("top.doc_id").alias("keep_id"), "group_size", (F.col("top.tie") == F.col("tie")).alias("kept"), "text_sha256", "n_bytes", "fp")


def fingerprints_of_parts(pieces: DataFrame, key: str, order: str, text_col: str = "text") -> DataFrame:
    """key, n_bytes, fp of documents whose texts lie in pieces, one row each, in any partition.

    Every piece is hashed where it is; the pieces' hashes (not their texts) meet by key, and
    are folded in ``order`` by the same length-shifted arithmetic.  A null piece is empty.
    Equal to the fingerprint of the joined text, so a document is one group however it is cut.
    """
    C.ship_package()
    d = pieces.select(F.col(key).alias("key"), F.col(order).alias("place"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, buf, start, end in _normal(batch):
                fp = fingerprints(buf, start, end)
                shift = [pa.array(_power(b, end - start, p)) for b, p in zip(BASES, PRIMES, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(end - start), pa.array(fp >> 31), pa.array(fp & (2**31 - 1)), *shift],
                                                 ["key", "place", "n", "x", "y", "sx", "sy"])

    fields = d.schema
    schema = f"key {fields['key'].dataType.simpleString()}, place {fields['place'].dataType.simpleString()}, n bigint, x bigint, y bigint, sx bigint, sy bigint"
    hashed = d.mapInArrow(run, schema)
    whole = hashed.groupBy("key").agg(F.sum("n").cast("bigint").alias("n_bytes"), F.array_sort(F.collect_list(F.struct("place", "x", "y", "sx", "sy"))).alias("way"))
    p, q = (F.lit(x).cast("bigint") for x in PRIMES)
    zero = F.struct(F.lit(0).cast("bigint").alias("x"), F.lit(0).cast("bigint").alias("y"))
    total = F.aggregate("way", zero, lambda h, w: F.struct(((h["x"] * w["sx"] + w["x"]) % p).alias("x"), ((h["y"] * w["sy"] + w["y"]) % q).alias("y")))
    return whole.withColumn("h", total).select(F.col("key").alias(key), "n_bytes", F.shiftleft(F.col("h.x"), 31).bitwiseOR(F.col("h.y")).alias("fp"))
