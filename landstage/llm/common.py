"""Helpers shared by the operators: Arrow batches as flat arrays, hashing, sessions.

The array helpers run inside Spark tasks.  They turn a batch of texts into one
flat byte array in which every text is followed by one separator byte, so that
words, lines and windows of many documents are found with a few numpy calls.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from landstage.operators.records import _pickle_package_by_value
from landstage.session import ensure_checkpoint_dir, scratch_path

CHUNK_BYTES = 2_000_000

# The white space that separates words, as in [\x20\x09-\x0D].
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
WORD = r"[^\x20\x09-\x0D]+"

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(SPACES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def ship_package() -> None:
    """Pickle this package by value, so executors need no installed copy."""
    _pickle_package_by_value()


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble unsigned 64-bit values (finaliser with two multiplications)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def odd_constants(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit multipliers, the same on every machine."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed * 1_000_003)) | np.uint64(1)


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first n powers of the rolling hash's base (or of its inverse), modulo 2**64.

    A worker keeps as many as its chunks have needed; the more that a longer text needs go with it.
    """
    key, kept = "inv" if inverse else "fwd", CHUNK_BYTES + 4096
    have = _powers.get(key)
    if have is None or len(have) < n:
        steps = np.full(n if n > kept else min(kept, 1 << n.bit_length()), _BASE_INV if inverse else _BASE, dtype=np.uint64)
        steps[:1] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if n <= kept:
            _powers[key] = have
    return have[:n]


class Texts(NamedTuple):
    """Texts of a chunk: bytes with one separator after each, and where each starts and ends."""

    buf: np.ndarray     # uint8
    start: np.ndarray   # int64, first byte of each text
    end: np.ndarray     # int64, the separator after each text


def flat(texts: pa.Array, separator: str = " ") -> Texts:
    """One byte array over all texts; a null counts as an empty text."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    joined = pc.binary_join_element_wise(pc.fill_null(texts.cast(pa.large_string()), ""),
                                         pa.scalar("", pa.large_string()), pa.scalar(separator, pa.large_string()))
    _, offsets, values = joined.buffers()
    off = np.frombuffer(offsets, dtype=np.int64, count=joined.offset + len(joined) + 1)[joined.offset:]
    if values is None or not len(joined):
        return Texts(np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64))
    buf = np.frombuffer(values, dtype=np.uint8)[off[0]:off[-1]]
    off = off - off[0]
    return Texts(buf, off[:-1], off[1:] - 1)


def chunks(batch: pa.RecordBatch, column: str = "text", most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``most`` text bytes; a longer text is a slice of its own."""
    if not batch.num_rows:
        return
    size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
    total = np.cumsum(np.asarray(size, dtype=np.int64) + 1)
    at = 0
    while at < batch.num_rows:
        base = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, base + most, side="right")))
        to = min(to, at + 60_000)
        yield batch.slice(at, to - at)
        at = to


class Words(NamedTuple):
    start: np.ndarray   # first byte of each word
    end: np.ndarray     # after its last byte
    doc: np.ndarray     # index of its text in the chunk
    first: np.ndarray   # index of each text's first word, and the number of words at the end


def words(t: Texts) -> Words:
    """Words (runs without white space) of every text; texts end in a separator."""
    n = len(t.start)
    if not len(t.buf):
        z = np.zeros(0, np.int64)
        return Words(z, z, z, np.zeros(n + 1, np.int64))
    inside = ~IS_SPACE[t.buf]
    inside[t.end] = False
    edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
    start, end = edge[0::2], edge[1::2]
    first = np.searchsorted(start, np.append(t.start, len(t.buf)))
    doc = np.repeat(np.arange(n), np.diff(first))
    return Words(start, end, doc, first)


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """Sums from which the hash of any byte range comes in constant time."""
    out = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * powers(len(buf)), out=out[1:])
    return out


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range, from its bytes and length alone."""
    raw = (sums[end] - sums[start]) * powers(len(sums), inverse=True)[start]
    return mix(raw + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def window_hash(word_hash: np.ndarray, size: int, seed: int = 5) -> np.ndarray:
    """Hash of every run of ``size`` consecutive words (runs that cross texts are the caller's to drop)."""
    n = len(word_hash) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j, c in enumerate(odd_constants(size, seed)):
        total += word_hash[j:j + n] * c
    return mix(total)


def by_doc_then(value: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Order by text and, within a text, by value."""
    order = np.argsort(value)
    return order[np.argsort(doc[order].astype(np.uint16 if not len(doc) or doc.max() < 65536 else np.int64), kind="stable")]


def shingles(t: Texts, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every distinct run of ``size`` words, by text and hash.

    A text with fewer words has its whole word sequence as one shingle; one without words has none.
    """
    w = words(t)
    if not len(w.start):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    wh = range_hash(prefix_hash(t.buf), w.start, w.end)
    h = window_hash(wh, size)
    doc = w.doc[:len(h)]
    inside = doc == w.doc[size - 1:] if len(h) else np.zeros(0, bool)
    doc, h = doc[inside], h[inside]
    count = np.diff(w.first)
    few = np.flatnonzero((count > 0) & (count < size))
    if len(few):
        total = np.zeros(len(few), np.uint64)
        for j, c in enumerate(odd_constants(size, 5)):
            has = count[few] > j
            total[has] += wh[w.first[few[has]] + j] * c
        # the number of words is part of the hash
        doc, h = np.append(doc, few), np.append(h, mix(total + count[few].astype(np.uint64)))
    order = by_doc_then(h, doc)
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    return doc[new], h[new]


def stretches(group: np.ndarray) -> list[tuple[int, int]]:
    """(from, to) of every stretch of equal values; none for an empty array."""
    if not len(group):
        return []
    cut = np.flatnonzero(np.append(True, group[1:] != group[:-1])).tolist()
    return list(zip(cut, [*cut[1:], len(group)], strict=True))


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts the lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def sampled(df: DataFrame, key: str, most: int, total: int) -> DataFrame:
    """At most ``most`` rows, those with the smallest hash of ``key``: a bounded sample, the same at every run.

    ``total`` rows (or more) are there: a first cut at a hash that about ``2 * most`` of them pass keeps
    what the tasks hand on bounded however many tasks there are.
    """
    order = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1 << 40))
    share = min(1.0, 2 * most / max(total, 1))
    return df.where(order < int(share * (1 << 40)) + 1).orderBy(order, F.col(key)).limit(most)


def numbered(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """rows with ``pos`` (place in the group, from 0) and ``n`` (rows of the group).

    A range sort, the counts of each (group, partition), and their running sums: at most one
    count per partition and group boundary is ever in a window.
    """
    at = rows.repartitionByRange(shuffle_partitions(rows.sparkSession), *group, *order).sortWithinPartitions(*group, *order)
    at = materialise(at.withColumn("at", F.monotonically_increasing_id()), "sorted").withColumn("part", F.shiftright("at", 33))
    keys = [F.col(g).alias(f"_{g}") for g in group]
    count = at.groupBy(*keys, F.col("part").alias("_part")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("m"))
    own = W.partitionBy(*[f"_{g}" for g in group]) if group else W.partitionBy(F.lit(0))
    upto = F.sum("m").over(own.orderBy("_part").rowsBetween(W.unboundedPreceding, W.currentRow))
    count = count.withColumns({"before": upto - F.col("m"), "n": F.sum("m").over(own)})
    same = F.col("part") == F.col("_part")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_{g}"))
    return at.join(count, same).select(*rows.columns, (F.col("before") + F.col("at") - F.col("first")).alias("pos"), "n")
