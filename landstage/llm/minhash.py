"""Near duplicates by fast similarity sketching (operator 1).

A document's set is its distinct 5-word shingles.  The sketch has ``COORDS``
coordinates.  In round i every shingle is hashed to one coordinate and a value,
and an empty coordinate takes the smallest value that falls on it, so values of
round i stay below those of round i + 1.  Rounds go on until every coordinate is
filled; round COORDS + j throws all shingles at coordinate j, so at most
2 * COORDS rounds fill all of them, whatever the size of the set.  Equal
coordinates of two sketches estimate the Jaccard similarity with the
concentration of independent draws.

Bands of ``ROWS`` coordinates give bucket keys.  A pair at the similarity 0.75
agrees in at least one of the 48 bands but for about 2 in a million.

Equal sets are one node.  In a bucket, every node is compared with the bucket's
smallest node, and links are confirmed on the full sets, which is linear.  Only
buckets whose nodes then still lie in several components are looked at again, for
links between components.  Those of at most ``SMALL`` nodes yield their pairs from
different components (a constant number a row).  Larger ones are cut into blocks of
about ``BLOCK`` nodes; a task takes two blocks, counts all common shingles with
matrix products and returns one link for each node and component, so no pair row
is ever made for a pair that is not linked.  Every candidate pair of two
components has then been checked, and the components are those of all candidate
links; no bucket is capped.  In a large bucket of documents that are alike but not
linked the comparisons (not the rows) grow with the square of its size.

Defined results: a null or empty text, or one without words, has the empty set, is
linked with nothing and stays.  With fewer than five words the whole sequence is
the one shingle.  Rows that repeat an id are one node.  Rows with a null id are
compared only by equal sets: they join the component of that set's smallest id,
and stay where there is none.  An empty table gives an empty table.  Only the id
and text columns are read, whatever others are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landstage.llm import common as C
from landstage.llm.components import connected_components

SHINGLE = 5
ROWS = 5
BANDS = 48
COORDS = ROWS * BANDS
THRESHOLD = 75          # per cent
SMALL = 32              # nodes of a bucket
BLOCK = 256
WIDE = 4096             # shingles of one matrix product

_OPEN = np.uint64(0xFFFFFFFFFFFFFFFF)
SKETCH_SCHEMA = "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>"


def sketch(doc: np.ndarray, item: np.ndarray, n_docs: int, coords: int = COORDS) -> np.ndarray:
    """(n_docs, coords) sketch of the sets given as (set index, 64-bit item); empty sets stay open."""
    cells = np.full(n_docs * coords, _OPEN, dtype=np.uint64)
    table = cells.reshape(n_docs, coords)
    for i in range(2 * coords):
        if not len(doc):
            break
        g = C.mix(item + np.uint64((i + 1) * 0xA24BAED4963EE407 & 0xFFFFFFFFFFFFFFFF))
        at = doc * coords + ((g >> np.uint64(34)) % np.uint64(coords)).astype(np.int64) if i < coords else doc * coords + (i - coords)
        value = (g & np.uint64(0xFFFFFFFF)) | np.uint64(i << 32)
        if i:
            free = cells[at] > np.uint64(i << 32)       # a value of an earlier round stays
            at, value = at[free], value[free]
        np.minimum.at(cells, at, value)
        live = np.zeros(n_docs, bool)
        ids = np.flatnonzero(np.bincount(doc, minlength=n_docs))
        live[ids] = (table[ids] == _OPEN).any(axis=1)
        if not live[ids].all():
            still = live[doc]
            doc, item = doc[still], item[still]
    return table


def band_keys(table: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of the key."""
    n, coords = table.shape
    weights = C.odd_constants(coords, 17)
    parts = (C.mix(table) * weights).reshape(n, coords // rows, rows).sum(axis=2, dtype=np.uint64)
    return C.mix(parts + np.arange(coords // rows, dtype=np.uint64)).view(np.int64)


def _per_set(value: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, np.uint64)
    np.add.at(out, doc, value)
    return out.view(np.int64)


def sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Set size, 128-bit name of the set and band keys of every document."""
    C.ship_package()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.chunks(batch):
                n = part.num_rows
                t = C.flat(part.column(1))
                doc, h = C.shingles(t._replace(buf=C.LOWER[t.buf]), SHINGLE)
                size = np.bincount(doc, minlength=n)
                keys = band_keys(sketch(doc, h, n))
                has = size > 0
                offsets = np.concatenate(([0], np.cumsum(has * BANDS))).astype(np.int32)
                bands = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[has].ravel()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(size.astype(np.int64)), pa.array(_per_set(C.mix(h), doc, n)),
                     pa.array(_per_set(C.mix(h ^ np.uint64(0x5851F42D4C957F2D)), doc, n)), bands],
                    ["doc_id", "n_shingles", "set_a", "set_b", "bands"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SKETCH_SCHEMA)


def shingle_sets(docs: DataFrame) -> DataFrame:
    """(node, items, brief): the sorted shingle hashes of (doc_id, text) rows, and their upper halves as bytes."""
    C.ship_package()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.chunks(batch):
                t = C.flat(part.column(1))
                doc, h = C.shingles(t._replace(buf=C.LOWER[t.buf]), SHINGLE)
                offsets = np.searchsorted(doc, np.arange(part.num_rows + 1)).astype(np.int32)
                halves = (h >> np.uint64(32)).astype(np.uint32)
                brief = pa.array([halves[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(h.view(np.int64))), brief], ["node", "items", "brief"])

    return docs.mapInArrow(run, "node bigint, items array<bigint>, brief binary")


def linked_blocks(table: pa.Table, low: int, high: int, threshold: int = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of nodes (rows of two blocks) that reach the threshold, one for each node and other component.

    Rows: node, root, brief, block.  The halves of the hashes may make a pair look closer than it is
    (by two shingles at most are allowed for); the caller confirms on the full hashes.
    """
    node, root, block = (table.column(c).to_numpy() for c in ("node", "root", "block"))
    items = [np.frombuffer(b, np.uint32) for b in table.column("brief").to_pylist()]
    left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
    size = np.array([len(x) for x in items])
    row = np.repeat(np.arange(len(items)), size)
    _, name, count = np.unique(np.concatenate(items), return_inverse=True, return_counts=True)
    shared = count > 1
    column = np.cumsum(shared) - 1
    row, name = row[shared[name]], column[name[shared[name]]]
    order = np.argsort(name, kind="stable")
    row, name = row[order], name[order]
    both = np.zeros((len(left), len(right)), np.float32)
    for a in range(0, int(shared.sum()), WIDE):
        lo, hi = np.searchsorted(name, (a, a + WIDE))
        m = np.zeros((len(items), WIDE), np.float32)
        m[row[lo:hi], name[lo:hi] - a] = 1
        both += m[left] @ m[right].T
    either = size[left][:, None] + size[right][None, :] - both
    near = (100 * (both + 2) >= threshold * (either - 2)) & (root[left][:, None] != root[right][None, :])
    i, j = np.nonzero(near)
    closest = np.argsort(-(both[i, j] / either[i, j]), kind="stable")
    i, j = left[i[closest]], right[j[closest]]
    _, first = np.unique(np.column_stack((node[i], root[j])), axis=0, return_index=True)
    i, j = i[first], j[first]
    return np.minimum(node[i], node[j]), np.maximum(node[i], node[j])


def links_in_blocks(rows: DataFrame, sets: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Candidate links (a, b) between components inside large buckets; rows (key, node, root, size)."""
    C.ship_package()
    blocks = F.ceil(F.col("size") / F.lit(BLOCK)).cast("int")
    dealt = (rows.join(sets.select("node", "brief"), "node").withColumn("blocks", blocks)
             .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "node", "root", "brief", "block"))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        a, b = linked_blocks(table, key[1].as_py(), key[2].as_py(), threshold)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt.groupBy("key", "low", "high").applyInArrow(run, "a bigint, b bigint")


def confirmed(pairs: DataFrame, sets: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    left = sets.select(F.col("node").alias("a"), F.col("items").alias("items_a"))
    right = sets.select(F.col("node").alias("b"), F.col("items").alias("items_b"))
    common = F.size(F.array_intersect("items_a", "items_b"))
    return (pairs.select("a", "b").distinct().join(left, "a").join(right, "b")
            .select("a", "b", common.alias("n"), (F.size("items_a") + F.size("items_b")).alias("total"))
            .where(100 * F.col("n") >= threshold * (F.col("total") - F.col("n"))).select("a", "b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable over links) and kept, one row per row of ``docs``."""
    named = C.materialise(sketches(docs, id_col, text_col), "sketches")
    nodes = C.materialise(named.where("n_shingles > 0").groupBy("set_a", "set_b").agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")), "nodes")
    keyed = nodes.where("node is not null").select("node", "n", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("c"), F.min(F.struct("node", "n")).alias("center")).where("c > 1").drop("c")
    member = C.materialise(keyed.join(shared, "key"), "members")
    fits = "100 * least(n, m) >= %d * greatest(n, m)" % threshold
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    wanted = member.select(F.col("node").alias("doc_id")).distinct().hint("shuffle_hash")
    sets = C.materialise(shingle_sets(texts.join(wanted, "doc_id", "left_semi")), "sets")
    pairs = C.materialise(member.select(F.col("center.node").alias("a"), F.col("center.n").alias("m"), F.col("node").alias("b"), "n").where("a <> b").where(fits).select("a", "b").distinct(), "pairs")
    links = C.materialise(confirmed(pairs, sets, threshold), "links")
    roots = connected_components(links)

    # buckets whose nodes still lie in several components: pairs across components
    placed = member.select("key", "node", "n")
    placed = placed.withColumn("root", F.col("node")) if roots is None else placed.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("size")).where("lo < hi").select("key", "size")
    rest = C.materialise(placed.join(mixed, "key"), "rest")
    few = rest.where(F.col("size") <= SMALL)
    other = few.select("key", F.col("node").alias("b"), F.col("n").alias("m"), F.col("root").alias("root_b"))
    near = (few.withColumnRenamed("node", "a").join(other, "key").where("a < b and root <> root_b").where(fits)
            .select("a", "b").distinct().join(pairs, ["a", "b"], "left_anti"))
    near = near.union(links_in_blocks(rest.where(F.col("size") > SMALL), sets, threshold))
    more = C.materialise(confirmed(near, sets, threshold), "more-links")
    if not more.isEmpty():
        roots = connected_components(links.union(more))

    groups = nodes.select("set_a", "set_b", "node")
    if roots is None:
        groups = groups.withColumn("component_id", F.col("node"))
    else:
        groups = groups.join(roots, "node", "left").withColumn("component_id", F.coalesce("root", "node")).drop("root")
    filled = named.where("n_shingles > 0").join(groups.drop("node"), ["set_a", "set_b"]).select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    empty = named.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return filled.union(empty).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
