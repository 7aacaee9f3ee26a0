"""Merkle manifest of a dataset as a persistent, path-copying tree.

Every row is a leaf; per group (language) the leaves are ordered by id, every RUN consecutive
nodes become their hash, level by level, until one is left (the group's subroot); the
subroots, ordered by group, become the root in the same way.  The tree is kept in aligned
blocks of BLOCK = RUN ** DEPTH nodes: a block's top is a node of the next, smaller forest,
until every group is one node.  A forest's positions come from one range sort and the counts
of its partitions, so no group is ever ordered or numbered in one task.

A changed leaf makes a version of the tree: it shares every untouched node with the base and
copies only the leaf's ancestors.  Inside its block the new ancestors are hashed from the
block's own nodes; above the block they go on along the path that the upper forests, which
are distributed in the same way, have handed down to the block.  ``manifest`` returns for
every leaf its base path (what lies left and right of it on every level, which proves the
leaf) and, for a changed leaf, the copied nodes up to the version's root.

At scale: one scan of the table hashes the rows in the JVM (no text leaves the scan), one
range shuffle and two hash shuffles move about 200 bytes a row; a block of at most BLOCK
leaves is the largest thing a task holds; upper forests shrink by BLOCK each time.  Only the
largest group's size and the root come to the driver.

Nulls and special cases: a null field is written ``-``; a null group is the first group, null
ids are the first leaves of theirs; rows with the same group and id are ordered by their
leaf hash; repeated rows are leaves of their own.  An empty table has no rows.  Other
columns are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landstage.llm import common as C

RUN = 8
DEPTH = 3
BLOCK = RUN ** DEPTH
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"

# The letters that the change lower-cases.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_hash(*fields: Column) -> Column:
    """Hash of a row: every field as its UTF-8 byte count, a colon and its text, or ``-`` for null."""
    each = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(f).cast("string"), F.lit(":"), f), F.lit("-")) for f in each]), 256)


def lowered(name: str, text: Column) -> Column:
    """The change of the manifest's query: the text's letters A-Z in lower case, other fields as they are."""
    return F.translate(text, UPPER, LOWER) if name == "text" else text


def marked(doc_id: Column) -> Column:
    """Rows that the query changes: 3 divides the checksum of the decimal id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 0, F.lit(False))


def _level_up(nodes: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / RUN).cast("int")),
                       lambda i: F.sha2(F.array_join(F.slice(nodes, i * RUN + 1, RUN), ""), 256))


def tops(nodes: DataFrame, group: list[str]) -> DataFrame:
    """The next forest: one node (group, pos, n, hash) for every aligned block of nodes."""
    block = F.floor(F.col("pos") / BLOCK).cast("bigint").alias("block")
    found = nodes.groupBy(*group, "n", block).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "hash"))), lambda x: x["hash"]).alias("level"))
    top, level = F.when(F.col("n") == 1, F.col("level")[0]), F.col("level")
    for k in range(1, DEPTH):
        level = _level_up(level)
        top = top.when(F.col("n") <= RUN ** k, level[0])
    top = top.otherwise(_level_up(level)[0])
    return found.select(*group, F.col("block").alias("pos"), F.ceil(F.col("n") / BLOCK).cast("bigint").alias("n"), top.alias("hash"))


def forests(nodes: DataFrame, group: list[str]) -> list[DataFrame]:
    """``nodes`` and the forests above it, up to the one where every group is a single node."""
    out, largest = [nodes], nodes.agg(F.max("n")).first()[0] or 0
    while largest > 1:
        out.append(C.materialise(tops(out[-1], group), "tops"))
        largest = -(-largest // BLOCK)
    return out


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def block_levels(nodes: list[str], n: int) -> list[list[str]]:
    """The levels of a block below its top; none if its group (of n nodes) is a single node."""
    out = []
    while n > 1 and len(out) < DEPTH:
        out.append(nodes)
        nodes, n = [_sha("".join(nodes[i:i + RUN])) for i in range(0, len(nodes), RUN)], -(-n // RUN)
    return out


def base_path(levels: list[list[str]], i: int) -> list[tuple[str, str]]:
    """What lies left and right of node i in its run, on every level of the block."""
    out = []
    for level in levels:
        run = i - i % RUN
        out.append(("".join(level[run:i]), "".join(level[i + 1:run + RUN])))
        i //= RUN
    return out


def copy_path(node: str, path: list[tuple[str, str]]) -> list[str]:
    """The ancestors that a version with ``node`` in place copies; all other nodes are the base's."""
    out = []
    for left, right in path:
        node = _sha(left + node + right)
        out.append(node)
    return out


def descend(nodes: DataFrame, group: list[str], above: DataFrame, schema: str, carry: list[str]) -> DataFrame:
    """The path of every node, its block's path of the forest above included.

    above: group, pos (the block), path and the columns ``carry``, one row per block.  If
    nodes have a column ``changed``, its non-null values are put in place as versions.
    """
    C.ship_package()
    names = [f.split(" ")[0] for f in schema.split(", ")]
    path_type = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))

    def run(block: pa.Table, upper: pa.Table) -> pa.Table:
        block = block.sort_by("pos")
        rest = [(s["left"], s["right"]) for s in upper.column("path")[0].as_py()]
        levels = block_levels(block.column("hash").to_pylist(), block.column("n")[0].as_py())
        paths = [base_path(levels, i) + rest for i in range(block.num_rows)]
        have = {"path": pa.array([[{"left": a, "right": b} for a, b in p] for p in paths], path_type)}
        if "copied" in names:
            have["copied"] = pa.array([None if c is None else copy_path(c, p) for c, p in zip(block.column("changed").to_pylist(), paths, strict=True)], pa.list_(pa.string()))
        for c in carry:
            have[c] = pa.array([upper.column(c)[0].as_py()] * block.num_rows, pa.string())
        return pa.table({c: have[c] if c in have else block.column(c) for c in names})

    left = nodes.withColumn("block", F.floor(F.col("pos") / BLOCK).cast("bigint"))
    right = above.withColumn("block", F.col("pos"))
    return left.groupBy(*group, "block").cogroup(right.groupBy(*group, "block")).applyInArrow(run, schema)


def manifest(docs: DataFrame, changes=lowered, changed=marked, group_col: str = "lang", id_col: str = "doc_id", fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """One row per row of docs: doc_id, lang, pos, n, leaf, subroot, root, path, changed, copied.

    ``changes(name, column)`` is the tampered form of a field, ``changed(id)`` the rows it is
    applied to; ``changed`` is then the new leaf and ``copied`` the version's new nodes, the
    last of them its root (none if the tree is a single leaf).  Both are null in other rows.
    """
    kept, other = [F.col(f) for f in fields], [changes(f, F.col(f)) for f in fields]
    leaves = C.materialise(docs.select(F.col(group_col).alias("lang"), F.col(id_col).alias("doc_id"), leaf_hash(*kept).alias("hash"),
                                       F.when(changed(F.col(id_col)), leaf_hash(*other)).alias("changed"), F.monotonically_increasing_id().alias("tie")), "leaves")
    lower = forests(C.materialise(C.numbered(leaves, ["lang"], ["doc_id", "hash", "tie"]).drop("tie"), "numbered"), ["lang"])
    upper = forests(C.materialise(C.numbered(lower[-1].select("lang", "hash"), [], ["lang"]), "subroots"), [])
    root = upper[-1].select("hash").first()
    root = F.lit(root[0] if root else None).cast("string")

    way = upper[-1].select("pos", F.array().cast(PATH).alias("path"))
    for i, nodes in enumerate(reversed(upper[:-1])):
        last = i == len(upper) - 2
        names = f"pos bigint, path {PATH}" + (", lang string, hash string" if last else "")
        way = descend(nodes, [], way, names, [])
    if len(upper) == 1:          # one group: its subroot is the root
        way = upper[0].select("pos", F.array().cast(PATH).alias("path"), "lang", "hash")
    way = way.select("lang", F.lit(0).cast("bigint").alias("pos"), "path", F.col("hash").alias("subroot"))
    for nodes in reversed(lower[1:-1]):
        way = C.materialise(descend(nodes, ["lang"], way, f"lang string, pos bigint, path {PATH}, subroot string", ["subroot"]), "paths")
    kind = leaves.schema["doc_id"].dataType.simpleString()
    schema = f"lang string, doc_id {kind}, pos bigint, n bigint, hash string, changed string, path {PATH}, copied array<string>, subroot string"
    found = descend(lower[0], ["lang"], way, schema, ["subroot"])
    return found.select("doc_id", "lang", "pos", "n", F.col("hash").alias("leaf"), "subroot", root.alias("root"), "path", "changed", "copied")


def proof_text(path: Column) -> Column:
    """The siblings of a leaf, level by level, left to right."""
    return F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), "")


def digests(found: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of a manifest."""
    fold = F.aggregate("path", F.col("leaf"), lambda h, p: F.sha2(F.concat(p["left"], h, p["right"]), 256))
    folded = F.when(F.col("changed").isNotNull(), F.coalesce(F.try_element_at("copied", F.lit(-1)), "changed")).otherwise(fold)
    out = found.select("doc_id", "leaf", "subroot", "root", F.sha2(proof_text(F.col("path")), 256).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
