"""Benchmark decontamination by spaced-seed hashing (operator 2); DataFrame functions only.

Rule: a document is contaminated by a benchmark item if, for some alignment of the
two, ``WINDOW`` consecutive item words face document words and at least
``NEED`` of them are equal (up to three substitutions in 13 words).  An item of n = 7 to
12 words is one window with up to ``3 n // 13`` substitutions, one of 3 to 6 words has to
be there as it is; items of one or two words are no evidence and are not searched.  Words
are lower-cased (A-Z) runs without white space.

Search: fixed masks read some word positions and ignore the others, three of five words
for long items, two of four words for those of 7 to 12, one of three in a row for shorter
ones.  They are lossless for this rule: wherever the allowed substitutions lie, one mask
fits between them (checked by enumeration in the tests).  Hashes of all masked places of the
documents are joined to those of the items; only masks that some item needs are hashed.
The item hashes are broadcast in blocks of at most ``BLOCK_ROWS`` rows, counted
beforehand, so no join shuffles the documents and no broadcast grows beyond that
bound.  Hits become distinct (document, item, alignment) rows.  A document's alignments meet
its text once: it is split into words once, and each alignment gets the slice that faces
its item, on which it is verified word by word.

Defined results: null or empty texts and items match nothing; rows with a null
id are never reported.  Repeated rows of a document or an item give
the same one row.  Either table may be empty.  Only the id and text columns are
read, whatever others are called.  A very long text costs its words once and each of its
alignments the item's length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landstage.llm.common import materialise

WINDOW = 13
NEED = 10
BLOCK_ROWS = 1_000_000

SHORTEST = 3
EXACT = 6               # items of so many words have to be there as they are

# Word positions that each mask reads, and the lengths of the items it is for.
MASKS = (((0, 1, 2, 4, 5), WINDOW, None), ((0, 1, 3, 4, 5), WINDOW, None), ((0, 1, 6, 8, 9), WINDOW, None),
         ((0, 1, 3, 4), EXACT + 1, WINDOW - 1), ((0, 1, 5, 6), EXACT + 1, WINDOW - 1), ((0, 1, 2), SHORTEST, EXACT))

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def word_array(text: Column) -> Column:
    """Lower-cased words of a text; empty for null."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower()), r"[\x20\x09-\x0D]+")
    return F.filter(parts, lambda w: w != "")


def allowed(n: int) -> int:
    """Substitutions that a window of n item words may have."""
    return 0 if n <= EXACT else (WINDOW - NEED) * min(n, WINDOW) // WINDOW


def seeds(df: DataFrame, key: str, text: str, masks: list[int], of_items: bool = False) -> DataFrame:
    """(id, n, mask, pos, seed): the hash of every place of the masks on every text of n words.

    Items have only the masks for their length.
    """
    hashed = df.select(F.col(key).alias("id"), F.transform(word_array(F.col(text)), lambda w: F.xxhash64(w)).alias("h")).withColumn("n", F.size("h"))
    empty = F.array().cast("array<bigint>")

    def places(number: int) -> Column:
        mask, least, most = MASKS[number]
        last = F.col("n") - F.lit(mask[-1] + 1)
        fits = (F.col("n") >= least) & (F.lit(True) if most is None else F.col("n") <= most) if of_items else last >= 0
        return F.when(fits, F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.lit(number), *(F.get("h", i + F.lit(o)) for o in mask)))).otherwise(empty)

    masked = hashed.select("id", "n", F.explode(F.array(*(F.struct(F.lit(k).alias("mask"), places(k).alias("places")) for k in masks))).alias("m"))
    return masked.select("id", "n", "m.mask", F.posexplode("m.places").alias("pos", "seed"))


def alignments(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Distinct (doc_id, item_id, n, shift) that share a masked place; docs (doc_id, text), items (item_id, text)."""
    item_seeds = materialise(seeds(items.where("item_id is not null"), "item_id", "text", list(range(len(MASKS))), of_items=True).distinct(), "item-seeds")
    used = [r["mask"] for r in item_seeds.select("mask").distinct().orderBy("mask").collect()] or [0]       # some of the six
    blocks = max(1, -(-item_seeds.count() // BLOCK_ROWS))
    doc_seeds = seeds(docs.where("doc_id is not null"), "doc_id", "text", used).select(F.col("id").alias("doc_id"), F.col("pos").alias("at"), "seed")
    item_seeds = item_seeds.select(F.col("id").alias("item_id"), "n", "pos", "seed")
    found = None
    for block in range(blocks):
        part = item_seeds if blocks == 1 else item_seeds.where(F.pmod(F.col("seed"), F.lit(blocks)) == block)
        hits = doc_seeds.join(F.broadcast(part), "seed").select("doc_id", "item_id", "n", (F.col("at") - F.col("pos")).alias("shift")).distinct()
        found = hits if found is None else found.union(hits)
    return found if blocks == 1 else found.distinct()


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, n_alignments, first_shift, best_matches), one row per contaminated pair.

    ``first_shift`` is the document word that faces the item's first word at the earliest
    passing alignment (negative if the item begins before the document);
    ``best_matches`` the most equal words in a window.
    """
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text"))
    # a written table: Spark knows its size, and shuffles the texts only if it is too large to broadcast
    mine = materialise(alignments(d, items).groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "n", "shift")).alias("hits")), "alignments")
    # a generator, and not a projection: the words are made once and not again in each alignment's slice
    texts = mine.join(d, "doc_id").select("doc_id", "hits", F.explode(F.array(word_array(F.col("text")))).alias("w"))
    missing = lambda x: F.greatest(-x["shift"], F.lit(0))  # noqa: E731  item words before the document's first
    face = F.transform("hits", lambda x: F.struct(x["item_id"].alias("item_id"), x["n"].alias("n"), x["shift"].alias("shift"),
                                                  F.slice("w", F.greatest(x["shift"], F.lit(0)) + 1, x["n"] - missing(x)).alias("face")))
    faces = texts.select("doc_id", F.explode(face).alias("x")).select("doc_id", "x.*")
    known = items.select("item_id", word_array(F.col("text")).alias("v")).withColumn("n", F.size("v")).distinct()
    pairs = faces.join(known, ["item_id", "n"])
    span = F.least(F.lit(WINDOW), F.col("n"))
    need = span - F.when(F.col("n") <= EXACT, 0).otherwise(F.floor((WINDOW - NEED) * span / WINDOW).cast("int"))
    before = F.greatest(-F.col("shift"), F.lit(0))
    equal = F.transform("v", lambda word, j: F.when((j >= before) & (F.get("face", F.greatest(j - before, F.lit(0))) == word), 1).otherwise(0))
    windows = F.transform(F.sequence(F.lit(0), F.col("n") - F.col("span")), lambda k: F.aggregate(F.slice("equal", k + 1, F.col("span")), F.lit(0), lambda a, x: a + x))
    # a generator again: which words are equal is made once, not in every window
    checked = (pairs.withColumn("span", span).withColumn("need", need).withColumn("equal", F.explode(F.array(equal)))
               .withColumn("best", F.array_max(windows)).where("best >= need"))
    return (checked.select("doc_id", "item_id", "shift", "best").distinct().groupBy("doc_id", "item_id")
            .agg(F.countDistinct("shift").alias("n_alignments"), F.min("shift").cast("bigint").alias("first_shift"), F.max("best").cast("bigint").alias("best_matches")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **columns: str) -> DataFrame:
    """The documents that no benchmark item contaminates, with all their columns; null ids stay."""
    found = materialise(overlaps(docs, benchmark, id_col, text_col, **columns).select("doc_id").distinct(), "contaminated")
    return docs.join(found, docs[id_col] == found["doc_id"], "left_anti")
