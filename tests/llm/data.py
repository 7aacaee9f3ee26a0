"""Small inputs for the operators' tests."""

from __future__ import annotations

import random

SF = "/root/testdata/sf0.001"

PROSE = ("the quick brown fox jumps over a lazy dog while seven wizards quietly box up the vexing jam "
         "and nobody in this old town remembers why the clock on the tower always stops at noon")


def words(seed: int, n: int, vocabulary: int = 500) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghiklmnoprstuvw") for _ in range(3)) + str(r.randrange(vocabulary))[:0] for _ in range(n))


def edge_rows() -> list[tuple]:
    """Nulls, empty and very long texts, repeated rows, ties: (doc_id, text, lang, source)."""
    long = words(7, 60_000)
    return [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", None, "b"), (None, PROSE + " one", "en", "b"),
        (4, PROSE, "en", "a"), (4, PROSE, "en", "a"), (5, PROSE, None, None), (6, long, "en", "a"), (7, "one two", "de", "b"),
        (8, "one two", "de", None), (9, "ünï çödé \U0001f600 " * 3 + PROSE, "de", "b"), (10, "x" * 5000, "en", "c"),
        (None, None, None, None), (11, "mail me at a.b@c.org or +1 (743) 555-3824 or 10.1.2.3 card 4111 1111 1111 1111", "en", "c"),
    ]


SCHEMA = "doc_id bigint, text string, lang string, source string"
#: Extra columns whose names the operators use inside.
CLASH = ("kept", "n_words", "score", "node", "key", "id", "bands", "w", "h", "block", "epoch", "item_id", "n_tokens", "z", "at", "component_id", "seed", "pos", "n", "root")


def edge_docs(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)
    return df.withColumns({c: F.lit(c) for c in CLASH})


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)
