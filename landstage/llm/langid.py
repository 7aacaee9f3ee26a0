"""Language identification by nearest centroids (operator 6).

A text is a vector of its byte 1-, 2- and 3-grams (letters in lower case, every run
of other ASCII characters one byte), hashed to ``DIMS`` places, with damped counts times the inverse
document frequency, scaled to length one.  Every language has up to ``CLUSTERS``
centroids, from spherical k-means over its sample.  A text gets the language of the
centroid with the largest cosine.  A text farther from that centroid than nearly
all (``KEEP``) of the centroid's own sample is marked ``rejected``: its prediction stays
the nearest language, as the caller may prefer it to none.

Document frequencies are counted over all documents that may be learned from.
More than ``MAX_LANGS`` languages raise an error.  The centroids come from at most ``SAMPLE`` texts per language (the smallest hashes of the
id among the texts with a letter, of any length): whole texts become gram counts on the
executors, and each language is fitted there from its sample's counts.  Scoring covers whole texts of all
rows in one pass without a shuffle.

Defined results: null texts and texts without a letter are ``und`` with score 0.  Rows
with a null id are scored, never learned from, and count as held out; rows with a null
language are not learned from.  Repeated rows count as often as they occur.  Ties go to
the language that sorts first.  Without any labelled text every
prediction is ``und``.  An empty table gives an empty table.  Only the id, text and language
columns are read, whatever others are called.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from landstage.llm import common as C
from landstage.llm.quality import held_out

DIMS = 4096
CLUSTERS = 4
SAMPLE = 500            # texts per language
MAX_LANGS = 10_000      # so the broadcast counts of languages and the centroids stay small
KEEP = 0.995
ROWS = 256              # texts whose vectors are held at a time

# letters in lower case, other ASCII characters as one kind of gap, bytes of longer characters as they are
_FOLD = np.full(256, 32, np.uint8)
_FOLD[65:91] = C.LOWER[65:91]
_FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def grams(t: C.Texts) -> np.ndarray:
    """(texts, DIMS) counts of hashed 1-, 2- and 3-grams of bytes."""
    n = len(t.start)
    out = np.zeros(n * DIMS)
    if not len(t.buf):
        return out.reshape(n, DIMS)
    b = _FOLD[t.buf]
    capital = np.flatnonzero((b[:-1] == 0xC3) & (b[1:] >= 0x80) & (b[1:] <= 0x9E) & (b[1:] != 0x97)) + 1
    b[capital] += 0x20                                                  # capitals with accents
    gap = b == 32
    keep = np.ones(len(b), bool)
    keep[1:] = ~(gap[1:] & gap[:-1])                                    # one byte for each gap
    keep[t.end] = True
    at = np.cumsum(keep) - 1
    end = at[t.end]
    b = b[keep].astype(np.uint32)
    size_of = end - np.concatenate(([0], end[:-1] + 1)) + 1
    doc = np.repeat(np.arange(n, dtype=np.int64) * DIMS, size_of)
    left = np.repeat(end, size_of) - np.arange(len(b))                  # bytes up to the separator
    key = np.zeros(len(b), np.uint32)
    for size in (1, 2, 3):
        key = key[:len(b) - size + 1] * np.uint32(256) + b[size - 1:]
        place = ((key + np.uint32(size << 24)) * np.uint32(2654435761)) >> np.uint32(20)
        inside = left[:len(key)] >= size
        out += np.bincount(doc[:len(key)][inside] + place[inside], minlength=n * DIMS)
    return out.reshape(n, DIMS)


def has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


class Model(NamedTuple):
    langs: list[str]        # of every centroid
    centroid: np.ndarray    # (centroids, DIMS)
    limit: np.ndarray       # smallest cosine that is not rejected
    idf: np.ndarray


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts) * idf
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def clustered(v: np.ndarray, k: int = CLUSTERS, rounds: int = 12) -> np.ndarray:
    """Centroids by spherical k-means; starts at the texts farthest from those chosen before."""
    k = min(k, len(v))
    mean = v.mean(axis=0)
    chosen = [int((v @ mean).argmax())]
    near = v @ v[chosen[0]]
    for _ in range(k - 1):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, v @ v[chosen[-1]])
    c = v[chosen]
    for _ in range(rounds):
        own = (v @ c.T).argmax(axis=1)
        c = np.stack([v[own == i].mean(axis=0) if (own == i).any() else c[i] for i in range(k)])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def document_frequency(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Number of (text) rows and, per place, of rows that have it; one row per task, then a sum."""
    C.ship_package()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(DIMS, np.int64), 0
        for batch in batches:
            for part in C.chunks(batch):
                for a in range(0, part.num_rows, ROWS):
                    some = part.slice(a, ROWS)
                    total += (grams(C.flat(some.column(0))) > 0).sum(axis=0)
                    rows += some.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.append(np.arange(DIMS), -1)), pa.array(np.append(total, rows))], ["place", "n"])

    got = docs.mapInArrow(run, "place bigint, n bigint").groupBy("place").agg(F.sum("n").alias("n")).toPandas().set_index("place")["n"]
    df = got.reindex(range(DIMS), fill_value=0).to_numpy()
    return int(got.get(-1, 0)), df


def with_counts(rows: DataFrame) -> DataFrame:
    """The text replaced by its gram counts: the places that occur (16 bits each) and their counts (32 bits each)."""
    C.ship_package()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.chunks(batch):
                for a in range(0, part.num_rows, ROWS):
                    some = part.slice(a, ROWS)
                    counts = grams(C.flat(some.column(4)))
                    places = [np.flatnonzero(x) for x in counts]
                    yield pa.RecordBatch.from_arrays([*some.columns[:4], pa.array([p.astype(np.uint16).tobytes() for p in places], pa.binary()), pa.array([x[p].astype(np.uint32).tobytes() for p, x in zip(places, counts, strict=True)], pa.binary())],
                                                     ["doc_id", "lang", "order", "tie", "places", "counts"])

    return rows.mapInArrow(run, "doc_id bigint, lang string, order bigint, tie bigint, places binary, counts binary")


def centroids_of(table: pa.Table, idf: np.ndarray) -> pa.Table:
    """The centroids of one language's sample and the smallest cosine each does not reject."""
    table = table.sort_by([("doc_id", "ascending"), ("tie", "ascending")])
    counts = np.zeros((table.num_rows, DIMS))
    for row, p, n in zip(counts, table.column("places").to_pylist(), table.column("counts").to_pylist(), strict=True):
        row[np.frombuffer(p, np.uint16)] = np.frombuffer(n, np.uint32)
    v = vectors(counts, idf)
    c = clustered(v)
    cos = v @ c.T
    own = cos.argmax(axis=1)
    edge = [float(np.quantile(cos[own == i, i], 1 - KEEP)) if (own == i).any() else 0.0 for i in range(len(c))]
    return pa.table({"lang": table.column("lang").slice(0, 1).to_pylist() * len(c), "i": pa.array(range(len(c)), pa.int32()), "centroid": pa.array([x.tobytes() for x in c], pa.binary()), "edge": edge})


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 4, fold: int = 2, sample: int = SAMPLE) -> Model:
    """Centroids from the labelled rows outside the held-out fold."""
    known = (docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
             .where("text is not null and lang is not null").where(~held_out(F.col("doc_id"), folds, fold)))
    n, df = document_frequency(known.select("text"))
    idf = np.log((1 + n) / (1 + df)) + 1
    # a first cut at a hash that about 4 * sample rows of each language pass, then the smallest hashes
    order = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 40))
    known = known.where(F.col("text").rlike(r"\p{L}"))
    marks = C.materialise(known.select("doc_id", "lang", order.alias("order")), "learnable")
    share = marks.groupBy(F.col("lang").alias("cut_lang")).agg((F.lit(4.0 * sample * (1 << 40)) / F.count("*")).alias("cut"))
    share = C.materialise(share, "languages")
    if share.count() > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    some = marks.join(F.broadcast(share), F.col("lang") == F.col("cut_lang")).where("order <= cut")
    first = Window.partitionBy("lang").orderBy("order", "doc_id")
    picked = some.select("doc_id", "lang", F.row_number().over(first).alias("k")).where(F.col("k") <= sample)
    ids = F.broadcast(picked.select("doc_id", "lang").distinct())   # at most ``sample`` rows per language
    rows = known.join(ids, ["doc_id", "lang"], "left_semi").select("doc_id", "lang", order.alias("order"), F.xxhash64("text").alias("tie"), "text")
    first = Window.partitionBy("lang").orderBy("order", "doc_id", "tie")
    rows = with_counts(rows).withColumn("k", F.row_number().over(first)).where(F.col("k") <= sample)
    found = rows.groupBy("lang").applyInArrow(lambda table: centroids_of(table, idf), "lang string, i int, centroid binary, edge double").toPandas()
    found = found.sort_values(["lang", "i"])
    centers = [np.frombuffer(x) for x in found["centroid"]]
    return Model(found["lang"].tolist(), np.stack(centers) if centers else np.zeros((0, DIMS)), found["edge"].to_numpy(np.float64), idf)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", folds: int = 4, fold: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score (cosine) and rejected, one row per document."""
    C.ship_package()
    model = model._replace(centroid=model.centroid.astype(np.float32), idf=model.idf.astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in C.chunks(batch):
                for a in range(0, chunk.num_rows, ROWS):
                    part = chunk.slice(a, ROWS)
                    letters = np.array([has_letter(x) for x in part.column(1).to_pylist()], bool) & (len(model.langs) > 0)
                    if len(model.langs):
                        cos = vectors(grams(C.flat(part.column(1))).astype(np.float32), model.idf) @ model.centroid.T
                        own = cos.argmax(axis=1)
                        best = cos[np.arange(len(own)), own]
                        lang = [model.langs[i] if ok else "und" for i, ok in zip(own, letters, strict=True)]
                        far = best < model.limit[own]
                    else:
                        lang, best, far = ["und"] * part.num_rows, np.zeros(part.num_rows), np.zeros(part.num_rows, bool)
                    score = np.where(letters, np.clip(best, 0, 1), 0).astype(np.float64)
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(lang, pa.string()), pa.array(score), pa.array(far | ~letters)],
                                                     ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).withColumn("held_out", held_out(F.col("doc_id"), folds, fold))
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double, rejected boolean")
