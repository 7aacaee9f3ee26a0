"""Quality classifier: histogram gradient-boosted trees over document statistics (operator 4).

Every text becomes about twenty statistics (lengths, shares of character classes,
repetition, lines).  Trees are grown level by level on histograms: each statistic is
cut into at most ``BINS`` bins at its quantiles, the gradients of the logistic loss
are summed per (node, statistic, bin), and the cut with the largest gain splits the
node.  The trees are full binary heaps stored as flat arrays (statistic, cut, leaf
value); a batch walks all trees at once with ``DEPTH`` array look-ups.

Training uses at most ``SAMPLE`` labelled documents, those with the smallest hash of
the id among the rows that may be learned from; the statistics are computed on the
executors and only their rows reach the driver.  Scoring covers whole texts of all
rows in one pass without a shuffle.

Defined results: null and empty texts have statistics of zero and get a score like any
other.  Rows with a null id are scored, never learned from, and count as held out.
Rows with a null label are not learned from; repeated rows count as often as they occur.
Without any label every score is 0.5 (predicted 1).  An empty table gives an empty table.
Only the id, text and label columns are read, whatever others are called.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landstage.llm import common as C
from landstage.llm.repetition import base_counts

SAMPLE = 20_000
BINS = 64
DEPTH = 4
TREES = 120
RATE = 0.1
LAMBDA = 1.0
LEAST = 8.0             # documents' weight (hessian times four) on each side of a cut

STATS = ("log_words", "word_length", "symbols", "digits", "upper", "punctuation", "spaces", "newlines", "other", "bang",
         "dup_lines", "repeat_words", "line_words", "distinct", "longest_word", "short_words", "symbol_ends", "line_ends", "upper_words", "sentence_words")


def _class(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


_DIGIT, _UPPER, _PUNCT, _BAR, _BANG, _STOP = (_class(c) for c in ("0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ".,;:!?'\"()-", "#*$%&|<>", "!", ".!?"))


def statistics(t: C.Texts) -> np.ndarray:
    """(texts, STATS) of a chunk."""
    n = len(t.start)
    if not len(t.buf):
        return np.zeros((n, len(STATS)))
    base = base_counts(t)
    w = C.words(t)
    size = np.maximum(t.end - t.start, 1)
    words = np.maximum(base["n_words"], 1)

    def share(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
        return (total[t.end] - total[t.start]) / size

    def per_word(value: np.ndarray) -> np.ndarray:
        return np.bincount(w.doc, weights=value, minlength=n) / words

    length = (w.end - w.start).astype(np.float64)
    longest = np.zeros(n)
    np.maximum.at(longest, w.doc, length)
    h = C.range_hash(C.prefix_hash(t.buf), w.start, w.end)
    o = C.by_doc_then(h, w.doc)
    new = np.ones(len(o), bool)
    new[1:] = (h[o][1:] != h[o][:-1]) | (w.doc[o][1:] != w.doc[o][:-1])
    lines = share(t.buf == 10) * size + 1
    last = t.buf[w.end - 1] if len(w.end) else t.buf[:0]
    upper = np.concatenate(([0], np.cumsum(_UPPER[t.buf])))
    letters = upper[w.end] - upper[w.start] if len(w.end) else length
    cut = np.flatnonzero(t.buf == 10)
    cut = cut[cut > 0]
    ends = np.bincount(np.searchsorted(t.start, cut, side="right") - 1, weights=_STOP[t.buf[cut - 1]].astype(float), minlength=n) / lines
    stops = per_word(_STOP[last].astype(float))
    return np.column_stack([
        np.log1p(base["n_words"]), per_word(length), share(_BAR[t.buf]), share(_DIGIT[t.buf]), share(_UPPER[t.buf]), share(_PUNCT[t.buf]),
        share(C.IS_SPACE[t.buf]), share(t.buf == 10), share(t.buf >= 128), share(_BANG[t.buf]),
        base["n_dup_lines"] / lines, base["n_repeat_words"] / words, base["n_words"] / lines, np.bincount(w.doc[o][new], minlength=n) / words,
        longest, per_word((length <= 2).astype(float)), per_word(_BAR[last].astype(float)), ends, per_word((letters >= 2).astype(float)), 1 / np.maximum(stops, 1e-3)])


class Trees(NamedTuple):
    stat: np.ndarray        # (trees, inner nodes), heap order
    cut: np.ndarray         # go right where the statistic is above
    leaf: np.ndarray        # (trees, leaves)
    start: float


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Boosted trees for labels 0 and 1; deterministic."""
    inner, leaves = 2 ** depth - 1, 2 ** depth
    if not len(y):
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)), 0.0)
    n, n_stats = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(n_stats)]
    binned = np.column_stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)])
    cuts = np.full((n_stats, BINS), np.inf)
    for j, e in enumerate(edges):
        cuts[j, :len(e)] = e
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    score = np.full(n, start)
    stat, cut, leaf = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves))
    flat = binned + np.arange(n_stats) * BINS
    for k in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            width = 2 ** level
            at = (node[:, None] * (n_stats * BINS) + flat).ravel()
            sums = [np.bincount(at, weights=np.repeat(v, n_stats), minlength=width * n_stats * BINS).reshape(width, n_stats, BINS).cumsum(axis=2) for v in (g, h)]
            (gl, hl), (gt, ht) = sums, (s[:, :1, -1:] for s in sums)
            gain = gl ** 2 / (hl + LAMBDA) + (gt - gl) ** 2 / (ht - hl + LAMBDA) - gt ** 2 / (ht + LAMBDA)
            gain[(4 * hl < LEAST) | (4 * (ht - hl) < LEAST) | ~np.isfinite(cuts)[None]] = 0
            best = gain.reshape(width, -1).argmax(axis=1)
            good = gain.reshape(width, -1)[np.arange(width), best] > 1e-9
            s, b = best // BINS, best % BINS
            heap = slice(width - 1, 2 * width - 1)
            stat[k, heap], cut[k, heap] = s, np.where(good, cuts[s, b], np.inf)
            right = good[node] & (binned[np.arange(n), s[node]] > b[node])
            node = 2 * node + right
        gs, hs = np.bincount(node, weights=g, minlength=leaves), np.bincount(node, weights=h, minlength=leaves)
        leaf[k] = RATE * gs / (hs + LAMBDA)
        score += leaf[k][node]
    return Trees(stat, cut, leaf, start)


def scores(model: Trees, x: np.ndarray) -> np.ndarray:
    """Probability of label 1, walking all trees at once in slices of rows."""
    out = np.empty(len(x))
    depth = int(model.leaf.shape[1]).bit_length() - 1
    tree = np.arange(len(model.leaf))
    for a in range(0, len(x), 2048):
        part = x[a:a + 2048]
        row = np.arange(len(part))[:, None]
        node = np.zeros((len(part), len(tree)), np.int64)
        for _ in range(depth):
            node = 2 * node + 1 + (part[row, model.stat[tree, node]] > model.cut[tree, node])
        out[a:a + 2048] = model.leaf[tree, node - (2 ** depth - 1)].sum(axis=1) + model.start
    return 1 / (1 + np.exp(-out))


def with_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the statistics of (doc_id, text) rows."""
    C.ship_package()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.chunks(batch):
                x = statistics(C.flat(part.column(1)))
                rows = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32()), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), rows], ["doc_id", "x"])

    return docs.mapInArrow(run, "doc_id bigint, x array<double>")


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(folds)) == fold, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          folds: int = 3, fold: int = 1, sample: int = SAMPLE) -> Trees:
    """Trees from at most ``sample`` labelled rows outside the held-out fold."""
    marked = labels.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("y is not null").where(~held_out(F.col("doc_id"), folds, fold))
    some = C.sampled(marked, "doc_id", sample, marked.count())
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    ids = F.broadcast(some.select("doc_id").distinct())         # at most ``sample`` rows
    x = with_statistics(texts.join(ids, "doc_id", "left_semi"))
    rows = x.join(F.broadcast(some), "doc_id").orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id", "y").limit(sample).toPandas()
    if not len(rows):
        return fit(np.zeros((0, len(STATS))), np.zeros(0))
    return fit(np.stack(rows["x"].to_numpy()), (rows["y"].to_numpy() == 1).astype(np.float64))


def classify(docs: DataFrame, model: Trees, id_col: str = "doc_id", text_col: str = "text", folds: int = 3, fold: int = 1) -> DataFrame:
    """doc_id, held_out, score, predicted, one row per document."""
    C.ship_package()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.chunks(batch):
                p = scores(model, statistics(C.flat(part.column(1))))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                                                 ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).withColumn("held_out", held_out(F.col("doc_id"), folds, fold))
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")
