"""Language-model scores by stupid backoff, computed relationally (operator 10).

A word w after u scores log10(c(uw) / c(u)) if the pair occurs at least twice in the
corpus, else log10(BACKOFF * c(w) / N); a document's first word scores
log10(c(w) / N).  The scores are summed per document.  All counts are over all documents.

Counts are tables partitioned by hash, and documents' n-grams are joined to them:

1. Frequent n-grams.  A word or pair with a share of at least ``SHARE`` has at least half
   that share in some batch, so the batches' own frequent n-grams contain all frequent
   ones; what remains of them after summing is at most 2 / SHARE words and as many
   pairs.  This bounded table is counted exactly and broadcast.
2. Pairs.  Frequent pairs are scored where they are read.  Other pairs go to the bucket of
   their first word, or, if that word is frequent, of the pair.  So no word or
   pair sends more than a share of ``SHARE`` to one bucket.  A batch sends each pair once,
   with its documents, and buckets hold everything needed to count c(uw) and c(u).
3. Words.  Pairs seen once ask the bucket of their second word for c(w).
4. The buckets' partial sums are unpacked there and added per document.

The exchanges carry packed arrays, one row per batch and bucket; the number of buckets
grows with the corpus (``BUCKET_WORDS``) and is at least ``spark.sql.shuffle.partitions``.  Words are named by 56-bit fingerprints.

Defined results: words are lower-cased (A-Z) runs without white space.  A text without words (null,
empty) has n_words 0 and null scores.  The rows of one id (null ids too) are scored
together as one document, one row per id.  An empty table gives an empty table.  Only the id and text
columns are read, whatever others are called.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landstage.llm import common as C

BACKOFF = 0.4
SEEN = 2                # least count of a pair that is used
SHARE = 2e-5
BATCH_WORDS = 500_000
BATCH_DOCS = 60_000
PART_BYTES = 1_000_000   # packed bytes that a bucket unpacks at a time
BUCKETS = 64            # at least
BUCKET_WORDS = 1_000_000  # words of the corpus for each bucket

_NO_ID = np.iinfo(np.int64).min
_PAIR = np.uint64(0x9FB21C651E98DF25)
U64 = np.uint64
PACKED = "bucket int, kind string, docs binary, a binary, b binary, c binary, d binary, e binary, f binary"
FIELDS = ("docs", "a", "b", "c", "d", "e", "f")


def pair_hash(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    return C.mix(h1 * _PAIR + h2)


def batches_of_words(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, word hashes, document index of each word) for batches of whole documents of about BATCH_WORDS words, at most BATCH_DOCS documents."""
    ids, hashes, docs, n_docs, n_words = [], [], [], 0, 0
    for batch in batches:
        for part in C.chunks(batch, most=250_000):
            t = C.flat(part.column(1))
            t = t._replace(buf=C.LOWER[t.buf])
            w = C.words(t)
            if n_words and n_words + len(w.start) > BATCH_WORDS or n_docs and n_docs + part.num_rows > BATCH_DOCS:
                yield np.concatenate(ids), np.concatenate(hashes), np.concatenate(docs)
                ids, hashes, docs, n_docs, n_words = [], [], [], 0, 0
            ids.append(part.column(0).fill_null(_NO_ID).to_numpy())
            # 56 bits name a word; 0 is free for the end of a text
            hashes.append(np.maximum(C.range_hash(C.prefix_hash(t.buf), w.start, w.end) >> U64(8), U64(1)))
            docs.append(w.doc + n_docs)
            n_docs, n_words = n_docs + part.num_rows, n_words + len(w.start)
    if n_docs:
        yield np.concatenate(ids), np.concatenate(hashes), np.concatenate(docs)


def followers(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The hash of the next word of the same text, 0 after the last."""
    nxt = np.zeros(len(h), U64)
    if len(h):
        nxt[:-1] = np.where(doc[1:] == doc[:-1], h[1:], U64(0))
    return nxt


class Frequent:
    """Sorted hashes of frequent words and pairs with their counts, and the number of words."""

    def __init__(self, total: int, words: np.ndarray, pairs: np.ndarray, word_count: np.ndarray | None = None, pair_count: np.ndarray | None = None) -> None:
        self.total, self.words, self.pairs, self.word_count, self.pair_count = total, words, pairs, word_count, pair_count

    @staticmethod
    def find(table: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each hash in the table, and whether it is there."""
        if not len(table):
            return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
        at = np.minimum(np.searchsorted(table, h), len(table) - 1)
        return at, table[at] == h


def frequent(docs: DataFrame, share: float = SHARE) -> Frequent:
    """Exact counts of a superset of all n-grams with that share; at most 2 / share words and as many pairs."""
    C.ship_package()

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, h, doc in batches_of_words(batches):
            nxt = followers(h, doc)
            inner = nxt != 0
            kinds, names, counts = [0], [np.zeros(1, U64)], [np.array([len(h)])]
            for kind, value in ((1, h), (2, pair_hash(h[inner], nxt[inner]))):
                name, count = np.unique(value, return_counts=True)
                often = count >= share / 2 * len(h)
                kinds.append(kind)
                names.append(name[often])
                counts.append(count[often])
            sizes = [len(x) for x in names]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(kinds, sizes).astype(np.int32)), pa.array(np.concatenate(names).view(np.int64)), pa.array(np.concatenate(counts).astype(np.int64))], ["kind", "h", "n"])

    schema = "kind int, h bigint, n bigint"
    summed = C.materialise(docs.mapInArrow(local, schema).groupBy("kind", "h").agg(F.sum("n").alias("n")), "frequent")
    total = int(sum(r["n"] for r in summed.where("kind = 0").collect()))
    often = summed.where((F.col("kind") > 0) & (F.col("n") >= share / 2 * total)).toPandas()
    tables = [np.sort(often.loc[often["kind"] == k, "h"].to_numpy(np.int64).view(U64)) for k in (1, 2)]

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(len(t), np.int64) for t in tables]
        for _, h, doc in batches_of_words(batches):
            nxt = followers(h, doc)
            inner = nxt != 0
            for table, total_, value in zip(tables, sums, (h, pair_hash(h[inner], nxt[inner])), strict=True):
                at, has = Frequent.find(table, value)
                total_ += np.bincount(at[has], minlength=len(table))
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat([1, 2], [len(t) for t in tables]).astype(np.int32)), pa.array(np.concatenate([np.arange(len(t)) for t in tables])), pa.array(np.concatenate(sums))], ["kind", "h", "n"])

    counts = [np.zeros(len(t), np.int64) for t in tables]
    for r in docs.mapInArrow(exact, schema).groupBy("kind", "h").agg(F.sum("n").alias("n")).toPandas().itertuples():
        counts[r.kind - 1][r.h] = r.n
    return Frequent(total, *tables, *counts)


def _small(x: np.ndarray) -> bytes:
    """Counts or steps as bytes, in the narrowest of four widths; the first byte is the width."""
    top = int(x.max()) if len(x) else 0
    width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
    return bytes([width]) + x.astype(f"u{width}").tobytes()


def _wide(b: bytes) -> np.ndarray:
    return np.frombuffer(b, f"u{b[0]}", offset=1).astype(np.int64)


def _ids(x: np.ndarray) -> bytes:
    """Ascending ids: the first and the steps between them."""
    return x[:1].tobytes() + _small((x[1:] - x[:-1]).view(np.uint64)) if len(x) else b""


def _from_ids(b: bytes) -> np.ndarray:
    if not b:
        return np.zeros(0, np.int64)
    return np.cumsum(np.append(np.frombuffer(b[:8], np.int64), _wide(b[8:])))


def _names(h: np.ndarray) -> bytes:
    """Seven bytes of each word's name."""
    return np.ascontiguousarray(h).view(np.uint8).reshape(-1, 8)[:, :7].tobytes()


def _from_names(b: bytes) -> np.ndarray:
    out = np.zeros((len(b) // 7, 8), np.uint8)
    out[:, :7] = np.frombuffer(b, np.uint8).reshape(-1, 7)
    return out.view(U64).ravel()


def _part(ids: np.ndarray, n: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n), pa.array(sums)], ["doc_id", "n", "s"])


def _cells(column: pa.Array | pa.ChunkedArray) -> list[pa.Buffer]:
    """The packed arrays of a column, where they are: a bucket's are the most that a task holds, so none is copied."""
    out = []
    for part in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        if len(part):
            _, offsets, values = part.buffers()
            at = np.frombuffer(offsets, np.int64 if pa.types.is_large_binary(part.type) else np.int32)[part.offset:part.offset + len(part) + 1].tolist()
            values = pa.py_buffer(b"") if values is None else values
            out += [values[a:b] for a, b in itertools.pairwise(at)]
    return out


def _row(bucket: int, kind: str, *fields: bytes) -> tuple:
    return (bucket, kind, *fields, *(b"" for _ in range(len(FIELDS) - len(fields))))


def _sum(bucket: int, ids: np.ndarray, sums: np.ndarray, words: np.ndarray | None = None) -> tuple:
    """A row of partial sums; ``words``: the documents' words, sent once."""
    o = np.argsort(ids, kind="stable")
    return _row(bucket, "sum", _ids(ids[o]), sums[o].astype(np.float64).tobytes(), b"" if words is None else _small(words[o]))


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.string(), *[pa.binary()] * len(FIELDS)]
    return pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], t) for t in kinds], ["bucket", "kind", *FIELDS])


def _asks(docs: np.ndarray, h: np.ndarray, back: np.ndarray, buckets: int) -> Iterator[tuple]:
    """Rows that ask the bucket of each word for its count; ``back``: 1 where the score is backed off."""
    to = (C.mix(h) % U64(buckets)).astype(np.int64)
    order = np.argsort(docs, kind="stable")
    order = order[np.argsort(to[order], kind="stable")]
    for a, b in C.stretches(to[order]):
        some = order[a:b]
        yield _row(int(to[some[0]]), "ask", _ids(docs[some]), _names(h[some]), _small(back[some]))


def packed_pairs(docs: DataFrame, top: Frequent, buckets: int) -> DataFrame:
    """Rows of pairs for their buckets, asks of first words, and what can be summed at once."""
    C.ship_package()
    shared = docs.sparkSession.sparkContext.broadcast(top)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = shared.value
        for ids, h, doc in batches_of_words(batches):
            nxt = followers(h, doc)
            n_docs, rows = len(ids), []
            order = np.argsort(ids, kind="stable")
            sorted_ids, by_id = ids[order], np.empty(n_docs, np.int64)
            by_id[order] = np.arange(n_docs)
            word_at, often = Frequent.find(f.words, h)
            ph = pair_hash(h, nxt)
            pair_at, known = Frequent.find(f.pairs, ph)
            known &= often & (nxt != 0)
            known[known] = f.pair_count[pair_at[known]] >= SEEN
            sums = np.zeros(n_docs)
            sums += np.bincount(doc[known], weights=np.log10(f.pair_count[pair_at[known]] / f.word_count[word_at[known]]), minlength=n_docs).astype(np.float64)
            first = np.append(True, doc[1:] != doc[:-1]) if len(doc) else np.zeros(0, bool)
            easy = first & often
            sums += np.bincount(doc[easy], weights=np.log10(f.word_count[word_at[easy]] / f.total), minlength=n_docs).astype(np.float64)
            rows.append(_sum(int(C.mix(ids[:1].view(U64))[0] % U64(buckets)), ids, sums, np.bincount(doc, minlength=n_docs)))
            hard = first & ~often
            rows += _asks(ids[doc[hard]], h[hard], np.zeros(int(hard.sum()), bool), buckets)
            rest = ~known & ~(often & (nxt == 0))           # the end of a text only matters for counting its last word
            h1, h2, d = h[rest], nxt[rest], doc[rest].astype(np.uint16 if n_docs <= 1 << 16 else np.int64)
            to = (np.where(often[rest], ph[rest], C.mix(h1)) % U64(buckets)).astype(np.uint16 if buckets < 65536 else np.int64)
            o = np.argsort(h2, kind="stable")
            o = o[np.argsort(h1[o], kind="stable")]
            o = o[np.argsort(to[o], kind="stable")]
            h1, h2, d, to = h1[o], h2[o], d[o], to[o]
            new1 = np.append(True, (h1[1:] != h1[:-1]) | (to[1:] != to[:-1])) if len(o) else np.zeros(0, bool)
            new2 = new1.copy()
            new2[1:] |= h2[1:] != h2[:-1]
            new3 = new2.copy()
            new3[1:] |= d[1:] != d[:-1]
            for a, b in C.stretches(to):
                s1, s2, s3 = (np.flatnonzero(x[a:b]) for x in (new1, new2, new3))
                pairs_of = np.diff(np.append(np.searchsorted(s2, s1), len(s2)))
                posts_of = np.diff(np.append(np.searchsorted(s3, s2), len(s3)))
                times = np.diff(np.append(s3, b - a))
                used, index = np.unique(by_id[d[a:b][s3]], return_inverse=True)
                rows.append(_row(int(to[a]), "pairs", _ids(sorted_ids[used]), _names(h1[a:b][s1]), _small(pairs_of), _names(h2[a:b][s2]), _small(posts_of), _small(index), _small(times)))
            yield _rows(rows)

    return docs.mapInArrow(run, PACKED)


def _added(ids: list[np.ndarray], sums: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not ids:
        return np.zeros(0, np.int64), np.zeros(0)
    name, at = np.unique(np.concatenate(ids), return_inverse=True)
    return name, np.bincount(at, weights=np.concatenate(sums), minlength=len(name)).astype(np.float64)


def counted_pairs(rows: DataFrame, top: Frequent, buckets: int) -> DataFrame:
    """Per bucket: c(uw) and c(u), the sums of the pairs seen often enough, the counts of words, asks for the others.

    Rows of other kinds pass through."""
    shared = rows.sparkSession.sparkContext.broadcast(top)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        f, bucket = shared.value, key[0].as_py()
        kind = np.array(table.column("kind").to_pylist())
        other, mine = table.filter(pa.array(kind != "pairs")), np.flatnonzero(kind == "pairs")
        if not len(mine):
            return other
        cols = {c: _cells(table.column(c)) for c in FIELDS}
        # the bucket's words are counted in parts, so that the unpacked arrays stay small
        parts = 1 + sum(len(cols[c][i]) for c in ("c", "e") for i in mine) // PART_BYTES
        ids, sums, out = [], [], []
        for part in range(parts):
            h1, h2, docs, times, posts = [], [], [], [], []
            for i in mine:
                word, pairs_of, posts_of = _from_names(cols["a"][i]), _wide(cols["b"][i]), _wide(cols["d"][i])
                own = (C.mix(word) >> U64(40)) % U64(parts) == part
                pair = np.repeat(own, pairs_of)
                post = np.repeat(pair, posts_of)
                h1.append(np.repeat(word[own], pairs_of[own]))
                h2.append(_from_names(cols["c"][i])[pair])
                posts.append(posts_of[pair])
                docs.append(_from_ids(cols["docs"][i])[_wide(cols["e"][i])[post]])
                times.append(_wide(cols["f"][i])[post])
            h1, h2, posts, docs, times = (np.concatenate(x) for x in (h1, h2, posts, docs, times))
            if not len(h2):
                continue
            first = np.concatenate(([0], np.cumsum(posts)[:-1]))
            uses = np.add.reduceat(times.astype(np.int64), first)
            o = np.argsort(h2, kind="stable")
            o = o[np.argsort(h1[o], kind="stable")]
            new1 = np.append(True, h1[o][1:] != h1[o][:-1])
            new2 = new1.copy()
            new2[1:] |= h2[o][1:] != h2[o][:-1]
            c2 = np.add.reduceat(uses[o], np.flatnonzero(new2))[np.cumsum(new2) - 1]
            words, c1 = h1[o][new1], np.add.reduceat(uses[o], np.flatnonzero(new1))
            at, often = Frequent.find(f.words, words)
            c1 = np.where(often, f.word_count[at] if len(f.words) else c1, c1)
            value = np.empty(len(o))
            pair_count = np.empty(len(o), np.int64)
            value[o] = np.log10(c2 / c1[np.cumsum(new1) - 1])
            pair_count[o] = c2
            good, real = pair_count >= SEEN, h2 != 0
            per_post = np.repeat(np.arange(len(h2)), posts)
            use = (good & real)[per_post]
            ids.append(docs[use])
            sums.append(value[per_post[use]] * times[use])
            miss = np.flatnonzero((~good & real)[per_post])
            word, who, often_ = h2[per_post[miss]], docs[miss], times[miss]
            at, there = Frequent.find(f.words, word)
            ids.append(who[there])
            sums.append(np.log10(BACKOFF * f.word_count[at[there]] / f.total) * often_[there] if len(f.words) else np.zeros(0))
            out.append(_row(bucket, "count", b"", _names(words[~often]), _small(c1[~often])))
            who, word = np.repeat(who[~there], often_[~there]), np.repeat(word[~there], often_[~there])
            out += _asks(who, word, np.ones(len(word), bool), buckets)
            ids, sums = ([x] for x in _added(ids, sums))
        out.append(_sum(bucket, ids[0], sums[0]))
        return pa.concat_tables([other.cast(_rows([]).schema), pa.Table.from_batches([_rows(out)])])

    return rows.groupBy("bucket").applyInArrow(run, PACKED)


def answered(rows: DataFrame, total: int) -> DataFrame:
    """Parts (doc_id, n, s) of documents' words and sums: per bucket, the packed sums and the asks' scores from the counts of words.

    The sums are unpacked here, as a step of Python after this one would keep a second worker for every core."""
    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asks, known = [], []
        for batch in batches:
            for kind, docs, a, b in zip(batch.column("kind").to_pylist(), *(_cells(batch.column(c)) for c in ("docs", "a", "b")), strict=True):
                if kind == "sum":
                    ids = _from_ids(docs)
                    yield _part(ids, _wide(b) if len(b) else np.zeros(len(ids), np.int64), np.frombuffer(a, np.float64).copy())
                elif kind == "ask":
                    asks.append((docs, a, b))
                else:
                    known.append((a, b))
        if asks:
            names = np.concatenate([_from_names(a) for a, _ in known])
            counts = np.concatenate([_wide(b) for _, b in known])
            order = np.argsort(names)
            ids = np.concatenate([_from_ids(docs) for docs, _, _ in asks])
            word = np.concatenate([_from_names(a) for _, a, _ in asks])
            back = np.concatenate([_wide(b) for _, _, b in asks])
            c = counts[order][np.searchsorted(names[order], word)]
            ids, found = _added([ids], [np.log10(np.where(back, BACKOFF, 1.0) * c / total)])
            yield _part(ids, np.zeros(len(ids), np.int64), found)

    return rows.groupBy("bucket").applyInArrow(run, "doc_id bigint, n bigint, s double")


def summed(parts: DataFrame) -> DataFrame:
    """(doc_id, n_words, total): parts added per document."""
    return parts.groupBy("doc_id").agg(F.sum("n").alias("n_words"), F.sum("s").alias("total"))


def buckets_for(spark: SparkSession, total: int) -> int:
    """A bucket for every BUCKET_WORDS words, so that what a task holds does not grow with the corpus."""
    return max(BUCKETS, C.shuffle_partitions(spark), -(-total // BUCKET_WORDS))


def backoff_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: float = SHARE) -> DataFrame:
    """doc_id, n_words, log10_total and log10_mean (per word) of every document under the corpus's own model."""
    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    top = frequent(d, share)
    buckets = buckets_for(docs.sparkSession, top.total)
    counted = counted_pairs(packed_pairs(d, top, buckets), top, buckets)
    out = summed(answered(counted, max(top.total, 1)))
    total = F.when(F.col("n_words") > 0, F.col("total"))
    return out.select(F.when(F.col("doc_id") != F.lit(int(_NO_ID)), F.col("doc_id")).alias("doc_id"), "n_words", total.alias("log10_total"), (total / F.col("n_words")).alias("log10_mean"))
