"""Quality rules by suffix-array repetition (operator 8).

Every document gets a suffix array over its characters.  Ranks are doubled
(7, 14, 28 ... characters, as many as fit in one machine word at first), and
only suffixes that still tie are sorted again.  The rank of every level is
kept, so the longest common prefix of two neighbours in the array comes from
comparing ranks from the deepest level down.  A suffix whose longest common
prefix with a neighbour is at least ``min_repeat`` starts a maximal repeated
substring; these spans are united.  A document passes if the united spans cover
at most ``max_covered`` per cent of its characters and no repeat is longer than
``max_repeat`` characters.

The base rules (word count, share of words in repeated 5-word windows) come
from the same pass over the text.

One task handles documents in chunks of about CHUNK_BYTES; nothing is shuffled.
A chunk, or one longer text, takes about 40 bytes for each character of prose
and up to 200 for a text that repeats itself without end (one line or one letter
over and over), where a rank of four bytes is kept for every doubling; so a chunk
of short documents stays under 80 MB whatever they say.

Defined results: a null or empty text has no words, so all counts are 0 and the
base rule rejects it.  A null id is carried through.  Repeated rows are judged
one by one.  An empty table gives an empty table.  Columns other than the id and
the text are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landstage.llm import common as C

CHUNK_BYTES = 400_000
MIN_WORDS = 10
MAX_REPEAT_WORDS = 20       # per cent of the words
MIN_REPEAT = 40             # characters
MAX_COVERED = 30            # per cent of the characters
MAX_REPEAT = 1000           # characters
WINDOW = 5

# Characters that count as symbols.
SYMBOLS = "#*$%&|<>"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_chars", "n_covered", "longest_repeat")
SCHEMA = "doc_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", base_failed boolean, kept boolean"

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[[ord(c) for c in SYMBOLS]] = True


def _per_text(mask: np.ndarray, t: C.Texts) -> np.ndarray:
    """How many bytes of each text the mask marks."""
    total = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
    return total[t.end] - total[t.start]


def base_counts(t: C.Texts) -> dict[str, np.ndarray]:
    """Word, symbol, line and window counts of every text of a chunk."""
    n = len(t.start)
    w = C.words(t)
    out = {"n_words": np.diff(w.first)}
    head = (t.buf & 0xC0) != 0x80               # first byte of a character
    head[t.end] = False
    out["n_chars"] = _per_text(head, t)
    out["word_chars"] = _per_text(head & ~C.IS_SPACE[t.buf], t)
    out["n_symbols"] = _per_text(_IS_SYMBOL[t.buf], t)
    if not len(w.start):
        return out | {"n_dup_lines": np.zeros(n, np.int64), "n_repeat_words": np.zeros(n, np.int64)}
    sums = C.prefix_hash(t.buf)
    # lines: cut at \n and at the end of a text; those without a word do not count
    cut = t.buf == 0x0A
    cut[t.end] = True
    ends = np.flatnonzero(cut)
    starts = np.concatenate(([0], ends[:-1] + 1))
    has_word = np.searchsorted(w.start, ends) > np.searchsorted(w.start, starts)
    starts, ends = starts[has_word], ends[has_word]
    line_doc = np.searchsorted(t.start, starts, side="right") - 1
    h = C.range_hash(sums, starts, ends)
    o = C.by_doc_then(h, line_doc)
    again = np.zeros(len(o), bool)
    again[1:] = (h[o][1:] == h[o][:-1]) & (line_doc[o][1:] == line_doc[o][:-1])
    out["n_dup_lines"] = np.bincount(line_doc[o][again], minlength=n)
    # words inside 5-word windows that the text holds twice or more
    wh = C.range_hash(sums, w.start, w.end)
    h = C.window_hash(wh, WINDOW)
    doc = w.doc[:len(h)]
    at = np.flatnonzero(doc == w.doc[WINDOW - 1:]) if len(h) else np.zeros(0, np.int64)
    o = at[C.by_doc_then(h[at], doc[at])]
    same = (h[o][1:] == h[o][:-1]) & (doc[o][1:] == doc[o][:-1])
    twice = np.zeros(len(o), bool)
    twice[1:] |= same
    twice[:-1] |= same
    step = np.zeros(len(w.start) + 1, np.int32)
    np.add.at(step, o[twice], 1)
    np.add.at(step, o[twice] + WINDOW, -1)
    out["n_repeat_words"] = np.bincount(w.doc[np.cumsum(step[:-1]) > 0], minlength=n)
    return out


def _symbols(t: C.Texts) -> tuple[np.ndarray, np.ndarray, int]:
    """Characters as small numbers (0: end of a text), where each text starts, and bits a character needs."""
    if not len(t.buf) or t.buf.max() < 128:
        points, start = t.buf.astype(np.int64), t.start
    else:
        points = np.frombuffer(t.buf.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        heads = np.concatenate(([0], np.cumsum((t.buf & 0xC0) != 0x80)))
        start = heads[t.start]
    seen = np.bincount(points, minlength=256) > 0
    name = np.cumsum(seen)                      # 1 and up, in the order of the characters
    sym = name[points].astype(np.uint64)
    ends = np.append(start[1:], len(points)) - 1
    sym[ends] = 0
    return sym, start, int(name[-1]).bit_length()


def repeats(t: C.Texts, min_repeat: int = MIN_REPEAT) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Suffix-array repeats of every text of a chunk.

    Returns characters covered by repeats and the longest repeat per text, and the spans'
    starts and lengths in the chunk's character array (one per suffix that repeats).
    """
    n_docs = len(t.start)
    none = np.zeros(n_docs, np.int64)
    if not len(t.buf):
        return none, none.copy(), none[:0], none[:0]
    sym, start, bits = _symbols(t)
    n = len(sym)
    doc_bits = max(1, int(n_docs - 1).bit_length())
    per = max(1, min((64 - doc_bits) // bits, min_repeat))
    doc = np.repeat(np.arange(n_docs, dtype=np.int32), np.diff(np.append(start, n)))
    key = doc.astype(np.uint64)
    for j in range(per):
        key <<= np.uint64(bits)
        key[:n - j] |= sym[j:]
    order = np.argsort(key)
    key = key[order]
    new = np.ones(n, bool)
    new[1:] = key[1:] != key[:-1]
    del key
    head = np.maximum.accumulate(np.where(new, np.arange(n, dtype=np.int32), np.int32(0)))    # where each group begins
    rank = np.empty(n + 1, np.int32)
    rank[n] = -1
    rank[order] = head
    tied = ~(new & np.append(new[1:], True))
    at, group = order[tied], head[tied]
    del order, head
    h, levels, deep = per, [(per, rank.copy())], None
    while len(at):
        if deep is None and 2 * h > min_repeat:
            deep = (at, group)                  # all suffixes that share min_repeat characters are here
        o = np.argsort(group.astype(np.int64) * (n + 1) + rank[at + h], kind="stable")
        at = at[o]
        del o
        nxt = rank[at + h]
        new = np.ones(len(at), bool)
        new[1:] = (group[1:] != group[:-1]) | (nxt[1:] != nxt[:-1])
        pos = np.arange(len(at), dtype=np.int32)
        begin = np.maximum.accumulate(np.where(np.append(True, group[1:] != group[:-1]), pos, np.int32(0)))
        group = group + (np.maximum.accumulate(np.where(new, pos, np.int32(0))) - begin)
        rank[at] = group
        del pos, begin, nxt
        tied = ~(new & np.append(new[1:], True))
        at, group = at[tied], group[tied]
        h *= 2
        levels.append((h, rank.copy()))
    if deep is None:
        return none, none.copy(), none[:0], none[:0]
    at, group = deep
    o = np.argsort(rank[at])
    at, group = at[o], group[o]
    pair = np.flatnonzero(group[1:] == group[:-1])
    a, b = at[pair], at[pair + 1]
    lcp = np.zeros(len(pair), np.int64)
    for size, r in reversed(levels):
        lcp += size * (r[a + lcp] == r[b + lcp])
    open_ = np.ones(len(pair), bool)
    padded = np.append(sym, np.zeros(1, np.uint64))
    for _ in range(per - 1):
        open_ &= padded[np.minimum(a + lcp, n)] == padded[np.minimum(b + lcp, n)]
        lcp += open_
    most = np.zeros(len(at), np.int64)
    np.maximum.at(most, pair, lcp)
    np.maximum.at(most, pair + 1, lcp)
    long = most >= min_repeat
    at, most = at[long], most[long]
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, at, 1)
    np.add.at(step, at + most, -1)
    covered = np.concatenate(([0], np.cumsum(np.cumsum(step[:-1]) > 0)))
    ends = np.append(start[1:], n) - 1
    longest = none.copy()
    np.maximum.at(longest, doc[at].astype(np.int64), most)
    return covered[ends] - covered[start], longest, at, most


def judge(t: C.Texts, min_repeat: int = MIN_REPEAT, max_covered: int = MAX_COVERED,
          max_repeat: int = MAX_REPEAT) -> dict[str, np.ndarray]:
    """All counts and both verdicts for every text of a chunk."""
    out = base_counts(t)
    out["n_covered"], out["longest_repeat"], _, _ = repeats(t, min_repeat)
    out["base_failed"] = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEAT_WORDS * out["n_words"])
    out["kept"] = ~out["base_failed"] & (100 * out["n_covered"] <= max_covered * out["n_chars"]) & (out["longest_repeat"] <= max_repeat)
    return out


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_repeat: int = MIN_REPEAT,
                  max_covered: int = MAX_COVERED, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """One row per document: id, counts, covered characters, longest repeat, both verdicts."""
    C.ship_package()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.chunks(batch, most=CHUNK_BYTES):
                got = judge(C.flat(part.column(1)), min_repeat, max_covered, max_repeat)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(got[c], pa.int64()) for c in COUNTS), pa.array(got["base_failed"]), pa.array(got["kept"])],
                    ["doc_id", *COUNTS, "base_failed", "kept"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)


def keep_good(docs: DataFrame, text_col: str = "text", min_repeat: int = MIN_REPEAT,
              max_covered: int = MAX_COVERED, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """The documents that pass, with all their columns as they were; no shuffle."""
    C.ship_package()
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.chunks(batch, text_col, CHUNK_BYTES):
                yield part.filter(pa.array(judge(C.flat(part.column(at)), min_repeat, max_covered, max_repeat)["kept"]))

    return docs.mapInArrow(run, docs.schema)
