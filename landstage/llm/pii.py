"""Personal data by a skip-chain conditional random field (operator 3).

Base spans come from four patterns (e-mail, IP address, payment card, phone).  The
field adds spans that the patterns miss.  Its nodes are the words with a digit or
an at sign; all other words have the label "none".  Potentials:

- each node: shape and digit features of its word;
- neighbouring words: a transition between their labels;
- skip edges: words of one document that are equal, or have the same seven or more
  digits, are tied along their occurrences (one edge from each to the next, so the
  edges grow with the text, not with the square of a group) and prefer one label.

Words inside base spans are observed.  Damped sum-product message passing over all
edges (``ROUNDS`` rounds) gives each other node's marginals; runs of neighbouring
nodes that most likely have one kind become added spans.  Thus a number that is
written once in a form that a pattern knows is also found where its form is broken.

Weights are fitted by pseudo-likelihood on at most ``SAMPLE`` documents (those with
the smallest hash of the id among texts of at most ``SAMPLE_CHARS`` characters that
hold a digit or an at sign, looked for among about ``20 * SAMPLE`` documents), with the
base spans as labels.  Everything else
reads whole texts of all rows in one pass, without a shuffle.

Defined results: a null or empty text has no spans (and a null text stays null when
redacted); a null id is carried through; repeated rows give repeated results; an empty
table gives an empty table.  Only the id and text columns are read, whatever others are called.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landstage.llm import common as C

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
SAMPLE = 1500
SAMPLE_CHARS = 200_000
ROUNDS = 12
SHAPES = 120

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match always begins where a run of digits begins, so the look-behind changes no result
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_EDGE = "\"'.,;:!?#*$%&|<>[]{}="


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(c)] for c in digits[-2::-2])
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text, start - 1):
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the four patterns, by start and kind."""
    found = [(s, 0, e) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def span_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


class Nodes(NamedTuple):
    """Words with a digit or an at sign, over the texts of a chunk."""

    doc: np.ndarray
    place: np.ndarray       # number of the word in the chunk
    start: np.ndarray       # characters from the start of its text
    end: np.ndarray
    label: np.ndarray       # of the base span it lies in, else 0
    core: list[str]
    base: list[list[tuple[int, int, int]]]      # base spans of every text


_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in "0123456789@"]] = True


def nodes(t: C.Texts, texts: list[str | None]) -> Nodes:
    w = C.words(t)
    base: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not len(w.start):
        z = np.zeros(0, np.int64)
        return Nodes(z, z, z, z, z, [], base)
    marks = np.concatenate(([0], np.cumsum(_MARK[t.buf])))
    place = np.flatnonzero(marks[w.end] > marks[w.start])
    heads = np.concatenate(([0], np.cumsum((t.buf & 0xC0) != 0x80)))
    doc = w.doc[place]
    start, end = (heads[x[place]] - heads[t.start[doc]] for x in (w.start, w.end))
    label = np.zeros(len(place), np.int64)
    core = [""] * len(place)
    for a, b in C.stretches(doc):
        d = int(doc[a])
        text = texts[d] or ""
        base[d] = base_spans(text)
        for i in range(a, b):
            word = text[start[i]:end[i]]
            core[i] = word.strip(_EDGE)
            start[i] += len(word) - len(word.lstrip(_EDGE)) if core[i] else 0
            end[i] = start[i] + len(core[i]) if core[i] else end[i]
        for s, k, e in reversed(base[d]):
            lo, hi = a + np.searchsorted(end[a:b], s, side="right"), a + np.searchsorted(start[a:b], e)
            label[lo:hi] = k + 1
    return Nodes(doc, place, start, end, label, core, base)


def shape(word: str) -> str:
    return re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]+", "9", word), flags=re.ASCII)[:24]


def features(word: str) -> list[str]:
    digits = _NOT_DIGIT.sub("", word)
    n = len(digits)
    size = n if n < 4 else 4 if n < 7 else 7 if n < 10 else 10 if n < 14 else 14 if n < 20 else 20
    parts = word.split(".")
    out = ["all", f"shape {shape(word)}", f"digits {size}", f"dots {min(len(parts) - 1, 4)}"]
    out += [name for name, has in (
        ("at", "@" in word), ("plus", word.startswith("+")), ("bracket", "(" in word or ")" in word), ("hyphen", "-" in word),
        ("letters", any(c.isalpha() for c in word)), ("luhn", 14 <= n <= 19 and luhn(digits)),
        ("octets", len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)),
        ("only digits", n == len(word))) if has]
    return out


def skip_key(word: str) -> str:
    digits = _NOT_DIGIT.sub("", word)
    return digits if len(digits) >= 7 else word.lower()


class Model(NamedTuple):
    names: dict[str, int]
    weight: np.ndarray      # (features, labels)
    step: np.ndarray        # (label, next label)
    tie: float


def _design(n: Nodes, names: dict[str, int]) -> np.ndarray:
    x = np.zeros((len(n.core), max(1, len(names))), np.float64)
    for i, word in enumerate(n.core):
        for f in features(word):
            if (k := names.get(f)) is not None:
                x[i, k] = 1
    return x


def edges(n: Nodes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Chain edges (from, to) and skip edges (from, to)."""
    near = np.flatnonzero((n.place[1:] == n.place[:-1] + 1) & (n.doc[1:] == n.doc[:-1])) if len(n.place) else np.zeros(0, np.int64)
    last: dict[tuple[int, str], int] = {}
    a, b = [], []
    for i, word in enumerate(n.core):
        key = (int(n.doc[i]), skip_key(word))
        if key in last:
            a.append(last[key])
            b.append(i)
        last[key] = i
    return near, near + 1, np.array(a, np.int64), np.array(b, np.int64)


def fit(n: Nodes, steps: int = 300, rate: float = 0.1, decay: float = 1e-3) -> Model:
    """Weights by pseudo-likelihood with the base spans' labels (Adam on the full sample)."""
    count = Counter(f for w in n.core for f in features(w))
    shapes = {f for f, _ in sorted(((f, c) for f, c in count.items() if f.startswith("shape")), key=lambda x: (-x[1], x[0]))[:SHAPES]}
    names = {f: i for i, f in enumerate(sorted(f for f in count if not f.startswith("shape") or f in shapes))}
    size = len(LABELS)
    if not n.core:
        return Model({}, np.zeros((1, size)), np.zeros((size, size)), 0.0)
    x, y = _design(n, names), np.eye(size)[n.label]
    ca, cb, sa, sb = edges(n)
    before, after = np.tile(np.eye(size)[0], (len(x), 1)), np.tile(np.eye(size)[0], (len(x), 1))
    before[cb], after[ca] = y[ca], y[cb]
    tied = np.zeros_like(y)
    np.add.at(tied, sa, y[sb])
    np.add.at(tied, sb, y[sa])
    p = [np.zeros((x.shape[1], size)), np.zeros((size, size)), np.zeros(1)]
    m, v = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p]
    for k in range(1, steps + 1):
        s = x @ p[0] + before @ p[1] + after @ p[1].T + p[2] * tied
        s = np.exp(s - s.max(1, keepdims=True))
        miss = (y - s / s.sum(1, keepdims=True)) / len(x)
        grads = [x.T @ miss, before.T @ miss + miss.T @ after, np.array([(tied * miss).sum()])]
        for i, g in enumerate(grads):
            g = g - decay * p[i]
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            p[i] = p[i] + rate * (m[i] / (1 - 0.9 ** k)) / (np.sqrt(v[i] / (1 - 0.999 ** k)) + 1e-8)
    return Model(names, p[0], p[1], float(max(p[2][0], 0.0)))


def marginals(n: Nodes, model: Model, rounds: int = ROUNDS) -> np.ndarray:
    """Label probabilities of every node by damped message passing over chain and skip edges."""
    size = len(LABELS)
    theta = _design(n, model.names) @ model.weight
    ca, cb, sa, sb = edges(n)
    first, last = np.ones(len(theta), bool), np.ones(len(theta), bool)
    first[cb], last[ca] = False, False
    theta[first] += model.step[0]
    theta[last] += model.step[:, 0]
    seen = n.label > 0
    theta[seen] = np.where(np.eye(size, dtype=bool)[n.label[seen]], 0.0, -60.0)
    a, b = np.concatenate((ca, sa)), np.concatenate((cb, sb))
    pot = np.concatenate((np.broadcast_to(model.step, (len(ca), size, size)), np.broadcast_to(model.tie * np.eye(size), (len(sa), size, size))))
    to_b, to_a = np.zeros((len(a), size)), np.zeros((len(a), size))

    def belief() -> np.ndarray:
        out = theta.copy()
        np.add.at(out, b, to_b)
        np.add.at(out, a, to_a)
        return out

    def send(x: np.ndarray, axis: int) -> np.ndarray:
        x = (x[:, :, None] if axis == 1 else x[:, None, :]) + pot
        top = x.max(axis=axis)
        out = top + np.log(np.exp(x - np.expand_dims(top, axis)).sum(axis=axis))
        return out - out.max(axis=1, keepdims=True)

    for _ in range(rounds if len(a) else 0):
        full = belief()
        new_b, new_a = send(full[a] - to_a, 1), send(full[b] - to_b, 2)
        to_b, to_a = 0.5 * to_b + 0.5 * new_b, 0.5 * to_a + 0.5 * new_a
    full = belief()
    full = np.exp(full - full.max(axis=1, keepdims=True))
    return full / full.sum(axis=1, keepdims=True)


def all_spans(t: C.Texts, texts: list[str | None], model: Model) -> tuple[list[list[tuple[int, int, int]]], list[list[tuple[int, int, int]]]]:
    """Base spans and added spans of every text of a chunk."""
    n = nodes(t, texts)
    added: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if n.core:
        best = np.where(n.label > 0, 0, marginals(n, model).argmax(axis=1))
        near = -9
        for i in np.flatnonzero(best):
            if not n.core[i]:
                continue
            d, k = int(n.doc[i]), int(best[i]) - 1
            run = added[d]
            if run and n.place[i] == near + 1 and run[-1][1] == k:
                run[-1] = (run[-1][0], k, int(n.end[i]))
            else:
                run.append((int(n.start[i]), k, int(n.end[i])))
            near = n.place[i]
    return n.base, added


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Model:
    """Weights from a bounded sample of the documents (see the module's text)."""
    some = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where(F.col("text").rlike("[0-9@]") & (F.length("text") <= SAMPLE_CHARS))
    texts = [r["text"] for r in C.sampled(some, "doc_id", sample, some.count()).collect()]
    return fit(nodes(C.flat(pa.array(texts, pa.string())), texts))


SCHEMA = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_added bigint"


def personal_data(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: base counts, digest of the base spans, all spans, number of added spans."""
    C.ship_package()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.chunks(batch):
                texts = part.column(1).to_pylist()
                base, added = all_spans(C.flat(part.column(1)), texts, model)
                counts = np.array([np.bincount([k for _, k, _ in b], minlength=4) for b in base], np.int64).reshape(-1, 4)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(counts[:, k]) for k in range(4)),
                     pa.array([hashlib.sha256(span_text(b).encode()).hexdigest() for b in base], pa.string()),
                     pa.array([span_text(sorted(b + x)) for b, x in zip(base, added, strict=True)], pa.string()),
                     pa.array([len(x) for x in added], pa.int64())],
                    ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)


def masked(text: str | None, spans: list[tuple[int, int, int]]) -> str | None:
    """The text with every span replaced by its kind in angle brackets; overlapping spans become one."""
    if text is None or not spans:
        return text
    out, at = [], 0
    merged: list[list[int]] = []
    for s, k, e in sorted(spans):
        if merged and s < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], e)
        else:
            merged.append([s, k, e])
    for s, k, e in merged:
        out += [text[at:s], f"<{KINDS[k]}>"]
        at = e
    return "".join(out) + text[at:]


def redact(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents with personal data masked in the text; all other columns as they were; no shuffle."""
    C.ship_package()
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.chunks(batch, text_col):
                texts = part.column(at).to_pylist()
                base, added = all_spans(C.flat(part.column(at)), texts, model)
                new = [masked(x, b + a) for x, b, a in zip(texts, base, added, strict=True)]
                yield part.set_column(at, part.schema.field(at), pa.array(new, part.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)
