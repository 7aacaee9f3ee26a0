"""Conversation structure repair: the cheapest edits that give ``(s?(ua)+)?``, audited.

Every row of a conversation becomes a symbol: its role's class (s, u, a or other) and its
first fault (blank, duplicate, truncated or none).  The edits of one symbol are a 4 x 4
min-plus transition between the states Start, after system, after user and after assistant,
the inserted rows before it included.  Equal consecutive symbols are collapsed to runs; a run
is advanced through binary powers of its transition, which are cached per worker, so a run of
n rows costs log n products.  Segments of SEGMENT rows get their transition in parallel.
Then, per conversation, the costs to go are carried back over its segments, and the choices
are unrolled: within a segment every row takes the ASCII-least edit that keeps the cost.

At scale: rows without their texts are sorted once by (conversation, turn), which numbers
them without a task per conversation; duplicates are found by the least number of each
(conversation, role, text) digest, joined back on the number, so no key is hot.  Texts are
shuffled once, for the repaired hash.  A conversation's audit and hash are single values: its
symbols (one byte a row) meet in one task, and its rows pass through that task as a stream,
one batch at a time.

Nulls and special cases: a null role or text counts as one space (a space is a blank text and
a role of no class); null turns come first; null conversation ids are one conversation.  Rows
of the same turn are ordered by role, then by the digest of role and text.  A conversation without rows has zeros, an
empty audit and the empty text's hash.  An empty table has no rows.  Other columns are not
read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landstage.llm import common as C

SEGMENT = 4096
START, SYSTEM, USER, ASSISTANT = range(4)
NEVER = 1 << 60
INSERT, REROLE, DELETE, TRUNCATED = 2, 2, 3, 1
#: State after an inserted or re-roled row: the assistant answers the user, else the user speaks.
TURN = (USER, USER, ASSISTANT, USER)
NAME = {USER: "user", ASSISTANT: "assistant"}

Vector = tuple[int, int, int, int]
Matrix = tuple[Vector, ...]


def memo(fn):
    """Keeps results per worker.  All keys are bounded: symbols, states, bits of a length, cost differences."""
    have: dict = {}

    def kept(*key):
        if key not in have:
            have[key] = fn(*key)
        return have[key]

    return kept


# ------------------------------------------------------------------ transitions
@memo
def edits(symbol: str, state: int) -> tuple[tuple[str, int, int], ...]:
    """(letter, cost, state after) of every edit of one row, letters ascending.

    symbol: ``x`` must go; s, u, a, o are roles, in upper case for truncated rows.
    """
    out = [("D", DELETE, state)]
    if symbol != "x":
        extra = TRUNCATED if symbol.isupper() else 0
        role = symbol.lower()
        if role == "s" and state == START:
            out.append(("K", extra, SYSTEM))
        if role in "ua" and TURN[state] == (USER if role == "u" else ASSISTANT):
            out.append(("K", extra, TURN[state]))
        out.append(("R", REROLE + extra, TURN[state]))
    return tuple(out)


@memo
def transition(symbol: str) -> Matrix:
    """Least cost from state to state over one row, inserted rows before it included."""
    rows = []
    for start in range(4):
        best = [NEVER] * 4
        state, paid = start, 0
        for _ in range(3):          # two inserted rows reach every state that any number reaches
            for _, cost, after in edits(symbol, state):
                best[after] = min(best[after], paid + cost)
            state, paid = TURN[state], paid + INSERT
        rows.append(tuple(best))
    return tuple(rows)


def times(a: Matrix, b: Matrix) -> Matrix:
    """Min-plus product."""
    return tuple(tuple(min(min(x + b[k][j] for k, x in enumerate(row)), NEVER) for j in range(4)) for row in a)


@memo
def power(symbol: str, k: int) -> Matrix:
    """Transition of 2 ** k equal rows."""
    return transition(symbol) if k == 0 else times(power(symbol, k - 1), power(symbol, k - 1))


def runs(symbols: str) -> list[tuple[str, int]]:
    """Equal consecutive symbols collapsed: (symbol, length)."""
    return [(s, sum(1 for _ in g)) for s, g in groupby(symbols)]


def advance(symbols: str) -> Matrix:
    """Transition of a whole segment, run by run through the binary powers."""
    total = None
    for symbol, length in runs(symbols):
        for k in range(length.bit_length()):
            if length >> k & 1:
                total = power(symbol, k) if total is None else times(total, power(symbol, k))
    return total


# ---------------------------------------------------------------------- choices
#: Cost to go at the end of a conversation: it may end at Start or after an assistant.
END: Vector = tuple(0 if s in (START, ASSISTANT) else INSERT * (2 if s == SYSTEM else 1) for s in range(4))


def back(m: Matrix, after: Vector) -> Vector:
    """Cost to go before a segment, from the cost to go after it."""
    return tuple(min(m[s][t] + after[t] for t in range(4)) for s in range(4))


@memo
def choices(symbol: str, after: Vector) -> tuple[Vector, tuple[tuple[str, int], ...]]:
    """Cost to go before one row, and from each state the ASCII-least edits and the state after.

    ``after`` is relative to its least entry, and so is the first result less its own least
    entry; few such vectors exist, so a conversation mostly meets cached ones.
    """
    before = back(transition(symbol), after)
    out = []
    for state in range(4):
        letters, s = "", state
        while True:
            done = next(((x, t) for x, cost, t in edits(symbol, s) if cost + after[t] == before[s]), None)
            insert = INSERT + before[TURN[s]] == before[s]
            if insert and not (done and done[0] == "D"):
                letters, s = letters + "I", TURN[s]
                continue
            out.append((letters + done[0], done[1]))
            break
    return before, tuple(out)


def unroll(symbols: str, state: int, after: Vector) -> tuple[str, int]:
    """The ASCII-least cheapest edits of a segment from ``state``, and the state after."""
    ways = []
    for symbol in reversed(symbols):
        least = min(after)
        after, way = choices(symbol, tuple(x - least for x in after))
        ways.append(way)
    out = []
    for way in reversed(ways):
        letters, state = way[state]
        out.append(letters)
    return "".join(out), state


def repair(segments: list[tuple[str, Matrix]]) -> tuple[int, str]:
    """Least cost and audit of a conversation from its segments' symbols and transitions."""
    ends = [END]
    for _, m in reversed(segments):
        ends.append(back(m, ends[-1]))
    cost, state, audit = ends[-1][START], START, []
    for (symbols, _), after in zip(segments, reversed(ends[:-1]), strict=True):
        letters, state = unroll(symbols, state, after)
        audit.append(letters)
    return cost, "".join(audit) + "I" * (END[state] // INSERT)


class Repaired:
    """Applies an audit to the rows of a conversation as they come; hashes the repaired lines."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.sha, self.empty = audit, 0, START, hashlib.sha256(), True

    def line(self, role: str, text: str) -> None:
        self.sha.update((("" if self.empty else "\n") + role + ":" + text).encode())
        self.empty = False

    def inserts(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            self.state = TURN[self.state]
            self.line(NAME[self.state], "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.inserts()
        letter, self.at = self.audit[self.at], self.at + 1
        if letter == "R":
            self.state = TURN[self.state]
            role = NAME[self.state]
        elif letter == "K":
            self.state = SYSTEM if self.state == START and role[:1] == "s" else TURN[self.state]
        if letter != "D":
            self.line(role, text)

    def digest(self) -> str:
        self.inserts()
        return self.sha.hexdigest()


# ------------------------------------------------------------------------- Spark
def damaged(rows: DataFrame, names: tuple[str, str, str, str] = ("conv_id", "turn", "role", "text")) -> DataFrame:
    """The query's damage, decided by the checksum of conversation and turn: conv_id, turn, role, text, copy.

    ``copy`` is 0, 1 for a repeated row, or -1 for a row that is dropped (kept here as a mark).
    """
    conv, turn, role, text = (F.col(n) for n in names)
    space = F.lit(" ")
    kind = F.crc32(F.concat(F.coalesce(conv.cast("string"), space), F.lit(":"), F.coalesce(turn.cast("string"), space))) % 20
    d = rows.select(conv.alias("conv_id"), turn.alias("turn"), F.coalesce(role, space).alias("role"), F.coalesce(text, space).alias("text"), kind.alias("kind"))
    d = d.select("conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                 F.when(F.col("kind").isin(0, 1), F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"), "kind")
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).when(F.col("kind") == 0, F.array(F.lit(-1))).otherwise(F.array(F.lit(0)))
    return d.select("conv_id", "turn", "role", "text", F.explode(copies).alias("copy"))


def _said(role: Column, text: Column) -> Column:
    return F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)


ORDER = ["turn", "role", "said", "copy"]


def segments(rows: DataFrame) -> DataFrame:
    """One row per SEGMENT rows of a conversation: its classes, symbols and counts (see SCHEMA)."""
    initial = F.substring("role", 1, 1)
    role = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("o"))
    last = F.substring(F.rtrim(F.translate("text", "\t\n\x0b\x0c\r", "     ")), -1, 1)
    facts = rows.where("copy >= 0").select("conv_id", "turn", "role", "copy", _said(F.col("role"), F.col("text")).alias("said"), role.alias("class"),
                                           (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("open"), F.monotonically_increasing_id().alias("tie"))
    at = C.materialise(C.numbered(C.materialise(facts, "facts"), ["conv_id"], [*ORDER, "tie"]).drop("role", "copy", "tie"), "rows")
    first = at.groupBy(F.col("conv_id").alias("c"), "said").agg(F.min("pos").alias("p")).select("c", "p")
    seen = at.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("pos") == F.col("p")), "left")
    repeat = ~F.col("blank") & F.col("p").isNull()
    cut = ~F.col("blank") & ~repeat & F.col("open")
    symbol = F.when(F.col("blank") | repeat, F.lit("x")).when(cut, F.upper("class")).otherwise(F.col("class"))
    each = seen.select("conv_id", F.floor(F.col("pos") / SEGMENT).cast("bigint").alias("seg"), F.struct("pos", "class", symbol.alias("symbol"), "turn").alias("r"),
                       *[x.cast("bigint").alias(n) for n, x in (("blank", F.col("blank")), ("duplicate", repeat), ("truncated", cut))])
    found = each.groupBy("conv_id", "seg").agg(F.array_sort(F.collect_list("r")).alias("r"), *[F.sum(n).alias(n) for n in ("blank", "duplicate", "truncated")])
    turns = F.array_compact(F.transform("r", lambda x: x["turn"]))
    found = found.withColumn("turns", turns)
    return found.select("conv_id", "seg", F.array_join(F.transform("r", lambda x: x["class"]), "").alias("classes"), F.array_join(F.transform("r", lambda x: x["symbol"]), "").alias("symbols"),
                        "blank", "duplicate", "truncated", F.array_min("turns").alias("low"), F.array_max("turns").alias("high"),
                        F.size(F.array_distinct("turns")).cast("bigint").alias("n_turns"))


HEAD = "classes string, symbols string, blank bigint, duplicate bigint, truncated bigint, low bigint, high bigint, n_turns bigint"
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def advanced(found: DataFrame, conv: str) -> DataFrame:
    """The segments with their transition (16 costs, row by row) and illegal pairs inside."""
    names = found.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = [[x for row in advance(s) for x in row] for s in batch.column(names.index("symbols")).to_pylist()]
            bad = [illegal_pairs(c) for c in batch.column(names.index("classes")).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(m, pa.list_(pa.int64())), pa.array(bad, pa.int64())], [*names, "costs", "illegal"])

    return found.mapInArrow(run, f"conv_id {conv}, seg bigint, {HEAD}, costs array<bigint>, illegal bigint")


def illegal_pairs(classes: str) -> int:
    return max(len(classes) - 1, 0) - sum(map(classes.count, ("su", "ua", "au")))


def conversation(conv, heads: list[dict]) -> tuple[dict, Repaired]:
    """Counts, cost and audit of a conversation from its segments, in order."""
    out = dict.fromkeys(COUNTS, 0)
    for h in heads:
        for c in ("blank", "duplicate", "truncated", "illegal"):
            out[c] += h[c]
    out["illegal"] += sum(illegal_pairs(a["classes"][-1] + b["classes"][0]) for a, b in zip(heads, heads[1:], strict=False))
    timed = [h for h in heads if h["low"] is not None]
    if timed:
        n = sum(h["n_turns"] for h in timed) - sum(a["high"] == b["low"] for a, b in zip(timed, timed[1:], strict=False))
        out["gaps"] = timed[-1]["high"] - timed[0]["low"] + 1 - n
    out["cost"], out["audit"] = repair([(h["symbols"], tuple(tuple(h["costs"][i:i + 4]) for i in (0, 4, 8, 12))) for h in heads])
    return {"conv_id": conv, **out}, Repaired(out["audit"])


def repaired(rows: DataFrame) -> DataFrame:
    """One row per conversation of rows (conv_id, turn, role, text, copy): counts, cost, audit, repaired_sha256."""
    C.ship_package()
    conv = rows.schema["conv_id"].dataType.simpleString()
    turn = rows.schema["turn"].dataType.simpleString()
    heads = advanced(segments(rows), conv)
    none = lambda t: F.lit(None).cast(t)
    top = heads.select("conv_id", F.lit(0).alias("kind"), "seg", none(turn).alias("turn"), none("string").alias("role"), none("string").alias("said"), none("int").alias("copy"), none("string").alias("text"),
                       F.struct("classes", "symbols", "blank", "duplicate", "truncated", "low", "high", "n_turns", "costs", "illegal").alias("head"))
    there = F.col("copy") >= 0
    body = rows.select("conv_id", F.when(there, F.lit(1)).otherwise(F.lit(2)).alias("kind"), none("bigint").alias("seg"), "turn", "role", _said(F.col("role"), F.col("text")).alias("said"), "copy",
                       F.when(there, F.col("text")).alias("text"), none(top.schema["head"].dataType).alias("head"))
    # the same order as the numbering's; rows that tie are equal
    stream = top.union(body).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "seg", *ORDER).select("conv_id", "kind", "role", "text", "head")
    names = ["conv_id", *COUNTS, "audit", "repaired_sha256"]
    schema = f"conv_id {conv}, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", audit string, repaired_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, now, open_, heads, work, out = None, None, False, [], None, []
        for batch in batches:
            arrow = pa.schema([(n, batch.schema.field(0).type if n == "conv_id" else pa.int64() if n in COUNTS else pa.string()) for n in names])
            for conv_id, kind, role, text, head in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not open_ or conv_id != now:
                    if open_:
                        out.append(_closed(now, heads, work))
                    now, open_, heads, work = conv_id, True, [], None
                if kind == 0:
                    heads.append(head)
                elif kind == 1:
                    if work is None:
                        work = conversation(now, heads)
                        heads = []
                    work[1].row(role, text)
            yield pa.RecordBatch.from_pylist(out, arrow)
            out = []
        if open_:
            yield pa.RecordBatch.from_pylist([_closed(now, heads, work)], arrow)

    return stream.mapInArrow(run, schema)


def _closed(conv, heads: list[dict], work: tuple[dict, Repaired] | None) -> dict:
    found, lines = work or conversation(conv, heads)
    return {**found, "repaired_sha256": lines.digest()}
