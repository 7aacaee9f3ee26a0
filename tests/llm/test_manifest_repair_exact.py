"""Brute-force, property and edge tests of the Merkle manifest, conversation repair and exact duplicates."""

from __future__ import annotations

import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from landstage.llm import common, exact, merkle, repair
from tests.llm.data import PROSE, edge_docs, edge_rows, empty_docs, words


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode("utf-8", "surrogatepass")).hexdigest()


def low(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def by_null(x):
    return (x is not None, x if x is not None else 0)


# ------------------------------------------------------------------ exact duplicates
def exact_by_hand(rows):
    """(doc_id, keep_id, group_size, kept, sha) sorted; equal rows: one stays."""
    groups: dict = {}
    for doc_id, text in rows:
        groups.setdefault(low(text), []).append(doc_id)
    out = []
    for text, ids in groups.items():
        ids = sorted(ids, key=by_null)
        out += [(i, ids[-1], len(ids), k == len(ids) - 1, sha(text)) for k, i in enumerate(ids)]
    return sorted(out, key=str)


def exact_rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


def test_exact_edges(spark):
    docs = edge_docs(spark).union(edge_docs(spark).where("doc_id = 6").withColumns({"doc_id": F.lit(99).cast("bigint"), "text": F.upper("text")}))
    rows = [(r[0], r[1]) for r in edge_rows()] + [(99, next(r[1] for r in edge_rows() if r[0] == 6).upper())]
    assert exact_rows(exact.exact_duplicates(docs)) == exact_by_hand(rows)
    assert exact.exact_duplicates(empty_docs(spark)).collect() == []


def test_non_ascii_case_differs(spark):
    rows = [(1, "ÄB"), (2, "äb"), (3, "ÄB".lower()), (4, "Äb"), (5, "KB"), (6, "kb")]     # a Kelvin sign is not k
    assert exact_rows(exact.exact_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))) == exact_by_hand(rows)


@pytest.mark.parametrize("primes", [(2, 3), (5, 2)])
def test_collisions_are_split_by_content(spark, primes, monkeypatch):
    """With tiny primes most texts collide; the chunkwise comparison still gives exact classes."""
    r = random.Random(primes[0])
    rows = [(i % 390, r.choice(["aa", "ab", "ba", "bb", "AA", "aB", "", None, "longer " * 30 + r.choice("abAB")])) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    real = exact.parts
    monkeypatch.setattr(exact, "parts", lambda d, p: real(d, p, 16))        # many chunks per text
    assert exact_rows(exact.exact_duplicates(docs, primes=primes)) == exact_by_hand(rows)


def test_large_group_of_copies(spark):
    rows = [(i, "Same text" if i % 3 else f"text {i}") for i in range(6000)]
    got = exact_rows(exact.exact_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)))
    assert got == exact_by_hand(rows) and sum(x[3] for x in got) == 2001


def test_fingerprint_does_not_depend_on_the_cut():
    r = np.random.default_rng(3)
    texts = [r.integers(0, 256, n).astype(np.uint8) for n in (0, 1, 4095, 4096, 4097, 20_000, 3_000_000)]
    end = np.cumsum([len(t) + 1 for t in texts]) - 1
    start = end - [len(t) for t in texts]
    buf = np.concatenate([np.append(t, np.uint8(32)) for t in texts])
    whole = exact.fingerprints(buf, start, end)
    assert (whole == exact.fingerprints(buf, start, end, chunk=1000)).all()
    for t, fp in zip(texts[:6], whole, strict=False):
        hand = 0
        for base, prime in zip(exact.BASES, exact.PRIMES, strict=True):
            h = 0
            for b in t.tolist():
                h = (h * base + b + 1) % prime
            hand = hand << 31 | h
        assert fp == hand


def test_parts_in_many_rows_equal_the_whole(spark):
    texts = {1: words(3, 30_000), 2: "short", 3: "", 4: "ünï çödé" * 900}
    pieces = []
    for k, t in texts.items():
        cut = sorted(random.Random(k).sample(range(len(t) + 1), min(len(t), 9)))
        pieces += [(k, i, t[a:b]) for i, (a, b) in enumerate(zip([0, *cut], [*cut, len(t)], strict=True))]
    pieces.append((3, 7, None))
    whole = {r["doc_id"]: (r["n_bytes"], r["fp"]) for r in exact.exact_duplicates(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")).collect()}
    got = exact.fingerprints_of_parts(spark.createDataFrame(pieces, "doc_id bigint, place int, text string").repartition(7), "doc_id", "place")
    assert {r["doc_id"]: (r["n_bytes"], r["fp"]) for r in got.collect()} == whole


# -------------------------------------------------------------------------- manifest
def field(x) -> str:
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def climb(nodes: list[str]) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i:i + 8])) for i in range(0, len(last), 8)])
    return levels


def manifest_by_hand(rows):
    """rows: (doc_id, source, lang, n_chars, text)"""
    def leaf(r, text):
        return sha("".join(map(field, (*r[:4], text))))

    langs: dict = {}
    for r in rows:
        langs.setdefault(r[2], []).append(r)
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for g in order:
        langs[g].sort(key=lambda r: (by_null(r[0]), leaf(r, r[4])))
        trees.append(climb([leaf(r, r[4]) for r in langs[g]]))
    top = climb([t[-1][0] for t in trees])

    def walk(levels, i):
        out = []
        for level in levels[:-1]:
            run = i // 8 * 8
            out.append(("".join(level[run:i]), "".join(level[i + 1:run + 8])))
            i //= 8
        return out

    out = []
    for k, g in enumerate(order):
        for i, r in enumerate(langs[g]):
            path = walk(trees[k], i) + walk(top, k)
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            h = leaf(r, None if r[4] is None else low(r[4])) if tampered else leaf(r, r[4])
            for a, b in path:
                h = sha(a + h + b)
            out.append((r[0], leaf(r, r[4]), trees[k][-1][0], top[-1][0], sha("".join(a + b for a, b in path)), h, h == top[-1][0]))
    return sorted(out, key=str)


MANIFEST = "doc_id bigint, source string, lang string, n_chars bigint, text string"


@pytest.mark.parametrize("rows", [
    [(7, "a", "en", 3, "Abc")],                                                     # a lone leaf is the root
    [(i, None, "en", i, f"Text {i}") for i in range(9)],                            # a last run of one
    [(i, "s", f"l{i % 70:02}" if i % 11 else None, None, f"T{i}") for i in range(300)],      # more than 64 groups
    [(i, "s", "en" if i % 5 else "de", i, "Hot" * (i % 4)) for i in range(5200)],   # two forests above the blocks
    [(r[0], r[3], r[2], None, r[1]) for r in edge_rows()],
])
def test_manifest_against_brute_force(spark, rows):
    docs = spark.createDataFrame(rows, MANIFEST).repartition(5).withColumns({c: F.lit(c) for c in ("pos", "n", "leaf", "root", "path", "hash", "block", "at", "part", "tie")})
    got = sorted((tuple(r) for r in merkle.digests(merkle.manifest(docs)).collect()), key=str)
    assert got == manifest_by_hand(rows)


def test_versions_share_all_but_the_ancestors(spark):
    rows = [(i, "s", "en", i, f"Text {i}") for i in range(700)]
    found = {r["pos"]: r for r in merkle.manifest(spark.createDataFrame(rows, MANIFEST)).collect()}
    levels = climb([found[i]["leaf"] for i in range(700)])
    assert {r["root"] for r in found.values()} == {levels[-1][0]}
    changed = [r for r in found.values() if r["changed"]]
    assert len(changed) == sum(zlib.crc32(str(i).encode()) % 3 == 0 for i in range(700))
    for r in changed:
        version = [list(x) for x in levels]
        i, version[0][r["pos"]] = r["pos"], r["changed"]
        for k, node in enumerate(r["copied"], 1):
            i //= 8
            assert node == sha("".join(version[k - 1][i * 8:i * 8 + 8]))
            version[k][i] = node
        assert len(r["copied"]) == len(levels) - 1
        assert sum(a != b for x, y in zip(levels, version, strict=True) for a, b in zip(x, y, strict=True)) == len(levels)


def test_manifest_empty(spark):
    assert merkle.manifest(spark.createDataFrame([], MANIFEST)).collect() == []


def test_numbering_spreads_one_group_over_partitions(spark):
    df = spark.range(10_000).select(F.lit("one").alias("g"), (10_000 - F.col("id")).alias("k"))
    got = common.numbered(df, ["g"], ["k"])
    assert sorted((r["k"], r["pos"], r["n"]) for r in got.collect()) == [(k, k - 1, 10_000) for k in range(1, 10_001)]


# ---------------------------------------------------------------------------- repair
SPACE = " \t\n\x0b\x0c\r"


def damage_by_hand(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if k == 0:
            continue
        text = "" if k == 1 else "".join(c for c in text if c not in ".!?") if k == 2 else text
        out += [(conv, turn, "user" if k == 4 else role, text, i) for i in range(2 if k == 3 else 1)]
    return out


def search(symbols):
    """All edits of a short conversation, tried one by one: (cost, audit)."""
    best = (1 << 30, "")

    def go(i, seen, cost, audit):
        nonlocal best
        if (cost, audit) > best and cost >= best[0]:
            return
        if i == len(symbols) and (seen == "" or seen.removeprefix("s") == "ua" * (len(seen.removeprefix("s")) // 2) and len(seen.removeprefix("s")) > 0):
            best = min(best, (cost, audit))
        if audit[-2:] != "II":
            for x in "ua":
                go(i, seen + x, cost + 2, audit + "I")
        if i < len(symbols):
            role, must_go, cut = symbols[i]
            go(i + 1, seen, cost + 3, audit + "D")
            if not must_go:
                go(i + 1, seen + role, cost + cut, audit + "K")
                for x in "ua":
                    go(i + 1, seen + x, cost + 2 + cut, audit + "R")

    def fits(seen):
        rest = seen.removeprefix("s")
        return all(c == "ua"[k % 2] for k, c in enumerate(rest))

    inner = go
    def go(i, seen, cost, audit):      # noqa: F811  prune prefixes that no pattern has
        if fits(seen):
            inner(i, seen, cost, audit)

    go(0, "", 0, "")
    return best


def repair_by_hand(rows, cheapest):
    out = []
    damaged = damage_by_hand(rows)
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in damaged if r[0] == conv), key=lambda r: (by_null(r[1]), r[2], sha(f"{len(r[2])}:{r[2]}{r[3]}"), r[4]))
        seen, symbols, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, _, role, text, _ in mine:
            core = text.strip(SPACE)
            fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            symbols.append((role[:1] if role[:1] in ("s", "u", "a") else "o", fault in ("blank", "duplicate"), int(fault == "truncated")))
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(mine))
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit = cheapest(symbols)
        lines, k, side = [], 0, "user"
        for x in audit:
            role, text = ("", "") if x == "I" else mine[k][2:4]
            k += x != "I"
            if x == "D":
                continue
            if x == "K" and role[:1] == "s":
                lines.append(role + ":" + text)
                continue
            lines.append((role if x == "K" else side) + ":" + text)
            side = "assistant" if side == "user" else "user"
        out.append((conv, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, sha("\n".join(lines))))
    return sorted(out, key=str)


def repair_rows(df):
    return sorted((tuple(r) for r in df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()), key=str)


CONV = "conv_id bigint, turn bigint, role string, text string"


def symbol(role, must_go, cut):
    return "x" if must_go else role.upper() if cut else role


def by_library(symbols):
    """The same dynamic programme one row at a time, without runs, powers, caches or segments."""
    best = {0: (0, "")}
    for role, must_go, cut in symbols:
        new = {}
        for state, (cost, audit) in best.items():
            paid, letters, s = cost, audit, state
            for _ in range(3):
                for x, c, t in repair.edits(symbol(role, must_go, cut), s):
                    new[t] = min(new.get(t, (1 << 60, "")), (paid + c, letters + x))
                paid, letters, s = paid + 2, letters + "I", repair.TURN[s]
        best = new
    return min((c + repair.END[s], a + "I" * (repair.END[s] // 2)) for s, (c, a) in best.items())


@pytest.mark.parametrize("seed", range(3))
def test_cheapest_edits_against_search(seed):
    r = random.Random(seed)
    for _ in range(60):
        symbols = [(r.choice("suao"), r.random() < .2, int(r.random() < .3)) for _ in range(r.randrange(6))]
        text = "".join(symbol(*s) for s in symbols)
        for size in (1, 2, 100):
            cut = [text[i:i + size] for i in range(0, len(text), size)]
            assert repair.repair([(c, repair.advance(c)) for c in cut]) == search(symbols)
        assert by_library(symbols) == search(symbols)


def test_long_runs_use_powers():
    for text in ("u" * 5000, "a" * 4097 + "x" * 1023 + "O" * 77, "sua" + "u" * 999 + "A" * 2048):
        symbols = [(c.lower() if c != "x" else "u", c == "x", int(c.isupper())) for c in text]
        assert repair.runs(text) == [(k, len(list(g))) for k, g in itertools.groupby(text)]
        cut = [text[i:i + 1000] for i in range(0, len(text), 1000)]
        assert repair.repair([(c, repair.advance(c)) for c in cut]) == by_library(symbols)


def conversations(seed, n, longest):
    r = random.Random(seed)
    says = ["Hello there.", "What? ", "no end", "", " ", "Same.", "Same.", "wait...\n", None, "ünï!", "x" * 40 + "."]
    rows = [(c if c else None, t if r.random() < .9 else None, r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), r.choice(says))
            for c in range(n) for t in range(r.randrange(1, longest))]
    return rows + rows[:3]


@pytest.mark.parametrize("segment", [4096, 3])
def test_repair_against_brute_force(spark, monkeypatch, segment):
    """Small segments put every conversation's rows, duplicates and runs across many of them."""
    monkeypatch.setattr(repair, "SEGMENT", segment)
    rows = conversations(segment, 60, 14) + [(1000, 1, "user", "Lost."), (1001, 5, "user", "a\tb\x0c")]
    rows += [(2000, t, "user" if t % 2 else "assistant", f"T {t % 50}.") for t in range(400)]
    df = spark.createDataFrame(rows, CONV).repartition(7).withColumns({c: F.lit(c) for c in ("kind", "seg", "pos", "copy", "said", "head", "symbols", "audit", "c", "p")})
    assert repair_rows(repair.repaired(repair.damaged(df))) == repair_by_hand(rows, by_library)


def test_conversation_without_rows(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "Hi.")]
    assert repair_rows(repair.repaired(repair.damaged(spark.createDataFrame(rows, CONV)))) == [(gone, 0, 0, 0, 0, 0, 0, "", sha(""))]
    assert repair.repaired(repair.damaged(spark.createDataFrame([], CONV))).collect() == []


def test_very_long_text(spark):
    rows = [(1, 1, "user", PROSE * 8000 + "."), (1, 2, "assistant", "y" * 2_000_000 + "!")]
    assert repair_rows(repair.repaired(repair.damaged(spark.createDataFrame(rows, CONV)))) == repair_by_hand(rows, by_library)
