"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing column names."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from landstage.llm import decontam, langid, lm, minhash, mixing, pii, quality, repetition, suffix, warc
from landstage.llm.common import WORD
from tests.llm.data import CLASH, PROSE, edge_docs, edge_rows, empty_docs

N = len(edge_rows())


def ids(rows):
    return sorted((r["doc_id"] for r in rows), key=lambda x: (x is None, x))


ALL_IDS = sorted((r[0] for r in edge_rows()), key=lambda x: (x is None, x))


def test_near_duplicates(spark):
    rows = minhash.near_duplicates(edge_docs(spark)).collect()
    assert ids(rows) == ALL_IDS
    by = {(r["doc_id"], r["n_shingles"]): r for r in rows}
    assert by[1, 0]["kept"] and by[2, 0]["kept"] and by[3, 0]["kept"]
    assert [r["component_id"] for r in rows if r["doc_id"] == 4] == [4, 4]
    assert by[5, by_size(by, 5)]["component_id"] == 4 and not by[5, by_size(by, 5)]["kept"]
    assert by[8, 1]["component_id"] == 7 and by[7, 1]["kept"]
    assert minhash.near_duplicates(empty_docs(spark)).collect() == []


def by_size(by, doc):
    return next(n for d, n in by if d == doc)


def test_decontamination(spark):
    items = spark.createDataFrame([(1, PROSE), (1, PROSE), (2, None), (3, "one two"), (None, PROSE), (4, "")], "item_id bigint, text string")
    rows = decontam.overlaps(edge_docs(spark), items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == {(4, 1), (5, 1), (9, 1)} and len(rows) == 3
    assert {r["best_matches"] for r in rows} == {13}
    kept = decontam.drop_contaminated(edge_docs(spark), items)
    assert kept.columns == edge_docs(spark).columns and kept.count() == N - 4
    assert decontam.overlaps(empty_docs(spark), items).collect() == []
    assert decontam.overlaps(edge_docs(spark), items.where("item_id > 99")).collect() == []


def test_personal_data(spark):
    docs = edge_docs(spark)
    model = pii.train(docs)
    rows = pii.personal_data(docs, model).collect()
    assert ids(rows) == ALL_IDS
    got = next(r for r in rows if r["doc_id"] == 11)
    assert (got["n_email"], got["n_ip"], got["n_card"], got["n_phone"]) == (1, 1, 1, 1)
    empty = hashlib.sha256(b"").hexdigest()
    assert all(r["base_sha256"] == empty for r in rows if r["doc_id"] in (1, 2, 3, 4, 6))
    out = pii.redact(docs, model)
    assert out.columns == docs.columns
    text = {r["doc_id"]: r["text"] for r in out.where("doc_id in (1, 2, 11)").collect()}
    assert text[1] is None and text[2] == "" and text[11] == "mail me at <email> or <phone> or <ip> card <card>"
    nothing = pii.train(empty_docs(spark))
    assert pii.personal_data(empty_docs(spark), nothing).collect() == []
    assert len(pii.personal_data(docs, nothing).collect()) == N


def test_personal_data_sample_counts_the_rows_that_qualify(spark):
    """Few rows with digits among very many without: all of them are training texts."""
    many = spark.range(60_000).selectExpr("id as doc_id", "'no digits in this one' as text")
    few = spark.range(60_000, 60_040).selectExpr("id as doc_id", "concat('call +1 (743) 555-38', 10 + id % 80, ' or 10.1.2.', id % 200) as text")
    assert pii.train(many.union(few), sample=20).names and not pii.train(many, sample=20).names


def test_quality(spark):
    docs = edge_docs(spark)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 12)] + [(4, None, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    rows = quality.classify(docs, quality.train(docs, labels)).collect()
    assert ids(rows) == ALL_IDS and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert all(r["held_out"] for r in rows if r["doc_id"] is None)
    none = quality.train(docs, labels.where("false"))
    assert {r["score"] for r in quality.classify(docs, none).collect()} == {0.5}
    assert quality.classify(empty_docs(spark), none).collect() == []


def test_mixing(spark):
    rows = mixing.mix(edge_docs(spark)).collect()
    assert not {1, 2, 3} & {r["doc_id"] for r in rows}
    assert {r["source"] for r in rows} <= {"a", "b", "c", None} and len({(r["source"], r["epoch"], r["block_rank"], r["doc_rank"]) for r in rows}) == len(rows)
    assert mixing.mix(empty_docs(spark)).collect() == []


def test_language(spark):
    docs = edge_docs(spark)
    rows = langid.identify(docs, langid.train(docs)).collect()
    assert ids(rows) == ALL_IDS
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in rows if r["doc_id"] in (1, 2, 3))
    assert all(r["lang_pred"] in ("en", "de") for r in rows if r["doc_id"] in (4, 6, 9, 10))
    none = langid.train(empty_docs(spark))
    assert {r["lang_pred"] for r in langid.identify(docs, none).collect()} == {"und"}
    assert langid.identify(empty_docs(spark), none).collect() == []


def test_language_of_long_texts_only(spark):
    """Languages whose labelled texts are all long, or few among many empty ones, are learned too."""
    r = random.Random(3)
    text = lambda letters, n: " ".join("".join(r.choice(letters) for _ in range(5)) for _ in range(n))
    rows = [(i, text("abcdefg", 60), "short") for i in range(20)] + [(i, text("hijklmn", 4_000), "long") for i in range(20, 40)]
    rows += [(i, text("tuvwxyz", 60), "rare") for i in range(40, 48)] + [(i, "", "rare") for i in range(100, 2_100)]
    rows += [(i, text("hijklmn", 60), None) for i in range(50, 55)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = langid.train(docs, sample=10)
    assert set(model.langs) == {"short", "long", "rare"}
    got = {x["doc_id"]: x["lang_pred"] for x in langid.identify(docs.where("text <> ''"), model).collect()}
    assert got == {i: lang or "long" for i, t, lang in rows if t}


def test_revisits(spark):
    schema = "record_id bigint, kind string, url string, at bigint, etag string, last_modified string, digest string, headers map<string,string>"
    data = [(1, "response", "http://a.org/x", 10, '"t"', "m", "d1", {"A": "1", "Content-Length": "9"}), (2, "revisit", "https://www.A.org/x/#f", 20, 'W/"t"', None, None, {"a": "2", "Content-Length": "0"}),
            (3, "revisit", "http://a.org/x", 10, '"t"', None, None, None), (4, "revisit", None, 30, '"t"', None, None, None), (5, "revisit", "http://a.org/x?utm_source=q", 99_999, None, None, None, None),
            (6, "revisit", "http://a.org/x", 30, None, "other", None, {}), (2, "revisit", "https://www.A.org/x/#f", 20, 'W/"t"', None, None, {"a": "2", "Content-Length": "0"}), (7, "request", "http://a.org/x", 5, None, None, None, None)]
    df = spark.createDataFrame(data, schema).withColumns({c: F.lit(c) for c in ("page", "slot", "own", "base", "full")})
    rows = [(r["record_id"], r["outcome"], r["refers_to"], r["headers"]) for r in warc.resolve_revisits(df).orderBy("record_id").collect()]
    two = (2, "resolved", 1, {"a": "2", "content-length": "9"})
    assert rows == [two, two, (3, "orphan", None, None), (4, "orphan", None, None), (5, "unverified", 1, {"a": "1", "content-length": "9"}), (6, "changed", 1, None)]
    assert warc.resolve_revisits(df.where("false")).collect() == []
    assert {r["outcome"] for r in warc.resolve_revisits(df.where("kind = 'revisit'")).collect()} == {"orphan"}


def test_repetition(spark):
    docs = edge_docs(spark)
    rows = repetition.quality_rules(docs).collect()
    assert ids(rows) == ALL_IDS
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["n_words"] == 0 and by[1]["base_failed"] and not by[1]["kept"]
    assert by[4]["kept"] and by[6]["kept"] and not by[10]["kept"] and by[10]["longest_repeat"] == 4999
    kept = repetition.keep_good(docs)
    assert kept.columns == docs.columns and ids(kept.select("doc_id").collect()) == ids([r for r in rows if r["kept"]])
    assert repetition.quality_rules(empty_docs(spark)).collect() == []


def test_suffix(spark):
    rows = suffix.without_repeats(edge_docs(spark)).collect()
    assert ids(rows) == ALL_IDS
    kept = {(r["doc_id"], r["n_bytes"]): bytes(r["kept"]) for r in rows}
    size = len(PROSE.encode())
    assert kept[1, 0] == b"" and kept[4, size] == PROSE.encode() and kept[5, size] == b""
    assert [bytes(r["kept"]) for r in rows if r["doc_id"] is None and r["n_bytes"]] == [(PROSE + " one").encode()]
    assert suffix.without_repeats(empty_docs(spark)).collect() == []


def test_suffix_buckets_grow_with_the_input(spark, monkeypatch):
    docs = edge_docs(spark).where("doc_id <> 6")
    want = sorted(map(tuple, suffix.without_repeats(docs).collect()), key=repr)
    monkeypatch.setattr(suffix, "BUCKET_BYTES", 16)
    assert suffix.buckets_for(docs) > 300 and suffix.buckets_for(empty_docs(spark)) == max(suffix.BUCKETS, 8)
    assert sorted(map(tuple, suffix.without_repeats(docs).collect()), key=repr) == want


def test_language_model(spark):
    rows = lm.backoff_scores(edge_docs(spark)).collect()
    assert ids(rows) == sorted({*ALL_IDS} - {None}) + [None]
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["n_words"] == 0 and by[1]["log10_total"] is None and by[4]["log10_total"] < 0
    assert by[4]["n_words"] == 2 * len(PROSE.split()) and by[4]["log10_mean"] == pytest.approx(by[5]["log10_mean"])
    assert lm.backoff_scores(empty_docs(spark)).collect() == []


def test_language_model_after_many_empty_texts(spark):
    """More wordless rows in one partition than 16 bits number, stored before the texts."""
    empty = spark.range(1_000, 71_000, 1, 1).selectExpr("id as doc_id", "if(id % 2 = 0, '', cast(null as string)) as text")
    texts = spark.createDataFrame([(i, f"{PROSE} tail{i % 3} end{i}") for i in range(12)], "doc_id bigint, text string").coalesce(1)
    want = {r["doc_id"]: r for r in lm.backoff_scores(texts).collect()}
    got = {r["doc_id"]: r for r in lm.backoff_scores(empty.union(texts).coalesce(1)).collect()}
    assert len(got) == 70_012 and all(r["n_words"] == 0 and r["log10_total"] is None for d, r in got.items() if d >= 1_000)
    assert all(got[d]["n_words"] == r["n_words"] and got[d]["log10_total"] == pytest.approx(r["log10_total"]) for d, r in want.items())


def test_language_model_buckets_grow_with_the_corpus(spark, monkeypatch):
    assert lm.buckets_for(spark, 5_000 * lm.BUCKET_WORDS) == 5_000
    docs = edge_docs(spark).where("doc_id <> 6")
    want = {r["doc_id"]: r["log10_total"] for r in lm.backoff_scores(docs).collect()}
    monkeypatch.setattr(lm, "BUCKET_WORDS", 1)
    got = {r["doc_id"]: r["log10_total"] for r in lm.backoff_scores(docs).collect()}
    assert got.keys() == want.keys() and all(got[d] == (None if x is None else pytest.approx(x)) for d, x in want.items())


def test_language_model_runs_one_step_of_python_in_a_stage(spark):
    """Two in one stage would keep two workers for every core, each as large as its largest step."""
    plan = lm.backoff_scores(edge_docs(spark))._jdf.queryExecution().executedPlan().toString()
    steps = re.findall(r"MapInArrow|FlatMapGroupsInArrow|Exchange", plan)
    assert steps[:6] == ["Exchange", "FlatMapGroupsInArrow"] * 2 + ["Exchange", "MapInArrow"] and "InArrow" not in "".join(steps[6:])


def test_packed_arrays_are_read_where_they_are():
    column = pa.chunked_array([[b"ab", b""], [b"cdef"]])
    cells = lm._cells(column)
    assert [x.to_pybytes() for x in cells] == column.to_pylist()
    assert [cells[0].address, cells[2].address] == [c.buffers()[2].address for c in column.chunks]
    for kind in (pa.binary(), pa.large_binary()):
        part = pa.array([b"x", b"yy", b"", b"zzz"], kind).slice(1)
        assert [x.to_pybytes() for x in lm._cells(part)] == part.to_pylist() and lm._cells(part.slice(3)) == []
        assert [x.to_pybytes() for x in lm._cells(pa.array([b"", b""], kind))] == [b"", b""]
    assert lm._wide(pa.py_buffer(lm._small(np.array([3, 70_000])))).tolist() == [3, 70_000]
    assert lm._from_ids(pa.py_buffer(lm._ids(np.array([5, 9, 9])))).tolist() == [5, 9, 9] and not len(lm._from_ids(cells[1]))
    assert not len(np.frombuffer(cells[1], np.float64)) and not len(lm._from_names(cells[1]))


def test_header_names_that_differ_by_case(spark):
    full = {"Date": "a", "date": "b", "DATE": "c", "X-One": "1"}
    rows = [(1, "response", "http://h/p?x=" + "y" * 1_200_000, 10, '"t"', None, "d", full),
            (2, "revisit", "http://h/p?x=" + "y" * 1_200_000, 20, 'W/"t"', None, None, {"AGE": "5", "Age": "6", "ETag": "no"}),
            (3, "revisit", "http://h/p?x=" + "y" * 1_199_999 + "z", 20, None, None, None, None)]
    got = {r["record_id"]: r for r in warc.resolve_revisits(spark.createDataFrame(
        rows, "record_id bigint, kind string, url string, at bigint, etag string, last_modified string, digest string, headers map<string,string>")).collect()}
    assert got[2]["outcome"] == "resolved" and got[2]["headers"] == {"age": "6", "date": "b", "x-one": "1"}
    assert got[3]["outcome"] == "orphan"                   # the URL differs after its first million characters


def test_near_dedup_of_different_texts_under_one_id(spark):
    other = " ".join(f"w{i}" for i in range(60))
    rows = [(1, PROSE, "en", "a"), (2, PROSE + " end", "en", "a"), (2, other, "en", "b"), (2, other, "en", "a"), (3, other + " x", "de", "c"), (4, "alone " * 9, "en", "a"),
            (None, PROSE, "en", "a"), (None, PROSE, "en", "a"), (9, "only repeated here", "en", "b"), (9, "only repeated here", "en", "a")]
    for seed in range(2):
        docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").repartition(3 + seed)
        got = sorted(map(tuple, corpus_pipeline.near_dedup(spark, docs, "").collect()), key=str)
        # 2's first text is a copy of 1's; its second one of 3's, whose id occurs once; 9's two rows are equal in id and text
        assert got == sorted([rows[0], rows[4], rows[5], rows[6], rows[7], rows[9]], key=str)


def test_repetition_memory_is_bounded():
    """2 MB of one letter, of one line and of prose: peak bytes for each character."""
    import tracemalloc

    import pyarrow as pa

    from landstage.llm import common
    common.powers(1), common.powers(1, True)
    for text, most in (("a" * 2_000_000, 220), (("the same line again\n" * 110_000)[:2_000_000], 220), (PROSE * 10 + "".join(random.Random(1).choices("abcdefgh ", k=2_000_000)), 110)):
        tracemalloc.start()
        repetition.judge(common.flat(pa.array([text])))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < most * len(text)
    assert all(len(x) <= common.CHUNK_BYTES + 4096 for x in common._powers.values())


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages(spark, tmp_path, name, stage):
    spark.createDataFrame([(1, "no such words here " * 5)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = edge_docs(spark)
    if name == "source_mixing":
        assert stage(spark, docs, str(tmp_path)).count() > 0
        assert stage(spark, empty_docs(spark), str(tmp_path)).count() == 0
        return
    out = stage(spark, docs, str(tmp_path))
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    n = {"near_dedup": N - 4, "decontamination": N, "personal_data": N}.get(name)
    assert n is None or out.count() == n
    assert stage(spark, empty_docs(spark), str(tmp_path)).count() == 0


def test_words_pattern():
    assert WORD == r"[^\x20\x09-\x0D]+" and "kept" in CLASH
