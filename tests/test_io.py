import hashlib

import pyspark.sql.functions as F
import pytest

from landstage.sinks import copy_files, copy_parquet_tree, json_documents, write_json, write_table
from landstage.sources import discover_files, read_paths, read_tree


def test_discover_read_and_copy_tree(spark, tmp_path):
    src = tmp_path / "src"
    a = spark.range(5).withColumn("x", F.lit("a"))
    b = spark.range(3).withColumn("y", F.lit(1.5))
    a.write.parquet(str(src / "one" / "a.parquet"))
    b.write.parquet(str(src / "two" / "b.parquet"))
    (src / "notes.txt").write_text("not parquet")
    files = discover_files(spark, str(src))
    rel = [r.relative for r in files.collect()]
    assert rel and all(".parquet" in p for p in rel)
    assert not any(p.endswith("notes.txt") for p in rel)
    tree = read_tree(spark, str(src), merge_schema=True)
    assert tree.count() == 8 and {"x", "y", "source_file"} <= set(tree.columns)
    copied = copy_parquet_tree(spark, str(src), str(tmp_path / "dst"))
    counts = {r.d: r.n for r in read_tree(spark, str(tmp_path / "dst"), merge_schema=True).groupBy(F.regexp_extract("relative", "^(one|two)", 1).alias("d"))
              .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts == {"one": 5, "two": 3}
    # names, folders and bytes are the same; each table keeps its own schema
    for r in copied.collect():
        data = (src / r.relative).read_bytes()
        assert (tmp_path / "dst" / r.relative).read_bytes() == data and r.copied == r.length == len(data) and r.sha256 == hashlib.sha256(data).hexdigest()
    assert sorted(r.relative for r in copied.collect()) == sorted(rel)
    assert spark.read.parquet(str(tmp_path / "dst" / "two" / "b.parquet")).columns == ["id", "y"]
    assert read_paths(spark, [str(src / "one" / "a.parquet"), str(src / "two" / "b.parquet")],
                      mergeSchema="true").count() == 8


def test_append_table_twice(spark, tmp_path):
    df = spark.range(4).withColumn("k", F.col("id") % 2)
    write_table(df, "t_append_test", path=str(tmp_path / "t"))
    write_table(df, "t_append_test", path=str(tmp_path / "t"))
    assert spark.table("t_append_test").count() == 8
    spark.sql("DROP TABLE t_append_test")


def test_json_documents_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("id1", 1.5, None, ["a"], True)],
                               "id string, created double, author string, tags array<string>, o18 boolean")
    docs = json_documents(df, ["id", "created", "author", ("treatment_tags", F.col("tags")), "o18"],
                          as_text=["author"])
    write_json(docs, str(tmp_path / "j"))
    back = spark.read.json(str(tmp_path / "j")).first()
    assert back.id == "id1" and back.treatment_tags == ["a"] and back.o18 is True


def test_tree_paths_are_safe_and_shared(spark, tmp_path):
    """Spaces, a repeated root name, empty files and parts without an extension: found, read and copied alike."""
    root = tmp_path / "my data" / "data"
    spark.range(3).coalesce(1).write.parquet(str(root / "x.parquet"))
    spark.range(2).coalesce(1).write.parquet(str(root / "sub" / "data" / "x.parquet"))
    spark.range(0).coalesce(1).write.parquet(str(root / "empty one.parquet"))
    part = next((root / "x.parquet").glob("part-*"))
    part.rename(root / "x.parquet" / "part-0000")
    found = {r.relative for r in discover_files(spark, str(root)).collect() if "_SUCCESS" not in r.relative}
    assert "x.parquet/part-0000" in found and any(p.startswith("sub/data/x.parquet/part-") for p in found) and len(found) == 3
    counts = {r.relative: r.n for r in read_tree(spark, str(root)).groupBy("relative").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sorted(counts.values()) == [2, 3] and counts["x.parquet/part-0000"] == 3 and set(counts) < found
    copied = copy_parquet_tree(spark, str(root), str(tmp_path / "copy"))
    assert {r.relative for r in copied.collect()} == found
    assert {r.relative: r.n for r in read_tree(spark, str(tmp_path / "copy")).groupBy("relative").agg(F.count(F.lit(1)).alias("n")).collect()} == counts


def test_tree_is_listed_level_by_level(spark, tmp_path):
    """Deep and wide trees, hidden names; the same files as Spark's own index finds."""
    for p in ("a/b/c/d/e/deep.parquet", "a/x.parquet", "top.parquet", "a/_temporary/0/y.parquet", "a/.z.parquet.crc", "_SUCCESS", "k=_v/p.parquet", "_k=1/q.parquet", "plain.txt", "a.parquet/part-0"):
        (tmp_path / p).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / p).write_bytes(p.encode())
    for i in range(40):
        (tmp_path / f"wide/{i}").mkdir(parents=True)
        (tmp_path / f"wide/{i}/f.parquet").write_bytes(b"x" * (i + 1))
    got = {r.relative: (r.path, r.length) for r in discover_files(spark, str(tmp_path)).collect()}

    def nothing(uri):
        raise OSError("no store for this scheme")

    index = {r.relative: (r.path, r.length) for r in discover_files(spark, str(tmp_path), store=nothing).collect()}
    assert got == index and len(got) == 40 + 6 and got["wide/7/f.parquet"][1] == 8
    with pytest.raises(ValueError, match="pass a store"):
        copy_parquet_tree(spark, str(tmp_path), str(tmp_path / "copy"), store=nothing)


def test_copy_replaces_files_and_fails_on_a_changed_source(spark, tmp_path):
    (tmp_path / "s").mkdir()
    (tmp_path / "s/a.parquet").write_bytes(b"new")
    (tmp_path / "d").mkdir()
    (tmp_path / "d/a.parquet").write_bytes(b"old bytes")
    (tmp_path / "d/b.parquet").write_bytes(b"stays")
    copy_parquet_tree(spark, str(tmp_path / "s"), str(tmp_path / "d"))
    assert sorted((p.name, p.read_bytes()) for p in (tmp_path / "d").iterdir()) == [("a.parquet", b"new"), ("b.parquet", b"stays")]
    stale = discover_files(spark, str(tmp_path / "s")).withColumn("length", F.lit(99).cast("bigint"))
    with pytest.raises(Exception, match="the manifest has 99 bytes"):
        copy_files(stale, f"file:{tmp_path}/s", f"file:{tmp_path}/d")


def test_merged_schema_needs_one_type_per_name(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "a.parquet"))
    spark.range(2).withColumn("id", F.col("id").cast("string")).write.parquet(str(tmp_path / "b.parquet"))
    with pytest.raises(ValueError, match="id is"):
        read_tree(spark, str(tmp_path), merge_schema=True)


def test_files_outside_the_predicate_are_never_opened(spark, tmp_path):
    spark.range(4).write.parquet(str(tmp_path / "a.parquet"))
    (tmp_path / "broken").write_text("not parquet")
    assert read_tree(spark, str(tmp_path)).count() == 4
    with pytest.raises(FileNotFoundError):
        read_tree(spark, str(tmp_path), contains="nowhere")


def test_json_keeps_null_fields(spark, tmp_path):
    df = spark.createDataFrame([("a", None)], "id string, url string")
    write_json(df, str(tmp_path / "j"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "j")).collect()] == ['{"id":"a","url":null}']


def test_shared_folder_is_required_off_local_masters():
    from landstage.session import ensure_checkpoint_dir

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
