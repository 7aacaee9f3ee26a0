"""The corpus pipeline: quality rules, near duplicates, decontamination, personal data, mixing.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor
kept; the stages before the last return the columns of ``documents``.  ``run``
writes every stage's result as Parquet to the shared folder and reads it again, so a
lost executor never costs more than the running stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from landstage.llm import decontam, minhash, mixing, pii, repetition
from landstage.llm.common import materialise

#: The field that finds personal data, and so the redacted words and their counts,
#: cannot be expressed in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base and repetition rules; null and empty texts go."""
    return repetition.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    Rows with a null id belong to no group and stay.  Rows that repeat an id are documents
    of their own: each distinct text among them is judged under a key of its text, after all
    ids that occur once (so it stays only if no such document is in its group), and of rows
    equal in id and text the first in the order of the other columns stays.  Without repeated
    ids the key is the id, and the texts are shuffled once, to a hash join that builds on the
    keys that go.
    """
    key, columns = "near_dedup key", docs.columns
    own = docs.where("doc_id is not null")
    repeated = materialise(own.groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated-ids")
    if repeated.isEmpty():
        found = materialise(minhash.near_duplicates(own), "near-duplicates")
        return docs.join(found.where("not kept").select("doc_id").hint("shuffle_hash"), "doc_id", "left_anti").select(columns)
    marked = docs.join(repeated.withColumn(key + " again", F.lit(True)), "doc_id", "left")
    late = F.lit(1 << 62).bitwiseOR(F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << 62) - 1)))
    keyed = materialise(marked.select(*columns, F.when(F.col(key + " again"), late).otherwise(F.col("doc_id")).alias(key)), "keyed")
    found = materialise(minhash.near_duplicates(keyed.where("doc_id is not null"), id_col=key), "near-duplicates")
    gone = found.where("not kept").select(F.col("doc_id").alias(key)).distinct()
    left = keyed.join(gone.hint("shuffle_hash"), key, "left_anti")
    again = left.where(F.col(key) >= 1 << 62).withColumn("place", F.row_number().over(W.partitionBy(key).orderBy(*[c for c in columns if c not in ("doc_id", "text")], "doc_id")))
    return left.where(F.col(key).isNull() | (F.col(key) < 1 << 62)).select(columns).union(again.where("place = 1").select(columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no benchmark item."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked in the text; ``n_chars`` follows the new text."""
    out = pii.redact(docs, pii.train(docs))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: which document is read in which epoch and place."""
    return mixing.mix(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("source_mixing", source_mixing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
