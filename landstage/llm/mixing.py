"""Temperature mixing of sources to target weights (operator 5); DataFrame functions only.

A source with the share p of all words gets the weight p**a / sum(p**a).  The
exponent a is bisected (60 halvings): either to the flattest weights whose most
repeated source is read at most ``max_repeats`` times, or to those whose entropy is
at most ``target_entropy`` nats.  The weights times the budget, rounded, are each
source's words.  They are realised as epochs: every full pass over the source, then
a last partial pass cut where the budget ends.

Order and cut are block permutations.  A source of n documents has about sqrt(n)
blocks by document hash; in each epoch the blocks are permuted by one hash and
the documents of a block by another.  Word counts are summed per block first, so
the running total needs a window over the blocks of a source and one over the
documents of a block; neither sees more than about sqrt(n) rows, however large a
source is.  The weights are one row per source; more than ``MAX_SOURCES`` sources
raise an error, which bounds both the array that is bisected over and the broadcast.

Defined results: documents without words (null, empty) are never in the mix.  A null
source is a source of its own; null ids are mixed like others.  Repeated rows each
take their place.  The last pass stops before the first document that
would exceed the budget.  An empty table gives an empty mix.  Only the id, text and
source columns are read, whatever others are called.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from landstage.llm.common import materialise

HALVINGS = 60
MAX_SOURCES = 100_000
MAX_REPEATS = 2.0
STEEPEST = 16.0         # largest exponent tried for an entropy target


def _number(text: Column) -> Column:
    """60 bits of the MD5 digest, as a number."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def bisected(fits, low: float, high: float) -> Column:
    """Smallest exponent for which ``fits`` holds, given that it holds from some exponent on."""
    def halve(span: Column, _: Column) -> Column:
        mid = (span["lo"] + span["hi"]) / 2
        return F.when(fits(mid), F.struct(span["lo"].alias("lo"), mid.alias("hi"))).otherwise(F.struct(mid.alias("lo"), span["hi"].alias("hi")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(HALVINGS)), F.struct(F.lit(low).alias("lo"), F.lit(high).alias("hi")), halve, lambda span: span["hi"])


def source_plan(counted: DataFrame, max_repeats: float | None = MAX_REPEATS, target_entropy: float | None = None,
                budget_share: float = 1.0) -> DataFrame:
    """One row per source: words, share, weight, budget in words, full epochs and the rest, number of blocks."""
    each = counted.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs"))
    one = each.agg(F.array_sort(F.collect_list(F.struct("source", "tokens", "docs"))).alias("s"))
    one = one.withColumn("s", F.when(F.size("s") > MAX_SOURCES, F.raise_error(F.lit("too many sources"))).otherwise(F.col("s")))
    one = one.withColumn("total", F.aggregate("s", F.lit(0).cast("bigint"), lambda a, x: a + x["tokens"]))
    one = one.withColumn("p", F.transform("s", lambda x: x["tokens"].cast("double") / F.col("total").cast("double")))

    def repeats_fit(a: Column) -> Column:
        z = _sum(F.transform("p", lambda x: F.pow(x, a)))
        return F.lit(budget_share) * F.array_max(F.transform("p", lambda x: F.pow(x, a - 1))) / z <= F.lit(float(max_repeats))

    def entropy_fits(a: Column) -> Column:
        z = _sum(F.transform("p", lambda x: F.pow(x, a)))
        return _sum(F.transform("p", lambda x: -(F.pow(x, a) / z) * F.ln(F.pow(x, a) / z))) <= F.lit(float(target_entropy))

    if target_entropy is not None:
        if not 0 < target_entropy < math.inf:
            raise ValueError("target_entropy must be positive")
        exponent = bisected(entropy_fits, 0.0, STEEPEST)
    else:
        exponent = bisected(repeats_fit, 0.0, 1.0)
    one = one.withColumn("exponent", exponent).withColumn("z", _sum(F.transform("p", lambda x: F.pow(x, F.col("exponent")))))
    rows = one.select("total", "exponent", "z", F.posexplode("s").alias("i", "s"), "p")
    rows = rows.select(F.col("s.source").alias("source"), F.col("s.tokens").alias("tokens"), F.col("s.docs").alias("docs"), "exponent",
                       (F.pow(F.get("p", F.col("i")), F.col("exponent")) / F.col("z")).alias("weight"), "total")
    rows = rows.withColumn("budget", F.floor(F.col("weight") * F.lit(budget_share) * F.col("total") + 0.5).cast("bigint"))
    return rows.select("source", "tokens", "docs", "exponent", "weight", "budget", F.floor(F.col("budget") / F.col("tokens")).cast("bigint").alias("full"),
                       (F.col("budget") % F.col("tokens")).alias("rest"), F.ceil(F.sqrt("docs")).cast("bigint").alias("n_blocks"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        max_repeats: float | None = MAX_REPEATS, target_entropy: float | None = None, budget_share: float = 1.0) -> DataFrame:
    """(doc_id, source, epoch, block_rank, doc_rank, n_tokens): the mix, one row per document and epoch."""
    counted = (docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                           F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("n_tokens")).where("n_tokens > 0"))
    counted = materialise(counted, "word-counts")       # the texts are read once
    plan = source_plan(counted, max_repeats, target_entropy, budget_share).select(F.col("source").alias("plan_source"), "full", "rest", "n_blocks")
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    rows = (counted.join(F.broadcast(plan), F.col("source").eqNullSafe(F.col("plan_source"))).drop("plan_source")
            .withColumn("block", F.pmod(_number(name), F.col("n_blocks")))
            .withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("full")))).where("epoch < full or rest > 0"))
    key = ["source", "epoch", "block"]
    blocks = rows.groupBy(*key).agg(F.sum("n_tokens").alias("in_block"))
    text = F.concat_ws(":", F.col("block").cast("string"), F.col("epoch").cast("string"))
    order = Window.partitionBy("source", "epoch").orderBy(_number(text), "block")
    blocks = (blocks.withColumn("block_rank", F.row_number().over(order).cast("bigint"))
              .withColumn("before", F.sum("in_block").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("in_block"))
              .select(*(F.col(k).alias(f"b_{k}") for k in key), "block_rank", "before"))
    placed = rows.join(blocks, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("epoch") == F.col("b_epoch")) & (F.col("block") == F.col("b_block")))
    inside = Window.partitionBy("source", "epoch", "block").orderBy(_number(F.concat_ws(":", name, F.col("epoch").cast("string"))), "doc_id", "n_tokens")
    placed = placed.withColumn("doc_rank", F.row_number().over(inside).cast("bigint")) \
        .withColumn("upto", F.col("before") + F.sum("n_tokens").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    return placed.where("epoch < full or upto <= rest").select("doc_id", "source", "epoch", "block_rank", "doc_rank", "n_tokens")
