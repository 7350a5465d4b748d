"""Mixing sources to target weights, with DataFrame functions only.

A document's size is its number of words. Sources in code-point order, null last, get weights from a repeating
cycle; each source's target is its weight's share of all words, held to a cap of so many times the source's own
size, and what is cut off goes to the other sources by weight until none is above its cap. A source's repetition
rate is target / size; each document is taken floor(rate) times, plus once more with the fraction's probability,
drawn from a hash of the document and of its source's trial, so reruns agree. Of so many trials, each a draw of the
whole source, a source keeps the one whose words come nearest its target: a single draw of a small source with a few
long texts may miss it by a quarter.

Defined results: null or blank text has size 0 and is copied like the rest; null is a source of its own; a source
without words has target 0 and is not taken; an empty table gives no rows; repeated rows draw alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import DOCUMENT, WORD, cut, keep, pick

#: The source table is broadcast up to so many sources (under 10 MB); beyond, it is joined by salted keys.
BROADCAST_SOURCES = 50_000
SALTS = 32
#: Draws that a source chooses from.
TRIALS = 256


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, cycle=(1, 2, 3), cap: float = 3.0) -> DataFrame:
    """(source, source_size, target), one row a source. The windows run over sources, not documents.

    In the order of cap ratio, a source is capped if the level shared by it and those after it would lift it
    above its cap; once one isn't, none after it is. All of this is one pass, so no loop is needed.
    """
    by = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    weights = F.array(*[F.lit(float(w)) for w in cycle])
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    by = by.withColumn("weight", F.element_at(weights, ((rank - 1) % len(cycle) + 1).cast("int")))
    by = by.withColumn("most", F.col("source_size") * F.lit(float(cap)))
    whole = Window.partitionBy()
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0.0)
    by = by.withColumn("total", F.sum("source_size").over(whole).cast("double")).withColumn("all_weight", F.sum("weight").over(whole))
    left = F.col("total") - F.coalesce(F.sum("most").over(before), none)
    left_weight = F.col("all_weight") - F.coalesce(F.sum("weight").over(before), none)
    by = by.withColumn("capped", F.col("weight") * left > F.col("most") * left_weight)
    held = F.sum(F.when(F.col("capped"), F.col("most")).otherwise(none)).over(whole)
    held_weight = F.sum(F.when(F.col("capped"), F.col("weight")).otherwise(none)).over(whole)
    free = F.col("weight") * (F.col("total") - held) / (F.col("all_weight") - held_weight)
    return by.select("source", "source_size", F.when(F.col("capped"), F.col("most")).otherwise(F.coalesce(F.least(free, F.col("most")), none)).alias("target"))


def _with_target(rows: DataFrame, targets: DataFrame, few: bool) -> DataFrame:
    """rows (source, draw, ..) with their source's row of targets."""
    same = F.col("source").eqNullSafe(F.col("target_source"))
    if few:
        return rows.join(F.broadcast(targets), same)
    targets = targets.withColumn("target_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))
    return rows.withColumn("salt", F.pmod("draw", F.lit(SALTS))).join(targets, same & (F.col("salt") == F.col("target_salt"))).drop("salt", "target_salt")


def _drawn() -> Column:
    """Whether a document's copy beyond floor(rate) is taken in the trial."""
    chance = F.pmod(F.shiftrightunsigned(F.xxhash64("draw", "trial"), 11), F.lit(1 << 53)) / F.lit(float(1 << 53))
    return chance < F.col("fraction")


def chosen_trials(sized: DataFrame, targets: DataFrame, trials: int, few: bool) -> DataFrame:
    """(target_source, trial): each source's trial whose words come nearest to what its target wants beyond whole
    copies, ties to the least. Partial sums are a row for each task, source and trial, whatever a source's size."""
    rows = _with_target(sized, targets.where("fraction > 0"), few)
    rows = rows.withColumn("trial", F.explode(F.sequence(F.lit(0), F.lit(trials - 1))))
    sums = rows.groupBy("target_source", "trial").agg(F.sum(F.when(_drawn(), F.col("size")).otherwise(0)).alias("words"), F.first(F.col("fraction") * F.col("source_size")).alias("wanted"))
    best = sums.groupBy("target_source").agg(F.min(F.struct(F.abs(F.col("words") - F.col("wanted")).alias("off"), "trial")).alias("m"))
    return best.select(F.col("target_source").alias("of"), "m.trial")


def plan_mix(docs: DataFrame, cycle=(1, 2, 3), cap: float = 3.0, seed: int = 17, trials: int = TRIALS, broadcast_sources: int = BROADCAST_SOURCES) -> DataFrame:
    """Documents with size, source_size, target and copies (how often the mix takes each)."""
    docs = pick(docs, DOCUMENT).withColumn("size", word_count(F.col("text"))).withColumn("draw", F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("source"), F.col("text")))
    sized = keep(docs.select("source", "size", "draw"), "sizes")
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(cap)))).otherwise(F.lit(0.0))
    targets = cut(source_targets(sized, cycle, cap).withColumnRenamed("source", "target_source").withColumn("whole", F.floor(rate)).withColumn("fraction", rate - F.floor(rate)))
    few = targets.count() <= broadcast_sources
    chosen = chosen_trials(sized, targets, trials, few)
    targets = targets.join(chosen, F.col("target_source").eqNullSafe(F.col("of")), "left").drop("of").withColumn("trial", F.coalesce("trial", F.lit(0)))
    copies = F.col("whole") + F.when(_drawn(), 1).otherwise(0)
    return _with_target(docs, cut(targets), few).select(*DOCUMENT, "size", "source_size", "target", copies.cast("long").alias("copies"))


def mix(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: each document as often as the plan takes it, with the columns of documents."""
    planned = plan_mix(docs, **how).where("copies > 0")
    return planned.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*DOCUMENT)


def query(spark, sf_dir: str) -> DataFrame:
    planned = plan_mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return planned.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
