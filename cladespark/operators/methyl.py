"""Methylation sites, dissimilarity of cells to references, and assignment of cell types."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def usable_sites(sites: DataFrame) -> DataFrame:
    """Sites that were read, and no more often methylated than read, with their methylated fraction."""
    return sites.filter("cov > 0 and mc >= 0 and mc <= cov").withColumn("frac", F.col("mc") / F.col("cov"))


def in_context(sites: DataFrame, context: str) -> DataFrame:
    """Sites in the CG context, or in CH: any other that starts with C."""
    cg = F.col("context").startswith("CG")
    return sites.filter(cg if context == "CG" else F.col("context").startswith("C") & ~cg)


def coverage_rates(sites: DataFrame, key: str) -> DataFrame:
    """key, cg_rate, ch_rate: methylated share of all reads in percent; null without reads."""
    cg = F.col("context").startswith("CG")
    ch = F.col("context").startswith("C") & ~cg
    rate = lambda rows: 100 * F.try_divide(F.sum(F.when(rows, F.col("mc"))), F.sum(F.when(rows, F.col("cov"))))
    return sites.groupBy(key).agg(rate(cg).alias("cg_rate"), rate(ch).alias("ch_rate"))


def dissimilarity(cells: DataFrame, refs: DataFrame, min_sites: int = 100, min_reads: int = 1, both: bool = False) -> DataFrame:
    """cell, ref, shared, score: mean absolute difference of fractions over shared sites, times 100.

    All cells meet all references; score is null under ``min_sites``. min_reads holds for the cell's side, or for both.
    """
    cells, refs = usable_sites(cells), usable_sites(refs)
    names = cells.select("cell").distinct().crossJoin(refs.select("ref").distinct())  # names alone
    if min_reads > 1:
        cells = cells.filter(F.col("cov") >= min_reads)
        refs = refs.filter(F.col("cov") >= min_reads) if both else refs
    met = cells.select("cell", "site", F.col("frac").alias("x")).join(refs.select("ref", "site", F.col("frac").alias("y")), "site")
    sums = met.groupBy("cell", "ref").agg(F.count(F.lit(1)).alias("n"), (100 * F.avg(F.abs(F.col("x") - F.col("y")))).alias("mean"))
    shared = F.coalesce("n", F.lit(0))
    return names.join(sums, ["cell", "ref"], "left").select("cell", "ref", shared.alias("shared"), F.when(shared >= min_sites, F.col("mean")).alias("score"))


def z_scores(scores: DataFrame) -> DataFrame:
    """Adds z: the score's distance from its cell's mean in standard deviations of a sample; null scores are left out."""
    row = Window.partitionBy("cell")
    return scores.withColumn("z", F.try_divide(F.col("score") - F.avg("score").over(row), F.stddev_samp("score").over(row)))


def assigned(scores: DataFrame, threshold: float = -1.1) -> DataFrame:
    """cell, best, best_score, best_z, second, second_z, assigned: the reference of the least z, if under the threshold."""
    ranked = z_scores(scores).withColumn("k", F.row_number().over(Window.partitionBy("cell").orderBy(F.col("z").asc_nulls_last(), "ref")))
    at = lambda k, c: F.max(F.when((F.col("k") == k) & F.col("z").isNotNull(), F.col(c)))
    out = ranked.groupBy("cell").agg(at(1, "ref").alias("best"), at(1, "score").alias("best_score"), at(1, "z").alias("best_z"), at(2, "ref").alias("second"), at(2, "z").alias("second_z"))
    return out.withColumn("assigned", F.when(F.col("best_z") < threshold, F.col("best")).otherwise("Unassigned"))


def assignment_summary(assignments: DataFrame) -> DataFrame:
    """assigned, cells, percent."""
    counts = assignments.groupBy("assigned").agg(F.count(F.lit(1)).alias("cells"))
    return counts.withColumn("percent", 100 * F.col("cells") / F.sum("cells").over(Window.partitionBy()))
