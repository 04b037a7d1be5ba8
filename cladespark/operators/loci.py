"""Statistics of loci over cells: baselines, deviations, variance between clones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def covered(values: DataFrame, cells: int, share: float = 0.8) -> DataFrame:
    """Rows (target, sample, lo, hi) of loci that have a value in that share of all cells at least."""
    seen = F.count(F.coalesce("lo", "hi")).over(Window.partitionBy("target"))
    return values.withColumn("_seen", seen).filter(F.col("_seen") >= share * cells).drop("_seen")


def baselines(values: DataFrame, by: str = "median", whole: bool = True) -> DataFrame:
    """target, baseline: median or mode of both alleles of all cells, rounded half to even; of several modes the least."""
    pool = values.select("target", F.explode(F.array("lo", "hi")).alias("v")).filter("v is not null").withColumn("v", F.bround("v") if whole else F.col("v"))
    if by == "median":
        out = pool.groupBy("target").agg(F.median("v").alias("baseline"))
    elif by == "mode":
        out = pool.groupBy("target").agg(F.mode("v", True).alias("baseline"))
    else:
        raise ValueError("by is median or mode")
    return out.withColumn("baseline", F.bround("baseline") if whole else F.col("baseline"))


def deviations(values: DataFrame, base: DataFrame, most: float | None = 2.0) -> DataFrame:
    """target, sample, lo, hi less the baseline; loci with a deviation over ``most`` are left out."""
    out = values.join(base, "target").select("target", "sample", (F.col("lo") - F.col("baseline")).alias("lo"), (F.col("hi") - F.col("baseline")).alias("hi"))
    if most is None:
        return out
    largest = F.max(F.greatest(F.abs("lo"), F.abs("hi"))).over(Window.partitionBy("target"))
    return out.withColumn("_most", largest).filter(F.col("_most") <= most).drop("_most")


def farther(lo: Column | None = None, hi: Column | None = None) -> Column:
    """The allele farther from the baseline; the lower one in ties; the one there is if one is missing."""
    lo, hi = F.col("lo") if lo is None else lo, F.col("hi") if hi is None else hi
    return F.when(lo.isNull(), hi).when(hi.isNull(), lo).when(F.abs(lo) >= F.abs(hi), lo).otherwise(hi)


def variance_ratio(values: DataFrame, least: int = 2) -> DataFrame:
    """target, f, groups, n: one-way analysis of variance of ``value`` over ``clone``.

    Loci where a clone of the table has fewer than ``least`` values are left out; f is 0 where it isn't finite.
    """
    clones = values.select("clone").distinct().agg(F.count(F.lit(1)).alias("clones"))
    parts = values.filter("value is not null").groupBy("target", "clone").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("s"), F.sum(F.col("value") * F.col("value")).alias("ss"))
    sums = parts.groupBy("target").agg(F.count(F.lit(1)).alias("groups"), F.min("n").alias("least"), F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss"), F.sum(F.col("s") * F.col("s") / F.col("n")).alias("between"))
    whole = sums.crossJoin(clones).filter((F.col("least") >= least) & (F.col("groups") == F.col("clones")) & (F.col("n") > F.col("groups")))  # one row
    ssb = F.greatest(F.lit(0.0), F.col("between") - F.col("s") * F.col("s") / F.col("n"))
    ssw = F.greatest(F.lit(0.0), F.col("ss") - F.col("between"))
    f = F.when(ssw > 1e-9, (ssb / (F.col("groups") - 1)) / (ssw / (F.col("n") - F.col("groups")))).otherwise(0.0)
    return whole.select("target", F.coalesce(f, F.lit(0.0)).alias("f"), "groups", "n")


def outlier_clone(values: DataFrame) -> DataFrame:
    """target, clone, deviation: the clone whose mean is farthest from the mean of the other clones' means."""
    means = values.groupBy("target", "clone").agg(F.avg("value").alias("m"))
    row = Window.partitionBy("target")
    others = F.try_divide(F.sum("m").over(row) - F.col("m"), F.count("m").over(row) - 1)
    away = means.withColumn("deviation", F.round(F.abs(F.col("m") - others), 9)).filter("deviation > 0")
    return away.withColumn("k", F.row_number().over(row.orderBy(F.col("deviation").desc(), "clone"))).filter("k = 1").select("target", "clone", "deviation")


def centred(values: DataFrame) -> DataFrame:
    """Adds centred: the value less its locus's most common value, of several the least."""
    mode = values.groupBy("target").agg(F.mode("value", True).alias("mode"))
    return values.join(mode, "target", "left").withColumn("centred", F.col("value") - F.col("mode")).drop("mode")
