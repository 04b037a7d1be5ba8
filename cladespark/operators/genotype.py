"""Genotype calls: filtering, allele sizes, read multisets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def good_call(min_qual: float = 0.9, min_reads: int = 10, max_stutter: float = 1.0) -> Column:
    """Quality and depth reach the minimum and the stutter share the maximum; missing values don't."""
    share = F.try_divide(F.col("stutter"), F.col("depth"))
    return F.coalesce((F.col("q") >= min_qual) & (F.col("depth") >= min_reads) & (share <= max_stutter), F.lit(False))


def allelotype(calls: DataFrame) -> DataFrame:
    """sample, target, alleles: the distinct alleles of each call, sorted."""
    return calls.select("sample", "target", F.array_sort(F.array_distinct(F.array("a1", "a2"))).alias("alleles"))


def known_targets(calls: DataFrame, targets: DataFrame) -> DataFrame:
    """Calls on listed targets, with their motif length and reference length in bases."""
    size = targets.select("target", "motif_len", (F.col("motif_len") * F.col("num_copies")).alias("ref_len"))
    return calls.join(size, "target")


def allele_sizes(differences: Column, ref_len: Column) -> Column:
    """Allele sizes in bases from differences to the reference length."""
    return F.transform(differences, lambda x: x + ref_len)


def read_multiset(packed: Column) -> Column:
    """``diff|count;diff|count`` as each difference as often as it was read; null where a part isn't two whole numbers."""
    parts = F.transform(F.split(packed, ";"), lambda x: F.struct(F.split_part(x, F.lit("|"), F.lit(1)).try_cast("int").alias("diff"), F.split_part(x, F.lit("|"), F.lit(2)).try_cast("int").alias("n")))
    bad = F.exists(parts, lambda p: p["diff"].isNull() | p["n"].isNull())
    return F.when(~bad, F.flatten(F.transform(parts, lambda p: F.array_repeat(p["diff"], p["n"]))))
