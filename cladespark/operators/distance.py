"""Allele groups and genetic distances between all pairs of samples.

For a group of alleles each sample has none, one or two distinct alleles of a call. With
n the smaller number, minComp compares n alleles by the closest choice, which has a
closed form per row; allComp compares all pairs. Everything is sums over (pair, target,
group), so resampling adds a key instead of a loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

METRICS = {"minComp_EqorNot", "minComp_Abs", "allComp_EqorNot", "allComp_Abs"}


def metric_parts(metric: str) -> tuple[str, str]:
    """(compared, by), in either order of the name."""
    parts = {*metric.split("_")}
    for compared in ("minComp", "allComp"):
        for by in ("EqorNot", "Abs"):
            if parts == {compared, by}:
                return compared, by
    raise ValueError(f"no such distance: {metric}")


def allele_groups(alleles: DataFrame, motif_len: str | int = 1) -> DataFrame:
    """target, allele, grp: alleles (in bases) of runs of consecutive repeat counts, over all samples.

    An allele that isn't a multiple of the motif counts towards a group by its whole repeats but is no member.
    """
    motif = F.lit(motif_len) if isinstance(motif_len, int) else F.col(motif_len)
    exploded = alleles.select("target", motif.alias("motif"), F.explode("alleles").alias("allele"))
    repeats = exploded.select("target", "motif", (F.col("allele") / F.col("motif")).cast("long").alias("r")).distinct()
    order = Window.partitionBy("target").orderBy("r")
    return repeats.select("target", (F.col("r") * F.col("motif")).alias("allele"), (F.col("r") - F.row_number().over(order)).alias("grp"))


def grouped_alleles(alleles: DataFrame, groups: DataFrame) -> DataFrame:
    """sample, target, grp, alleles: the members of each call in each group, sorted."""
    one = alleles.select("sample", "target", F.explode("alleles").alias("allele")).distinct()
    return one.join(groups, ["target", "allele"]).groupBy("sample", "target", "grp").agg(F.array_sort(F.collect_set("allele")).alias("alleles"))  # a call has two alleles at most


def pairs_of_targets(alleles: DataFrame) -> DataFrame:
    """s1, s2, target of samples s1 <= s2 that share a target, a sample with itself included."""
    a, b = (alleles.select(F.col("sample").alias(s), "target") for s in ("s1", "s2"))
    return a.join(b, "target").filter("s1 <= s2")


def contributions(alleles: DataFrame, groups: DataFrame, metric: str) -> DataFrame:
    """s1, s2, target, comparisons, difference: what each shared target adds to each pair's sums."""
    compared, by = metric_parts(metric)
    members = grouped_alleles(alleles, groups)
    a, b = (members.select(F.col("sample").alias(s), "target", "grp", F.col("alleles").alias(x)) for s, x in (("s1", "x"), ("s2", "y")))
    met = a.join(b, ["target", "grp"]).filter("s1 < s2")
    n = F.least(F.size("x"), F.size("y"))
    if compared == "minComp":
        count = n
        if by == "EqorNot":
            difference = n - F.size(F.array_intersect("x", "y"))
        else:
            least = F.array_min(F.flatten(F.transform("x", lambda p: F.transform("y", lambda q: F.abs(p - q)))))
            difference = F.when(n == 2, F.abs(F.element_at("x", 1) - F.element_at("y", 1)) + F.abs(F.element_at("x", 2) - F.element_at("y", 2))).otherwise(least)
    else:
        count = F.size("x") * F.size("y")
        if by == "EqorNot":
            difference = count - F.size(F.array_intersect("x", "y"))
        else:
            difference = F.aggregate(F.flatten(F.transform("x", lambda p: F.transform("y", lambda q: F.abs(p - q)))), F.lit(0).cast("long"), lambda s, v: s + v)
    by_group = met.select("s1", "s2", "target", count.cast("long").alias("comparisons"), difference.cast("long").alias("difference"))
    return by_group.groupBy("s1", "s2", "target").agg(F.sum("comparisons").alias("comparisons"), F.sum("difference").alias("difference"))


def summed(parts: DataFrame, shared: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Pair sums over targets. keys: further grouping keys that both tables have, such as an iteration."""
    keys = [*(keys or []), "s1", "s2"]
    targets = shared.groupBy(*keys).agg(F.count(F.lit(1)).alias("num_targets"))
    sums = parts.groupBy(*keys).agg(F.sum("comparisons").alias("c"), F.sum("difference").alias("d"))
    itself = F.col("s1") == F.col("s2")
    out = targets.join(sums, keys, "left").withColumns({"num_alleles": F.when(itself, F.col("num_targets")).otherwise(F.coalesce("c", F.lit(0))), "num_diff": F.coalesce("d", F.lit(0))})
    dist = F.coalesce(F.try_divide("num_diff", "num_alleles"), F.lit(0.0))
    return out.select(*keys, "num_targets", "num_alleles", "num_diff", dist.alias("dist"), (F.col("num_alleles") > 0).alias("is_comparable"))


def pair_distances(alleles: DataFrame, metric: str = "minComp_EqorNot", motif_len: str | int = 1) -> DataFrame:
    """s1, s2, num_targets, num_alleles, num_diff, dist, is_comparable of all unordered pairs that share a target, each sample with itself included.

    A pair without a comparison has distance 0 and is marked as not comparable.
    """
    groups = allele_groups(alleles, motif_len)
    return summed(contributions(alleles, groups, metric), pairs_of_targets(alleles))


def square(distances: DataFrame, value: str) -> DataFrame:
    """i, j, value of ordered pairs, both ways round."""
    one = distances.select(F.col("s1").alias("i"), F.col("s2").alias("j"), F.col(value).alias(value))
    return one.union(one.filter("i <> j").select("j", "i", value))


def tree_stats(distances: DataFrame) -> DataFrame:
    """One row: mean, least and most targets of a sample and of a pair."""
    itself = F.col("s1") == F.col("s2")
    out = []
    for name, rows in (("cell", itself), ("pair", ~itself)):
        value = F.when(rows, F.col("num_targets"))
        out += [F.avg(value).alias(f"{name}_mean"), F.min(value).alias(f"{name}_min"), F.max(value).alias(f"{name}_max")]
    return distances.agg(*out)


def shared_at_depth(depth: DataFrame, samples: DataFrame, min_reads: int = 10) -> DataFrame:
    """s1, s2, shared: targets with enough reads in both, for all pairs s1 < s2 of samples, without shared ones too."""
    enough = depth.filter(F.col("depth") >= min_reads)
    shared = pairs_of_targets(enough).filter("s1 < s2").groupBy("s1", "s2").agg(F.count(F.lit(1)).alias("n"))
    a, b = (samples.select(F.col("sample").alias(s)).distinct() for s in ("s1", "s2"))
    return a.join(b, F.col("s1") < F.col("s2")).join(shared, ["s1", "s2"], "left").select("s1", "s2", F.coalesce("n", F.lit(0)).alias("shared"))
