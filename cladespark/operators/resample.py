"""Resampling as keys: bootstrap, downsampling and permutations are joins to seeded draws.

Draws go by md5 of seed and keys, so they are the same on every run and any engine can repeat them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def draw(seed: int | Column, *keys: str) -> Column:
    """A uniform pseudo-random hex text of the seed and the keys."""
    return F.md5(F.concat_ws("|", F.lit(seed) if isinstance(seed, int) else seed, *(F.col(k).cast("string") for k in keys)).cast("binary"))


def iterations(spark, count: int, name: str = "iteration") -> DataFrame:  # noqa: ANN001
    return spark.range(1, count + 1).select(F.col("id").cast("int").alias(name))


def bootstrap_targets(targets: DataFrame, count: int, share: float = 0.8, seed: int = 1) -> DataFrame:
    """iteration, target: that share of all targets, without replacement, in each iteration."""
    runs = iterations(targets.sparkSession, count)
    drawn = targets.select("target").distinct().crossJoin(runs)  # a stated number of iterations
    row = Window.partitionBy("iteration")
    ranked = drawn.withColumns({"k": F.row_number().over(row.orderBy(draw(seed, "iteration", "target"), "target")), "n": F.count(F.lit(1)).over(row)})
    return ranked.filter(F.col("k") <= F.floor(F.lit(share) * F.col("n"))).select("iteration", "target")


def downsample(calls: DataFrame, number: int, seed: int = 1) -> DataFrame:
    """The calls of exactly ``number`` targets of each sample; samples with fewer are left out."""
    targets = calls.select("sample", "target").distinct()
    row = Window.partitionBy("sample")
    ranked = targets.withColumns({"k": F.row_number().over(row.orderBy(draw(seed, "sample", "target"), "target")), "n": F.count(F.lit(1)).over(row)})
    return calls.join(ranked.filter((F.col("n") >= number) & (F.col("k") <= number)).select("sample", "target"), ["sample", "target"], "left_semi")


def permuted_labels(labels: DataFrame, count: int, seed: int = 1, preserve_sizes: bool = False) -> DataFrame:
    """perm, sample, grp: labels dealt anew. By default each sample draws from the distinct labels with replacement.

    With preserve_sizes the labels themselves are shuffled. Where there are no more samples than
    distinct labels, they are drawn without replacement.
    """
    runs = iterations(labels.sparkSession, count, "perm")
    samples = labels.select("sample", "grp")
    every = samples.crossJoin(runs)  # a stated number of permutations
    shuffle = Window.partitionBy("perm").orderBy(draw(seed, "perm", "sample"), "sample")
    if preserve_sizes:
        slots = every.withColumn("k", F.row_number().over(shuffle)).select("perm", "sample", "k")
        given = every.withColumn("k", F.row_number().over(Window.partitionBy("perm").orderBy("sample"))).select("perm", "k", "grp")
        return slots.join(given, ["perm", "k"]).select("perm", "sample", "grp")
    distinct = samples.select("grp").distinct().withColumns({"g": F.row_number().over(Window.orderBy("grp")) - 1, "groups": F.count(F.lit(1)).over(Window.partitionBy())})
    size = samples.agg(F.count(F.lit(1)).alias("samples"))
    replaced = F.conv(F.substring(draw(seed, "perm", "sample"), 1, 8), 16, 10).cast("long") % F.col("groups")
    drawn = every.crossJoin(distinct.agg(F.max("groups").alias("groups"))).crossJoin(size)  # one row
    drawn = drawn.withColumn("g", F.when(F.col("groups") < F.col("samples"), replaced).otherwise(F.row_number().over(shuffle) - 1).cast("int"))
    return drawn.select("perm", "sample", "g").join(distinct.select("g", "grp"), "g").select("perm", "sample", "grp")


def permuted_genotypes(calls: DataFrame, count: int, seed: int = 1) -> DataFrame:
    """perm and the columns of ``calls``: at each target, the samples called there swap their whole calls."""
    runs = iterations(calls.sparkSession, count, "perm")
    every = calls.crossJoin(runs)  # a stated number of permutations
    place = Window.partitionBy("perm", "target")
    slots = every.withColumn("k", F.row_number().over(place.orderBy("sample"))).select("perm", "target", "k", "sample")
    fields = [c for c in calls.columns if c not in ("sample", "target")]
    given = every.withColumn("k", F.row_number().over(place.orderBy(draw(seed, "perm", "target", "sample"), "sample"))).select("perm", "target", "k", *fields)
    return slots.join(given, ["perm", "target", "k"]).select("perm", "sample", "target", *fields)
