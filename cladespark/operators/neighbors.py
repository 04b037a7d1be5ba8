"""Nearest neighbours of cells by adjusted distance, and what groups they belong to."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import trees


def adjusted(pairs: DataFrame) -> DataFrame:
    """i, j, q: d - r_i / (n - 2) - r_j / (n - 2), 0 on the diagonal, from i, j, dist of all ordered pairs."""
    sums = pairs.groupBy("i").agg(F.sum("dist").alias("r"))
    n = sums.agg(F.count(F.lit(1)).alias("n"))
    share = sums.crossJoin(n).select("i", F.try_divide("r", F.col("n") - 2).alias("u"))  # one row
    out = pairs.join(share, "i").join(share.select(F.col("i").alias("j"), F.col("u").alias("v")), "j")
    return out.select("i", "j", F.when(F.col("i") == F.col("j"), 0.0).otherwise(F.col("dist") - F.col("u") - F.col("v")).alias("q"))


def nearest(pairs: DataFrame, k: int, value: str = "dist", exclude_self: bool = True) -> DataFrame:
    """i, j, k: the k nearest of each cell. Without exclude_self, the first in order is left out instead, whichever it is."""
    rows = pairs.filter("i <> j") if exclude_self else pairs
    skip = 0 if exclude_self else 1
    rank = F.row_number().over(Window.partitionBy("i").orderBy(value, "j")) - skip
    return rows.withColumn("k", rank).filter(F.col("k").between(1, k)).select("i", "j", "k")


def composition(neighbours: DataFrame, groups: DataFrame) -> DataFrame:
    """seed, grp, mean_count, enrichment: neighbours of each group around the cells of a seed group, and relative to the group's mean over seeds."""
    label = lambda n, c: groups.select(F.col("sample").alias(n), F.col("grp").alias(c))
    counts = neighbours.join(label("i", "seed"), "i").join(label("j", "grp"), "j").groupBy("seed", "grp").agg(F.count(F.lit(1)).alias("n"))
    seeds = neighbours.select("i").distinct().join(label("i", "seed"), "i").groupBy("seed").agg(F.count(F.lit(1)).alias("cells"))
    every = seeds.crossJoin(groups.select("grp").distinct())  # names of groups alone
    mean = every.join(counts, ["seed", "grp"], "left").select("seed", "grp", (F.coalesce("n", F.lit(0)) / F.col("cells")).alias("mean_count"))
    over = F.avg("mean_count").over(Window.partitionBy("grp"))
    return mean.withColumn("enrichment", F.when(over > 0, F.col("mean_count") / over).otherwise(0.0))


def seed_correlation(rows: DataFrame) -> DataFrame:
    """a, b, r: the correlation of the enrichment of two seed groups over groups, 0 where there is none."""
    x, y = (rows.select(F.col("seed").alias(n), "grp", F.col("enrichment").alias(v)) for n, v in (("a", "x"), ("b", "y")))
    out = x.join(y, "grp").groupBy("a", "b").agg(F.corr("x", "y").alias("r"))
    return out.withColumn("r", F.when(F.isnan("r"), 0.0).otherwise(F.coalesce("r", F.lit(0.0))))


def clustered(correlations: DataFrame) -> DataFrame:
    """step, left, right, distance, size: average-linkage merges of 1 - r; items are numbered in the order of their names."""

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        names = sorted({*rows["a"]})
        at = {n: k for k, n in enumerate(names)}
        d = np.zeros((len(names), len(names)))
        d[rows["a"].map(at), rows["b"].map(at)] = 1 - rows["r"]
        found = trees.average_linkage(d)
        return pd.DataFrame([(k, *m) for k, m in enumerate(found)], columns=["step", "left", "right", "distance", "size"])

    return correlations.withColumn("_one", F.lit(1)).groupBy("_one").applyInPandas(lambda rows: merge(rows), "step int, left int, right int, distance double, size int")
