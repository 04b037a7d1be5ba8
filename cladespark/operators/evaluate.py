"""Accuracy of trees against known lineages, and permutation statistics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def triplets(samples: DataFrame) -> DataFrame:
    """a, b, c (names in order) and their clones, of all three samples of at least two clones."""
    one = lambda n: samples.select(F.col("sample").alias(n), F.col("clone").alias(f"clone_{n}"))
    three = one("a").join(one("b"), F.col("a") < F.col("b")).join(one("c"), F.col("b") < F.col("c"))
    return three.filter("clone_a <> clone_b or clone_b <> clone_c")


def triplet_results(three: DataFrame, pairs: DataFrame, reference: DataFrame) -> DataFrame:
    """a, b, c, ref_max, correct: whether the closest pair of the tree is that of the reference.

    pairs: a, b, depth (of the closest common ancestor); reference: clone_1, clone_2, d, both ways round.
    Triplets with a tie for the largest value in the tree or the reference are left out.
    """
    out = three
    for x, y in (("a", "b"), ("a", "c"), ("b", "c")):
        out = out.join(pairs.select(F.col("a").alias(x), F.col("b").alias(y), F.col("depth").alias(f"t_{x}{y}")), [x, y])
        out = out.join(reference.select(F.col("clone_1").alias(f"clone_{x}"), F.col("clone_2").alias(f"clone_{y}"), F.col("d").alias(f"r_{x}{y}")), [f"clone_{x}", f"clone_{y}"])
    sides = {k: F.array(*(F.round(f"{k}_{p}", 9) for p in ("ab", "ac", "bc"))) for k in "tr"}
    out = out.withColumns({k: v for k, v in sides.items()})
    once = lambda k: F.size(F.filter(k, lambda v: v == F.array_max(k))) == 1
    out = out.filter(once("t") & once("r"))
    correct = F.array_position("t", F.array_max("t")) == F.array_position("r", F.array_max("r"))
    return out.select("a", "b", "c", F.array_max("r").alias("ref_max"), correct.cast("int").alias("correct"))


def triplet_accuracy(results: DataFrame) -> DataFrame:
    """mrca_distance, correct, total, accuracy by reference distance, 0 left out, with a row All_Distances."""
    rolled = results.filter("ref_max <> 0").rollup("ref_max").agg(F.sum("correct").cast("long").alias("correct"), F.count(F.lit(1)).alias("total"), F.grouping("ref_max").alias("all"))
    name = F.when(F.col("all") == 1, "All_Distances").otherwise(F.col("ref_max").cast("long").cast("string"))
    return rolled.select(name.alias("mrca_distance"), F.coalesce("correct", F.lit(0)).alias("correct"), "total", F.try_divide("correct", "total").alias("accuracy"))


def sibling_percentage(siblings: DataFrame, labels: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """keys, comparisons, pairs, percentage: sibling leaves of one group, of those of which one has a group.

    keys tell permutations apart, of the labels or of the trees that the siblings are of.
    """
    keys = keys or []
    own = [k for k in keys if k in labels.columns]
    side = lambda n: labels.select(*own, F.col("sample").alias(n), F.col("grp").alias(f"grp_{n}"))
    missing = [k for k in keys if k not in siblings.columns]
    pairs = siblings.crossJoin(labels.select(*missing).distinct()) if missing else siblings  # a stated number of permutations
    met = pairs.join(side("a"), [*own, "a"], "left").join(side("b"), [*own, "b"], "left").filter("grp_a is not null or grp_b is not null")
    counts = met.groupBy(*keys).agg(F.count(F.lit(1)).alias("comparisons"), F.count_if(F.expr("grp_a = grp_b")).alias("pairs"))
    return counts.withColumn("percentage", F.coalesce(100 * F.try_divide("pairs", "comparisons"), F.lit(0.0)))


def permutation_summary(observed: DataFrame, permuted: DataFrame) -> DataFrame:
    """One row: the observed percentage, permutations, their mean, median and largest, and p: the share at or above the observed."""
    both = permuted.select("percentage").crossJoin(observed.select(F.col("percentage").alias("observed")))  # one row
    return both.groupBy("observed").agg(F.count(F.lit(1)).alias("permutations"), F.avg("percentage").alias("mean"), F.median("percentage").alias("median"), F.max("percentage").alias("largest"), F.avg((F.col("percentage") >= F.col("observed")).cast("int")).alias("p_value"))


def sequential_test(observed: DataFrame, permuted: Callable[[int, int], DataFrame], batch: int = 50, most: int = 1000, enough: int = 10) -> DataFrame:
    """One row: observed, permutations, at_or_above, failed, stopped, p_value of a permutation test that stops early.

    permuted(first, last) gives perm and percentage of permutations first to last - 1, each batch one job; a permutation that it doesn't
    list or whose percentage is null has failed (its tree couldn't be built, nothing was comparable): it is counted as such and
    not as a value of 0, which would flatter p. The test ends with the permutation at which ``enough`` values reached the observed one
    (Besag and Clifford 1991): p is then enough / (permutations without failures so far); else, after ``most``, (at_or_above + 1) / (their number + 1).
    """
    spark = observed.sparkSession
    value = observed.first()["percentage"]
    above, valid, done, stopped = 0, 0, 0, False
    while done < most and not stopped:
        last = min(most, done + batch)
        found = permuted(done, last).filter("percentage is not null").select("perm", (F.col("percentage") >= F.lit(value)).alias("reached")).orderBy("perm").collect()  # a batch's permutations
        for perm, reached in found:
            valid, above = valid + 1, above + reached
            if above == enough:
                done, stopped = perm + 1, True
                break
        else:
            done = last
    p = enough / valid if stopped else (above + 1) / (valid + 1)
    return spark.createDataFrame([(value, done, above, done - valid, stopped, p)], "observed double, permutations int, at_or_above int, failed int, stopped boolean, p_value double")
