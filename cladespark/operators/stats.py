"""Summary statistics, regressions and rank tests as aggregates; p-values from small functions of their results."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Ranges of values whose rows are ranked together.
RANGES = 64


def describe(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """by, count, mean, std, min, q25, q50, q75, max of a column."""
    quarter = lambda p: F.percentile(value, F.lit(p))
    return df.groupBy(*by).agg(F.count(value).alias("count"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.min(value).alias("min"), quarter(0.25).alias("q25"), quarter(0.5).alias("q50"), quarter(0.75).alias("q75"), F.max(value).alias("max"))


def quality_summary(df: DataFrame, by: list[str], value: str, good: float = 0.9) -> DataFrame:
    """by, n, median, q25, q75, frac_good: the share of values that reach ``good``."""
    quarter = lambda p: F.percentile(value, F.lit(p))
    return df.groupBy(*by).agg(F.count(value).alias("n"), F.median(value).alias("median"), quarter(0.25).alias("q25"), quarter(0.75).alias("q75"), F.avg((F.col(value) >= good).cast("int")).alias("frac_good"))


def metric_table(df: DataFrame, metrics: list[str]) -> DataFrame:
    """metric, mean, median, std, min, max, a row for each column named."""
    long_ = df.select(F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics))).alias("m")).select("m.*")
    figures = long_.groupBy("metric").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    return figures.join(F.broadcast(medians(long_, "metric", "value")), "metric", "left").select("metric", "mean", "median", "std", "min", "max")


def medians(df: DataFrame, by: str, value: str) -> DataFrame:
    """by, median of a few groups: equal values are counted first and put in order within ranges of values, so no task holds a group.

    Groups without values are absent.
    """
    rows = df.select(F.col(by).alias("g"), F.col(value).alias("v")).filter("v is not null")
    found = rows.groupBy("g").agg(F.percentile_approx("v", [i / RANGES for i in range(1, RANGES)]).alias("bounds"), F.count(F.lit(1)).alias("total"))
    counts = rows.groupBy("g", "v").agg(F.count(F.lit(1)).alias("c")).join(F.broadcast(found), "g")  # a row for each group
    placed = counts.select("g", "v", "c", "total", F.size(F.filter("bounds", lambda x: x < F.col("v"))).alias("part"))
    upto = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    parts = placed.groupBy("g", "part").agg(F.sum("c").alias("n")).select("g", "part", (F.sum("n").over(upto) - F.col("n")).alias("before"))  # RANGES rows a group
    after = F.col("before") + F.sum("c").over(Window.partitionBy("g", "part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    ordered = placed.join(F.broadcast(parts), ["g", "part"]).withColumn("after", after)
    at = lambda rank: F.min(F.when((F.col("after") - F.col("c") <= rank) & (rank < F.col("after")), F.col("v")))
    return ordered.groupBy("g").agg((at(F.floor((F.col("total") - 1) / 2)) * 0.5 + at(F.floor(F.col("total") / 2)) * 0.5).alias("median")).withColumnRenamed("g", by)


def regression(df: DataFrame, by: list[str], x: str, y: str) -> DataFrame:
    """by, n, slope, intercept, r2, stderr, t: least squares of y on x; null where x doesn't vary."""
    x_, y_ = F.col(x).cast("double"), F.col(y).cast("double")
    sums = df.filter(x_.isNotNull() & y_.isNotNull()).groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.regr_slope(y_, x_).alias("slope"), F.regr_intercept(y_, x_).alias("intercept"), F.regr_r2(y_, x_).alias("r2"), F.regr_sxx(y_, x_).alias("sxx"), F.regr_syy(y_, x_).alias("syy"))
    error = F.sqrt(F.try_divide(F.greatest(F.lit(0.0), (1 - F.col("r2")) * F.col("syy")), (F.col("n") - 2) * F.col("sxx")))
    return sums.withColumn("stderr", error).withColumn("t", F.try_divide("slope", "stderr")).drop("sxx", "syy")


def interaction(df: DataFrame, group: str, x: str, y: str) -> DataFrame:
    """One row: f, df1, df2 of the hypothesis that the slopes of all groups are one, each with an intercept of its own."""
    x_, y_ = F.col(x).cast("double"), F.col(y).cast("double")
    parts = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.regr_sxx(y_, x_).alias("sxx"), F.regr_syy(y_, x_).alias("syy"), F.regr_sxy(y_, x_).alias("sxy"))
    total = parts.agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum("sxx").alias("sxx"), F.sum("syy").alias("syy"), F.sum("sxy").alias("sxy"), F.sum(F.col("syy") - F.try_divide(F.col("sxy") * F.col("sxy"), F.col("sxx"))).alias("apart"))
    together = F.col("syy") - F.col("sxy") * F.col("sxy") / F.col("sxx")
    df1, df2 = F.col("k") - 1, F.col("n") - 2 * F.col("k")
    return total.select(F.try_divide((together - F.col("apart")) / df1, F.col("apart") / df2).alias("f"), df1.alias("df1"), df2.alias("df2"))


def mann_whitney(df: DataFrame, group: str, value: str) -> DataFrame:
    """g1, g2, n1, n2, u, z, comparisons of all pairs of groups g1 < g2; ties have mean ranks and correct the variance."""
    rows = df.select(F.col(group).alias("g"), F.col(value).alias("v")).filter("v is not null")
    names = rows.select("g").distinct()
    pairs = names.select(F.col("g").alias("g1")).join(names.select(F.col("g").alias("g2")), F.col("g1") < F.col("g2"))
    counts = rows.groupBy("g", "v").agg(F.count(F.lit(1)).alias("c"))
    both = pairs.join(counts, (F.col("g") == F.col("g1")) | (F.col("g") == F.col("g2")))
    at = both.groupBy("g1", "g2", "v").agg(F.sum("c").alias("c"), F.sum(F.when(F.col("g") == F.col("g1"), F.col("c")).otherwise(0)).alias("c1"))
    # values are put in order within ranges; a range adds what the ranges before it have
    found = rows.agg(F.percentile_approx(F.col("v").cast("double"), [i / RANGES for i in range(1, RANGES)])).first()[0] or []
    place = F.lit(0)
    for bound in sorted({*found}):
        place = place + (F.col("v").cast("double") > F.lit(bound)).cast("int")
    at = at.withColumn("part", place)
    earlier = lambda *by: Window.partitionBy("g1", "g2", *by).rowsBetween(Window.unboundedPreceding, -1)
    sizes = at.groupBy("g1", "g2", "part").agg(F.sum("c").alias("n"))
    parts = sizes.select("g1", "g2", "part", F.coalesce(F.sum("n").over(earlier().orderBy("part")), F.lit(0)).alias("before"))  # RANGES rows a pair
    own = F.coalesce(F.sum("c").over(earlier("part").orderBy("v")), F.lit(0))
    ranked = at.withColumn("own", own).join(parts, ["g1", "g2", "part"]).withColumn("rank", F.col("before") + F.col("own") + (F.col("c") + 1) / 2)
    sums = ranked.groupBy("g1", "g2").agg(F.sum("c1").alias("n1"), F.sum(F.col("c") - F.col("c1")).alias("n2"), F.sum(F.col("rank") * F.col("c1")).alias("r1"), F.sum(F.col("c") * F.col("c") * F.col("c") - F.col("c")).alias("ties"))
    n = F.col("n1") + F.col("n2")
    u = F.col("r1") - F.col("n1") * (F.col("n1") + 1) / 2
    variance = F.col("n1") * F.col("n2") / 12.0 * (n + 1 - F.try_divide(F.col("ties"), n * (n - 1)))
    centre = F.abs(u - F.col("n1") * F.col("n2") / 2) - 0.5
    return sums.select("g1", "g2", "n1", "n2", u.alias("u"), F.try_divide(centre, F.sqrt(variance)).alias("z"), F.count(F.lit(1)).over(Window.partitionBy()).alias("comparisons"))


def bonferroni(p: Column, comparisons: Column) -> Column:
    return F.least(F.lit(1.0), p * comparisons)


def mean_band(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """by, n, mean, low, high: the mean with 1.96 standard errors to both sides; no band for one value."""
    out = df.groupBy(*by).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), (1.96 * F.stddev_samp(value) / F.sqrt(F.count(value))).alias("e"))
    return out.select(*by, "n", "mean", (F.col("mean") - F.col("e")).alias("low"), (F.col("mean") + F.col("e")).alias("high"))


def common_counts(df: DataFrame, group: str, number: str) -> DataFrame:
    """number: values that every group has."""
    groups = df.select(group).distinct().agg(F.count(F.lit(1)).alias("groups"))
    have = df.groupBy(number).agg(F.count_distinct(group).alias("have"))
    return have.crossJoin(groups).filter("have = groups").select(number)  # one row


def duplicates(df: DataFrame, value: str) -> DataFrame:
    """One row: distinct values that occur more than once, and the rows beyond their first."""
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return counts.agg(F.count(F.lit(1)).alias("values"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus"))


def coverage_table(df: DataFrame, by: list[str], value: str, levels: tuple[int, ...] = (1, 2, 10, 30, 50)) -> DataFrame:
    """by, level, percent of rows whose value reaches each level."""
    long_ = df.select(*by, F.explode(F.array(*map(F.lit, levels))).alias("level"), F.col(value).alias("v"))
    return long_.groupBy(*by, "level").agg((100 * F.avg((F.col("v") >= F.col("level")).cast("int"))).alias("percent"))


def _beta_fraction(a: float, b: float, x: float) -> float:
    c, d = 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > 1e-300 else 1e-300)
    out = d
    for m in range(1, 500):
        for top in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + top * d
            d = 1 / (d if abs(d) > 1e-300 else 1e-300)
            c = 1 + top / c
            c = c if abs(c) > 1e-300 else 1e-300
            out *= c * d
        if abs(c * d - 1) < 1e-14:
            break
    return out


def incomplete_beta(a: float, b: float, x: float) -> float:
    """The regularised incomplete beta function."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    return front * _beta_fraction(a, b, x) / a if x < (a + 1) / (a + b + 2) else 1 - front * _beta_fraction(b, a, 1 - x) / b


def p_of_t(t: float, freedom: float) -> float:
    """Two-sided."""
    return incomplete_beta(freedom / 2, 0.5, freedom / (freedom + t * t)) if freedom > 0 and np.isfinite(t) else float("nan")


def p_of_f(f: float, df1: float, df2: float) -> float:
    """The upper tail."""
    return incomplete_beta(df2 / 2, df1 / 2, df2 / (df2 + df1 * f)) if f >= 0 and df1 > 0 and df2 > 0 else float("nan")


def p_of_z(z: float) -> float:
    """Two-sided."""
    return math.erfc(abs(z) / math.sqrt(2))


def p_value_t(t: Column, freedom: Column) -> Column:
    """Two-sided p of a column of t, for the few rows of a result; null where t is."""

    @F.pandas_udf("double")
    def p(t: pd.Series, freedom: pd.Series) -> pd.Series:
        return pd.Series([p_of_t(x, f) for x, f in zip(t, freedom)], dtype=float)

    return F.when(t.isNotNull(), p(t.cast("double"), freedom.cast("double")))


def p_value_f(f: Column, df1: Column, df2: Column) -> Column:
    """The upper tail of a column of F; null where F is."""

    @F.pandas_udf("double")
    def p(f: pd.Series, df1: pd.Series, df2: pd.Series) -> pd.Series:
        return pd.Series([p_of_f(*x) for x in zip(f, df1, df2)], dtype=float)

    return F.when(f.isNotNull(), p(f.cast("double"), df1.cast("double"), df2.cast("double")))


def p_value_z(z: Column) -> Column:
    """Two-sided p of a column of z; null where z is."""

    @F.pandas_udf("double")
    def p(z: pd.Series) -> pd.Series:
        return pd.Series([p_of_z(x) for x in z], dtype=float)

    return F.when(z.isNotNull(), p(z.cast("double")))


def regression_test(df: DataFrame, by: list[str], x: str, y: str) -> DataFrame:
    """As ``regression``, with the p of its slope."""
    return regression(df, by, x, y).withColumn("p", p_value_t(F.col("t"), F.col("n") - 2))


def interaction_test(df: DataFrame, group: str, x: str, y: str) -> DataFrame:
    """As ``interaction``, with its p."""
    return interaction(df, group, x, y).withColumn("p", p_value_f(F.col("f"), F.col("df1"), F.col("df2")))


def rank_test(df: DataFrame, group: str, value: str) -> DataFrame:
    """As ``mann_whitney``, with p and p_adjusted for the number of comparisons. A z below 0 is one of 0: the correction for continuity went past the centre."""
    tested = mann_whitney(df, group, value).withColumn("p", p_value_z(F.greatest(F.col("z"), F.lit(0.0))))
    return tested.withColumn("p_adjusted", bonferroni(F.col("p"), F.col("comparisons")))
