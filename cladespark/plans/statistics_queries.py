"""Queries on summary statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sequence
from ..operators import stats
from .registry import query
from .views import table, view


@query("A16", """select sample, cast(target % 5 as integer) as length, count(q) as n, round(median(q), 6) as median, round(quantile_cont(q, 0.25), 6) as q25, round(quantile_cont(q, 0.75), 6) as q75, round(avg(case when q >= 0.9 then 1 else 0 end), 6) as frac_good from v_calls group by 1, 2""")
def quality_by_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.quality_summary(view(spark, sf_dir, "v_calls").withColumn("length", (F.col("target") % 5).cast("int")), ["sample", "length"], "q")


@query("A17", """select p_brand, count(p_retailprice) as count, round(avg(p_retailprice), 6) as mean, round(stddev_samp(p_retailprice), 6) as std, round(min(p_retailprice), 6) as min, round(quantile_cont(p_retailprice, 0.25), 6) as q25, round(quantile_cont(p_retailprice, 0.5), 6) as q50, round(quantile_cont(p_retailprice, 0.75), 6) as q75, round(max(p_retailprice), 6) as max from part group by 1""")
def price_description(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.describe(table(spark, sf_dir, "part"), ["p_brand"], "p_retailprice")


METRICS = ["l_quantity", "l_extendedprice", "l_discount"]


@query("A18 A33", " union all ".join(f"select '{m}' as metric, round(avg({m}), 6) as mean, round(median({m}), 6) as median, round(stddev_samp({m}), 6) as std, round(min({m}), 6) as min, round(max({m}), 6) as max from lineitem" for m in METRICS))
def metric_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.metric_table(table(spark, sf_dir, "lineitem"), METRICS)


@query("A24", """with s as (select l_returnflag, count(*) as n, regr_slope(l_extendedprice, l_quantity) as slope, regr_intercept(l_extendedprice, l_quantity) as intercept, regr_r2(l_extendedprice, l_quantity) as r2, regr_sxx(l_extendedprice, l_quantity) as sxx, regr_syy(l_extendedprice, l_quantity) as syy from lineitem group by 1)
 select l_returnflag, n, round(slope, 4) as slope, round(intercept, 4) as intercept, round(r2, 4) as r2, round(sqrt((1 - r2) * syy / ((n - 2) * sxx)), 4) as stderr, round(slope / sqrt((1 - r2) * syy / ((n - 2) * sxx)), 3) as t from s""")
def price_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stats.regression(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_quantity", "l_extendedprice")
    return out.select("l_returnflag", "n", *(F.round(c, 4).alias(c) for c in ("slope", "intercept", "r2", "stderr")), F.round("t", 3).alias("t"))


@query("A25", """with p as (select l_returnflag, count(*) as n, regr_sxx(l_extendedprice, l_quantity) as sxx, regr_syy(l_extendedprice, l_quantity) as syy, regr_sxy(l_extendedprice, l_quantity) as sxy from lineitem group by 1),
 t as (select count(*) as k, sum(n) as n, sum(sxx) as sxx, sum(syy) as syy, sum(sxy) as sxy, sum(syy - sxy * sxy / sxx) as apart from p)
 select round(((syy - sxy * sxy / sxx - apart) / (k - 1)) / (apart / (n - 2 * k)), 3) as f, k - 1 as df1, cast(n - 2 * k as bigint) as df2 from t""")
def slope_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stats.interaction(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_quantity", "l_extendedprice")
    return out.select(F.round("f", 3).alias("f"), "df1", "df2")


@query("A26 W6", """with r as (select o_orderpriority as g, cast(floor(o_totalprice / 1000) as bigint) as v from orders), p as (select a.g as g1, b.g as g2 from (select distinct g from r) a join (select distinct g from r) b on a.g < b.g),
 k as (select g1, g2, r.g, v, rank() over (partition by g1, g2 order by v) + (count(*) over (partition by g1, g2, v) - 1) / 2 as rk, count(*) over (partition by g1, g2, v) as c from p join r on r.g = g1 or r.g = g2),
 s as (select g1, g2, count(*) filter (g = g1) as n1, count(*) filter (g = g2) as n2, sum(rk) filter (g = g1) as r1, sum(c * c - 1) as ties from k group by 1, 2)
 select g1, g2, n1, n2, r1 - n1 * (n1 + 1) / 2 as u, round((abs(r1 - n1 * (n1 + 1) / 2 - n1 * n2 / 2) - 0.5) / sqrt(n1 * n2 / 12 * (n1 + n2 + 1 - ties / ((n1 + n2) * (n1 + n2 - 1)))), 6) as z, count(*) over () as comparisons from s""")
def rank_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderpriority", F.floor(F.col("o_totalprice") / 1000).alias("v"))
    return stats.mann_whitney(rows, "o_orderpriority", "v").withColumns({c: F.col(c).cast("long") for c in ("n1", "n2")})


def integral(density: str, upper: str, steps: int = 2000) -> str:
    """DuckDB SQL of Simpson's rule from 0 to ``upper`` of a density of x."""
    at = density.replace("<x>", f"({upper} * i / {steps})")
    return f"(select sum((case when i in (0, {steps}) then 1 when i % 2 = 1 then 4 else 2 end) * {at}) * {upper} / {steps} / 3 from range(0, {steps + 1}) r(i))"


T_DENSITY = "exp(lgamma((v + 1) / 2) - lgamma(v / 2)) / sqrt(v * pi()) * pow(1 + <x> * <x> / v, -(v + 1) / 2)"
F_DENSITY = "exp(lgamma((df1 + df2) / 2) - lgamma(df1 / 2) - lgamma(df2 / 2) + df1 / 2 * ln(df1 / df2)) * pow(<x>, df1 / 2 - 1) * pow(1 + df1 * <x> / df2, -(df1 + df2) / 2)"
Z_DENSITY = "exp(-<x> * <x> / 2) / sqrt(2 * pi())"


@query("A24", f"""with s as (select p_brand, count(*) as n, regr_slope(p_retailprice, p_size) as slope, regr_r2(p_retailprice, p_size) as r2, regr_sxx(p_retailprice, p_size) as sxx, regr_syy(p_retailprice, p_size) as syy from part group by 1),
 told as (select p_brand, n, slope, slope / sqrt((1 - r2) * syy / ((n - 2) * sxx)) as t, cast(n - 2 as double) as v from s)
 select p_brand, n, round(slope, 6) as slope, round(t, 6) as t, round(1 - 2 * {integral(T_DENSITY, 'abs(t)')}, 6) as p from told""")
def slope_p_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.regression_test(table(spark, sf_dir, "part"), ["p_brand"], "p_size", "p_retailprice").select("p_brand", "n", "slope", "t", "p")


@query("A25", f"""with q as (select p_brand, count(*) as n, regr_sxx(p_retailprice, p_size) as sxx, regr_syy(p_retailprice, p_size) as syy, regr_sxy(p_retailprice, p_size) as sxy from part group by 1),
 t as (select count(*) as k, sum(n) as n, sum(sxx) as sxx, sum(syy) as syy, sum(sxy) as sxy, sum(syy - sxy * sxy / sxx) as apart from q),
 told as (select ((syy - sxy * sxy / sxx - apart) / (k - 1)) / (apart / (n - 2 * k)) as f, cast(k - 1 as double) as df1, cast(n - 2 * k as double) as df2 from t)
 select round(f, 6) as f, cast(df1 as bigint) as df1, cast(df2 as bigint) as df2, round(1 - {integral(F_DENSITY, 'f', 20000)}, 6) as p from told""")
def slope_interaction_p_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.interaction_test(table(spark, sf_dir, "part"), "p_brand", "p_size", "p_retailprice")


@query("A26 W6", f"""with r as (select o_orderpriority as g, cast(floor(o_totalprice / 1000) as bigint) as v from orders), p as (select a.g as g1, b.g as g2 from (select distinct g from r) a join (select distinct g from r) b on a.g < b.g),
 k as (select g1, g2, r.g, v, rank() over (partition by g1, g2 order by v) + (count(*) over (partition by g1, g2, v) - 1) / 2 as rk, count(*) over (partition by g1, g2, v) as c from p join r on r.g = g1 or r.g = g2),
 s as (select g1, g2, count(*) filter (g = g1) as n1, count(*) filter (g = g2) as n2, sum(rk) filter (g = g1) as r1, sum(c * c - 1) as ties from k group by 1, 2),
 told as (select g1, g2, (abs(r1 - n1 * (n1 + 1) / 2 - n1 * n2 / 2) - 0.5) / sqrt(n1 * n2 / 12 * (n1 + n2 + 1 - ties / ((n1 + n2) * (n1 + n2 - 1)))) as z, count(*) over () as comparisons from s),
 ps as (select *, 1 - 2 * {integral(Z_DENSITY, 'greatest(z, 0)')} as p from told)
 select g1, g2, round(z, 6) as z, round(p, 6) as p, round(least(1, p * comparisons), 6) as p_adjusted from ps""")
def rank_test_p_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderpriority", F.floor(F.col("o_totalprice") / 1000).alias("v"))
    return stats.rank_test(rows, "o_orderpriority", "v").select("g1", "g2", "z", "p", "p_adjusted")


@query("A27", "select cast(floor(num_copies / 5) as bigint) as bin, count(*) as n, min(t_start) as min, max(t_start) as max, round(avg(t_start), 6) as mean from v_targets group by 1")
def length_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = view(spark, sf_dir, "v_targets").withColumn("bin", F.floor(F.col("num_copies") / 5))
    return t.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.min("t_start").alias("min"), F.max("t_start").alias("max"), F.avg("t_start").alias("mean"))


@query("A40", """select sample, count(q) as n, round(avg(q), 6) as mean, round(avg(q) - 1.96 * stddev_samp(q) / sqrt(count(q)), 6) as low, round(avg(q) + 1.96 * stddev_samp(q) / sqrt(count(q)), 6) as high from v_calls group by 1""")
def mean_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.mean_band(view(spark, sf_dir, "v_calls"), ["sample"], "q")


@query("A36", " union all ".join(f"select sample, {n} as level, round(100 * avg(case when depth >= {n} then 1 else 0 end), 6) as percent from v_calls group by 1" for n in (1, 2, 10, 30, 50)))
def coverage_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.coverage_table(view(spark, sf_dir, "v_calls"), ["sample"], "depth")


@query("A38 U6", "with t as (select distinct sample, depth from v_calls) select depth from t group by 1 having count(distinct sample) = (select count(distinct sample) from t)")
def common_depths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.common_counts(view(spark, sf_dir, "v_calls").select("sample", "depth").distinct(), "sample", "depth")


@query("P21 P22", """select p_partkey, trim(regexp_replace(regexp_replace(regexp_replace(replace(p_brand, '#', '-'), '[_#-]', ' ', 'g'), '([a-z])([A-Z])', '\\1 \\2', 'g'), ' +', ' ', 'g')) as tissue, split_part(p_brand, '#', 2) as clone from part""")
def name_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = F.concat(F.replace("p_brand", F.lit("#"), F.lit("-")), F.lit("_Plate1"))
    return table(spark, sf_dir, "part").select("p_partkey", sequence.tissue_name(named).alias("tissue"), F.split_part("p_brand", F.lit("#"), F.lit(2)).alias("clone"))


@query("O5", "select p_partkey from part order by md5(concat_ws('|', '7', p_partkey)), p_partkey limit 20")
def sampled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.resample import draw

    return table(spark, sf_dir, "part").select("p_partkey").orderBy(draw(7, "p_partkey"), "p_partkey").limit(20)
