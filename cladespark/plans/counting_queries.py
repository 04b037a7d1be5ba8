"""Queries on target depth and sample quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import counting
from ..storage import scratch
from ..streaming import depth
from .registry import query
from .views import table, view

DEPTH = """depths as (select sample, target, count(*) as depth from v_reads r join v_targets t on r.chrom = t.chrom and r.ref_start <= t.t_start and r.ref_end >= t.t_end group by all)"""
MS = """ms as (select sample, count(*) as targets_total, count(*) filter (depth >= 3) as targets_with_min_reads from depths group by sample)"""
CPG = """cpg as (select concat('s0', right(cell, 1)) as sample, count(*) filter (cov > 0) as cpg_count from v_sites group by all)"""
STATS = f"""{DEPTH}, {MS}, {CPG}, stats as (select coalesce(m.sample, c.sample) as sample, coalesce(targets_with_min_reads, 0) as targets_with_min_reads, coalesce(cpg_count, 0) as cpg_count,
 coalesce(targets_with_min_reads, 0) >= 700 and coalesce(cpg_count, 0) >= 0 as pass from ms m full join cpg c on m.sample = c.sample)"""


def depths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.spanning_counts(view(spark, sf_dir, "v_reads"), view(spark, sf_dir, "v_targets"))


def stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    ms = counting.depth_stats(depths(spark, sf_dir), 3)
    sites = view(spark, sf_dir, "v_sites").withColumn("sample", F.concat(F.lit("s0"), F.right("cell", F.lit(1))))
    return counting.merged_stats(ms, counting.cpg_stats(sites), 700, 0)


@query("S24 J1 A1 P1", f"with {DEPTH} select * from depths")
def target_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return depths(spark, sf_dir)


@query("A2 P2", f"with {DEPTH}, {MS} select * from ms")
def sample_depth_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.depth_stats(depths(spark, sf_dir), 3)


@query("J6 P3", f"with {STATS} select * from stats")
def sample_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats(spark, sf_dir)


@query("P4", f"with {STATS} select d.* from depths d where sample in (select sample from stats where pass)")
def passing_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.passing_only(depths(spark, sf_dir), stats(spark, sf_dir))


@query("A3", f"""with {STATS} select count(*) as samples, count(*) filter (pass) as samples_passing,
 round(avg(targets_with_min_reads), 6) as mean_targets_with_min_reads_all, round(median(targets_with_min_reads), 6) as median_targets_with_min_reads_all,
 round(avg(targets_with_min_reads) filter (pass), 6) as mean_targets_with_min_reads_passing, round(median(targets_with_min_reads) filter (pass), 6) as median_targets_with_min_reads_passing,
 round(avg(cpg_count), 6) as mean_cpg_count_all, round(median(cpg_count), 6) as median_cpg_count_all,
 round(avg(cpg_count) filter (pass), 6) as mean_cpg_count_passing, round(median(cpg_count) filter (pass), 6) as median_cpg_count_passing from stats""")
def stats_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.summary(stats(spark, sf_dir))


@query("S10", "select distinct chrom from v_targets")
def target_chromosomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "v_targets").select("chrom").distinct()


@query("O1 O6 U1", """select chrom, t_start, target, row_number() over (order by chrom, t_start, target) as k from (select chrom, t_start, target from v_targets where target % 2 = 0 union all select chrom, t_start, target from v_targets where target % 3 = 0)""")
def merged_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.ordering import numbered_in_order

    targets = view(spark, sf_dir, "v_targets").select("chrom", "t_start", "target")
    return numbered_in_order(targets.filter("target % 2 = 0").unionByName(targets.filter("target % 3 = 0")), ["chrom", "t_start", "target"])


@query("J7 O2 U3", """select c.c_custkey, c.c_mktsegment, coalesce(o.orders, 0) as orders, coalesce(o.total, 0) as total from customer c
 left join (select o_custkey, count(*) as orders, round(sum(o_totalprice), 2) as total from orders group by 1) o on o.o_custkey = c.c_custkey""")
def per_customer_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    joined = table(spark, sf_dir, "customer").join(orders, F.col("o_custkey") == F.col("c_custkey"), "left")
    return joined.select("c_custkey", "c_mktsegment", F.coalesce("orders", F.lit(0)).alias("orders"), F.coalesce("total", F.lit(0.0)).alias("total")).orderBy(F.col("orders").desc(), "c_mktsegment", "c_custkey")


@query("U6 U7 A38", "select l_partkey % 100 as n from lineitem where l_returnflag = 'R' intersect select l_partkey % 100 from lineitem where l_returnflag = 'A' except select l_partkey % 100 from lineitem where l_quantity > 49 and l_partkey % 7 = 0")
def common_without(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumn("n", F.col("l_partkey") % 100)
    of = lambda c: lines.filter(c).select("n")
    return of("l_returnflag = 'R'").intersect(of("l_returnflag = 'A'")).exceptAll(of("l_quantity > 49 and l_partkey % 7 = 0").distinct())


@query("A2 K1", "select sample, count(*) as targets_total, count(*) filter (depth >= 3) as targets_with_min_reads from v_calls group by sample")
def streamed_depth_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures of depth files that a stream reads as they arrive, two at a time; the last version of its table."""
    own = view(spark, sf_dir, "v_calls").select("sample", F.col("target").cast("string").alias("target"), F.col("depth").cast("long").alias("depth"))
    with scratch(spark) as tables:
        arrived, out = f"{tables.root}/arrived", f"{tables.root}/figures"
        own.repartition(5, "target").write.parquet(arrived)
        depth.start(depth.running_stats(depth.arriving_depth(spark, arrived, 2), 3), out, f"{tables.root}/state", once=True).awaitTermination()
        return depth.current(spark, out).checkpoint()
