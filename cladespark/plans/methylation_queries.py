"""Queries on methylation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import counting, methyl
from .registry import query
from .views import view

USABLE = "cs as (select *, mc / cov as frac from v_sites where cov > 0 and mc >= 0 and mc <= cov), rs as (select *, mc / cov as frac from v_refsites where cov > 0 and mc >= 0 and mc <= cov)"
SCORES = f"""{USABLE}, met as (select cell, ref, count(*) as n, 100 * avg(abs(cs.frac - rs.frac)) as m from cs join rs on cs.site = rs.site group by 1, 2),
 scores as (select c.cell, r.ref, coalesce(n, 0) as shared, case when coalesce(n, 0) >= 20 then m end as score from (select distinct cell from cs) c cross join (select distinct ref from rs) r left join met using (cell, ref))"""
Z = f"{SCORES}, z as (select *, (score - avg(score) over (partition by cell)) / nullif(stddev_samp(score) over (partition by cell), 0) as z from scores)"
ASSIGNED = f"""{Z}, ranked as (select *, row_number() over (partition by cell order by z asc nulls last, ref) as k from z),
 found as (select cell, max(ref) filter (k = 1 and z is not null) as best, max(score) filter (k = 1 and z is not null) as best_score, max(z) filter (k = 1 and z is not null) as best_z, max(ref) filter (k = 2 and z is not null) as second, max(z) filter (k = 2 and z is not null) as second_z from ranked group by 1),
 assigned as (select *, case when best_z < -1.1 then best else 'Unassigned' end as assigned from found)"""


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return methyl.dissimilarity(view(spark, sf_dir, "v_sites"), view(spark, sf_dir, "v_refsites"), 20)


@query("P11 P12", f"with {USABLE} select cell, site, cov, mc, round(frac, 6) as frac from cs")
def usable_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return methyl.usable_sites(view(spark, sf_dir, "v_sites"))


@query("A4 P10", """select cell, count(*) filter (cov > 0) as cpg_count, count(*) filter (cov > 0 and mc / cov > 0.5) as methylated_count,
 round(coalesce(count(*) filter (cov > 0 and mc / cov > 0.5) / nullif(count(*) filter (cov > 0), 0), 0), 6) as methylation_rate from v_sites group by 1""")
def cpg_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.cpg_stats(view(spark, sf_dir, "v_sites"), "cell")


CONTEXT = "case when site % 3 = 0 then 'CGN' when site % 3 = 1 then 'CHG' else 'CTA' end"


@query("P9", f"select cell, site, cov, mc, {CONTEXT} as context from v_sites where {CONTEXT} like 'C%' and {CONTEXT} not like 'CG%'")
def ch_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return methyl.in_context(view(spark, sf_dir, "v_sites").withColumn("context", F.expr(CONTEXT)), "CH")


@query("A5", f"""select cell, round(100 * sum(mc) filter ({CONTEXT} like 'CG%') / sum(cov) filter ({CONTEXT} like 'CG%'), 6) as cg_rate,
 round(100 * sum(mc) filter ({CONTEXT} not like 'CG%') / sum(cov) filter ({CONTEXT} not like 'CG%'), 6) as ch_rate from v_sites group by 1""")
def methylation_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return methyl.coverage_rates(view(spark, sf_dir, "v_sites").withColumn("context", F.expr(CONTEXT)), "cell")


@query("A9 J4 J5", f"with {SCORES} select cell, ref, shared, round(score, 6) as score from scores")
def dissimilarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(spark, sf_dir)


@query("W2", f"with {Z} select cell, ref, shared, round(score, 6) as score, round(z, 6) as z from z")
def z_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return methyl.z_scores(scores(spark, sf_dir))


@query("W3", f"with {ASSIGNED} select cell, best, round(best_score, 6) as best_score, round(best_z, 6) as best_z, second, round(second_z, 6) as second_z, assigned from assigned")
def cell_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return methyl.assigned(scores(spark, sf_dir))


@query("A35", f"with {ASSIGNED} select assigned, count(*) as cells, round(100 * count(*) / sum(count(*)) over (), 6) as percent from assigned group by 1")
def cell_type_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return methyl.assignment_summary(methyl.assigned(scores(spark, sf_dir)))
