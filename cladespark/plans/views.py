"""Domain tables derived from the generic test tables, in SQL that Spark and DuckDB both run."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "v_calls": """
select sample, target, depth, case when target%2=0 then 10+2*x1 else 10+x1 end as a1, case when target%2=0 then 10+2*x2 else 10+x2 end as a2, q, stutter
from (select concat('s',lpad(cast(l_suppkey%12 as varchar(10)),2,'0')) as sample, l_partkey%500 as target, count(*) as depth,
  cast(sum(l_linenumber)%3 as bigint) as x1, cast(sum(l_orderkey)%3 as bigint) as x2,
  cast((85+sum(l_orderkey)%16) as double)/100 as q, cast(sum(l_linenumber)%4 as bigint) as stutter
  from {lineitem} group by 1,2) t""",
    "v_targets": """
select p_partkey as target, concat('chr',cast(p_partkey%3+1 as varchar(10))) as chrom, (p_partkey*37)%5000 as t_start,
  (p_partkey*37)%5000+10+p_size%15 as t_end, 10+p_size%15 as num_copies, 1 as motif_len from {part}""",
    "v_reads": """
select concat('s',lpad(cast(l_suppkey%12 as varchar(10)),2,'0')) as sample, concat('chr',cast(l_partkey%3+1 as varchar(10))) as chrom,
  (l_orderkey*53+l_linenumber*7)%5000 as ref_start, (l_orderkey*53+l_linenumber*7)%5000+20+cast(l_quantity as bigint) as ref_end from {lineitem}""",
    "v_sites": """
select concat('c',cast(user_id%8 as varchar(10))) as cell, cast(extract(day from ts) as bigint)*24%200+cast(extract(hour from ts) as bigint) as site,
  count(*) as cov, cast(sum(case when event_type in ('click','purchase') then 1 else 0 end) as bigint) as mc from {events} group by 1,2""",
    "v_refsites": """
select concat('r',cast(l_suppkey%5 as varchar(10))) as ref, l_partkey%200 as site, count(*) as cov,
  cast(sum(case when l_returnflag='R' then 1 else 0 end) as bigint) as mc from {lineitem} group by 1,2""",
    "v_seq": """
select doc_id, translate(concat(md5(text),md5(concat(lang,text)),md5(concat(source,text))),'0123456789abcdef','AAAAAACCCGGGTTTT') as seq from {documents}""",
    "v_samples": """
select distinct concat('s',lpad(cast(s_suppkey%12 as varchar(10)),2,'0')) as sample, concat('g',cast(s_suppkey%4 as varchar(10))) as grp from {supplier}""",
    # a tree of the samples: node k has nodes 2k and 2k + 1 below it, samples are the leaves in the order of their quantities
    "v_tree": """
select k+n-1 as node, cast(floor((k+n-1)/2) as bigint) as parent, sample as name, cast(total%5+1 as double) as len from (
  select sample, total, cast(row_number() over (order by total desc, sample) as bigint) as k, count(*) over () as n from (
    select concat('s',lpad(cast(l_suppkey%12 as varchar(10)),2,'0')) as sample, cast(sum(l_quantity) as bigint) as total from {lineitem} group by 1) t) u
union all select k as node, case when k>1 then cast(floor(k/2) as bigint) end as parent, null as name, cast(total%7+1 as double) as len from (
  select total, cast(row_number() over (order by total desc, sample) as bigint) as k, count(*) over () as n from (
    select concat('s',lpad(cast(l_suppkey%12 as varchar(10)),2,'0')) as sample, cast(sum(l_quantity) as bigint) as total from {lineitem} group by 1) t) u where k<n""",
}
TABLES = {t for text in VIEWS.values() for t in re.findall(r"\{(\w+)\}", text)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = VIEWS[name]
    used = {t: table(spark, sf_dir, t) for t in re.findall(r"\{(\w+)\}", text)}
    return spark.sql(text, **used)


def with_views(body: str) -> str:
    """DuckDB SQL with the views that ``body`` names in front."""
    used = [v for v in VIEWS if re.search(rf"\b{v}\b", body)]
    parts = [f"{v} as ({re.sub(r'[{}]', '', VIEWS[v])})" for v in used]
    rest = body.strip()
    if not parts:
        return rest
    recursive = rest.lower().startswith("with recursive")
    if rest.lower().startswith("with"):
        rest = re.sub(r"(?i)^with\s+(recursive\s+)?", "", rest)
        return f"with {'recursive ' if recursive else ''}" + ",\n".join(parts) + ",\n" + rest
    return "with " + ",\n".join(parts) + "\n" + rest
