"""Queries that write test tables in a tool's format and read the files as that tool's output is read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import sinks
from ..functions.sequence import reverse_complement
from ..operators import counting, probes, reads, tree
from ..sources import bam, excel, lines, logs, text
from ..storage import scratch
from .registry import query
from .views import table, view


def through_files(spark: SparkSession, write: Callable[[str], None], read: Callable[[str], DataFrame], name: str = "files") -> DataFrame:
    """What ``read`` finds in what ``write`` wrote."""
    with scratch(spark) as tables:
        path = f"{tables.root}/{name}"
        write(path)
        return read(path).checkpoint()


def texts_column(template: str) -> Column:
    """value: the template with columns in braces filled in."""
    pieces = template.replace("}", "{").split("{")
    return F.concat(*(F.lit(p) if i % 2 == 0 else F.col(p).cast("string") for i, p in enumerate(pieces))).alias("value")


def lines_of(df: DataFrame, template: str, *junk: str) -> DataFrame:
    """value: the template with columns in braces filled in, after lines that readers must skip."""
    own = df.select(texts_column(template))
    if not junk:
        return own
    first = df.sparkSession.createDataFrame(list(enumerate(junk)), "k int, value string")
    both = first.unionByName(own.withColumn("k", F.lit(len(junk))))
    return both.coalesce(1).sortWithinPartitions("k").select("value")  # in one file, the first line being a heading


def text_file(lines: DataFrame) -> Callable[[str], None]:
    return lambda path: lines.write.text(path)


@query("S7 S8 S20", "select chrom, cast(t_start as integer) as t_start, cast(t_end as integer) as t_end, cast(motif_len as integer) as motif_len, cast(num_copies as integer) as num_copies, concat('T', target) as target from v_targets")
def bed_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = lines_of(view(spark, sf_dir, "v_targets"), "{chrom}\t{t_start}\t{t_end}\t{motif_len}\t{num_copies}\tT{target}", "chr1\tx\t110\t1\t10\tbad", "chr1\t5\t6", "chr9\t1\t2\t1\t10\tT1")
    return through_files(spark, text_file(lines), lambda path: text.bed(spark, path))


@query("S6", "select chrom, cast(t_start as integer) as t_start, cast(t_end as integer) as t_end, concat(chrom, ':', t_start, '-', t_end) as target from v_targets")
def interval_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = lines_of(view(spark, sf_dir, "v_targets"), "{chrom} {t_start}\t{t_end} x", "chr1 5", "")
    return through_files(spark, text_file(lines), lambda path: text.bed_intervals(spark, path))


@query("S9", "select concat(chrom, '_', t_start, '_', t_end, '_', num_copies, 'xAC') as target, cast(num_copies as integer) as num_copies, 'AC' as motif, 'GGTTGGTT' as up, concat('TT', repeat('G', cast(target % 5 as integer))) as down from v_targets")
def probe_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = view(spark, sf_dir, "v_targets").withColumns({"run": F.expr("repeat('AC', cast(num_copies as int))"), "down": F.expr("concat('TT', repeat('G', cast(target % 5 as int)))")})
    return through_files(spark, text_file(lines_of(own, "{chrom}_{t_start}_{t_end}_{num_copies}xAC\tGGTTGGTT{run}{down}")), lambda path: text.probe_info(spark, path))


def vcf_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls of v_calls as records; samples lack some targets."""
    call = F.concat(F.lit("0|1:"), F.col("a1"), F.lit("|"), F.col("a2"), F.lit(":"), F.col("q"), F.lit(":.:"), F.col("depth"), F.lit(":.:"), F.col("stutter"), F.lit(":"), F.col("a1"), F.lit("|"), F.col("depth"))
    target = F.concat(F.lit("T"), F.col("target"), F.lit("_"), 10 + F.col("target") % 20, F.lit("xA"))
    return view(spark, sf_dir, "v_calls").select(F.lit("chr1").alias("chrom"), (F.col("target") + 1).cast("int").alias("pos"), target.alias("target"), F.lit("PERIOD=2;X=1").alias("info"), F.lit("GT:GB:Q:PQ:DP:DSNP:DSTUTTER:MALLREADS").alias("format"), "sample", call.alias("call"))


def vcf_file(spark: SparkSession, sf_dir: str, read: Callable[[DataFrame], DataFrame]) -> DataFrame:
    return through_files(spark, lambda path: sinks.write_vcf(vcf_records(spark, sf_dir), path), lambda path: read(text.vcf(spark, path)))


NAME = "concat('T', target, '_', 10 + target % 20, 'xA')"


@query("S11 K18 P5", f"select 'chr1' as chrom, cast(target + 1 as integer) as pos, {NAME} as target, sample, cast(a1 as integer) as g1, cast(a2 as integer) as g2, q, cast(depth as integer) as depth, cast(stutter as integer) as stutter, concat(a1, '|', depth) as reads from v_calls")
def vcf_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vcf_file(spark, sf_dir, text.calls).select("chrom", "pos", "target", "sample", F.get("gb", F.lit(0)).alias("g1"), F.get("gb", F.lit(1)).alias("g2"), "q", "depth", "stutter", "reads")


@query("S12 S15", f"select {NAME} as target, sample, cast(coalesce(depth, 0) as integer) as depth from (select distinct target from v_calls) cross join (select distinct sample from v_calls) left join v_calls using (target, sample)")
def vcf_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vcf_file(spark, sf_dir, text.coverage)


@query("S13 A16", "select 'c' as cohort, cast(10 + target % 20 as integer) as length, count(*) as n, round(median(q), 6) as median_q from v_calls where 10 + target % 20 <= 25 group by all")
def vcf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vcf_file(spark, sf_dir, lambda records: text.quality_by_length(records, "c")).groupBy("cohort", "length").agg(F.count(F.lit(1)).alias("n"), F.median("q").alias("median_q"))


@query("S14", f"select {NAME} as target, sample, least(a1, a2) / 2.0 as lo, greatest(a1, a2) / 2.0 as hi from v_calls")
def vcf_alleles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vcf_file(spark, sf_dir, text.both_alleles).filter("lo is not null")


CONTEXT = "case site % 3 when 0 then 'CGA' when 1 then 'CHG' else 'CGT' end"


def allc_file(spark: SparkSession, sf_dir: str, read: Callable[[str], DataFrame]) -> DataFrame:
    sites = view(spark, sf_dir, "v_sites").selectExpr("*", "site % 5 as chrom", f"{CONTEXT} as context")
    lines = lines_of(sites, "chr{chrom}\t{site}\t+\t{context}\t{mc}\t{cov}\t1", "#chrom\tpos", "chr1\t7\t+\tCGT\t3\t2\t1", "chr1\t8\t+\tCGT\t0\t0\t0", "bad")
    return through_files(spark, text_file(lines), read)


@query("S16 P9 P11 P12", f"select cast(site % 5 as varchar) as chrom, cast(site as integer) as pos, {CONTEXT} as context, cast(mc as integer) as mc, cast(cov as integer) as cov, concat(site % 5, '_', site) as site, round(mc / cov, 6) as frac from v_sites where site % 3 <> 1")
def allc_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return allc_file(spark, sf_dir, lambda path: text.allc(spark, path)).select("chrom", "pos", "context", "mc", "cov", "site", "frac")


@query("S17 S18", "select count(*) filter (site % 3 <> 1) + 2 as cpgs from v_sites")
def allc_cpgs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return allc_file(spark, sf_dir, lambda path: text.cpg_lines(spark, path)).select("cpgs")


@query("S19 K1 U2", "select cast(target as varchar) as target, depth from v_calls where sample = 's01'")
def depth_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = view(spark, sf_dir, "v_calls").filter("sample = 's01'").select(F.col("target").alias("target_id"), "depth")
    return through_files(spark, lambda path: sinks.write_tsv(own, path, ["target_id"]), lambda path: text.depth_files(spark, path)).select("target", "depth")


@query("S1 S2 S3 S4 S5", "select sample as sample_id, case when grp = 'g1' then 'unknown' else grp end as grp, case when grp = 'g2' then 'red' else 'grey' end as color, grp = 'g0' as has_meth from v_samples")
def sample_sheet_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = view(spark, sf_dir, "v_samples").selectExpr("sample", "case when grp = 'g1' then '' else grp end as grp", "case when grp = 'g2' then 'red' else '' end as color", "case when grp = 'g0' then 'm.fq' else '' end as meth")
    lines = lines_of(own, "{sample},a.fq,{meth},{grp},{color}", "sample_id,ms_fastq_1,meth_fastq_1,group,color", "#x,a.fq,,g,", ",a.fq,,g,")
    sheet = through_files(spark, text_file(lines), lambda path: text.with_reads(text.sample_sheet(spark, path)))
    return sheet.select("sample_id", "grp", "color", F.col("meth_fastq_1").isNotNull().alias("has_meth"))


@query("S21 S22 K5 K8", "select cell as row, concat('p', site % 7) as col, round(sum(mc) / 3.0, 4) as value from v_sites group by all")
def matrix_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = view(spark, sf_dir, "v_sites").groupBy(F.col("cell").alias("row"), F.expr("concat('p', site % 7)").alias("col")).agg((F.sum("mc") / 3).alias("v"))
    return through_files(spark, lambda path: sinks.write_matrix(cells, path, "row", "col", "v"), lambda path: text.matrix(spark, path), "matrix.csv")


@query("S25 S26 S27 F4", "select seq as read_r1, seq as read_r2 from v_seq")
def fastq_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    seqs = view(spark, sf_dir, "v_seq")
    mates = {"r1": F.col("seq"), "r2": reverse_complement(F.col("seq"))}

    def write(path: str) -> None:
        for mate, seq in mates.items():
            own = seqs.repartition(3, "doc_id").sortWithinPartitions("doc_id").select("doc_id", seq.alias("seq"))
            lines_of(own, "@{doc_id}\n{seq}\n+\n{seq}").write.text(f"{path}/{mate}")

    return through_files(spark, write, lambda path: reads.extract_paired(text.fastq(spark, f"{path}/r1"), text.fastq(spark, f"{path}/r2"))).select("read_r1", "read_r2")


@query("S25 S27", "select seq, row_number() over (order by doc_id) - 1 as read_no from v_seq")
def fastq_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads of block-gzip FASTQ files, each read in ranges of 4 KB, in the order of their files."""
    lines_in_order = lines_of(view(spark, sf_dir, "v_seq"), "@{doc_id}\n{seq}\n+\n{seq}").withColumn("k", F.regexp_extract("value", r"^@(\d+)", 1).cast("long"))
    ordered = lines_in_order.repartitionByRange(3, "k").sortWithinPartitions("k").select("value")

    def read(path: str) -> DataFrame:
        found = text.fastq(spark, f"{path}/*.gz", split=1 << 12)
        sizes = found.groupBy("file_no").agg(F.count(F.lit(1)).alias("n"))  # a row for each file
        before = F.coalesce(F.sum("n").over(Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        return found.join(F.broadcast(sizes.select("file_no", before.alias("before"))), "file_no").select("seq", (F.col("before") + F.col("read_no")).alias("read_no"))

    return through_files(spark, lambda path: lines.write_blocks(ordered, path), read)


@query("S28 K15", "select concat('d', doc_id) as chrom, seq from v_seq")
def fasta_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    seqs = view(spark, sf_dir, "v_seq").select(F.concat(F.lit("d"), "doc_id").alias("target"), F.lower("seq").alias("seq"))
    return through_files(spark, lambda path: sinks.write_fasta(seqs, path), lambda path: text.fasta(spark, path))


@query("S30", "select concat('E', n_nationkey) as name, concat(repeat('G', cast(n_nationkey % 4 as integer)), 'A|TC') as site, concat(repeat('G', cast(n_nationkey % 4 as integer)), 'ATC') as seq, cast(n_nationkey % 4 + 1 as integer) as cut from nation")
def enzyme_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "nation").selectExpr("n_nationkey", "repeat('G', cast(n_nationkey % 4 as int)) as g")
    return through_files(spark, text_file(lines_of(own, "E{n_nationkey}  {g}A|TC", "", "E1 NOBAR")), lambda path: text.enzymes(spark, path))


@query("S31 P18", "select chrom, cast(t_start as integer) as start, cast(t_start + 2 * num_copies as integer) as \"end\", cast(num_copies as integer) as copies, 'AC' as motif, concat(chrom, ':', t_start, '_', t_start + 2 * num_copies, '_', num_copies, 'xAC') as target from v_targets")
def repeat_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = lines_of(view(spark, sf_dir, "v_targets"), "585\t{chrom}\t{t_start}\t{t_end}\t{num_copies}xAC", "#bin\tchrom\tstart\tend\tname", "585\tchr1\tx\t1\t3xA")
    return through_files(spark, text_file(lines), lambda path: text.repeat_locations(spark, path))


@query("S23 K6 T7", "select name, len from v_tree where name is not null")
def newick_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = view(spark, sf_dir, "v_tree").select(F.lit(1).alias("tree_id"), "node", "parent", "name", "len", F.lit(None).cast("double").alias("support"))
    return through_files(spark, lambda path: sinks.write_newick(tree.to_newick(own).coalesce(1), path), lambda path: tree.from_newick(text.newick_files(spark, path).filter("newick <> ''")).filter("name is not null").select("name", "len"))


def log_texts(spark: SparkSession, sf_dir: str, template: str) -> DataFrame:
    """The texts of log files, a file for each nation, as the tools leave them."""
    own = table(spark, sf_dir, "nation").selectExpr("n_nationkey as k", "format_number(n_nationkey * 1000 + 1234, 0) as total", "n_nationkey * 100 + 7 as mapped", "n_nationkey + 1 as few")
    logged = lines_of(own, template).withColumn("log", F.xxhash64("value"))
    return through_files(spark, lambda path: logged.repartition("log").write.partitionBy("log").text(path), lambda path: logs.whole(spark, path))


@query("S33", "select concat('s', n_nationkey) as sample, n_nationkey * 1000 + 1234 as total, n_nationkey * 100 + 7 as mapped, n_nationkey + 1 as deduplicated from nation")
def methylpy_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = log_texts(spark, sf_dir, "Start\nProcessing file: s{k}\nThere are {total} total input read pairs\nThere are {mapped} uniquely mapping read pairs\nThere are {few} non-clonal read pairs\nProcessing file: broken\n")
    return logs.methylpy_sessions(texts).select("sample", *(F.col(c).cast("long").alias(c) for c in ("total", "mapped", "deduplicated")))


@query("S34 A33", "select count(*) as sessions, sum(n_nationkey * 1000 + 1234) as total, round(avg(n_nationkey * 1000 + 1234), 6) as mean, round(median(n_nationkey * 1000 + 1234), 6) as median from nation")
def methylpy_single_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = log_texts(spark, sf_dir, "Processing file: s{k}\nThere are {total} total input reads\nThere are {mapped} uniquely mapping reads\n")
    sums = logs.run_summary(logs.methylpy_sessions(texts, paired=False), "total")
    return sums.select("sessions", F.col("total").cast("long").alias("total"), F.col("mean").cast("double").alias("mean"), F.col("median").cast("double").alias("median"))


@query("S35", "select n_nationkey * 100 + 7 as total, n_nationkey + 1.5 as mapped_percent from nation")
def flagstat_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = log_texts(spark, sf_dir, "{mapped} + 0 in total\n1\n2\n3\n4\n5\n7 + 0 mapped ({few}.5% : N/A)\n8")
    return logs.flagstat(texts).select(F.col("total").cast("long").alias("total"), (F.col("mapped_percent") - 0).alias("mapped_percent"))


@query("S36", "select 'A' as metric, cast(n_nationkey + 1 as varchar) as value from nation union all select 'B', cast(n_nationkey * 100 + 7 as varchar) from nation union all select 'C', null from nation")
def hs_metrics_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.hs_metrics(log_texts(spark, sf_dir, "## htsjdk\n# x\n## METRICS CLASS\tx\nA\tB\tC\n{few}\t{mapped}\t\n\n")).select("metric", "value")


@query("S37 A34", "select floor(round(100 * avg(n_nationkey + 1.25), 6)) / 100 as efficiency, floor(round(100 * avg(n_nationkey + 1.5), 6)) / 100 as cpg, floor(round(10000 - 100 * floor(round(100 * avg(n_nationkey + 1.5), 6)) / 100, 6)) / 100 as conversion from nation")
def bismark_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = log_texts(spark, sf_dir, "Mapping efficiency:\t{few}.25%\nC methylated in CpG context:\t{few}.5%\nC methylated in CHG context:\t1.0%\nC methylated in CHH context:\t2.0%\n")
    return logs.bismark_average(logs.bismark_report(texts)).select("efficiency", "cpg", "conversion")


@query("K3 K7 K9", "select 'targets' as name, cast(count(*) as varchar) as value from v_targets union all select 'largest', cast(max(num_copies) as varchar) from v_targets union all select 'any', 'True'")
def report_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    figures = view(spark, sf_dir, "v_targets").agg(F.count(F.lit(1)).alias("targets"), F.max("num_copies").alias("largest"), F.lit(True).alias("any"))
    return through_files(spark, lambda path: sinks.write_report(figures, path), lambda path: spark.read.csv(path, sep="\t", schema="name string, value string"))


@query("K2 K10 K11 K14", "select cast(target as varchar) as target, case when motif_len * num_copies > 15 then 'True' else 'False' end as long, concat(t_start, ',', t_end) as span from v_targets")
def tsv_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = view(spark, sf_dir, "v_targets").selectExpr("target", "motif_len * num_copies > 15 as long", "array(t_start, t_end) as span")
    return through_files(spark, lambda path: sinks.write_tsv(own, path, ["target"]), lambda path: spark.read.csv(path, sep="\t", header=True))


@query("K17 K19", "select cast(target as varchar) as target, chrom, case when num_copies > 15 then 'True' else 'False' end as long from v_targets")
def csv_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = view(spark, sf_dir, "v_targets").selectExpr("target", "chrom", "num_copies > 15 as long")
    return through_files(spark, lambda path: sinks.write_csv(own, path), lambda path: spark.read.csv(path, header=True))


@query("K13 F15", "select target, chrom, num_copies from v_targets")
def json_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = view(spark, sf_dir, "v_targets").select("target", "chrom", "num_copies")
    return through_files(spark, lambda path: sinks.write_json(own, path), lambda path: spark.read.schema(own.schema).json(path))


@query("K4 K12", "select sample, target, a1, a2 from v_calls")
def alleles_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = view(spark, sf_dir, "v_calls").select("sample", "target", F.array("a1", "a2").alias("alleles"))
    back = through_files(spark, lambda path: sinks.write_alleles(own, path), lambda path: spark.read.parquet(path))
    return back.select("sample", "target", F.get("alleles", F.lit(0)).alias("a1"), F.get("alleles", F.lit(1)).alias("a2"))


@query("K16", "select concat('P', target, x) as probe from v_targets, (values ('a'), ('b')) t(x)")
def probe_order_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = view(spark, sf_dir, "v_targets").select("target", F.expr("array(concat('P', target, 'a'), concat('P', target, 'b'))").alias("probe_list"))
    return through_files(spark, lambda path: sinks.write_probes(own, f"{path}/order", f"{path}/info"), lambda path: spark.read.text(f"{path}/order").withColumnRenamed("value", "probe"))


def bam_files(spark: SparkSession, sf_dir: str) -> Callable[[str], None]:
    """Writes v_reads as BAM files, samples as read groups."""
    named = view(spark, sf_dir, "v_reads").withColumns({"read_group": F.col("sample"), "name": F.concat_ws(":", "sample", "ref_start", "ref_end")})
    ends = named.groupBy("chrom").agg(F.max("ref_end").alias("end")).orderBy("chrom").collect()  # a row for each chromosome
    return lambda path: bam.write_reads(named, path, {r["chrom"]: r["end"] + 1 for r in ends})


BAM_DEPTHS = "select sample, target, count(*) as depth from v_reads r join v_targets t on r.chrom = t.chrom and r.ref_start <= t.t_start and r.ref_end >= t.t_end"


@query("S24 J1 A1 P1", f"{BAM_DEPTHS} group by all")
def bam_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Depths from BAM files, each read in ranges of 64 KB."""
    return through_files(spark, bam_files(spark, sf_dir), lambda path: counting.spanning_counts(bam.reads(spark, path, split=1 << 16), view(spark, sf_dir, "v_targets")))


@query("S24", f"{BAM_DEPTHS} where t.chrom = 'chr2' and t.t_start between 1000 and 1999 group by all")
def bam_region_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Depths of the targets of one region, for which only the blocks are read that the index names."""
    targets = view(spark, sf_dir, "v_targets").filter("chrom = 'chr2' and t_start between 1000 and 1999")
    return through_files(spark, bam_files(spark, sf_dir), lambda path: counting.spanning_counts(bam.reads(spark, path, regions=[("chr2", 1000, 2000)]), targets))


@query("S24 P19", "select sample, chrom, count(*) as reads, sum(ref_end - ref_start) as covered from v_reads group by all")
def bam_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return through_files(spark, bam_files(spark, sf_dir), lambda path: bam.reads(spark, path).groupBy("sample", "chrom").agg(F.count(F.lit(1)).alias("reads"), F.sum((F.col("ref_end") - F.col("ref_start")).cast("long")).alias("covered")))


@query("S32 K19 U3", "select cast(target as varchar) as target, chrom, cast(t_start as varchar) as t_start, case when target % 5 = 0 then null else concat('<', num_copies, '> & _x0041_ ', chr(9)) end as note from v_targets")
def excel_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table in several workbooks of several sheets."""
    rows = view(spark, sf_dir, "v_targets").select("target", "chrom", "t_start", F.when(F.col("target") % 5 != 0, F.concat(F.lit("<"), "num_copies", F.lit("> & _x0041_ \t"))).alias("note"))
    return through_files(spark, lambda path: excel.write_tables(rows.repartition(3), path, rows=150), lambda path: excel.tables(spark, path))


@query("S21", "select concat('t', target) as row, 'start' as col, cast(t_start as double) as value from v_targets union all select concat('t', target), 'end', cast(t_end as double) from v_targets")
def excel_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "v_targets").select(F.concat(F.lit("t"), "target").alias("name"), F.col("t_start").alias("start"), F.col("t_end").alias("end"))
    return through_files(spark, lambda path: excel.write_tables(rows, path), lambda path: text.matrix(spark, f"{path}/*.xlsx"))


@query("S38", "select concat('Brain_', n_nationkey, '_Plate1') as sample, n_nationkey + 50.5 as rate from nation where n_nationkey % 4 <> 1")
def bisulfite_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "nation").selectExpr("n_nationkey as k", "case when n_nationkey % 4 = 1 then 'no rate' else concat('Bisulfite conversion rate: ', n_nationkey + 50.5, '% (x)\n  Bisulfite conversion rate: 1%') end as rate")
    lines_ = lines_of(own, "Summary for Methyl_X_SC_Brain_{k}_20250422_Plate1_:\n reads 5\n  {rate}").repartition(3)
    found = through_files(spark, lambda path: lines_.write.text(path), lambda path: logs.bisulfite_summary(logs.whole(spark, path)))
    return found.select("sample", "rate")


@query("S40", "select concat('r', n_nationkey, '.cov.', n_nationkey * 10) as run, n_nationkey * 10 as n_target, round(100 * (n_nationkey + 1) / 50, 6) as accuracy, n_nationkey + 30 as n_sample, n_nationkey + 0.25 as targets_per_pair from nation where n_nationkey <> 3")
def downsampled_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy tables and tree reports of runs; one run has no accuracy table."""
    own = table(spark, sf_dir, "nation").selectExpr("n_nationkey as k", "concat('r', n_nationkey, '.cov.', n_nationkey * 10) as run", "(n_nationkey + 1) / 50 as share", "n_nationkey + 30 as n", "n_nationkey + 0.25 as shared")

    def write(path: str) -> None:
        for suffix, rows, template in (("evalPhylo", own.filter("k <> 3"), "MRCA_Distance\tCorrect_Triplets\tTotal_Triplets\tPercent_Accuracy\n2\t1\t2\t0.5\nAll_Distances\t{k}\t50\t{share}"), ("buildPhylo.stats", own, "Number of Samples Analyzed:\t{n}\na,b\nAvg targets captured per single cell:\t9.5\t[Min:1, Max:2]\nAvg targets shared per pair of cells:\t{shared}\t[Min:1, Max:3]\n")):
            named = F.concat("run", F.lit(f".{suffix}.txt")).alias("run")
            rows.select(named, texts_column(template)).repartition("run").write.partitionBy("run").text(f"{path}/{suffix}")

    return through_files(spark, write, lambda path: logs.accuracies(spark, f"{path}/evalPhylo").join(logs.tree_figures(spark, f"{path}/buildPhylo.stats"), "run"))


@query("S29 S28", "with own as (select concat('t', doc_id, '_5xA') as target, seq from v_seq) select target from own where not (strpos(seq, 'AAAAA') - 1 >= 5 and strpos(seq, 'AAAAA') - 1 + 5 <= length(seq) - 5)")
def bad_target_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = view(spark, sf_dir, "v_seq").select(F.concat(F.lit("t"), "doc_id", F.lit("_5xA")).alias("target"), "seq")
    return through_files(spark, lambda path: sinks.write_fasta(own, path), lambda path: probes.bad_targets(text.fasta(spark, path)))


@query("S20", "select concat('sample=', sample) as folder, cast(row_number() over (order by sample) as bigint) as place from (select distinct sample from v_calls where sample <> 's03') t")
def listed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that overlapping patterns name, once each and in order."""
    own = view(spark, sf_dir, "v_calls").select("sample", F.col("target").cast("string").alias("value")).repartition("sample")

    def read(path: str) -> DataFrame:
        found = text.files(spark, [f"{path}/sample=s0[0-24-9]/*", f"{path}/sample=s1*/*", f"{path}/sample=s05/*"]).withColumn("id", F.monotonically_increasing_id())
        return found.select(F.regexp_extract("file", r"([^/]+)/[^/]+$", 1).alias("folder"), F.row_number().over(Window.orderBy("id")).cast("long").alias("place"))  # a row for each file

    return through_files(spark, lambda path: own.write.partitionBy("sample").text(path), read)
