"""Tables from the text files that the sequencing tools write. Malformed rows are skipped, never raised on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.sequence import strip_affixes, without_chr
from ..operators.genome import SIZE, tiled
from . import excel
from .lines import SPLIT, before_parts, numbered

#: Headings of sequences that are broadcast; more are joined by a shuffle.
BROADCAST_HEADS = 100_000


def files(spark: SparkSession, patterns: str | list[str]) -> DataFrame:
    """file: the files that paths, folders and patterns name, each once, in order; none for a pattern that fits nothing. Nothing of them is read."""
    found = set()
    for pattern in [patterns] if isinstance(patterns, str) else patterns:
        path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        for status in system.globStatus(path) or []:
            inside = system.listStatus(status.getPath()) if status.isDirectory() else [status]
            found |= {f.getPath().toString() for f in inside if f.isFile() and f.getPath().getName()[0] not in "._"}
    return spark.createDataFrame([(f,) for f in sorted(found)], "file string")


def sample_sheet(spark: SparkSession, path: str) -> DataFrame:
    """sample_id, ms_fastq_1, meth_fastq_1, grp, color, clone; rows without an id or with one that starts with # are left out."""
    raw = spark.read.csv(path, header=True, comment="#")
    have = {c.strip().lower(): c for c in raw.columns}
    column = lambda name: F.nullif(F.trim(F.col(f"`{have[name]}`")), F.lit("")) if name in have else F.lit(None).cast("string")
    out = raw.select(*(column(n).alias(n) for n in ("sample_id", "ms_fastq_1", "meth_fastq_1", "group", "color", "clone")))
    out = out.filter(F.col("sample_id").isNotNull() & ~F.col("sample_id").startswith("#"))
    return out.select("sample_id", "ms_fastq_1", "meth_fastq_1", F.coalesce("group", F.lit("unknown")).alias("grp"), F.coalesce("color", F.lit("grey")).alias("color"), "clone")


def with_reads(sheet: DataFrame, column: str = "ms_fastq_1") -> DataFrame:
    """The rows that name a file in that column."""
    return sheet.filter(F.col(column).isNotNull())


def bed(spark: SparkSession, path: str) -> DataFrame:
    """chrom, t_start, t_end, motif_len, num_copies, target of rows of six fields; of a repeated target the last row."""
    rows = numbered(spark, path).withColumn("f", F.split(F.rtrim("value"), "\t")).filter(F.size("f") >= 6)
    at = lambda i: F.get("f", F.lit(i))
    out = rows.select("file", "line", at(0).alias("chrom"), at(1).try_cast("int").alias("t_start"), at(2).try_cast("int").alias("t_end"), at(3).try_cast("int").alias("motif_len"), at(4).try_cast("int").alias("num_copies"), at(5).alias("target")).dropna(subset=["t_start", "t_end", "motif_len", "num_copies"])
    return last_of_target(out, ["chrom", "t_start", "t_end", "motif_len", "num_copies", "target"])


def last_of_target(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The last row (by file and line) of each target; rows are compared before they are shuffled."""
    return rows.groupBy(F.col("target").alias("_of")).agg(F.max_by(F.struct(*columns), F.struct("file", "line")).alias("r")).select("r.*")


def bed_intervals(spark: SparkSession, path: str) -> DataFrame:
    """chrom, t_start, t_end, target (chrom:start-end) of rows of three fields, parted by any white space."""
    rows = spark.read.text(path).select(F.split(F.trim("value"), r"\s+").alias("f")).filter(F.size("f") >= 3)
    out = rows.select(F.get("f", F.lit(0)).alias("chrom"), F.get("f", F.lit(1)).try_cast("int").alias("t_start"), F.get("f", F.lit(2)).try_cast("int").alias("t_end")).dropna()
    return out.withColumn("target", F.concat("chrom", F.lit(":"), "t_start", F.lit("-"), "t_end"))


def probe_info(spark: SparkSession, path: str) -> DataFrame:
    """target, num_copies, motif, up, down: target names ``chr_start_end_NxSEQ`` with their sequence, cut at the repeat so that both flanks together are longest."""
    rows = spark.read.text(path).select(F.split("value", "\t").alias("f")).filter(F.size("f") >= 2)
    named = rows.select(F.get("f", F.lit(0)).alias("target"), F.get("f", F.lit(1)).alias("seq")).withColumns({"num_copies": F.regexp_extract("target", r"_(\d+)x[A-Z]+$", 1).try_cast("int"), "motif": F.regexp_extract("target", r"_\d+x([A-Z]+)$", 1)}).filter("num_copies is not null and motif <> ''")
    pieces = F.split(F.col("seq"), F.concat(F.lit("(?:"), F.repeat("motif", F.col("num_copies")), F.lit(")")), -1)
    return named.select("target", "num_copies", "motif", "seq", pieces.alias("p")).select("target", "num_copies", "motif", *longest_pair(F.col("p")))


def longest_pair(pieces: Column) -> list[Column]:
    """up and down: the neighbouring pieces that are longest together; null where there is one piece only."""
    pairs = F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), lambda p, i: F.struct((F.char_length(p) + F.char_length(F.get(pieces, i + 1))).alias("n"), (-i).alias("o"), p.alias("up"), F.get(pieces, i + 1).alias("down")))
    best = F.array_max(pairs)
    return [best["up"].alias("up"), best["down"].alias("down")]


def from_tenth(parts: Column) -> Column:
    """The columns of samples."""
    return F.slice(parts, F.lit(10), F.greatest(F.size(parts) - 9, F.lit(0)))


def vcf(spark: SparkSession, path: str) -> DataFrame:
    """chrom, pos, target, info, format, sample, call, line: a row for each sample of each record; of a repeated target the last."""
    lines = numbered(spark, path)
    header = lines.filter(F.col("value").startswith("#CHROM")).select("file", from_tenth(F.split("value", r"\s+")).alias("samples"))
    body = lines.filter(~F.col("value").startswith("#") & (F.trim("value") != "")).withColumn("f", F.split(F.trim("value"), r"\s+")).filter(F.size("f") > 9)
    rows = body.join(header, "file")
    at = lambda i: F.get("f", F.lit(i))
    one = rows.select("file", "line", at(0).alias("chrom"), at(1).try_cast("int").alias("pos"), at(2).alias("target"), at(7).alias("info"), at(8).alias("format"), F.arrays_zip("samples", from_tenth(F.col("f")).alias("calls")).alias("s"))
    one = last_of_target(one, ["chrom", "pos", "target", "info", "format", "line", "s"])
    return one.select("chrom", "pos", "target", "info", "format", "line", F.explode("s").alias("s")).select("chrom", "pos", "target", "info", "format", "line", F.col("s")["samples"].alias("sample"), F.col("s")["calls"].alias("call"))


def call_field(name: str, position: int) -> Column:
    """A part of a call by its name in FORMAT, or by its place where FORMAT doesn't name it; a dot is missing."""
    parts, names = F.split("call", ":"), F.split("format", ":")
    at = F.array_position(names, name)
    place = F.lit(position) if position >= 0 else F.size(parts) + position
    return F.nullif(F.get(parts, F.when(at > 0, (at - 1).cast("int")).otherwise(place)), F.lit("."))


def calls(records: DataFrame) -> DataFrame:
    """chrom, pos, target, sample, gb, q, depth, stutter, reads of records with more than seven parts to a call."""
    long_ = records.filter(F.size(F.split("call", ":")) > 7)
    gb = F.transform(F.split(call_field("GB", 1), r"[|/]"), lambda x: x.try_cast("int"))
    return long_.select("chrom", "pos", "target", "sample", gb.alias("gb"), call_field("Q", 2).try_cast("double").alias("q"), call_field("DP", 4).try_cast("int").alias("depth"), call_field("DSTUTTER", 6).try_cast("int").alias("stutter"), call_field("MALLREADS", -2).alias("reads"))


def coverage(records: DataFrame) -> DataFrame:
    """target, sample, depth: DP of every call, 0 where it is missing."""
    return records.select("target", "sample", F.coalesce(call_field("DP", 4).try_cast("int"), F.lit(0)).alias("depth"))


def quality_by_length(records: DataFrame, cohort: str, longest: int = 25) -> DataFrame:
    """cohort, length, q: quality of calls by the repeat number in the target's name, for numbers up to ``longest``."""
    length = F.regexp_extract("target", r"_(\d+)x[ATGC]$", 1).try_cast("int")
    return records.select(F.lit(cohort).alias("cohort"), length.alias("length"), call_field("Q", 2).try_cast("double").alias("q")).filter(F.col("length").isNotNull() & F.col("q").isNotNull() & (F.col("length") <= longest))


def both_alleles(records: DataFrame) -> DataFrame:
    """target, sample, lo, hi: both differences in repeat units, of GB and the record's PERIOD."""
    gb = F.transform(F.split(call_field("GB", 1), r"[|/]"), lambda x: x.try_cast("double"))
    period = F.regexp_extract("info", r"PERIOD=(\d+)", 1).try_cast("double")
    lo, hi = (F.try_divide(f(F.get(gb, F.lit(0)), F.get(gb, F.lit(1))), period) for f in (F.least, F.greatest))
    return records.select("target", "sample", lo.alias("lo"), hi.alias("hi"))


def allc(spark: SparkSession, paths: str | list[str], cg_only: bool = True) -> DataFrame:
    """file, chrom, pos, strand, context, mc, cov, site, frac of usable sites; ``chr`` in front of names goes."""
    rows = spark.read.text(paths).filter(~F.col("value").startswith("#")).select(F.input_file_name().alias("file"), F.split("value", "\t").alias("f")).filter(F.size("f") >= 6)
    at = lambda i: F.get("f", F.lit(i))
    out = rows.select("file", without_chr(at(0)).alias("chrom"), at(1).try_cast("int").alias("pos"), at(2).alias("strand"), at(3).alias("context"), at(4).try_cast("int").alias("mc"), at(5).try_cast("int").alias("cov")).dropna(subset=["pos", "mc", "cov"])
    out = out.filter("cov > 0 and mc >= 0 and mc <= cov")
    if cg_only:
        out = out.filter(F.col("context").startswith("CG"))
    return out.withColumns({"site": F.concat_ws("_", "chrom", "pos"), "frac": F.col("mc") / F.col("cov")})


def cell_name(file: Column) -> Column:
    return strip_affixes(F.element_at(F.split(file, "/"), -1), "allc_", ".tsv.gz")


def reference_name(file: Column) -> Column:
    return F.split_part(F.element_at(F.split(file, "/"), -1), F.lit("."), F.lit(1))


def cpg_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """file, cpgs: lines after the first whose context (fourth field) is CG."""
    body = numbered(spark, paths).filter("line > 0")
    return body.groupBy("file").agg(F.count_if(F.get(F.split("value", "\t"), F.lit(3)).startswith("CG")).alias("cpgs"))


def depth_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """sample, target, depth; the sample is the file's name up to its first dot. Headings and blank lines are skipped."""
    rows = spark.read.text(paths).select(F.input_file_name().alias("file"), F.split(F.trim("value"), "\t").alias("f"))
    out = rows.select(F.regexp_extract("file", r"([^/]+?)\.[^/]*$", 1).alias("sample"), F.get("f", F.lit(0)).alias("target"), F.get("f", F.lit(1)).try_cast("long").alias("depth"))
    return out.filter("depth is not null")


def interval_list(spark: SparkSession, path: str) -> DataFrame:
    """chrom, start, end, strand, name; header lines start with @."""
    return spark.read.csv(path, sep="\t", comment="@", schema="chrom string, start int, end int, strand string, name string")


def matrix(spark: SparkSession, path: str, value: str = "value") -> DataFrame:
    """row, col, value of a square or other matrix with names in the first row and column; parted by commas, or tabs in .tsv and .txt files, or a workbook."""
    raw = excel.tables(spark, path) if path.endswith(".xlsx") else spark.read.csv(path, header=True, sep="\t" if path.endswith((".tsv", ".txt")) else ",")
    first, *rest = raw.columns
    cells = F.explode(F.array(*(F.struct(F.lit(c).alias("col"), F.col(f"`{c}`").try_cast("double").alias(value)) for c in rest)))
    return raw.select(F.col(f"`{first}`").alias("row"), cells.alias("c")).select("row", "c.*")


def fastq(spark: SparkSession, path: str | list[str], split: int = SPLIT) -> DataFrame:
    """file_no (the file's place among those that the path names), read_no in its file, seq: the second of every four lines."""
    lines = numbered(spark, path, split).filter("pmod(line, 4) = 1")
    return lines.select("file_no", F.floor(F.col("line") / 4).alias("read_no"), F.trim("value").alias("seq"))


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """chrom, seq (upper case): the lines under each heading joined."""
    lines = numbered(spark, path)
    heading = F.col("value").startswith(">")
    so_far = F.sum(heading.cast("int")).over(Window.partitionBy("file", "part").orderBy("line").rowsBetween(Window.unboundedPreceding, 0))
    named = lines.withColumn("_k", so_far).join(before_parts(lines, heading.cast("int")), ["file", "part"]).withColumn("n", F.col("_k") + F.col("_before")).filter("n > 0")
    heads = named.filter(heading).select("file", "n", F.regexp_extract("value", r"^>(\S*)", 1).alias("chrom"))
    parts = named.filter(~heading).groupBy("file", "n").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", F.trim("value").alias("v")))), lambda x: x["v"]), "").alias("seq"))  # one sequence
    return heads.join(parts, ["file", "n"], "left").select("chrom", F.upper(F.coalesce("seq", F.lit(""))).alias("seq"))


def fasta_tiles(spark: SparkSession, path: str | list[str], size: int = SIZE) -> DataFrame:
    """The tiles (``operators.genome``) of the sequences of FASTA files, without a chromosome being one value.

    Each line's place in its sequence is a running sum of line lengths within a part of the file, and sums of parts before.
    """
    lines = numbered(spark, path).withColumn("value", F.trim("value"))
    heading = F.col("value").startswith(">")
    marked = lines.withColumns({"head": heading, "n": F.when(heading, F.lit(0)).otherwise(F.char_length("value")).cast("long")})
    parts = marked.join(before_parts(marked, F.col("head").cast("int")).withColumnRenamed("_before", "heads"), ["file", "part"]).join(before_parts(marked, F.col("n")).withColumnRenamed("_before", "bases"), ["file", "part"])
    upto = Window.partitionBy("file", "part").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    placed = parts.withColumns({"sequence": F.col("heads") + F.sum(F.col("head").cast("int")).over(upto), "at": F.col("bases") + F.sum("n").over(upto) - F.col("n")})
    heads = placed.filter("head").select("file", "sequence", F.regexp_extract("value", r"^>(\S*)", 1).alias("chrom"), F.col("at").alias("first"))
    few = heads.limit(BROADCAST_HEADS + 1).count() <= BROADCAST_HEADS
    named = placed.filter("not head and n > 0").select("file", "sequence", "at", "value").join(F.broadcast(heads) if few else heads, ["file", "sequence"])
    return tiled(named.select("chrom", (F.col("at") - F.col("first")).alias("at"), F.upper("value").alias("seq")), size)


def enzymes(spark: SparkSession, path: str) -> DataFrame:
    """name, site (with its bar), seq, cut: restriction sites and where they cut."""
    rows = spark.read.text(path).select(F.split(F.trim("value"), r"\s+").alias("f")).filter(F.size("f") >= 2)
    out = rows.select(F.get("f", F.lit(0)).alias("name"), F.get("f", F.lit(1)).alias("site")).filter(F.contains("site", F.lit("|")))
    return out.withColumns({"seq": F.replace("site", F.lit("|"), F.lit("")), "cut": F.instr("site", "|") - 1})


def repeat_locations(spark: SparkSession, path: str) -> DataFrame:
    """chrom, start, end, copies, motif, target from lines of bin, chrom, start, end and NxSEQ; # lines are skipped."""
    rows = spark.read.text(path).filter(~F.col("value").startswith("#")).select(F.split(F.trim("value"), r"\s+").alias("f")).filter(F.size("f") >= 5)
    at = lambda i: F.get("f", F.lit(i))
    out = rows.select(at(1).alias("chrom"), at(2).try_cast("int").alias("start"), at(4).alias("name")).withColumns({"copies": F.split_part("name", F.lit("x"), F.lit(1)).try_cast("int"), "motif": F.split_part("name", F.lit("x"), F.lit(2))}).dropna()
    end = F.col("start") + F.col("copies") * F.char_length("motif")
    return out.select("chrom", "start", end.alias("end"), "copies", "motif", F.concat("chrom", F.lit(":"), "start", F.lit("_"), end, F.lit("_"), "name").alias("target"))


def newick_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """tree_id (the file), newick: a whole file is one tree."""
    return spark.read.text(paths, wholetext=True).select(F.input_file_name().alias("tree_id"), F.regexp_replace("value", "\n", "").alias("newick"))
