"""Figures scraped from the reports and logs of sequencing tools."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .lines import numbered


def whole(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """file, text."""
    return spark.read.text(paths, wholetext=True).select(F.input_file_name().alias("file"), F.col("value").alias("text"))


def number(text: Column, pattern: str, kind: str = "long") -> Column:
    """The first group of a pattern as a number without its commas; null if it isn't found."""
    return F.replace(F.regexp_extract(text, pattern, 1), F.lit(","), F.lit("")).try_cast(kind)


def after(parts: Column, count: int) -> Column:
    """An array without its first elements."""
    return F.slice(parts, F.lit(count + 1), F.greatest(F.size(parts) - count, F.lit(0)))


def methylpy_sessions(texts: DataFrame, paired: bool = True) -> DataFrame:
    """file, sample, total, mapped, deduplicated (of pairs), or sample, total, mapped (of single reads).

    A log is cut at ``Processing file:``; sessions in which a figure is missing are left out.
    """
    sessions = texts.select("file", F.explode(after(F.split("text", "Processing file:"), 1)).alias("s"))
    sample = F.regexp_extract("s", r"^\s*(\S+)", 1)
    unit = "read pairs" if paired else "reads"
    figures = {"total": rf"There are (?:total )?([\d,]+) (?:total )?(?:input )?{unit}", "mapped": rf"There are ([\d,]+) uniquely mapping {unit}"}
    if paired:
        figures["deduplicated"] = rf"There are ([\d,]+) non-clonal {unit}"
    out = sessions.select("file", sample.alias("sample"), *(number(F.col("s"), p).alias(n) for n, p in figures.items()))
    return out.dropna(subset=[*figures])


def run_summary(sessions: DataFrame, value: str) -> DataFrame:
    """One row: sum, mean and median of a figure over sessions."""
    return sessions.agg(F.count(F.lit(1)).alias("sessions"), F.coalesce(F.sum(value), F.lit(0)).alias("total"), F.avg(value).alias("mean"), F.median(value).alias("median"))


def flagstat(texts: DataFrame) -> DataFrame:
    """file, total, mapped_percent: the first number of the first line, and the percentage of the line on mapped reads."""
    first = F.get(F.split("text", "\n"), F.lit(0))
    seventh = F.get(F.split("text", "\n"), F.lit(6))
    return texts.select("file", number(first, r"^(\d+)").alias("total"), number(seventh, r"\(([\d.]+)%", "double").alias("mapped_percent"))


def hs_metrics(texts: DataFrame) -> DataFrame:
    """file, metric, value: the row of names after the metrics heading, with the row under it."""
    lines = F.split("text", "\n")
    at = F.array_position(F.transform(lines, lambda x: x.startswith("## METRICS CLASS")), True).cast("int")
    names, values = (F.split(F.get(lines, at + i), "\t") for i in (0, 1))
    pairs = F.transform(names, lambda n, i: F.struct(n.alias("metric"), F.nullif(F.get(values, i), F.lit("")).alias("value")))
    return texts.filter(at > 0).select("file", F.inline(pairs)).filter("metric <> ''")


def bismark_report(texts: DataFrame) -> DataFrame:
    """file, efficiency, cpg, chg, chh: percentages of a mapping report."""
    part = lambda p: number(F.col("text"), p + r":?\s*([\d.]+)%", "double")
    return texts.select("file", part("Mapping efficiency").alias("efficiency"), *(part(f"C methylated in {c} context").alias(n) for c, n in (("CpG", "cpg"), ("CHG", "chg"), ("CHH", "chh"))))


def bismark_average(reports: DataFrame) -> DataFrame:
    """One row: mean figures and conversion = 100 - CpG methylation, cut off after two decimals."""
    cut = lambda c: F.floor(F.round(c * 100, 6)) / 100
    names = ("efficiency", "cpg", "chg", "chh")
    return reports.agg(*(cut(F.avg(n)).alias(n) for n in names)).withColumn("conversion", cut(100 - F.col("cpg")))


def bismark_sample(name: Column) -> Column:
    """A sample's name without its first three parts and any date of eight digits."""
    parts = after(F.split(name, "_"), 3)
    return F.array_join(F.filter(parts, lambda p: ~p.rlike(r"^\d{8}$")), "_")


def bisulfite_summary(texts: DataFrame) -> DataFrame:
    """file, sample, rate: the first conversion rate (percent) under each ``Summary for``; samples without one are left out."""
    parts = texts.select("file", F.explode(after(F.split("text", "(?m)^\\s*Summary for "), 1)).alias("s"))
    name = F.trim(F.replace(F.substring_index("s", "\n", 1), F.lit(":"), F.lit("")))
    rate = number(F.col("s"), r"Bisulfite conversion rate:\s*([\d.]+)\s*%", "double")
    named = F.array_join(F.filter(F.split(bismark_sample(name), "_"), lambda p: p != ""), "_")
    return parts.select("file", named.alias("sample"), rate.alias("rate")).filter("rate is not null")


def tree_matrices(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """file, matrix (``distance`` or ``targets``), s1, s2, value: the matrices of the text reports of tree building.

    A matrix has a title, a line of names and a line for each name, all parted by commas.
    """
    lines = numbered(spark, paths)
    title = F.when(F.col("value").startswith("Distance Matrix"), "distance").when(F.col("value").startswith("Target Matrix"), "targets")
    titles = lines.select("file", F.col("line").alias("at"), title.alias("matrix")).filter("matrix is not null")
    heads = lines.join(F.broadcast(titles), "file").filter("line = at + 1").select(F.col("file").alias("of_file"), "at", "matrix", F.split("value", ",").alias("names"))  # a row for each matrix
    body = lines.join(F.broadcast(heads), (F.col("file") == F.col("of_file")) & (F.col("line") > F.col("at") + 1) & (F.col("line") <= F.col("at") + F.size("names"))).withColumn("cells", F.split("value", ","))
    pair = F.arrays_zip(after(F.col("names"), 1).alias("s2"), after(F.col("cells"), 1).alias("value"))
    return body.select("file", "matrix", F.get("cells", F.lit(0)).alias("s1"), F.explode(pair).alias("p")).select("file", "matrix", "s1", F.col("p.s2").alias("s2"), F.col("p.value").try_cast("double").alias("value"))


def tree_figures(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """run (the file's name up to ``.buildPhylo.stats.txt``), n_sample, targets_per_pair of the same reports."""
    texts = whole(spark, paths)
    run = F.regexp_extract("file", r"([^/=]+)\.buildPhylo\.stats\.txt", 1)
    return texts.select(run.alias("run"), number(F.col("text"), r"(?m)^Number of Samples Analyzed\D*(\d+)").alias("n_sample"), number(F.col("text"), r"(?m)^Avg targets shared per pair of cells[^\d\n]*(\d+\.\d+)", "double").alias("targets_per_pair"))


def accuracies(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """run (the file's name up to ``.evalPhylo.txt``), n_target (its third part), accuracy (percent, over all distances) of accuracy tables."""
    rows = spark.read.text(paths).select(F.regexp_extract(F.input_file_name(), r"([^/=]+)\.evalPhylo\.txt", 1).alias("run"), F.split("value", "\t").alias("f"))
    every = rows.filter(F.get("f", F.lit(0)) == "All_Distances")
    return every.select("run", F.get(F.split("run", r"\."), F.lit(2)).try_cast("int").alias("n_target"), (F.get("f", F.lit(3)).try_cast("double") * 100).alias("accuracy"))
