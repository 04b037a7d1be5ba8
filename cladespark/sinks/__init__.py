"""Writers in the formats that downstream tools read. Each writes a folder, as Spark does, and returns nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def python_boolean(value: Column) -> Column:
    """Booleans as the texts True and False."""
    return F.when(value, "True").when(~value, "False")


def as_text(df: DataFrame) -> DataFrame:
    """Booleans made texts, arrays joined by commas; Parquet keeps types, text files don't."""
    out = []
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        if kind == "boolean":
            column = python_boolean(column)
        elif kind.startswith("array"):
            column = F.array_join(column.cast("array<string>"), ",")
        out.append(column.alias(name))
    return df.select(*out)


def write_tsv(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """Tab-separated with a heading, sorted by text if ``order`` is given."""
    rows = as_text(df)
    rows = rows.orderBy(*(F.col(c).cast("string") for c in order)) if order else rows
    rows.write.csv(path, sep="\t", header=True)


def write_csv(df: DataFrame, path: str) -> None:
    as_text(df).write.csv(path, header=True)


def write_json(df: DataFrame, path: str) -> None:
    df.write.json(path)


def write_matrix(long_: DataFrame, path: str, row: str, column: str, value: str, digits: int = 4) -> None:
    """A wide matrix from a long table, with names in the first row and column. Meant for names that fit a row."""
    wide = long_.groupBy(row).pivot(column).agg(F.first(F.round(value, digits))).orderBy(row)
    wide.write.csv(path, header=True)


def write_tree_stats(distances: DataFrame, path: str) -> None:
    """The text report of a tree: how many samples and shared targets there are, and the matrices of distances (four decimals) and targets.

    distances: s1, s2 (both ways round or not), num_targets, dist. One file; each line has a value for every sample.
    """
    both = distances.select("s1", "s2", "dist", "num_targets").union(distances.filter("s1 <> s2").select("s2", "s1", "dist", "num_targets"))
    listed = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("s2", F.col(c).cast("string").alias("v")))), lambda x: x["v"]), ",")
    rows = both.withColumn("dist", F.round("dist", 4)).groupBy("s1").agg(listed("dist").alias("dist"), listed("num_targets").alias("targets"), F.array_join(F.array_sort(F.collect_list("s2")), ",").alias("names"))
    itself = F.col("s1") == F.col("s2")
    one = distances.agg(F.count_if(itself).alias("n"), F.avg(F.when(itself, F.col("num_targets"))).alias("own"), F.avg(F.when(~itself, F.col("num_targets"))).alias("shared"), *(f(F.when(c, F.col("num_targets"))).alias(n) for n, f, c in (("a", F.min, itself), ("b", F.max, itself), ("c", F.min, ~itself), ("d", F.max, ~itself))))
    line = lambda text, k: F.struct(F.lit(k).alias("k"), text.alias("value"))
    top = F.array(line(F.concat(F.lit("Number of Samples Analyzed:\t"), "n"), 0), line(F.format_string("Avg targets captured per single cell:\t%s\t[Min:%s, Max:%s]", "own", "a", "b"), 2), line(F.format_string("Avg targets shared per pair of cells:\t%s\t[Min:%s, Max:%s]", "shared", "c", "d"), 3), line(F.lit(""), 4), line(F.lit("Distance Matrix (pairwise distances between samples):"), 5), line(F.lit(""), 8), line(F.lit("Target Matrix (number of shared targets between samples):"), 9))
    names = rows.agg(F.min_by("names", "s1").alias("names")).select(F.explode(F.array(line(F.col("names"), 1), line(F.concat(F.lit("Sample,"), "names"), 6), line(F.concat(F.lit("Sample,"), "names"), 10))).alias("x"))
    body = [rows.select(F.struct(F.lit(k).alias("k"), F.concat_ws(",", "s1", c).alias("value")).alias("x"), "s1") for k, c in ((7, "dist"), (11, "targets"))]
    lines = one.select(F.explode(top).alias("x")).union(names).withColumn("s1", F.lit("")).union(body[0]).union(body[1])
    lines.select("x.k", "s1", "x.value").coalesce(1).sortWithinPartitions("k", "s1").select("value").write.text(path)


def write_newick(newicks: DataFrame, path: str) -> None:
    newicks.select("newick").write.text(path)


def write_fasta(seqs: DataFrame, path: str, name: str = "target", seq: str = "seq") -> None:
    seqs.select(F.concat(F.lit(">"), F.col(name), F.lit("\n"), F.col(seq)).alias("value")).write.text(path)


def write_vcf(records: DataFrame, path: str, header: list[str] | None = None, samples: list[str] | None = None) -> None:
    """A VCF from a row for each sample and record: chrom, pos, target, info, format, sample, call; other fixed columns are dots.

    Each file has the heading, with all samples in order, and the records of a range of places; a sample
    without a call in a record has a dot. Meant for samples that fit a row, as the format is.
    samples: the samples in order, those of the records if not given. Without records there is one file with the heading.
    """
    names = samples if samples is not None else [r[0] for r in records.select("sample").distinct().orderBy("sample").collect()]  # the heading's columns
    whole = records.groupBy("chrom", "pos", "target", "info", "format").agg(F.map_from_entries(F.collect_list(F.struct("sample", "call"))).alias("calls"))
    dot = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("."))
    cells = F.array_join(F.transform(F.array(*map(F.lit, names)), lambda n: F.coalesce(F.col("calls")[n], F.lit("."))), "\t")
    line = F.concat_ws("\t", "chrom", "pos", "target", *(F.lit(".") for _ in range(4)), dot("info"), dot("format"), cells)
    ranged = whole.repartitionByRange("chrom", "pos", "target").sortWithinPartitions("chrom", "pos", "target").select(line.alias("value"))
    head = "\n".join([*(header or ["##fileformat=VCFv4.2"]), "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", *names])])
    if not records.limit(1).count():
        records.sparkSession.createDataFrame([(head,)], "value string").coalesce(1).write.text(path)
        return
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0  # of its file
    ranged.select(F.when(first, F.concat(F.lit(head + "\n"), "value")).otherwise(F.col("value")).alias("value")).write.option("maxRecordsPerFile", 0).text(path)  # a file for each task, whatever the session says


def write_report(metrics: DataFrame, path: str) -> None:
    """A one-row table as lines of name, tab and value."""
    pairs = F.explode(F.array(*(F.concat_ws("\t", F.lit(c), F.col(f"`{c}`").cast("string")) for c in as_text(metrics).columns)))
    as_text(metrics).select(pairs.alias("value")).write.text(path)


def write_probes(probes: DataFrame, order_path: str, info_path: str) -> None:
    """The order list, a probe a line, and the info list: target and its probes."""
    probes.select(F.explode("probe_list").alias("value")).write.text(order_path)
    write_tsv(probes.select("target", "probe_list"), info_path)


def write_alleles(alleles: DataFrame, path: str) -> None:
    """Nested columns keep their types."""
    alleles.write.parquet(path)
