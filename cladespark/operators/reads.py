"""Microsatellite runs in reads: molecular tags, libraries and position windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sequence import reverse_complement

#: Library index, pattern of the run, least start and largest end (single reads).
SINGLE = [("CGCTCAGTTC", "A{9,}", 97, 122), ("TATCTGACCT", "A{9,}", 77, 107), ("ATATGAGACG", "A{9,}", 83, 123), ("CTTATGGAAT", "(?:AC){7,}", 74, 114), ("TAATCTCGTC", "(?:AC){7,}", 84, 134)]
#: Library index, least and largest start (paired reads).
PAIRED = [("CGCTCAGTTC", 89, 124), ("TATCTGACCT", 69, 109), ("ATATGAGACG", 75, 125), ("GCGCGATGTT", 95, 125), ("AGAGCACTAG", 80, 125)]


def libraries(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    return spark.createDataFrame(rows, columns)


def first_run(read: Column, pattern: Column | str) -> tuple[Column, Column]:
    """The first run, null if there is none, and where it starts, counted from 0."""
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    run = F.regexp_substr(read, pattern)
    return run, F.when(run.isNotNull(), F.regexp_instr(read, pattern) - 1)


def extract_single(reads: DataFrame, table: list[tuple] | None = None) -> DataFrame:
    """read_no, read, umi, lib, ms: the first run of the library's kind, if it lies within the library's window."""
    known = libraries(reads.sparkSession, table or SINGLE, "lib string, pattern string, low int, high int")
    cut = reads.select("read_no", F.col("seq").alias("read"), F.substring("seq", 4, 20).alias("umi"), F.substring("seq", 24, 10).alias("lib"))
    run, start = first_run(F.col("read"), F.col("pattern"))
    ok = (start >= F.col("low")) & (start + F.char_length(run) <= F.col("high"))
    return cut.join(F.broadcast(known), "lib", "left").select("read_no", "read", "umi", "lib", F.when(ok, run).alias("ms"))  # a short list


def extract_paired(first: DataFrame, second: DataFrame, table: list[tuple] | None = None) -> DataFrame:
    """read_no, read_r1, read_r2, umi, lib, ms_r1, ms_r2: runs of six A and more that start within the library's window."""
    known = libraries(first.sparkSession, table or PAIRED, "lib string, low int, high int")
    keys = [c for c in ("file_no", "read_no") if c in first.columns and c in second.columns]
    mates = first.select(*keys, F.col("seq").alias("read_r1")).join(second.select(*keys, reverse_complement(F.col("seq")).alias("read_r2")), keys)
    cut = mates.withColumns({"umi": F.substring("read_r1", 1, 20), "lib": F.substring("read_r1", 21, 10)}).join(F.broadcast(known), "lib", "left")  # a short list
    out = {}
    for name in ("r1", "r2"):
        run, start = first_run(F.col(f"read_{name}"), "A{6,}")
        out[f"ms_{name}"] = F.when(start.between(F.col("low"), F.col("high")), run)
    return cut.withColumns(out).select(*keys, "read_r1", "read_r2", "umi", "lib", "ms_r1", "ms_r2")


def same_number(first: DataFrame, second: DataFrame) -> None:
    """Raises unless both have as many reads."""
    if first.count() != second.count():
        raise ValueError("read 1 and read 2 have different numbers of reads")


def run_accuracy(pairs: DataFrame, by: str = "lib") -> DataFrame:
    """lib, n, same_percent: pairs with both runs whose lengths are equal."""
    both = pairs.dropna(subset=["ms_r1", "ms_r2"])
    return both.groupBy(by).agg(F.count(F.lit(1)).alias("n"), (100 * F.avg((F.char_length("ms_r1") == F.char_length("ms_r2")).cast("int"))).alias("same_percent"))
