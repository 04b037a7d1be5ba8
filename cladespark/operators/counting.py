"""Target depth from reads, per-sample quality figures, and the gate on samples."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import reach_workers

#: Powers of two that bins are wide, and rows of them that a worker counts at once.
LEVELS = [8, 14, 20, 26, 32, 38, 44, 50, 56, 62]
AT_ONCE = 500_000


def spanning_counts(reads: DataFrame, targets: DataFrame) -> DataFrame:
    """sample, target, depth: reads of a sample that cover the whole of a target. Targets without any are absent.

    No pair of a read and a target is made. Equal reads and targets of equal place become one row first. A read's level is the
    least of LEVELS whose width holds it, and bins of a level are as wide, so a read touches one of them or two; a target is in the bin
    of its start, on each level that holds its length. The rows of a bin meet in one task, which counts by sorting (``covered``).
    """
    reach_workers(reads.sparkSession)
    of_bin = lambda c: F.floor(F.col(c) / F.pow(F.lit(2.0), F.col("level")))
    width = lambda a, b: F.col(b).cast("long") - F.col(a).cast("long")
    fitting = F.filter(F.array(*map(F.lit, LEVELS)), lambda k: width("t_start", "t_end") <= F.pow(F.lit(2.0), k))
    own = F.coalesce(*(F.when(width("ref_start", "ref_end") <= 2**k, k) for k in LEVELS))
    alike = reads.filter("chrom is not null and ref_start is not null and ref_end is not null").groupBy("sample", "chrom", "ref_start", "ref_end").agg(F.count(F.lit(1)).alias("n")).withColumn("level", own)
    spread = alike.withColumn("bin", F.explode(F.sequence(of_bin("ref_start"), of_bin("ref_end"))))
    shapes = targets.select("chrom", *(F.col(c).cast("long").alias(c) for c in ("t_start", "t_end"))).filter("chrom is not null and t_start is not null and t_end is not null")
    placed = shapes.distinct().withColumn("level", F.explode(fitting)).withColumn("bin", of_bin("t_start"))
    key = ["chrom", "level", "bin"]
    both = spread.select(*key, F.lit(True).alias("is_read"), "sample", F.col("ref_start").cast("long").alias("a"), F.col("ref_end").cast("long").alias("b"), "n").unionByName(
        placed.select(*key, F.lit(False).alias("is_read"), F.lit(None).cast(reads.schema["sample"].dataType).alias("sample"), F.col("t_start").alias("a"), F.col("t_end").alias("b"), F.lit(0).cast("long").alias("n"))
    )
    types = {f.name: f.dataType.simpleString() for f in both.schema}
    met = both.repartition(*key).sortWithinPartitions(*key, "is_read").mapInArrow(covered, f"sample {types['sample']}, chrom {types['chrom']}, t_start long, t_end long, n long")
    counted = met.groupBy("sample", "chrom", "t_start", "t_end").agg(F.sum("n").alias("n"))
    placed_targets = targets.select("target", "chrom", *(F.col(c).cast("long").alias(c) for c in ("t_start", "t_end")))
    return counted.join(placed_targets, ["chrom", "t_start", "t_end"]).groupBy("sample", "target").agg(F.sum("n").alias("depth"))


def covered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """sample, chrom, t_start, t_end, n: sums over some rows of a bin at a time, which add up. Rows lie by bins, the targets of each first.

    Of the rows before those at hand, only the targets of the bin that goes on are held.
    """
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= AT_ONCE:
            out, rest = covered_once(pa.Table.from_batches(held).combine_chunks())
            yield from out
            held, size = rest.to_batches(), 0
    if held:
        yield from covered_once(pa.Table.from_batches(held).combine_chunks())[0]


def covered_once(rows: pa.Table) -> tuple[list[pa.RecordBatch], pa.Table]:
    """Sums of these rows, and the targets of the last bin."""
    codes = lambda c: pc.fill_null(rows[c].combine_chunks().dictionary_encode().indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)
    number = {c: rows[c].to_numpy() for c in ("level", "bin", "a", "b", "n")}
    key = np.stack([codes("chrom"), number["level"], number["bin"]])
    group = np.concatenate([[0], np.cumsum((key[:, 1:] != key[:, :-1]).any(axis=0))]) if rows.num_rows else np.zeros(0, np.int64)
    is_read = rows["is_read"].to_numpy()
    reads, targets = np.flatnonzero(is_read), np.flatnonzero(~is_read)
    rest = rows.take(pa.array(targets[group[targets] == group[-1]])) if len(group) else rows
    if not len(reads) or not len(targets):
        return [], rest
    sample = codes("sample")
    reads = reads[np.lexsort((number["a"][reads], sample[reads], group[reads]))]
    first = np.flatnonzero(np.concatenate([[True], (group[reads][1:] != group[reads][:-1]) | (sample[reads][1:] != sample[reads][:-1])]))  # of each bin's sample
    last = np.append(first[1:], len(reads))
    places = np.unique(number["a"][reads])
    spot = np.repeat(np.arange(len(first)), last - first) * (len(places) + 1) + np.searchsorted(places, number["a"][reads], "right")
    find = Dominance(number["b"][reads], number["n"][reads])
    low, high = np.searchsorted(group[targets], group[reads[first]], "left"), np.searchsorted(group[targets], group[reads[first]], "right")
    out, many = [], np.cumsum(high - low)
    begin = 0
    while begin < len(first):  # bins' samples, some pairs with targets at a time
        stop = max(begin + 1, int(np.searchsorted(many, (many[begin - 1] if begin else 0) + AT_ONCE, "right")))
        count = (high - low)[begin:stop]
        which = np.repeat(np.arange(begin, stop), count)
        target = targets[np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + low[which]]
        upto = np.searchsorted(spot, which * (len(places) + 1) + np.searchsorted(places, number["a"][target], "right"), "right")
        n = find.at_least(first[which], upto, number["b"][target])
        some = n > 0
        names = rows["sample"].take(pa.array(reads[first[which[some]]]))
        own = rows.select(["chrom", "a", "b"]).take(pa.array(target[some]))
        out += pa.table([names, own["chrom"], own["a"], own["b"], pa.array(n[some], pa.int64())], ["sample", "chrom", "t_start", "t_end", "n"]).combine_chunks().to_batches()
        begin = stop
    return out, rest


class Dominance:
    """Sums of weights over a run of rows whose value isn't below another: rows dealt by the bits of their values' ranks, the highest first."""

    def __init__(self, values: np.ndarray, weights: np.ndarray):
        self.known, rank = np.unique(values, return_inverse=True)
        self.bits = []
        sums = lambda x: np.concatenate([[0], np.cumsum(x)])
        for bit in reversed(range(len(self.known).bit_length())):
            one = rank >> bit & 1 == 1
            self.bits.append((bit, sums(~one), sums(np.where(one, weights, 0))))
            order = np.concatenate([np.flatnonzero(~one), np.flatnonzero(one)])
            rank, weights = rank[order], weights[order]
        self.total = sums(weights)

    def at_least(self, first: np.ndarray, last: np.ndarray, least: np.ndarray) -> np.ndarray:
        """For each run (to before ``last``), the weight of its rows with a value of ``least`` or more."""
        last = np.maximum(first, last)
        rank, out = np.searchsorted(self.known, least, "left"), np.zeros(len(first), np.int64)
        for bit, zeros, ones in self.bits:
            up = rank >> bit & 1 == 1
            out += np.where(up, 0, ones[last] - ones[first])
            first, last = (np.where(up, zeros[-1] + x - zeros[x], zeros[x]) for x in (first, last))
        return out + self.total[last] - self.total[first]


def depth_stats(depth: DataFrame, min_reads: int = 10) -> DataFrame:
    """sample, targets_total, targets_with_min_reads."""
    return depth.groupBy("sample").agg(F.count(F.lit(1)).alias("targets_total"), F.count_if(F.col("depth") >= min_reads).alias("targets_with_min_reads"))


def cpg_stats(sites: DataFrame, sample: str = "sample") -> DataFrame:
    """sample, cpg_count, methylated_count, methylation_rate: a site is methylated if more than half of its reads are."""
    return sites.groupBy(sample).agg(
        F.count_if(F.col("cov") > 0).alias("cpg_count"),
        F.count_if((F.col("cov") > 0) & (F.try_divide("mc", "cov") > 0.5)).alias("methylated_count"),
    ).withColumn("methylation_rate", F.coalesce(F.try_divide("methylated_count", "cpg_count"), F.lit(0.0)))


def merged_stats(ms: DataFrame, cpg: DataFrame, min_targets: int = 100, min_cpgs: int = 0, with_cpg: bool = True) -> DataFrame:
    """sample, targets_with_min_reads, cpg_count, pass: a sample in one table only has 0 of the other."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    both = ms.join(cpg, "sample", "full").select("sample", zero("targets_with_min_reads"), zero("cpg_count"))
    return both.withColumn("pass", passes(min_targets, min_cpgs, with_cpg))


def passes(min_targets: int, min_cpgs: int, with_cpg: bool = True) -> Column:
    enough = F.col("targets_with_min_reads") >= min_targets
    return enough & (F.col("cpg_count") >= min_cpgs) if with_cpg else enough


def passing_only(rows: DataFrame, stats: DataFrame) -> DataFrame:
    """The rows of samples that pass."""
    return rows.join(stats.filter("pass").select("sample"), "sample", "left_semi")


def summary(stats: DataFrame) -> DataFrame:
    """One row: counts, and mean and median of targets and CpGs over all samples and over those that pass."""
    figures = [F.count(F.lit(1)).alias("samples"), F.count_if("pass").alias("samples_passing")]
    for column in ("targets_with_min_reads", "cpg_count"):
        for kind, value in (("all", F.col(column)), ("passing", F.when(F.col("pass"), F.col(column)))):
            figures += [F.avg(value).alias(f"mean_{column}_{kind}"), F.median(value).alias(f"median_{column}_{kind}")]
    return stats.agg(*figures)
