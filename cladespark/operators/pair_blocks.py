"""Pair distances by blocks of samples and of targets, for many samples.

``distance.pair_distances`` makes a row for each pair of samples and target that they share: for 100,000 samples that is five thousand million rows a
target. Here the calls of ``cells`` samples at some ``targets`` targets are packed into one row of arrays; each pair of blocks meets
once for each part of the targets, a worker computes all its sums as products of matrices (or, for differences of sizes, slice by
slice), and only sums by pair are shuffled. Results are those of ``distance.pair_distances``.

A block row has at most cells * targets calls. Numbers of samples, and of the columns (target, group) of a part, are dense, so nothing rests on hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .distance import allele_groups, grouped_alleles, metric_parts
from .ordering import numbered_in_order

#: Columns whose differences of sizes a worker holds for a pair of blocks at once.
SLICE = 64
#: Samples that are broadcast; more are joined by a shuffle.
BROADCAST_SAMPLES = 1_000_000


class Block:
    """The calls of a block of samples at a part of the targets."""

    def __init__(self, targets: list, columns: list):
        """targets: (place of the sample, target); columns: (place, column, alleles)."""
        self.places = np.array([p for p, _ in targets], np.int64)
        self.targets = np.array([t for _, t in targets], np.int64)
        self.rows = np.array([p for p, _, _ in columns], np.int64)
        self.columns = np.array([c for _, c, _ in columns], np.int64)
        self.first = np.array([a[0] for _, _, a in columns], float)
        self.second = np.array([a[1] if len(a) > 1 else np.nan for _, _, a in columns], float)


def dense(rows: np.ndarray, columns: np.ndarray, values: np.ndarray | float, shape: tuple[int, int], empty: float = 0.0) -> np.ndarray:
    out = np.full(shape, empty)
    out[rows, columns] = values
    return out


def sums(x: Block, y: Block, cells: int, compared: str, by: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shared targets, comparisons and differences of all pairs of two blocks; whole numbers in doubles, far from where these end."""
    width = 1 + max(x.targets.max(initial=-1), y.targets.max(initial=-1))
    shared = dense(x.places, x.targets, 1.0, (cells, width)) @ dense(y.places, y.targets, 1.0, (cells, width)).T
    width = 1 + max(x.columns.max(initial=-1), y.columns.max(initial=-1))
    some, two = ([dense(b.rows, b.columns, v(b), (cells, width)) for b in (x, y)] for v in (lambda b: 1.0, lambda b: (~np.isnan(b.second)).astype(float)))
    if compared == "minComp":
        count = some[0] @ some[1].T + two[0] @ two[1].T
    else:
        count = (some[0] + two[0]) @ (some[1] + two[1]).T
    if by == "EqorNot":
        # an indicator column for each allele of each column that is seen in both blocks
        keys = [np.concatenate([np.stack([b.columns, b.first], 1), np.stack([b.columns, b.second], 1)[~np.isnan(b.second)]]) for b in (x, y)]
        rows = [np.concatenate([b.rows, b.rows[~np.isnan(b.second)]]) for b in (x, y)]
        seen, place = np.unique(np.concatenate(keys), axis=0, return_inverse=True)
        place = place.ravel()
        cut = len(keys[0])
        same = dense(rows[0], place[:cut], 1.0, (cells, len(seen))) @ dense(rows[1], place[cut:], 1.0, (cells, len(seen))).T
        return shared, count, count - same
    difference = np.zeros((cells, cells))
    own = [(dense(b.rows, b.columns, b.first, (cells, width), np.nan), dense(b.rows, b.columns, b.second, (cells, width), np.nan)) for b in (x, y)]
    for low in range(0, width, SLICE):
        (p1, p2), (q1, q2) = ([a[:, low : low + SLICE] for a in side] for side in own)
        away = [np.abs(p[:, None] - q[None]) for p in (p1, p2) for q in (q1, q2)]  # null where one of the two isn't there
        if compared == "minComp":
            both = away[0] + away[3]
            least = np.fmin(np.fmin(away[0], away[1]), np.fmin(away[2], away[3]))
            difference += np.nansum(np.where(np.isnan(both), least, both), 2)
        else:
            difference += sum(np.nansum(a, 2) for a in away)
    return shared, count, difference


def pair_distances(alleles: DataFrame, metric: str = "minComp_EqorNot", motif_len: str | int = 1, cells: int = 128, targets: int = 2048) -> DataFrame:
    """s1, s2, num_targets, num_alleles, num_diff, dist, is_comparable, as ``distance.pair_distances``."""
    compared, by = metric_parts(metric)
    groups = allele_groups(alleles, motif_len)
    names = numbered_in_order(alleles.select("sample").distinct(), ["sample"]).select("sample", (F.col("k") - 1).alias("no")).checkpoint()
    few = names.count() <= BROADCAST_SAMPLES
    parts = max(1, -(-alleles.select("target").distinct().count() // targets))
    part = F.pmod(F.xxhash64("target"), F.lit(parts)).cast("int")
    # dense numbers within a part, which has about ``targets`` targets
    of_part = lambda df, *order: df.withColumn("part", part).withColumn("at", F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1)
    target_at = of_part(alleles.select("target").distinct(), "target")
    column_at = of_part(groups.select("target", "grp").distinct(), "target", "grp")
    none = F.lit(None).cast("array<long>")
    there = alleles.select("sample", "target").distinct().join(target_at, "target").select("sample", "part", "at", none.alias("alleles"))
    held = grouped_alleles(alleles, groups).join(column_at, ["target", "grp"]).select("sample", "part", "at", F.col("alleles").cast("array<long>").alias("alleles"))
    placed = there.unionByName(held).join(F.broadcast(names) if few else names, "sample").select("part", F.floor(F.col("no") / cells).alias("block"), F.struct((F.col("no") % cells).cast("int").alias("place"), F.col("at").cast("int"), "alleles").alias("call"))
    packed = placed.groupBy("part", "block").agg(F.collect_list("call").alias("calls"))  # cells * targets calls and their groups at most
    last = F.lit(-(-names.count() // cells) - 1).cast("long")
    left = packed.select("part", F.col("block").alias("i"), F.explode(F.sequence("block", F.greatest("block", last))).alias("j"), F.col("calls").alias("x"))
    right = packed.select("part", F.explode(F.sequence(F.lit(0).cast("long"), "block")).alias("i"), F.col("block").alias("j"), F.col("calls").alias("y"))
    met = left.join(right, ["part", "i", "j"]).select("i", "j", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                i, j = batch.column(0)[r].as_py(), batch.column(1)[r].as_py()
                x, y = (block_of(batch.column(c)[r].values) for c in (2, 3))
                shared, count, difference = sums(x, y, cells, compared, by)
                a, b = np.nonzero(shared if i < j else np.triu(shared))
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in (i * cells + a, j * cells + b, *(m[a, b].astype(np.int64) for m in (shared, count, difference)))], ["n1", "n2", "t", "c", "d"])

    totals = met.mapInArrow(run, "n1 long, n2 long, t long, c long, d long").groupBy("n1", "n2").agg(F.sum("t").alias("num_targets"), F.sum("c").alias("c"), F.sum("d").alias("d"))
    for number, name in (("n1", "s1"), ("n2", "s2")):
        own = names.select(F.col("no").alias(number), F.col("sample").alias(name))
        totals = totals.join(F.broadcast(own) if few else own, number)
    itself = F.col("n1") == F.col("n2")
    out = totals.withColumns({"num_alleles": F.when(itself, F.col("num_targets")).otherwise(F.col("c")), "num_diff": F.when(itself, F.lit(0)).otherwise(F.col("d"))})
    dist = F.coalesce(F.try_divide("num_diff", "num_alleles"), F.lit(0.0))
    return out.select("s1", "s2", "num_targets", "num_alleles", "num_diff", dist.alias("dist"), (F.col("num_alleles") > 0).alias("is_comparable"))


def block_of(calls: pa.StructArray) -> Block:
    places, at, alleles = (calls.field(k).to_pylist() for k in range(3))
    return Block([(p, t) for p, t, a in zip(places, at, alleles) if a is None], [(p, c, a) for p, c, a in zip(places, at, alleles) if a is not None])
