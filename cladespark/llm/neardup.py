"""Embedding near-duplicates through randomised-rotation binary codes.

A unit vector u is turned by a random rotation; its code is the sign of each turned
component, and the factor stored with it is f = <code, turned u> / sqrt(D). For another
unit vector v, <code, turned v> / (f sqrt(D)) is an unbiased estimate of <u, v> over
rotations, and with BOUND it lies within BOUND * sqrt((1 - f^2) / f^2 / (D - 1)) but for
a few in 10^5 cases. Pairs whose upper bound is under the threshold are dropped; all
others are computed exactly in doubles, and only exact values make links.

Which vectors meet: bits of codes of independent rotations make TABLES of buckets, so many
that a pair at the threshold itself meets in none of them with a probability of MISS,
and nearer pairs far less often. The bits of a bucket grow with the table, so buckets
don't. A pair counts in the first table where it meets, so no pair is listed to tell
doubles apart: tasks hand on how many links each vector has and a tree of links.

Buckets of more than LARGE vectors are dealt as pairs of parts. Equal vectors are one.

Defined results: vectors that are null, zero or hold null or non-finite components have
no links and are their own component; shorter vectors are filled with zeros; repeated
rows are links of each other and a row each; null keys are nobody's smallest key unless
there is no other; further columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import scratch
from .components import components
from .vectors import dimension, matrix

BOUND = 4.0
MISS = 0.005
#: Vectors in a bucket, about, and the size from which a bucket is split.
BUCKET, LARGE = 512, 2048
#: Large buckets are broadcast if they are no more than this, else joined by a shuffle.
BROADCAST_BUCKETS = 100_000


class Plan(NamedTuple):
    width: int
    threshold: float
    bits: int
    tables: int
    seed: int = 1
    number: str = "f8"


def plan(count: int, width: int, threshold: float, number: str = "f8") -> Plan:
    """So many bits that buckets stay small, so many tables that misses stay rare."""
    bits = max(1, math.ceil(math.log2(max(2, count / BUCKET))))
    agree = 1 - math.acos(threshold) / math.pi
    return Plan(width, threshold, bits, max(1, math.ceil(math.log(MISS) / math.log(1 - agree**bits))), number=number)


def rotation(width: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, width)))
    return q * np.sign(np.diag(r))


class Codes:
    """The rotations of a plan; the first gives estimates, the others buckets."""

    def __init__(self, p: Plan):
        self.plan = p
        turns = -(-p.bits * p.tables // p.width)
        self.first = rotation(p.width, p.seed)
        self.others = np.hstack([rotation(p.width, p.seed + 1 + i).T for i in range(turns)])[:, : p.bits * p.tables]
        self.powers = 1 << np.arange(min(p.bits, 62), dtype=np.int64)

    def buckets(self, units: np.ndarray) -> np.ndarray:
        """The bucket of each vector in each table."""
        bits = (units @ self.others > 0).reshape(len(units), self.plan.tables, self.plan.bits)
        return bits[:, :, :62] @ self.powers

    def estimates(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Turned vectors, codes (+1 and -1) and factors."""
        turned = (units @ self.first.T).astype(np.float32)
        codes = np.where(turned > 0, np.float32(1), np.float32(-1))
        return turned, codes, (codes * turned).sum(1) / math.sqrt(self.plan.width)


def unit_vectors(df: DataFrame, width: int, number: str) -> DataFrame:
    """key, class (hash of the vector; null where it takes no part), vector (binary, of the numbers that it came in)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, whole = matrix(batch.column(1), width)
            whole &= (rows != 0).any(1)
            data = [x.tobytes() if ok else None for x, ok in zip((rows + 0.0).astype(number), whole)]
            own = [None if x is None else xxhash.xxh3_64_intdigest(x) - (1 << 63) for x in data]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.int64()), pa.array(data, pa.binary())], ["key", "class", "vector"])

    kind = df.schema["key"].dataType.simpleString()
    return df.mapInArrow(run, f"key {kind}, class long, vector binary")


def normalised(data: list[bytes], p: Plan) -> np.ndarray:
    rows = np.frombuffer(b"".join(data), p.number).reshape(len(data), p.width).astype(float)
    scaled = rows / np.abs(rows).max(1)[:, None]
    return scaled / np.sqrt((scaled**2).sum(1))[:, None]


def bucketed(classes: DataFrame, codes: Codes, carried: list[str]) -> DataFrame:
    """table, bucket and the carried columns: a row for each table."""
    names = ["table", "bucket", *carried]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = codes.plan.tables
        for batch in batches:
            if not batch.num_rows:
                continue
            units = normalised(batch.column(0).to_pylist(), codes.plan)
            at = pa.array(np.repeat(np.arange(batch.num_rows), tables))
            yield pa.RecordBatch.from_arrays([pa.array(np.tile(np.arange(tables, dtype=np.int32), batch.num_rows)), pa.array(codes.buckets(units).ravel()), *(batch.column(1 + i).take(at) for i in range(len(carried)))], names)

    rows = classes.select("vector", *(F.col(c).alias(f"_{c}") for c in carried))
    fields = "".join(f", {f.name} {f.dataType.simpleString()}" for f in classes.select(*carried).schema)
    return rows.mapInArrow(run, f"table int, bucket long{fields}")


def compare(table: int, own: list[tuple], other: list[tuple] | None, codes: Codes) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places (in own, and in other or own again) that link and meet in no earlier table."""
    p = codes.plan
    sides = [own, own if other is None else other]
    units = [normalised([x[2] for x in side], p) for side in sides]
    known = [codes.estimates(u) for u in units[: 1 if other is None else 2]]

    def asked(x: int, y: int) -> np.ndarray:
        """Which pairs may link by the codes of side x."""
        (_, signs, factor), turned = known[x], known[y][0]
        slack = BOUND * np.sqrt(np.maximum(1 - factor**2, 0) / factor**2 / max(1, p.width - 1))
        return signs @ turned.T / (factor * math.sqrt(p.width))[:, None] + slack[:, None] + 1e-4 >= p.threshold

    maybe = asked(0, len(known) - 1)  # either one's code may be asked
    maybe = np.triu(maybe | maybe.T, 1) if other is None else maybe | asked(1, 0).T
    a, b = np.nonzero(maybe)
    exact = np.einsum("ij,ij->i", units[0][a], units[1][b])
    a, b = a[exact >= p.threshold], b[exact >= p.threshold]
    if table and len(a):
        earlier = [codes.buckets(u)[:, :table] for u in units]
        new = ~(earlier[0][a] == earlier[1][b]).any(1)
        a, b = a[new], b[new]
    return a, b


def linked(parts: DataFrame, codes: Codes) -> DataFrame:
    """a, b, links: how many rows a links with in one bucket (b = a), and links a, b that connect it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, ([], [])

        def flush() -> pa.RecordBatch:
            table, _, i, j = now
            own, other = held if i != j else (held[0], None)
            out = ([], [], [])
            if own and (other is None or other):
                a, b = compare(table, own, other, codes)
                everyone = own + (other or [])
                b = b + (len(own) if other is not None else 0)
                times = np.array([x[1] for x in everyone])
                sums = np.bincount(a, times[b], len(everyone)) + np.bincount(b, times[a], len(everyone))
                root = list(range(len(everyone)))

                def find(x: int) -> int:
                    while root[x] != x:
                        root[x] = root[root[x]]
                        x = root[x]
                    return x

                for x, y in zip(a.tolist(), b.tolist()):
                    root[find(x)] = find(y)
                for x in np.flatnonzero(sums).tolist():
                    for column, value in zip(out, (everyone[x][0], everyone[x][0], int(sums[x]))):
                        column.append(value)
                    if find(x) != x:
                        for column, value in zip(out, (everyone[x][0], everyone[find(x)][0], 0)):
                            column.append(value)
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["a", "b", "links"])

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for table, bucket, i, j, part, own, times, vector in zip(*columns):
                if (table, bucket, i, j) != now:
                    if now is not None:
                        yield flush()
                    now, held = (table, bucket, i, j), ([], [])
                held[0 if part == i else 1].append((own, times, vector))
        if now is not None:
            yield flush()

    return parts.select("table", "bucket", "i", "j", "part", "class", "times", "vector").mapInArrow(run, "a long, b long, links long")


def near_duplicates(df: DataFrame, threshold: float = 0.95, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """key, n_links, component_id (the smallest key reachable), kept (whether that is its own), one row for each row."""
    spark = df.sparkSession
    width = dimension(df, vector)
    with scratch(spark) as tables:
        number = "f4" if df.schema[vector].dataType.elementType == T.FloatType() else "f8"
        rows = tables.keep(unit_vectors(df.select(F.col(key).alias("key"), F.col(vector).alias("vector")), width, number), "vectors")
        classes = tables.keep(rows.filter(F.col("class").isNotNull()).groupBy("class").agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("times"), F.min("vector").alias("vector")), "classes")
        codes = Codes(plan(classes.count(), max(1, width), threshold, number))
        large = tables.keep(bucketed(classes, codes, []).groupBy("table", "bucket").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > LARGE), "large")
        few = large.limit(BROADCAST_BUCKETS + 1).count() <= BROADCAST_BUCKETS
        spread = bucketed(classes, codes, ["class", "times", "vector"]).join(F.broadcast(large) if few else large, ["table", "bucket"], "left")
        parts = spread.withColumn("parts", F.ceil(F.coalesce("size", F.lit(1)) / LARGE).cast("int"))
        parts = parts.withColumn("part", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int")).withColumn("x", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        parts = parts.withColumns({"i": F.least("part", "x"), "j": F.greatest("part", "x")})
        dealt = parts.repartition("table", "bucket", "i", "j").sortWithinPartitions("table", "bucket", "i", "j")
        found = tables.keep(linked(dealt, codes), "links")
        sums = found.groupBy(F.col("a").alias("class")).agg(F.sum("links").alias("links"))
        connected = components(found.filter("a <> b").select("a", "b"), tables).withColumnRenamed("id", "class")
        own = classes.join(sums, "class", "left").join(connected, "class", "left").select("class", "key", (F.col("times") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "class").alias("component"))
        smallest = own.groupBy("component").agg(F.min("key").alias("component_id"))
        named = own.join(smallest, "component").select("class", "n_links", "component_id")
        out = rows.select("key", "class").join(named, "class", "left").select(F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "key").alias("component_id"))
        return out.withColumn("kept", F.col(key).eqNullSafe(F.col("component_id"))).checkpoint()
