import random
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from cladespark.operators import counting, stats

READS, TARGETS = "sample string, chrom string, ref_start long, ref_end long", "target long, chrom string, t_start long, t_end long"


def near(draw):
    return draw.choice([draw.randint(-300, 3000), draw.randint(0, 10**6), 2**40 + draw.randint(0, 500)])


def test_spanning_counts_by_brute_force(spark):
    draw = random.Random(3)
    reads = [(draw.choice(["a", "b", None]), draw.choice(["x", "y", None]), a := near(draw), a + draw.choice([0, 3, 50, 255, 256, 257, 5000, 10**6])) for _ in range(800)]
    targets = [(draw.choice([i, 7, None]), draw.choice(["x", "y", None]), a := near(draw), a + draw.choice([0, 1, 20, 256, 300])) for i in range(400)]
    reads += reads[:100]
    want = Counter((s, t) for s, c, a, b in reads for t, d, x, y in targets if c == d is not None and a <= x and b >= y)
    got = counting.spanning_counts(spark.createDataFrame(reads, READS), spark.createDataFrame(targets, TARGETS)).collect()
    assert {(r.sample, r.target): r.depth for r in got} == want


def test_no_pair_of_read_and_target(spark):
    """Many targets below many reads: joins are on equal places only, and a bin's rows are counted some at a time."""
    reads, targets = spark.range(50).selectExpr("'s' as sample", "'c' as chrom", "id as ref_start", "id + 100 as ref_end"), spark.range(50).selectExpr("id as target", "'c' as chrom", "50 + id % 2 as t_start", "60L as t_end")
    plan = counting.spanning_counts(reads, targets)._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in plan.splitlines() if "Join" in x and "<=" in x]


def test_a_bin_in_pieces(monkeypatch):
    monkeypatch.setattr(counting, "AT_ONCE", 5)
    names = ["chrom", "level", "bin", "is_read", "sample", "a", "b", "n"]
    rows = [("c", 8, 0, False, None, 10 + k, 20, 0) for k in range(7)] + [("c", 8, 0, True, "s", k, 20 + k % 2, 2) for k in range(20)] + [("d", 8, 0, True, "s", 0, 99, 1)]
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i : i + 3])], names).cast(pa.schema([("chrom", pa.string()), ("level", pa.int32()), ("bin", pa.int64()), ("is_read", pa.bool_()), ("sample", pa.string()), ("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])) for i in range(0, len(rows), 3)]
    got = Counter()
    for batch in counting.covered(batches):
        for r in batch.to_pylist():
            got[r["sample"], r["chrom"], r["t_start"]] += r["n"]
    assert got == {("s", "c", 10 + k): 2 * (11 + k) for k in range(7)}


def test_medians_from_counts(spark):
    values = {"a": [3.0, 1.0, 1.0, 2.0, 8.0], "b": [5.0], "c": [-1.0, float("inf"), 4.0, 4.0, 7.0, 9.0], "d": [k * 0.5 for k in range(1000)], "e": []}
    rows = [(g, v) for g, own in values.items() for v in [*own, None]]
    df = spark.createDataFrame(rows, "g string, v double")
    assert {r.g: r.median for r in stats.medians(df, "g", "v").collect()} == {r.g: r.m for r in df.groupBy("g").agg(F.median("v").alias("m")).collect() if r.m is not None}
    wide = spark.createDataFrame([(1.0, None), (2.0, None)], "x double, y double")
    got = {r.metric: (r.median, r.mean) for r in stats.metric_table(wide, ["x", "y"]).collect()}
    assert got == {"x": (1.5, 1.5), "y": (None, None)}
    assert "median(" not in stats.metric_table(wide, ["x"])._jdf.queryExecution().optimizedPlan().toString()
