"""Allele groups, distances, trees and resampling against hand-computed and brute-force answers."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cladespark.functions import trees
from cladespark.operators import distance, evaluate, genotype, loci, methyl, neighbors, resample, stats, tree


def calls(spark, rows):
    return spark.createDataFrame(rows, "sample string, target string, alleles array<int>")


def dist(spark, rows, metric, motif=1):
    out = distance.pair_distances(calls(spark, rows), metric, motif).collect()
    return {(r.s1, r.s2): r for r in out}


@pytest.mark.parametrize(("metric", "diff", "n"), [("minComp_EqorNot", 0, 1), ("minComp_Abs", 0, 1), ("allComp_EqorNot", 1, 2), ("Abs_allComp", 1, 2)])
def test_one_against_two(spark, metric, diff, n):
    r = dist(spark, [("a", "t", [10, 11]), ("b", "t", [10])], metric)["a", "b"]
    assert (r.num_diff, r.num_alleles) == (diff, n)


def test_two_against_two(spark):
    rows = [("a", "t", [10, 11]), ("b", "t", [11, 12])]
    assert dist(spark, rows, "minComp_EqorNot")["a", "b"][3:5] == (2, 1)
    assert dist(spark, rows, "minComp_Abs")["a", "b"][3:5] == (2, 2)


def test_groups_part_alleles(spark):
    r = dist(spark, [("a", "t", [10, 14]), ("b", "t", [10, 12])], "minComp_EqorNot")["a", "b"]
    assert (r.num_diff, r.num_alleles) == (0, 1)
    r = dist(spark, [("a", "t", [10]), ("b", "t", [12])], "minComp_EqorNot")
    assert (r["a", "b"].dist, r["a", "b"].num_alleles, r["a", "b"].num_targets, r["a", "b"].is_comparable) == (0, 0, 1, False)
    assert (r["a", "a"].num_alleles, r["a", "a"].dist) == (1, 0)


def test_motif_of_two(spark):
    groups = distance.allele_groups(calls(spark, [("a", "t", [20, 22]), ("b", "t", [21])]), 2)
    assert sorted(r.allele for r in groups.collect()) == [20, 22]
    assert len({r.grp for r in groups.collect()}) == 1
    with pytest.raises(ValueError, match="no such distance"):
        distance.metric_parts("minComp")


def brute(rows, metric):
    by = {}
    for s, t, a in rows:
        by.setdefault(t, {})[s] = a
    out = {}
    for t, own in by.items():
        alleles = sorted({x for a in own.values() for x in a})
        groups, last = [], None
        for x in alleles:
            if last is None or x > last + 1:
                groups.append([])
            groups[-1].append(x)
            last = x
        for s1, s2 in itertools.combinations(sorted(own), 2):
            total = out.setdefault((s1, s2), [0, 0])
            for g in groups:
                x, y = ([v for v in own[s] if v in g] for s in (s1, s2))
                if metric.startswith("all"):
                    for p, q in itertools.product(x, y):
                        total[0] += (p != q) if "Eq" in metric else abs(p - q)
                        total[1] += 1
                elif x and y:
                    n = min(len(x), len(y))
                    options = [sum(a != b for a, b in zip(sorted(p), sorted(q))) if "Abs" not in metric else sum(abs(a - b) for a, b in zip(sorted(p), sorted(q))) for p in itertools.combinations(x, n) for q in itertools.combinations(y, n)]
                    if "Eq" in metric:
                        options = [n - len({*p} & {*q}) for p in itertools.combinations(x, n) for q in itertools.combinations(y, n)]
                    total[0] += min(options)
                    total[1] += n
    return out


@pytest.mark.parametrize("metric", sorted(distance.METRICS))
def test_distances_by_brute_force(spark, metric):
    rng = random.Random(4)
    rows = [(f"s{s}", f"t{t}", sorted({rng.randint(10, 16), rng.randint(10, 16)})) for s in range(5) for t in range(20) if rng.random() < 0.8]
    want, got = brute(rows, metric), dist(spark, rows, metric)
    assert {k: (v.num_diff, v.num_alleles) for k, v in got.items() if k[0] != k[1]} == {k: tuple(v) for k, v in want.items()}


def test_genotype_filter_and_reads(spark):
    rows = [("ok", 0.95, 12, 0), ("low q", 0.89, 12, 0), ("shallow", 0.95, 9, 0), ("stutter", 0.95, 12, 13), ("missing", None, 12, 0), ("empty", 0.95, 0, 0)]
    df = spark.createDataFrame(rows, "name string, q double, depth int, stutter int")
    assert [r.name for r in df.filter(genotype.good_call()).collect()] == ["ok"]
    packed = spark.createDataFrame([("0|7;1|5",), ("x|1",), (None,)], "p string").select(genotype.read_multiset(F.col("p")).alias("m"))
    assert [r.m for r in packed.collect()] == [[0] * 7 + [1] * 5, None, None]


def additive():
    names = list("abcde")
    pairs = dict(zip(itertools.combinations(names, 2), [5, 9, 9, 8, 10, 10, 9, 8, 7, 3]))
    d = np.zeros((5, 5))
    for (x, y), v in pairs.items():
        d[names.index(x), names.index(y)] = d[names.index(y), names.index(x)] = v
    return names, d, pairs


def test_neighbour_joining_recovers_a_tree(spark):
    names, d, pairs = additive()
    root = trees.neighbour_joining(names, d)
    lengths = {n.name: n.length for n in walk(root) if not n.children}
    assert lengths == {"a": 2, "b": 3, "c": 4, "d": 2, "e": 1}
    assert sorted(n.length for n in walk(root) if n.children and n is not root) == [2, 3]
    df = spark.createDataFrame([(1, x, y, float(v)) for (x, y), v in pairs.items()], "tree_id int, i string, j string, dist double")
    found = tree.neighbour_joining(df)
    assert found.filter("is_leaf").count() == 5
    text = tree.to_newick(found).first().newick
    again = tree.from_newick(spark.createDataFrame([(1, text)], "tree_id int, newick string"))
    assert {tuple(r.leaves) for r in tree.clades(found, []).collect()} == {tuple(r.leaves) for r in tree.clades(again, []).collect()}


def walk(node):
    yield node
    for c in node.children:
        yield from walk(c)


def total(node):
    return sum(n.length for n in walk(node))


@pytest.mark.parametrize("outgroup", ["Midpoint", "a", "e", "NA"])
def test_rooting_keeps_the_tree(outgroup):
    names, d, _ = additive()
    root = trees.rooted(trees.neighbour_joining(names, d), outgroup)
    assert sorted(trees.leaves(root)) == names
    assert total(root) == pytest.approx(17)
    depth = {}

    def go(node, x):
        if not node.children:
            depth[node.name] = x
        for c in node.children:
            go(c, x + c.length)

    go(root, 0.0)
    if outgroup == "Midpoint":
        assert len(root.children) == 2
        assert max(depth.values()) == pytest.approx(5)  # half of the longest path
        assert sorted(depth.values())[-2] == pytest.approx(5)
    elif outgroup != "NA":
        assert any(not c.children and c.name == outgroup for c in root.children)


def test_newick_round_trip():
    text = "((a:1,'b c':2)0.95:0.5,(d:1,e:3):1.5,f:0.25);"
    assert trees.to_newick(trees.parse_newick(text)) == text
    with pytest.raises(ValueError, match="doesn't end"):
        trees.parse_newick("(a,b)")
    rows = trees.table(trees.parse_newick(text))
    assert [r["y"] for r in rows if r["is_leaf"]] == [0, 1, 2, 3, 4]
    assert next(r for r in rows if r["support"])["support"] == 0.95


def test_support_is_a_share(spark):
    names, d, pairs = additive()
    one = tree.neighbour_joining(spark.createDataFrame([(1, x, y, float(v)) for (x, y), v in pairs.items()], "tree_id int, i string, j string, dist double"))
    two = one.unionByName(one.withColumn("tree_id", F.lit(2)))
    found = tree.support(one, two, 2)
    assert {r.support for r in found.collect()} == {1.0}
    assert {r.label for r in tree.percent_labels(found).collect()} == {100}


def test_ties_and_equal_clones_are_left_out(spark):
    samples = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y")], "sample string, clone string")
    assert evaluate.triplets(samples).count() == 1
    assert evaluate.triplets(samples.withColumn("clone", F.lit("x"))).count() == 0
    reference = spark.createDataFrame([("x", "x", 5), ("x", "y", 1), ("y", "x", 1)], "clone_1 string, clone_2 string, d int")
    near = spark.createDataFrame([("a", "b", 3.0), ("a", "c", 1.0), ("b", "c", 1.0)], "a string, b string, depth double")
    assert [r.correct for r in evaluate.triplet_results(evaluate.triplets(samples), near, reference).collect()] == [1]
    tied = spark.createDataFrame([("a", "b", 3.0), ("a", "c", 3.0), ("b", "c", 1.0)], "a string, b string, depth double")
    none = evaluate.triplet_results(evaluate.triplets(samples), tied, reference)
    assert none.count() == 0
    assert [r.total for r in evaluate.triplet_accuracy(none).collect() if r.total] == []


def test_resampling_sizes(spark):
    rows = [("s1", t, t) for t in range(10)] + [("s2", t, t) for t in range(4)]
    df = spark.createDataFrame(rows, "sample string, target int, call int")
    kept = resample.downsample(df, 5)
    assert {r.sample for r in kept.collect()} == {"s1"}
    assert kept.count() == 5
    perms = resample.permuted_genotypes(df, 3).collect()
    for p in (1, 2, 3):
        for t in range(10):
            assert sorted(r.call for r in perms if (r.perm, r.target) == (p, t)) == sorted(c for s, x, c in rows if x == t)
    boot = resample.bootstrap_targets(df, 4)
    assert {r["count"] for r in boot.groupBy("iteration").count().collect()} == {8}
    labels = spark.createDataFrame([(f"s{i}", f"g{i % 2}") for i in range(8)], "sample string, grp string")
    kept = resample.permuted_labels(labels, 5, preserve_sizes=True)
    assert {r["count"] for r in kept.groupBy("perm", "grp").count().collect()} == {4}


def test_z_scores_and_assignment(spark):
    rows = [("c", "r1", 1.0), ("c", "r2", 2.0), ("c", "r3", 3.0), ("d", "r1", 5.0), ("d", "r2", None)]
    df = spark.createDataFrame(rows, "cell string, ref string, score double")
    assert [r.z for r in methyl.z_scores(df).filter("cell = 'c'").orderBy("ref").collect()] == [-1, 0, 1]
    found = {r.cell: r for r in methyl.assigned(df, -1.1).collect()}
    assert found["c"].assigned == "Unassigned"
    assert found["d"].second is None
    assert {r.cell: r.assigned for r in methyl.assigned(df, -0.9).collect()}["c"] == "r1"


def test_site_filters(spark):
    df = spark.createDataFrame([("c", 1, 3, 2), ("c", 2, 0, 0), ("c", 3, 1, 2)], "cell string, site int, mc int, cov int")
    assert [r.site for r in methyl.usable_sites(df).collect()] == [3]


def test_neighbours_leave_themselves_out(spark):
    df = spark.createDataFrame([("a", "a", 0.0), ("a", "b", -1.0), ("a", "c", 2.0)], "i string, j string, dist double")
    assert [r.j for r in neighbors.nearest(df, 1).collect()] == ["b"]
    assert [r.j for r in neighbors.nearest(df, 1, exclude_self=False).collect()] == ["a"]


def test_farther_allele(spark):
    df = spark.createDataFrame([(-2.0, 2.0), (1.0, -3.0), (None, 1.0), (1.0, None), (None, None)], "lo double, hi double")
    assert [r.v for r in df.select(loci.farther().alias("v")).collect()] == [-2, -3, 1, 1, None]


def test_p_values():
    assert stats.p_of_t(2.228, 10) == pytest.approx(0.05, abs=1e-4)
    assert stats.p_of_f(4.26, 2, 9) == pytest.approx(0.05, abs=1e-3)
    assert stats.p_of_z(1.96) == pytest.approx(0.05, abs=1e-3)


def test_deep_trees_keep_all_ancestors(spark):
    """A comb of 200 levels: each level has one leaf."""
    levels = 200
    rows = [(0, None, None, 0.0)]
    for k in range(levels):
        rows += [(2 * k + 1, 2 * k, f"s{k:03d}", 1.0), (2 * k + 2, 2 * k, None if k + 1 < levels else "end", 1.0)]
    comb = spark.createDataFrame(rows, "node int, parent int, name string, len double")
    got = {(r.a, r.b): (r.edges, r.depth) for r in tree.leaf_pairs(comb, []).collect()}
    assert len(got) == (levels + 1) * levels // 2
    assert got["s000", "s199"] == (201, 0.0)
    assert got["s150", "s199"] == (51, 150.0)
    sizes = sorted(len(r.leaves) for r in tree.clades(comb, []).collect())
    assert sizes == list(range(2, levels + 2))


def test_siblings_of_many_trees(spark):
    sibs = spark.createDataFrame([(1, "a", "b"), (1, "c", "d"), (2, "a", "c"), (2, "b", "e")], "tree_id int, a string, b string")
    labels = spark.createDataFrame([("a", "g"), ("b", "g"), ("c", "h")], "sample string, grp string")
    got = {r.tree_id: (r.comparisons, r.pairs, r.percentage) for r in evaluate.sibling_percentage(sibs, labels, ["tree_id"]).collect()}
    assert got == {1: (2, 1, 50.0), 2: (2, 0, 0.0)}


def test_sequential_tests_stop_and_count_failures(spark):
    from cladespark.operators import evaluate

    values = [10.0, None, 50.0, 20.0, 60.0, None, 70.0, 10.0, 80.0, 90.0] * 10
    asked = []

    def permuted(first, last):
        asked.append((first, last))
        rows = [(k, values[k]) for k in range(first, last) if k % 10 != 5]  # one isn't listed, another has no value
        return spark.createDataFrame(rows, "perm int, percentage double")

    observed = spark.createDataFrame([(60.0,)], "percentage double")
    got = evaluate.sequential_test(observed, permuted, batch=8, most=100, enough=3).first()
    assert got[:] == (60.0, 9, 3, 2, True, 3 / 7) and asked == [(0, 8), (8, 16)]
    got = evaluate.sequential_test(observed, permuted, batch=30, most=100, enough=1000).first()
    assert got[:] == (60.0, 100, 40, 20, False, 41 / 81)


def test_p_value_columns(spark):
    rows = spark.createDataFrame([(2.228, 10.0), (None, 3.0), (1.0, 0.0)], "t double, v double")
    got = [r.p for r in rows.select(stats.p_value_t(F.col("t"), F.col("v")).alias("p")).collect()]
    assert got[0] == pytest.approx(0.05, abs=1e-4) and got[1] is None and (got[2] is None or got[2] != got[2])
    ranked = stats.rank_test(spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 1.5), ("b", 9.0), ("c", 8.0), ("c", 7.0)], "g string, v double"), "g", "v").collect()
    assert all(r.p <= r.p_adjusted <= 1 for r in ranked) and len(ranked) == 3


@pytest.mark.parametrize("metric", sorted(distance.METRICS))
def test_blocks_give_the_same_distances(spark, monkeypatch, metric):
    from cladespark.operators import pair_blocks

    monkeypatch.setattr(pair_blocks, "SLICE", 3)
    rng = random.Random(metric)
    rows = [(f"s{s:02d}", t, [rng.choice([10, 11, 12, 20, 21, 30]) for _ in range(rng.choice([1, 2, 2, 3]))][:2]) for s in range(11) for t in range(23) if rng.random() < 0.6]
    rows += [("alone", 999, [5]), ("none", 5, [])]
    calls = spark.createDataFrame(rows, "sample string, target int, alleles array<long>")
    want = sorted(tuple(r) for r in distance.pair_distances(calls, metric, 2).collect())
    for cells, targets in ((4, 5), (128, 2048)):
        assert sorted(tuple(r) for r in pair_blocks.pair_distances(calls, metric, 2, cells, targets).collect()) == want
