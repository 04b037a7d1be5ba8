"""Tours, pairs of leaves, clades and linkage against plain computations; deep trees."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from cladespark.functions import trees
from cladespark.operators import tree


def random_tree(rng, count):
    """Node rows (node, parent, name, len), numbers in any order."""
    numbers = rng.sample(range(1000), count)
    parents = [None] + [numbers[rng.randrange(max(0, k - 6), k)] for k in range(1, count)]
    inner = set(parents)
    return [(n, p, None if n in inner and count > 1 else f"leaf {n}", float(rng.randrange(5))) for n, p in zip(numbers, parents)]


def pairs_by_closure(rows):
    parent, length, name = {r[0]: r[1] for r in rows}, {r[0]: r[3] for r in rows}, {r[0]: r[2] for r in rows}

    def path(n):
        out = [n]
        while parent[out[-1]] is not None:
            out.append(parent[out[-1]])
        return out

    depth = {n: sum(length[x] for x in path(n)) for n in parent}
    out = set()
    for a in parent:
        for b in parent:
            if name[a] and name[b] and name[a] < name[b]:
                up, other = path(a), path(b)
                met = next(x for x in up if x in other)
                out.add((name[a], name[b], up.index(met) + other.index(met), depth[met], depth[a] + depth[b] - 2 * depth[met]))
    return sorted(out)


def frame(spark, forest):
    return spark.createDataFrame([(t, *r) for t, rows in forest.items() for r in rows], "tree_id int, node int, parent int, name string, len double")


def test_pairs_and_clades_of_random_trees(spark, monkeypatch):
    rng = random.Random(1)
    forest = {t: random_tree(rng, n) for t, n in enumerate((1, 2, 3, 30, 31, 90))}
    df = frame(spark, forest)
    for block in (4, 128):
        monkeypatch.setattr(tree, "LEAVES", block)
        got = tree.leaf_pairs(df, ["tree_id"]).collect()
        for t, rows in forest.items():
            assert sorted(tuple(r)[1:] for r in got if r.tree_id == t) == pairs_by_closure(rows)
    below = tree.ancestors(df, ["tree_id"]).filter("hops > 0").join(df.filter("name is not null").select("tree_id", "node", "name"), ["tree_id", "node"])
    want = below.groupBy("tree_id", F.col("anc").alias("node")).agg(F.array_sort(F.collect_list("name")).alias("leaves"))
    key = lambda rows: sorted((r.tree_id, r.node, tuple(r.leaves)) for r in rows)
    assert key(tree.clades(df, ["tree_id"]).collect()) == key(want.collect())


def test_a_path_of_many_nodes(spark):
    count = 5000
    rows = [(2 * k, 2 * (k - 1) if k else None, None, 1.0) for k in range(count // 2)] + [(2 * k + 1, 2 * k, f"l{k:05d}", 1.0) for k in range(count // 2)]
    df = frame(spark, {0: rows})
    found = tree.leaf_pairs(df, ["tree_id"])
    n = count // 2
    assert found.count() == n * (n - 1) // 2
    assert found.filter("a = 'l00010' and b = 'l02000'").select("edges", "depth", "length").first()[:] == (1992, 11.0, 1992.0)


def test_support_counts_equal_sets(spark):
    rng = random.Random(2)
    forest = {t: [(n, p, None if x is None else "leaf", d) for n, p, x, d in random_tree(rng, 40)] for t in range(8)}
    forest[7] = forest[0]
    for t, rows in forest.items():
        names = iter(rng.sample([f"n{k}" for k in range(sum(1 for r in rows if r[2]))], sum(1 for r in rows if r[2])))
        forest[t] = [(n, p, next(names) if x else None, d) for n, p, x, d in rows]
    forest[6] = forest[0]
    df = frame(spark, forest)
    got = {tuple(r.leaves): r.num_verified for r in tree.support(df.filter("tree_id = 0").drop("tree_id"), df, 8).collect()}
    sets = [(r.tree_id, tuple(r.leaves)) for r in tree.clades(df, ["tree_id"]).collect()]
    assert got == {c: len({t for t, x in sets if x == c}) for t0, c in sets if t0 == 0}
    assert max(got.values()) >= 2


def test_same_names_raise(spark):
    with pytest.raises(Exception, match="same name"):
        tree.leaf_pairs(frame(spark, {0: [(0, None, None, 0.0), (1, 0, "a", 1.0), (2, 0, "a", 1.0)]}), ["tree_id"]).collect()


def test_deep_newick_texts():
    text = "(" * 20_000 + "a:1" + "".join(f",b{k}:2)'x y':1" for k in range(20_000)) + ";"
    root = trees.parse_newick(text)
    assert trees.to_newick(root) == text.rsplit(":", 1)[0] + ";"
    rows = trees.table(root)
    assert len(rows) == 40_001 and max(r["x"] for r in rows) == 20_001 and rows[0]["parent"] is None
    assert trees.leaves(root)[:3] == ["a", "b0", "b1"]
    for bad in ("(a,b", "a,b);", "(a,b)", ""):
        with pytest.raises(ValueError):
            trees.parse_newick(bad)


def merges_by_brute_force(distance):
    d = {(i, j): float(distance[i, j]) for i in range(len(distance)) for j in range(i + 1, len(distance))}
    size, out = dict.fromkeys(range(len(distance)), 1), []
    while len(size) > 1:
        (a, b), away = min(d.items(), key=lambda kv: (kv[1], kv[0]))
        new = len(distance) + len(out)
        of = lambda x, y: d.pop((min(x, y), max(x, y)))
        for k in list(size):
            if k not in (a, b):
                d[k, new] = (size[a] * of(a, k) + size[b] * of(b, k)) / (size[a] + size[b])
        del d[a, b]
        size[new] = size.pop(a) + size.pop(b)
        out.append((a, b, away, size[new]))
    return out


def test_linkage_with_ties_and_many_items():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 5, 30):
        for kind in (rng.random((n, n)), rng.integers(1, 4, (n, n)).astype(float)):
            d = np.triu(kind, 1) + np.triu(kind, 1).T
            got = trees.average_linkage(d)
            want = merges_by_brute_force(d)
            assert [(a, b, s) for a, b, _, s in got] == [(a, b, s) for a, b, _, s in want]
            assert np.allclose([x[2] for x in got], [x[2] for x in want])
    points = rng.random((3000, 5))
    began = time.perf_counter()
    assert len(trees.average_linkage(np.linalg.norm(points[:, None] - points[None], axis=2))) == 2999
    assert time.perf_counter() - began < 60


def joined_by_brute_force(names, distance):
    """Every q of every step."""
    nodes, d = [trees.Node(n) for n in names], np.array(distance, float)
    while len(nodes) > 3:
        n, total = len(nodes), d.sum(1)
        q = (n - 2) * d - total[:, None] - total[None]
        q[np.tril_indices(n)] = np.inf
        i, j = np.unravel_index(np.argmin(q), q.shape)
        to_i = d[i, j] / 2 + (total[i] - total[j]) / (2 * (n - 2))
        nodes[i].length, nodes[j].length = max(0.0, to_i), max(0.0, d[i, j] - to_i)
        away = (d[i] + d[j] - d[i, j]) / 2
        keep = [k for k in range(n) if k not in (i, j)]
        grown = np.zeros((n - 1, n - 1))
        grown[1:, 1:] = d[np.ix_(keep, keep)]
        grown[0, 1:] = grown[1:, 0] = away[keep]
        nodes, d = [trees.Node(children=[nodes[i], nodes[j]]), *(nodes[k] for k in keep)], grown
    if len(nodes) == 3:
        for i, j, k in ((0, 1, 2), (1, 0, 2), (2, 0, 1)):
            nodes[i].length = max(0.0, (d[i, j] + d[i, k] - d[j, k]) / 2)
    elif len(nodes) == 2:
        nodes[0].length = nodes[1].length = d[0, 1] / 2
    return nodes[0] if len(nodes) == 1 else trees.Node(children=nodes)


def test_joining_with_bounds_gives_the_same_trees():
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 4, 5, 9, 33, 60):
        for d in (rng.random((n, n)), rng.integers(0, 4, (n, n)) * 64.0, np.zeros((n, n)), np.full((n, n), 8.0)):
            d = np.triu(d, 1) + np.triu(d, 1).T
            names = [f"x{k}" for k in range(n)]
            got, want = trees.neighbour_joining(names, d), joined_by_brute_force(names, d)
            plain = lambda t: [(x.name, p) for x, p in trees.preorder(t)]
            assert plain(got) == plain(want)
            assert np.allclose([x.length for x, _ in trees.preorder(got)], [x.length for x, _ in trees.preorder(want)])


def test_joining_many_cells():
    rng = np.random.default_rng(6)
    points = rng.random((2000, 6)).cumsum(1)
    began = time.perf_counter()
    root = trees.neighbour_joining([str(k) for k in range(2000)], np.linalg.norm(points[:, None] - points[None], axis=2))
    assert len(trees.leaves(root)) == 2000
    assert time.perf_counter() - began < 90
