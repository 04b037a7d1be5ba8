"""Trees as tables: tree_id, node, parent, name, len, support, is_leaf, x, y."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import trees
from ..storage import shared_dir

#: Leaves whose pairs are a task's.
LEAVES = 128
SCHEMA = "node int, parent int, name string, len double, support double, is_leaf boolean, x double, y double"


def neighbour_joining(distances: DataFrame, tree_id: str = "tree_id", outgroup: str = "NA") -> DataFrame:
    """A tree for each tree_id from i, j, dist of all ordered or unordered pairs; trees are built side by side.

    A missing pair counts as 0, as one without comparable alleles does.
    """
    kind = distances.schema[tree_id].dataType.simpleString()

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        names = sorted({*rows["i"], *rows["j"]})
        at = {n: k for k, n in enumerate(names)}
        d = np.zeros((len(names), len(names)))
        i, j = rows["i"].map(at).to_numpy(), rows["j"].map(at).to_numpy()
        d[i, j] = d[j, i] = rows["dist"].to_numpy()
        np.fill_diagonal(d, 0)
        out = pd.DataFrame(trees.table(trees.rooted(trees.neighbour_joining(names, d), outgroup)))
        out.insert(0, tree_id, key[0])
        return out

    return distances.groupBy(tree_id).applyInPandas(build, f"{tree_id} {kind}, {SCHEMA}")


def from_newick(texts: DataFrame, tree_id: str = "tree_id", newick: str = "newick", outgroup: str = "NA") -> DataFrame:
    """The nodes of Newick texts, one tree for each row."""
    kind = texts.schema[tree_id].dataType.simpleString()

    def read(batches):  # noqa: ANN001, ANN202
        for rows in batches:
            for key, text in zip(rows[tree_id], rows[newick]):
                out = pd.DataFrame(trees.table(trees.rooted(trees.parse_newick(text), outgroup)))
                out.insert(0, tree_id, key)
                yield out

    return texts.select(tree_id, newick).mapInPandas(read, f"{tree_id} {kind}, {SCHEMA}")


def node_of(rows: pd.DataFrame) -> trees.Node:
    nodes = {r.node: trees.Node(r.name_, r.len, None if r.support is None or r.support != r.support else r.support) for r in rows.rename(columns={"name": "name_"}).itertuples()}
    root = None
    for r in rows.sort_values("node").itertuples():
        if r.parent is None or r.parent != r.parent:
            root = nodes[r.node]
        else:
            nodes[int(r.parent)].children.append(nodes[r.node])
    return root


def to_newick(tree: DataFrame, tree_id: str = "tree_id") -> DataFrame:
    """tree_id, newick."""
    kind = tree.schema[tree_id].dataType.simpleString()

    def write(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({tree_id: [key[0]], "newick": [trees.to_newick(node_of(rows))]})

    return tree.select(tree_id, "node", "parent", "name", "len", "support").groupBy(tree_id).applyInPandas(write, f"{tree_id} {kind}, newick string")


def ancestors(tree: DataFrame, keys: list[str]) -> DataFrame:
    """keys, node, anc, hops: each node with itself (0) and all nodes above it. Paths double each turn until none is longer."""
    shared_dir(tree.sparkSession)
    hop = lambda rows: rows.select(*keys, F.col("node").alias("anc"), F.col("anc").alias("top"), F.col("hops").alias("h"))
    longer = lambda x, y: x.join(hop(y), [*keys, "anc"]).select(*keys, "node", F.col("top").alias("anc"), (F.col("hops") + F.col("h")).alias("hops"))
    up = tree.filter("parent is not null").select(*keys, "node", F.col("parent").alias("anc"), F.lit(1).alias("hops"))
    reach = tree.select(*keys, "node", F.col("node").alias("anc"), F.lit(0).alias("hops"))
    for _ in range(2):  # up to three hops, in one plan
        reach, up = reach.unionByName(longer(reach, up)), longer(up, up)
    while True:
        up = up.checkpoint()
        if not up.limit(1).count():
            return reach
        reach, up = reach.unionByName(longer(reach, up)).checkpoint(), longer(up, up)


def tours(tree: DataFrame, keys: list[str]) -> DataFrame:
    """A row for each tree: its leaves in preorder and, for neighbours among them, their closest common ancestor.

    names, hops and depths of leaves (edges and length from the root); met_hops and met_depths of the ancestor of each leaf and the next.
    The common ancestor of any two leaves is the one with the fewest hops among those of the neighbours between them, so these arrays are all that
    distances need. nodes, lows, highs: inner nodes and the leaves below them, as a range of places; sums, others: sums of two hashes of the names there.
    A tree is a task's, as it is when it is built; it has a few numbers for each node. Names of leaves must differ within a tree.
    """
    kinds = {f.name: f.dataType.simpleString() for f in tree.schema}
    arrays = "names array<string>, hops array<long>, depths array<double>, met_hops array<long>, met_depths array<double>, nodes array<long>, lows array<long>, highs array<long>, sums array<long>, others array<long>"

    def tour(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node", kind="stable")
        numbers, names, lengths = rows["node"].tolist(), rows["name"].tolist(), rows["len"].fillna(0).tolist()
        row = {n: k for k, n in enumerate(numbers)}
        up = [None if pd.isna(p) else row[int(p)] for p in rows["parent"].tolist()]
        children: dict[int, list[int]] = {}
        for k, p in enumerate(up):
            if p is not None:
                children.setdefault(p, []).append(k)
        hops, depth, low, high = ([0] * len(names) for _ in range(4))
        depth = list(lengths)  # the root's own; others follow
        order: list[int] = []  # leaves
        met: list[int] = []
        stack = [(k, False) for k, p in enumerate(up) if p is None][:1]
        last = None  # the node that was left last: the next leaf is below its parent
        while stack:
            at, left = stack.pop()
            if left or at not in children:
                if not left:
                    low[at] = len(order)
                    if last is not None:
                        met.append(up[last])
                    order.append(at)
                high[at], last = len(order), at
                continue
            low[at] = len(order)
            stack.append((at, True))
            for child in reversed(children[at]):
                hops[child], depth[child] = hops[at] + 1, depth[at] + lengths[child]
                stack.append((child, False))
        known = [names[k] for k in order if names[k] is not None]
        if len(set(known)) < len(known):
            raise ValueError(f"leaves of tree {key} have the same name")
        inner = sorted(children)
        sums = [np.append(0, np.cumsum(rows[c].to_numpy(np.int64)[order])) for c in ("h1", "h2")]  # they wrap round
        of = lambda values, at: [values[k] for k in at]
        lows, highs = of(low, inner), of(high, inner)
        found = {"names": of(names, order), "hops": of(hops, order), "depths": of(depth, order), "met_hops": of(hops, met), "met_depths": of(depth, met), "nodes": of(numbers, inner), "lows": lows, "highs": highs}
        found |= {c: (s[highs] - s[lows]).tolist() for c, s in zip(("sums", "others"), sums)}
        return pd.DataFrame({**{k: [v] for k, v in zip(keys, key)}, **{k: [v] for k, v in found.items()}})

    fields = "".join(f"{k} {kinds[k]}, " for k in keys)
    hashed = tree.select(*keys, "node", "parent", "name", "len", F.when(F.col("name").isNull(), 0).otherwise(F.xxhash64("name")).alias("h1"), F.when(F.col("name").isNull(), 0).otherwise(F.xxhash64(F.lit("other"), "name")).alias("h2"))
    return hashed.groupBy(*keys).applyInPandas(tour, fields + arrays)


def leaf_pairs(tree: DataFrame, keys: list[str]) -> DataFrame:
    """keys, a, b, edges (between them over their closest common ancestor), depth (length from the root to it), length (between them), of leaf names a < b.

    Tasks are blocks of leaves; each goes along the leaves after its own with the least ancestor so far.
    """
    found = tours(tree, keys).withColumn("first", F.explode(F.sequence(F.lit(0), F.greatest(F.size("names") - 1, F.lit(0)), F.lit(LEAVES))))
    kinds = {f.name: f.dataType.simpleString() for f in tree.schema}

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                names, hops, depths, met_hops, met_depths, first = (batch.column(len(keys) + k)[r].as_py() for k in range(6))
                hops, depths, met_hops, met_depths = (np.array(x) for x in (hops, depths, met_hops, met_depths))
                for i in range(first, min(first + LEAVES, len(names) - 1)):
                    ahead = met_hops[i:]
                    least = np.minimum.accumulate(ahead)
                    place = np.maximum.accumulate(np.where(ahead == least, np.arange(len(ahead)), 0))
                    depth = met_depths[i:][place]
                    there = [k for k in range(i + 1, len(names)) if names[k] is not None] if names[i] is not None else []
                    if not there:
                        continue
                    j = np.array(there)
                    at = j - i - 1
                    low = [min(names[i], names[k]) for k in there]
                    high = [max(names[i], names[k]) for k in there]
                    own = [pa.repeat(batch.column(k)[r], len(there)) for k in range(len(keys))]
                    yield pa.RecordBatch.from_arrays([*own, pa.array(low), pa.array(high), pa.array(hops[i] + hops[j] - 2 * least[at]), pa.array(depth[at]), pa.array(depths[i] + depths[j] - 2 * depth[at])], [*keys, "a", "b", "edges", "depth", "length"])

    fields = "".join(f"{k} {kinds[k]}, " for k in keys)
    return found.select(*keys, "names", "hops", "depths", "met_hops", "met_depths", "first").mapInArrow(pairs, f"{fields}a string, b string, edges long, depth double, length double")


def clade_rows(toured: DataFrame, keys: list[str]) -> DataFrame:
    """keys, node, size (leaves), h1, h2 (hashes of the set of their names), leaves (sorted names) of each inner node."""
    each = toured.withColumn("c", F.explode(F.arrays_zip("nodes", "lows", "highs", "sums", "others")))
    below = F.slice("names", (F.col("c.lows") + 1).cast("int"), (F.col("c.highs") - F.col("c.lows")).cast("int"))
    return each.select(*keys, F.col("c.nodes").alias("node"), (F.col("c.highs") - F.col("c.lows")).alias("size"), F.col("c.sums").alias("h1"), F.col("c.others").alias("h2"), F.array_sort(F.array_compact(below)).alias("leaves"))


def clades(tree: DataFrame, keys: list[str]) -> DataFrame:
    """keys, node, leaves: the sorted leaf names below each inner node."""
    return clade_rows(tours(tree, keys), keys).select(*keys, "node", "leaves")


def support(original: DataFrame, replicates: DataFrame, iterations: int) -> DataFrame:
    """leaves, num_verified, support: the share of replicate trees (tree_id) that have each clade of the original.

    Clades meet by their size and two sums of 64-bit hashes of their names; names themselves are only listed for the original.
    """
    same = ["size", "h1", "h2"]
    own = clade_rows(tours(original, []), []).select(*same, "leaves").dropDuplicates(same)
    seen = clade_rows(tours(replicates, ["tree_id"]), ["tree_id"]).select("tree_id", *same).distinct()
    found = seen.groupBy(*same).agg(F.count(F.lit(1)).alias("num_verified"))
    told = own.join(found, same, "left").select("leaves", F.coalesce("num_verified", F.lit(0)).cast("long").alias("num_verified"))
    return told.withColumn("support", F.round(F.col("num_verified") / iterations, 2))


def support_summary(supports: DataFrame) -> DataFrame:
    """One row: clades, mean and median support."""
    return supports.agg(F.count(F.lit(1)).alias("clades"), F.avg("support").alias("mean_support"), F.median("support").alias("median_support"))


def percent_labels(supports: DataFrame) -> DataFrame:
    """Adds label: support in percent, whether it is given as a share or as percent."""
    value = F.col("support")
    return supports.withColumn("label", F.round(F.when(value <= 1.5, value * 100).otherwise(value)).cast("int"))


def siblings(tree: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """keys, a, b: leaves a < b of one parent."""
    keys = keys or []
    tips = tree.filter("name is not null and parent is not null")
    x, y = (tips.select(*keys, "parent", F.col("name").alias(n)) for n in "ab")
    return x.join(y, [*keys, "parent"]).filter("a < b").select(*keys, "a", "b")
