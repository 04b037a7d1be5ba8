"""Connected components of links between ids, for large and star-shaped graphs.

Each node takes the smallest label among its own and its neighbours', then the label of
its label (a shortcut), until nothing changes. Sums are partial before they are
shuffled, so the many links of one node don't meet in a task. Labels are written
after each round, which cuts lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import Scratch


def components(links: DataFrame, tables: Scratch) -> DataFrame:
    """id, component (its smallest id) of every id in the links a, b. Ids without links are not listed."""
    pairs = links.select("a", "b").filter("a <> b")
    both = tables.keep(pairs.union(pairs.select("b", "a")).distinct(), "links")
    labels = tables.keep(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "id"), "labels")
    while True:
        offered = both.join(labels, both["b"] == labels["id"]).groupBy(both["a"].alias("id")).agg(F.min("label").alias("offer"))
        nearer = labels.join(offered, "id", "left").select("id", F.col("label").alias("before"), F.least("label", "offer").alias("label"))
        root = labels.select(F.col("id").alias("label"), F.col("label").alias("root"))
        after = tables.keep(nearer.join(root, "label", "left").select("id", "before", F.least("label", "root").alias("label")), "labels")
        changed = after.filter("before <> label").limit(1).count()
        labels = after.select("id", "label")
        if not changed:
            return labels.withColumnRenamed("label", "component")
