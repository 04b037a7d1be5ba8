"""Queries on genotypes, distances, trees and resampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import distance, evaluate, genotype, loci, neighbors, pair_blocks, resample, tree
from .registry import query
from .views import view

GOOD = """good as (select sample, target, depth, q, stutter, a1, a2, case when a1 = a2 then [a1] else list_sort([a1, a2]) end as alleles from v_calls where depth >= 10 and q >= 0.9 and stutter / depth <= 1)"""
GROUPS = """repeats as (select distinct target, unnest(alleles) as allele from good), groups as (select target, allele, allele - row_number() over (partition by target order by allele) as grp from repeats)"""
MEMBERS = """members as (select g.sample, g.target, r.grp, list_sort(list(distinct r.allele)) as alleles from (select sample, target, unnest(alleles) as allele from good) g join groups r on r.target = g.target and r.allele = g.allele group by all)"""
MET = """met as (select a.sample as s1, b.sample as s2, a.target, a.alleles as x, b.alleles as y, least(len(a.alleles), len(b.alleles)) as n, len(list_intersect(a.alleles, b.alleles)) as same from members a join members b on a.target = b.target and a.grp = b.grp and a.sample < b.sample)"""
SHARED = """shared as (select a.sample as s1, b.sample as s2, count(*) as num_targets from good a join good b on a.target = b.target and a.sample <= b.sample group by all)"""
PAIRS = "list_transform(flatten(list_transform(x, lambda p: list_transform(y, lambda q: [p, q]))), lambda z: abs(z[1] - z[2]))"
PARTS = {
    "minComp_EqorNot": ("n", "n - same"),
    "minComp_Abs": ("n", f"case when n = 2 then abs(x[1] - y[1]) + abs(x[2] - y[2]) else list_min({PAIRS}) end"),
    "allComp_EqorNot": ("len(x) * len(y)", "len(x) * len(y) - same"),
    "allComp_Abs": ("len(x) * len(y)", f"list_sum({PAIRS})"),
}


def distance_sql(metric: str, name: str = "dists") -> str:
    count, difference = PARTS[metric]
    return f"""{GOOD}, {GROUPS}, {MEMBERS}, {MET}, {SHARED}, parts as (select s1, s2, sum({count}) as c, sum({difference}) as d from met group by all),
 {name} as (select s.s1, s.s2, s.num_targets, cast(case when s.s1 = s.s2 then s.num_targets else coalesce(c, 0) end as bigint) as num_alleles, cast(coalesce(d, 0) as bigint) as num_diff,
 case when s.s1 = s.s2 or coalesce(c, 0) = 0 then 0 else d / c end as dist, case when s.s1 = s.s2 then s.num_targets else coalesce(c, 0) end > 0 as is_comparable from shared s left join parts p on p.s1 = s.s1 and p.s2 = s.s2)"""


def good_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "v_calls").filter(genotype.good_call(0.9, 10, 1.0))


def alleles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return genotype.allelotype(good_calls(spark, sf_dir))


def flagship(spark: SparkSession, sf_dir: str, min_reads: int = 1) -> DataFrame:
    """Pair distances with a depth that the smallest tables reach."""
    good = view(spark, sf_dir, "v_calls").filter(genotype.good_call(0.85, min_reads, 10.0))
    return distance.pair_distances(genotype.allelotype(good))


@query("P5 P23", "select * from v_calls where depth >= 10 and q >= 0.9 and stutter / depth <= 1")
def genotype_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return good_calls(spark, sf_dir)


@query("P6 P7 P8", """select sample, c.target, (a1 - 10) + motif_len * num_copies as size_1, (a2 - 10) + motif_len * num_copies as size_2,
 depth + stutter as reads, cast((a1 - 10) * depth + (a2 - 10) * stutter as bigint) as read_sum from v_calls c join v_targets t on t.target = c.target where depth < 200""")
def allele_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = genotype.known_targets(view(spark, sf_dir, "v_calls"), view(spark, sf_dir, "v_targets")).filter("depth < 200")
    sizes = genotype.allele_sizes(F.array(F.col("a1") - 10, F.col("a2") - 10), F.col("ref_len"))
    packed = F.concat((F.col("a1") - 10).cast("string"), F.lit("|"), F.col("depth").cast("string"), F.lit(";"), (F.col("a2") - 10).cast("string"), F.lit("|"), F.col("stutter").cast("string"))
    reads = genotype.read_multiset(packed)
    return calls.select("sample", "target", F.get(sizes, F.lit(0)).alias("size_1"), F.get(sizes, F.lit(1)).alias("size_2"), F.size(reads).cast("long").alias("reads"), F.aggregate(reads, F.lit(0).cast("long"), lambda a, x: a + x).alias("read_sum"))


@query("T1 W1 A6 F13", f"with {GOOD}, {GROUPS} select * from groups")
def allele_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distance.allele_groups(alleles(spark, sf_dir))


def _distance_query(metric: str, covers: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return distance.pair_distances(alleles(spark, sf_dir), metric)

    run.__name__ = f"pair_distance_{metric.lower()}"
    query(covers, f"with {distance_sql(metric)} select * replace (round(dist, 6) as dist) from dists")(run)


_distance_query("minComp_EqorNot", "T2 T5 J2 J3 A7 U4 F8")
_distance_query("minComp_Abs", "T3")
_distance_query("allComp_EqorNot", "T4")
_distance_query("allComp_Abs", "T4")


def _blocked_query(metric: str, covers: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return pair_blocks.pair_distances(alleles(spark, sf_dir), metric, cells=4, targets=200)

    run.__name__ = f"blocked_distance_{metric.lower()}"
    query(covers, f"with {distance_sql(metric)} select * replace (round(dist, 6) as dist) from dists")(run)


_blocked_query("minComp_EqorNot", "T2 T5 J2 J3 A7")
_blocked_query("minComp_Abs", "T3 J2 J3 A7")


@query("A8", f"""with {distance_sql("minComp_EqorNot")} select round(avg(num_targets) filter (s1 = s2), 6) as cell_mean, min(num_targets) filter (s1 = s2) as cell_min, max(num_targets) filter (s1 = s2) as cell_max,
 round(avg(num_targets) filter (s1 <> s2), 6) as pair_mean, min(num_targets) filter (s1 <> s2) as pair_min, max(num_targets) filter (s1 <> s2) as pair_max from dists""")
def distance_tree_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distance.tree_stats(distance.pair_distances(alleles(spark, sf_dir)))


@query("S39 K5", f"""with {distance_sql("minComp_EqorNot")}, both_ as (select s1, s2, dist, num_targets from dists union all select s2, s1, dist, num_targets from dists where s1 <> s2) select s1, s2, round(dist, 4) as dist, cast(num_targets as double) as targets from both_""")
def tree_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matrices of a tree's report, from its text."""
    from .. import sinks
    from ..sources import logs
    from .file_queries import through_files

    pairs = distance.pair_distances(alleles(spark, sf_dir))
    found = through_files(spark, lambda path: sinks.write_tree_stats(pairs, path), lambda path: logs.tree_matrices(spark, path))
    value = lambda name: F.max(F.when(F.col("matrix") == name, F.col("value")))
    return found.groupBy("s1", "s2").agg(value("distance").alias("dist"), value("targets").alias("targets"))


@query("A15 J5", """with deep as (select sample, target from v_calls where depth >= 10 and sample <> 's03'), names as (select distinct sample from v_calls)
 select a.sample as s1, b.sample as s2, coalesce(n, 0) as shared from names a join names b on a.sample < b.sample left join (select x.sample as s1, y.sample as s2, count(*) as n from deep x join deep y on x.target = y.target and x.sample < y.sample group by all) c on c.s1 = a.sample and c.s2 = b.sample""")
def shared_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = view(spark, sf_dir, "v_calls")
    return distance.shared_at_depth(calls.filter("sample <> 's03'"), calls, 10)


@query("T9", f"""with {GOOD}, {GROUPS}, {MEMBERS}, {MET}, drawn as (select i as iteration, target, row_number() over (partition by i order by md5(concat_ws('|', '1', i, target)), target) as k, count(*) over (partition by i) as n from (select distinct target from v_calls), range(1, 6) t(i)),
 boot as (select iteration, target from drawn where k <= floor(0.8 * n)),
 shared as (select iteration, a.sample as s1, b.sample as s2, count(*) as num_targets from good a join good b on a.target = b.target and a.sample <= b.sample join boot on boot.target = a.target group by all),
 parts as (select iteration, s1, s2, sum(n) as c, sum(n - same) as d from met join boot on boot.target = met.target group by all)
 select cast(s.iteration as integer) as iteration, s.s1, s.s2, s.num_targets, cast(case when s.s1 = s.s2 then s.num_targets else coalesce(c, 0) end as bigint) as num_alleles, cast(coalesce(d, 0) as bigint) as num_diff,
 round(case when s.s1 = s.s2 or coalesce(c, 0) = 0 then 0 else d / c end, 6) as dist, case when s.s1 = s.s2 then s.num_targets else coalesce(c, 0) end > 0 as is_comparable
 from shared s left join parts p on p.iteration = s.iteration and p.s1 = s.s1 and p.s2 = s.s2""")
def bootstrap_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bootstrapped(spark, sf_dir, 5)


def bootstrapped(spark: SparkSession, sf_dir: str, iterations: int) -> DataFrame:
    own = alleles(spark, sf_dir)
    drawn = resample.bootstrap_targets(view(spark, sf_dir, "v_calls"), iterations)
    parts = distance.contributions(own, distance.allele_groups(own), "minComp_EqorNot").join(drawn, "target")
    return distance.summed(parts, distance.pairs_of_targets(own).join(drawn, "target"), ["iteration"])


def original_tree(spark: SparkSession, sf_dir: str, outgroup: str = "Midpoint") -> DataFrame:
    pairs = distance.pair_distances(alleles(spark, sf_dir)).select(F.lit(0).alias("tree_id"), F.col("s1").alias("i"), F.col("s2").alias("j"), "dist")
    return tree.neighbour_joining(pairs, outgroup=outgroup)


@query("T6 T7 T8 T22")
def lineage_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return original_tree(spark, sf_dir)


@query("T11")
def lineage_newick(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree.to_newick(original_tree(spark, sf_dir, "s00"))


@query("T10 A10 J16 D14 U5 T25")
def clade_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    replicas = bootstrapped(spark, sf_dir, 20).select(F.col("iteration").alias("tree_id"), F.col("s1").alias("i"), F.col("s2").alias("j"), "dist")
    found = tree.support(original_tree(spark, sf_dir), tree.neighbour_joining(replicas, outgroup="Midpoint"), 20)
    return tree.percent_labels(found).withColumn("leaves", F.array_join("leaves", ","))


UP = """up as (select node, node as anc, 0 as hops from v_tree union all select u.node, t.parent, u.hops + 1 from up u join v_tree t on t.node = u.anc where t.parent is not null)"""
LEAF_PAIRS = f"""{UP}, depth as (select u.node, sum(t.len) as depth from up u join v_tree t on t.node = u.anc group by 1),
 pairs as (select a.name as a, b.name as b, min(x.hops + y.hops) as edges, arg_min(d.depth, x.hops + y.hops) as depth, arg_min(f.depth + g.depth - 2 * d.depth, x.hops + y.hops) as length from up x join up y on x.anc = y.anc join v_tree a on a.node = x.node join v_tree b on b.node = y.node join depth d on d.node = x.anc join depth f on f.node = x.node join depth g on g.node = y.node where a.name < b.name group by 1, 2)"""
SIBLINGS = "sibs as (select a.name as a, b.name as b from v_tree a join v_tree b on a.parent = b.parent and a.name < b.name)"


@query("T13 J10", f"with recursive {LEAF_PAIRS} select a, b, edges, depth, length from pairs")
def tree_leaf_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree.leaf_pairs(view(spark, sf_dir, "v_tree"), [])


@query("D14 J16", f"with recursive {UP} select u.anc as node, string_agg(t.name, ',' order by t.name) as leaves from up u join v_tree t on t.node = u.node where t.name is not null and u.hops > 0 group by 1")
def tree_clades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree.clades(view(spark, sf_dir, "v_tree"), []).withColumn("leaves", F.array_join("leaves", ","))


def rebuilt_tree(spark: SparkSession, sf_dir: str, outgroup: str) -> DataFrame:
    """The tree that neighbour joining finds from the lengths between the leaves of v_tree, which it must find again."""
    lengths = tree.leaf_pairs(view(spark, sf_dir, "v_tree"), []).select(F.lit(0).alias("tree_id"), F.col("a").alias("i"), F.col("b").alias("j"), F.col("length").alias("dist"))
    return tree.neighbour_joining(lengths, outgroup=outgroup)


@query("T6 T8 T13 T22", f"with recursive {LEAF_PAIRS} select a, b, round(length, 6) as length from pairs")
def tree_rebuilt_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree.leaf_pairs(rebuilt_tree(spark, sf_dir, "Midpoint"), ["tree_id"]).select("a", "b", "length")


BELOW = f"{UP}, below as (select u.anc as node, list(t.name order by t.name) as leaves from up u join v_tree t on t.node = u.node where t.name is not null and u.hops > 0 group by 1)"


@query("T6 T7 T8 T11 S23 K6", f"""with recursive {BELOW}, everyone as (select list(name order by name) as names from v_tree where name is not null),
 sides as (select distinct case when list_contains(leaves, 's00') then list_filter(names, lambda x: not list_contains(leaves, x)) else leaves end as leaves, len(names) as n from below, everyone)
 select array_to_string(leaves, ',') as leaves from sides where len(leaves) between 2 and n - 2""")
def tree_rebuilt_clades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clades of the rebuilt tree with s00 as the outgroup, by way of Newick text."""
    again = tree.from_newick(tree.to_newick(rebuilt_tree(spark, sf_dir, "s00")))
    found = tree.clades(again, ["tree_id"]).select("leaves")
    most = view(spark, sf_dir, "v_tree").filter("name is not null").agg((F.count(F.lit(1)) - 2).alias("most"))
    return found.join(F.broadcast(most), (F.size("leaves") >= 2) & (F.size("leaves") <= F.col("most"))).select(F.array_join("leaves", ",").alias("leaves"))  # one row


@query("T10 A10 J16 U5 T25 D14", f"""with recursive {BELOW}, n as (select count(*) as n from v_tree where name is not null),
 tips as (select node, name, node - n as place, n from v_tree, n where name is not null),
 moved as (select cast(t as bigint) as tree_id, x.node, y.name from tips x, range(6) r(t) join tips y on y.place = (x.place + t) % y.n),
 seen as (select distinct m.tree_id, list(m.name order by m.name) as leaves from up u join moved m on m.node = u.node where u.hops > 0 group by m.tree_id, u.anc)
 select array_to_string(b.leaves, ',') as leaves, count(s.tree_id) as num_verified, round(count(s.tree_id) / 6, 2) as support, cast(round(100 * round(count(s.tree_id) / 6, 2)) as integer) as label
 from (select distinct leaves from below) b left join seen s on s.leaves = b.leaves group by 1""")
def tree_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Support of the clades of v_tree in six trees whose leaves have moved on by 0 to 5 places."""
    own = view(spark, sf_dir, "v_tree").checkpoint()
    tips = own.filter("name is not null")
    n = F.broadcast(tips.agg(F.count(F.lit(1)).alias("n")))  # one row
    placed = tips.join(n).select("node", "name", (F.col("node") - F.col("n")).alias("place"), "n")
    copies = own.drop("name").join(F.broadcast(spark.range(6).withColumnRenamed("id", "tree_id")))
    moved = placed.select("node", "place", "n").join(F.broadcast(spark.range(6).withColumnRenamed("id", "tree_id"))).withColumn("from", F.pmod(F.col("place") + F.col("tree_id"), F.col("n")))
    named = moved.join(placed.select(F.col("place").alias("from"), "name"), "from").select("tree_id", "node", "name")
    return tree.percent_labels(tree.support(own, copies.join(named, ["tree_id", "node"], "left"), 6)).withColumn("leaves", F.array_join("leaves", ","))


@query("T14 J12", f"with {SIBLINGS} select * from sibs")
def tree_siblings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree.siblings(view(spark, sf_dir, "v_tree"))


CLONES = "clones as (select sample, min(grp) as clone from v_samples group by 1), refd as (select a.clone as clone_1, b.clone as clone_2, case when a.clone = b.clone then 5 else abs(ascii(right(a.clone, 1)) - ascii(right(b.clone, 1))) end as d from (select distinct clone from clones) a, (select distinct clone from clones) b)"
TRIPLETS = f"""{LEAF_PAIRS}, {CLONES},
 three as (select x.sample as a, y.sample as b, z.sample as c, round(p.depth, 9) as t1, round(q.depth, 9) as t2, round(r.depth, 9) as t3, d1.d as r1, d2.d as r2, d3.d as r3 from clones x join clones y on x.sample < y.sample join clones z on y.sample < z.sample
 join pairs p on p.a = x.sample and p.b = y.sample join pairs q on q.a = x.sample and q.b = z.sample join pairs r on r.a = y.sample and r.b = z.sample
 join refd d1 on d1.clone_1 = x.clone and d1.clone_2 = y.clone join refd d2 on d2.clone_1 = x.clone and d2.clone_2 = z.clone join refd d3 on d3.clone_1 = y.clone and d3.clone_2 = z.clone
 where x.clone <> y.clone or y.clone <> z.clone),
 results as (select a, b, c, greatest(r1, r2, r3) as ref_max, cast(list_position([t1, t2, t3], greatest(t1, t2, t3)) = list_position([r1, r2, r3], greatest(r1, r2, r3)) as integer) as correct from three
 where len(list_filter([t1, t2, t3], lambda v: v = greatest(t1, t2, t3))) = 1 and len(list_filter([r1, r2, r3], lambda v: v = greatest(r1, r2, r3))) = 1)"""


def clones(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    own = view(spark, sf_dir, "v_samples").groupBy("sample").agg(F.min("grp").alias("clone"))
    names = own.select("clone").distinct()
    far = F.abs(F.ascii(F.right("clone_1", F.lit(1))) - F.ascii(F.right("clone_2", F.lit(1))))
    both = names.withColumnRenamed("clone", "clone_1").join(names.withColumnRenamed("clone", "clone_2"))
    return own, both.withColumn("d", F.when(F.col("clone_1") == F.col("clone_2"), 5).otherwise(far))


def triplet_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    own, reference = clones(spark, sf_dir)
    pairs = tree.leaf_pairs(view(spark, sf_dir, "v_tree"), [])
    return evaluate.triplet_results(evaluate.triplets(own), pairs, reference)


@query("J8 J9 T12 D20", f"with recursive {TRIPLETS} select * from results")
def triplet_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triplet_rows(spark, sf_dir)


@query("A11 A39", f"""with recursive {TRIPLETS} select case when grouping(ref_max) = 1 then 'All_Distances' else cast(ref_max as varchar) end as mrca_distance, cast(coalesce(sum(correct), 0) as bigint) as correct, count(*) as total,
 round(sum(correct) / count(*), 6) as accuracy from results where ref_max <> 0 group by rollup (ref_max)""")
def triplet_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.triplet_accuracy(triplet_rows(spark, sf_dir))


LABELS = "labels as (select sample, min(grp) as grp from v_samples group by 1)"
PERMUTED = f"""{LABELS}, kinds as (select grp, row_number() over (order by grp) - 1 as g, count(*) over () as groups from (select distinct grp from labels)),
 permuted as (select cast(i as integer) as perm, sample, (select k.grp from kinds k where k.g = cast('0x' || substring(md5(concat_ws('|', '1', i, sample)), 1, 8) as bigint) % k.groups) as grp from labels, range(1, 51) t(i))"""


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "v_samples").groupBy("sample").agg(F.min("grp").alias("grp"))


@query("A12", f"""with {SIBLINGS}, {LABELS} select count(*) as comparisons, count(*) filter (x.grp = y.grp) as pairs, round(100 * count(*) filter (x.grp = y.grp) / count(*), 6) as percentage
 from sibs left join labels x on x.sample = a left join labels y on y.sample = b where x.grp is not null or y.grp is not null""")
def sibling_percentage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.sibling_percentage(tree.siblings(view(spark, sf_dir, "v_tree")), labels(spark, sf_dir))


@query("T16 A14", f"with {PERMUTED} select * from permuted")
def permuted_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.permuted_labels(labels(spark, sf_dir), 50)


@query("A13 T18", f"""with {SIBLINGS}, {PERMUTED}, runs as (select x.perm, 100 * count(*) filter (x.grp = y.grp) / count(*) as percentage from sibs join permuted x on x.sample = a join permuted y on y.sample = b and y.perm = x.perm group by 1),
 observed as (select 100 * count(*) filter (x.grp = y.grp) / count(*) as observed from sibs join labels x on x.sample = a join labels y on y.sample = b)
 select round(observed, 6) as observed, count(*) as permutations, round(avg(percentage), 6) as mean, round(median(percentage), 6) as median, round(max(percentage), 6) as largest, round(avg(case when percentage >= observed then 1 else 0 end), 6) as p_value from runs, observed group by observed""")
def label_permutation_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    sibs, own = tree.siblings(view(spark, sf_dir, "v_tree")), labels(spark, sf_dir)
    runs = evaluate.sibling_percentage(sibs, resample.permuted_labels(own, 50), ["perm"])
    return evaluate.permutation_summary(evaluate.sibling_percentage(sibs, own), runs)


@query("A13 T18", f"""with {SIBLINGS}, {PERMUTED.replace("range(1, 51)", "range(1, 201)")}, runs as (select x.perm, 100 * count(*) filter (x.grp = y.grp) / count(*) as percentage from sibs join permuted x on x.sample = a join permuted y on y.sample = b and y.perm = x.perm group by 1),
 observed as (select 100 * count(*) filter (x.grp = y.grp) / count(*) as observed from sibs join labels x on x.sample = a join labels y on y.sample = b),
 told as (select perm, observed, sum(cast(percentage >= observed as integer)) over (order by perm) as above from runs, observed),
 ended as (select coalesce(min(perm) filter (above = 8), 200) as permutations, bool_or(above = 8) as stopped from told)
 select round(observed, 6) as observed, cast(permutations as integer) as permutations, cast(above as integer) as at_or_above, 0 as failed, stopped, round(case when stopped then 8 / permutations else (above + 1) / (permutations + 1) end, 6) as p_value from told, ended where perm = permutations""")
def sequential_label_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``label_permutation_test``, in batches of 25 until 8 permutations reach the observed value."""
    sibs, own = tree.siblings(view(spark, sf_dir, "v_tree")).checkpoint(), labels(spark, sf_dir).checkpoint()

    def permuted(first: int, last: int) -> DataFrame:
        drawn = resample.permuted_labels(own, last).filter(F.col("perm") > first)
        return evaluate.sibling_percentage(sibs, drawn, ["perm"]).withColumn("perm", F.col("perm") - 1)

    return evaluate.sequential_test(evaluate.sibling_percentage(sibs, own), permuted, 25, 200, 8)


@query("T15 J11", """with ranked as (select sample, target, row_number() over (partition by sample order by md5(concat_ws('|', '1', sample, target)), target) as k, count(*) over (partition by sample) as n from v_calls)
 select c.* from v_calls c join ranked r on r.sample = c.sample and r.target = c.target where n >= 100 and k <= 100""")
def downsampled_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.downsample(view(spark, sf_dir, "v_calls"), 100)


@query("T17", """with places as (select i as perm, sample, target, row_number() over (partition by i, target order by sample) as k, row_number() over (partition by i, target order by md5(concat_ws('|', '1', i, target, sample)), sample) as m, a1, a2 from v_calls, range(1, 4) t(i))
 select cast(s.perm as integer) as perm, s.sample, s.target, g.a1, g.a2 from places s join places g on g.perm = s.perm and g.target = s.target and g.m = s.k""")
def permuted_genotypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.permuted_genotypes(view(spark, sf_dir, "v_calls").select("sample", "target", "a1", "a2"), 3)


SQUARE = f"""{distance_sql("minComp_EqorNot")}, sq as (select s1 as i, s2 as j, dist from dists union all select s2, s1, dist from dists where s1 <> s2)"""
QMATRIX = f"""{SQUARE}, rs as (select i, sum(dist) as r, count(*) over () as n from sq group by i), qm as (select sq.i, sq.j, case when sq.i = sq.j then 0 else dist - a.r / (a.n - 2) - b.r / (b.n - 2) end as q from sq join rs a on a.i = sq.i join rs b on b.i = sq.j)"""


def square(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distance.square(distance.pair_distances(alleles(spark, sf_dir)), "dist")


@query("T19 D12 S39", f"with {QMATRIX} select i, j, round(q, 6) as q from qm")
def adjusted_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbors.adjusted(square(spark, sf_dir))


KNN = f"""{SQUARE}, knn as (select i, j, row_number() over (partition by i order by dist, j) as k from sq where i <> j), near as (select * from knn where k <= 3), {LABELS}"""
COMPOSITION = f"""{KNN}, cells as (select grp as seed, count(*) as cells from labels where sample in (select i from near) group by 1), counts as (select x.grp as seed, y.grp, count(*) as n from near join labels x on x.sample = i join labels y on y.sample = j group by 1, 2),
 comp as (select seed, grp, coalesce(n, 0) / cells as mean_count from cells cross join (select distinct grp from labels) g left join counts c using (seed, grp)), enr as (select *, case when avg(mean_count) over (partition by grp) > 0 then mean_count / avg(mean_count) over (partition by grp) else 0 end as enrichment from comp)"""


def composition_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbors.composition(neighbors.nearest(square(spark, sf_dir), 3), labels(spark, sf_dir))


@query("T20 W4", f"with {KNN} select i, j, cast(k as integer) as k from near")
def nearest_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbors.nearest(square(spark, sf_dir), 3)


@query("A19", f"with {COMPOSITION} select seed, grp, round(mean_count, 6) as mean_count, round(enrichment, 6) as enrichment from enr")
def neighbour_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return composition_rows(spark, sf_dir)


@query("A20", f"with {COMPOSITION} select x.seed as a, y.seed as b, round(coalesce(case when isnan(corr(x.enrichment, y.enrichment)) then 0 else corr(x.enrichment, y.enrichment) end, 0), 6) as r from enr x join enr y on x.grp = y.grp group by 1, 2")
def seed_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbors.seed_correlation(composition_rows(spark, sf_dir))


@query("T21")
def clustered_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbors.clustered(neighbors.seed_correlation(composition_rows(spark, sf_dir)))


LOHI = "lohi as (select sample, target, cast(least(a1, a2) as double) as lo, cast(greatest(a1, a2) as double) as hi from v_calls where depth >= 10)"
COVERED = f"{LOHI}, cov as (select *, count(*) over (partition by target) as seen from lohi), kept as (select sample, target, lo, hi from cov where seen >= 0.8 * 12)"
BASE = f"{COVERED}, base as (select target, round_even(median(v), 0) as baseline from (select target, lo as v from kept union all select target, hi from kept) group by 1), dev as (select k.target, k.sample, lo - baseline as lo, hi - baseline as hi from kept k join base b on b.target = k.target), devs as (select * from dev where target not in (select target from dev where greatest(abs(lo), abs(hi)) > 2))"
VALUES = f"{BASE}, {CLONES}, vals as (select d.target, d.sample, c.clone, case when abs(lo) >= abs(hi) then lo else hi end as value from devs d join clones c on c.sample = d.sample)"


def covered_alleles(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = view(spark, sf_dir, "v_calls").filter("depth >= 10")
    values = calls.select("sample", "target", F.least("a1", "a2").cast("double").alias("lo"), F.greatest("a1", "a2").cast("double").alias("hi"))
    return loci.covered(values, 12)


def plotted(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = covered_alleles(spark, sf_dir)
    own, _ = clones(spark, sf_dir)
    return loci.deviations(values, loci.baselines(values)).join(own, "sample").select("target", "sample", "clone", loci.farther().alias("value"))


@query("P24", f"with {COVERED} select * from kept")
def covered_loci(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covered_alleles(spark, sf_dir)


@query("A23 F9", f"with {BASE} select * from base")
def locus_baselines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loci.baselines(covered_alleles(spark, sf_dir))


@query("T23 P24", f"with {VALUES} select * from vals")
def plotted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plotted(spark, sf_dir)


@query("A21 O3", f"""with {VALUES}, parts as (select target, clone, count(*) as n, sum(value) as s, sum(value * value) as ss from vals group by 1, 2), sums as (select target, count(*) as groups, min(n) as least, sum(n) as n, sum(s) as s, sum(ss) as ss, sum(s * s / n) as b from parts group by 1)
 select target, round(case when ss - b > 1e-9 then (greatest(0, b - s * s / n) / (groups - 1)) / ((ss - b) / (n - groups)) else 0 end, 6) as f, groups, cast(n as bigint) as n from sums where least >= 2 and groups = (select count(distinct clone) from vals) and n > groups""")
def locus_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loci.variance_ratio(plotted(spark, sf_dir)).orderBy(F.col("f").desc(), "target")


@query("A22 W7", f"""with {VALUES}, means as (select target, clone, avg(value) as m from vals group by 1, 2), away as (select target, clone, round(abs(m - (sum(m) over (partition by target) - m) / (count(*) over (partition by target) - 1)), 9) as deviation from means)
 select target, clone, round(deviation, 6) as deviation from (select *, row_number() over (partition by target order by deviation desc, clone) as k from away where deviation > 0) where k = 1""")
def locus_outlier_clone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loci.outlier_clone(plotted(spark, sf_dir))


@query("T24", f"""with {VALUES}, freq as (select target, value, row_number() over (partition by target order by count(*) desc, value) as k from vals group by 1, 2)
 select v.target, v.sample, v.clone, v.value, v.value - f.value as centred from vals v join freq f on f.target = v.target and f.k = 1""")
def centred_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loci.centred(plotted(spark, sf_dir))


@query("J17 D1", "with sheet as (select sample, min(grp) as grp from v_samples group by 1) select t.node, t.name, t.len, coalesce(s.grp, 'unknown') as grp, case s.grp when 'g0' then 'red' when 'g1' then 'blue' else 'grey' end as color from v_tree t left join sheet s on s.sample = t.name where t.name is not null")
def tree_tip_colors(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheet = labels(spark, sf_dir).withColumn("color", F.when(F.col("grp") == "g0", "red").when(F.col("grp") == "g1", "blue"))
    tips = view(spark, sf_dir, "v_tree").filter("name is not null")
    joined = tips.join(sheet, F.col("name") == F.col("sample"), "left")
    return joined.select("node", "name", "len", F.coalesce("grp", F.lit("unknown")).alias("grp"), F.coalesce("color", F.lit("grey")).alias("color"))


@query("A14", "select grp, count(*) as cells from v_samples group by 1")
def group_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "v_samples").groupBy("grp").agg(F.count(F.lit(1)).alias("cells"))


PERM_GROUPS = """places as (select i as perm, sample, target, row_number() over (partition by i, target order by sample) as k, row_number() over (partition by i, target order by md5(concat_ws('|', '1', i, target, sample)), sample) as m, alleles from good, range(1, 4) t(i)),
 dealt as (select s.perm, s.sample, s.target, g.alleles from places s join places g on g.perm = s.perm and g.target = s.target and g.m = s.k),
 repeats as (select distinct target, unnest(alleles) as allele from good), groups as (select target, allele, allele - row_number() over (partition by target order by allele) as grp from repeats),
 members as (select d.perm, d.sample, d.target, r.grp, list_sort(list(distinct r.allele)) as alleles from (select perm, sample, target, unnest(alleles) as allele from dealt) d join groups r on r.target = d.target and r.allele = d.allele group by all),
 met as (select a.perm, a.sample as s1, b.sample as s2, least(len(a.alleles), len(b.alleles)) as n, len(list_intersect(a.alleles, b.alleles)) as same from members a join members b on a.perm = b.perm and a.target = b.target and a.grp = b.grp and a.sample < b.sample)"""


def permuted_distances(spark: SparkSession, sf_dir: str, count: int) -> DataFrame:
    """perm, s1, s2, ... of calls whose genotypes were dealt anew at each target: (perm, target) takes the place of the target."""
    dealt = resample.permuted_genotypes(alleles(spark, sf_dir), count)
    own = dealt.withColumn("target", F.struct("perm", "target"))
    parts = distance.contributions(own, distance.allele_groups(own), "minComp_EqorNot").withColumn("perm", F.col("target.perm"))
    return distance.summed(parts, distance.pairs_of_targets(own).withColumn("perm", F.col("target.perm")), ["perm"])


@query("T17 T18", f"with {GOOD}, {PERM_GROUPS}, sums as (select perm, s1, s2, cast(sum(n) as bigint) as num_alleles, cast(sum(n - same) as bigint) as num_diff from met group by all) select cast(perm as integer) as perm, s1, s2, num_alleles, num_diff from sums")
def permuted_genotype_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permuted_distances(spark, sf_dir, 3).filter("s1 <> s2 and num_alleles > 0").select("perm", "s1", "s2", "num_alleles", "num_diff")


@query("T18 A13")
def genotype_permutation_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shuffled genotypes to trees to sibling percentages; permutations are tree ids."""
    pairs = permuted_distances(spark, sf_dir, 10).select(F.col("perm").alias("tree_id"), F.col("s1").alias("i"), F.col("s2").alias("j"), "dist")
    sibs = tree.siblings(tree.neighbour_joining(pairs, outgroup="Midpoint"), ["tree_id"])
    own = labels(spark, sf_dir)
    return evaluate.permutation_summary(evaluate.sibling_percentage(tree.siblings(original_tree(spark, sf_dir)), own), evaluate.sibling_percentage(sibs, own, ["tree_id"]))
