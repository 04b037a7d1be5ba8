"""Restriction fragments, probes per target, and the choice of probes within a budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequence import cut_sites, with_adapters
from .genome import cuts
from .resample import draw

LONGEST_FRAGMENT = 2000


def good_flanks(seq: Column, copies: Column, motif: Column, least: int = 5) -> Column:
    """Whether the repeat is in the sequence with that many bases on both sides."""
    run = F.repeat(motif, copies)
    start = F.instr(seq, run) - 1
    return (start >= least) & (start + F.char_length(run) <= F.char_length(seq) - least)


def bad_targets(seqs: DataFrame) -> DataFrame:
    """target: sequences (chrom, seq) named ..._NxMOTIF without that repeat, or with fewer than five bases to a side of it. Names without one are left out."""
    last = F.element_at(F.split("chrom", "_"), -1)
    named = seqs.withColumns({"copies": F.regexp_extract(last, r"^(\d+)x[A-Z]+$", 1).try_cast("int"), "motif": F.regexp_extract(last, r"^\d+x([A-Z]+)$", 1)}).filter("copies is not null")
    return named.filter(~good_flanks(F.upper("seq"), F.col("copies"), F.col("motif"))).select(F.col("chrom").alias("target"))


def on_genome(sites: DataFrame, genome: DataFrame) -> DataFrame:
    """Repeats (chrom, start, copies, motif) whose sequence is what the genome has there."""
    run = F.repeat(F.col("motif"), F.col("copies"))
    there = F.substring(F.col("seq"), F.col("start") + 1, F.char_length(run))
    return sites.join(genome, "chrom").filter(there == run).select(*sites.columns)


def positions(genome: DataFrame, enzymes: dict[str, str], sites: DataFrame) -> DataFrame:
    """chrom, pos, item: cuts and ends of repeats in order; what falls on one position is one item, enzymes first."""
    return merged_positions({name: genome.select("chrom", F.explode(cut_sites(F.col("seq"), site)).alias("pos")) for name, site in enzymes.items()}, sites)


def tile_positions(tiled_genome: DataFrame, enzymes: dict[str, str], sites: DataFrame) -> DataFrame:
    """As ``positions``, of a tiled genome."""
    return merged_positions({name: cuts(tiled_genome, site) for name, site in enzymes.items()}, sites)


def merged_positions(cuts_of: dict[str, DataFrame], sites: DataFrame) -> DataFrame:
    """chrom, pos, item of the cuts (chrom, pos) of each enzyme and the ends of repeats."""
    every = sites.select("chrom", F.explode(F.array("start", "end")).alias("pos"), F.lit(len(cuts_of)).alias("o"), F.concat(F.lit("MS_"), F.col("target")).alias("item"))
    kind = next((c.schema["pos"].dataType for c in cuts_of.values()), every.schema["pos"].dataType)
    every = every.withColumn("pos", F.col("pos").cast(kind))
    for order, (name, own) in enumerate(cuts_of.items()):
        every = every.unionByName(own.select("chrom", "pos", F.lit(order).alias("o"), F.lit(f"RE_{name}").alias("item")))
    items = F.transform(F.array_sort(F.collect_set(F.struct("o", "item"))), lambda x: x["item"])  # of one position
    return every.groupBy("chrom", "pos").agg(F.array_join(items, "|").alias("item"))


def fragments(marks: DataFrame, span: int = 1 << 22) -> DataFrame:
    """chrom, start, end, re_left, re_right, target: pieces between cuts, with the repeat that lies inside alone, else null.

    The first piece of a chromosome starts at 0 with ``Start``. The last position of each is not looked at.
    Positions are put in order within spans of a chromosome; a span is told by the few figures of those before it how many cuts
    there were and where the last one is.
    """
    is_cut = F.contains("item", F.lit("RE"))
    in_span = marks.withColumns({"span": F.floor(F.col("pos") / span), "cut": is_cut, "cut_pos": F.when(is_cut, F.col("pos")), "cut_item": F.when(is_cut, F.col("item"))})
    figures = in_span.groupBy("chrom", "span").agg(F.count("cut_pos").alias("n"), F.max("cut_pos").alias("last_cut"), F.max_by("item", "cut_pos").alias("last_item"), F.max("pos").alias("last"))
    order = Window.partitionBy("chrom").orderBy("span")  # a row for each span
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    told = figures.select("chrom", "span", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("pieces"), F.last("last_cut", True).over(earlier).alias("cut_before"), F.last("last_item", True).over(earlier).alias("item_before"), F.max("last").over(Window.partitionBy("chrom")).alias("end_of_all"))
    row = Window.partitionBy("chrom", "span").orderBy("pos")
    upto = row.rowsBetween(Window.unboundedPreceding, -1)
    within = in_span.withColumns({"own": F.coalesce(F.sum(F.col("cut").cast("int")).over(upto), F.lit(0)), "left_cut": F.last("cut_pos", True).over(upto), "left_item": F.last("cut_item", True).over(upto)})
    seen = within.join(told, ["chrom", "span"]).filter("pos < end_of_all").withColumn("piece", F.col("pieces") + F.col("own"))
    inside = seen.filter(~F.col("cut")).groupBy("chrom", "piece").agg(F.count(F.lit(1)).alias("ends"), F.count_distinct("item").alias("names"), F.min("pos").alias("ms_start"), F.max("pos").alias("ms_end"), F.min("item").alias("name"))
    borders = seen.filter("cut").select("chrom", "piece", "pos", "item", F.coalesce("left_cut", "cut_before", F.lit(0)).alias("start"), F.coalesce("left_item", "item_before", F.lit("RE_Start")).alias("re_left"))
    out = borders.join(inside, ["chrom", "piece"], "left")
    one = (F.col("ends") == 2) & (F.col("names") == 1)
    plain = lambda c: F.replace(c, F.lit("RE_"), F.lit(""))
    return out.select("chrom", "start", F.col("pos").alias("end"), plain("re_left").alias("re_left"), plain("item").alias("re_right"), F.when(one, F.substring("name", F.lit(4), F.char_length("name"))).alias("target"), F.when(one, F.col("ms_start")).alias("ms_start"), F.when(one, F.col("ms_end")).alias("ms_end"))


def size_classes(pieces: DataFrame, read_length: int) -> DataFrame:
    """class, size, n: fragment sizes by kind (ref or MS) and by the enzyme on both sides, or ``diff``."""
    size = F.col("end") - F.col("start")
    short = pieces.withColumn("size", size).filter(F.col("size") < LONGEST_FRAGMENT)
    side = F.when(F.col("re_left") == F.col("re_right"), F.col("re_left")).otherwise("diff")
    readable = F.col("target").isNotNull() & (F.col("ms_end") - F.col("start") <= read_length) & (F.col("end") - F.col("ms_start") <= read_length)
    kinds = F.when(readable, F.array(F.lit("ref_"), F.lit("MS_"))).otherwise(F.array(F.lit("ref_")))
    return short.select(F.explode(kinds).alias("kind"), side.alias("side"), "size").groupBy(F.concat("kind", "side").alias("class"), "size").agg(F.count(F.lit(1)).alias("n"))


def best_ranges(sizes: DataFrame, width: int = 200) -> DataFrame:
    """class, low, n: the range [low, low + width) that holds most fragments of each class; the lowest of several."""
    bounds = sizes.agg(F.min("size").alias("least"), F.max("size").alias("most"))
    starts = bounds.filter(F.col("least") < F.col("most") - width).select(F.explode(F.sequence(F.col("least"), F.col("most") - width - 1)).alias("low"))
    sums = sizes.join(starts, (F.col("size") >= F.col("low")) & (F.col("size") < F.col("low") + width)).groupBy("class", "low").agg(F.sum("n").alias("n"))  # at most as many starts as sizes
    order = Window.partitionBy("class").orderBy(F.col("n").desc(), "low")
    return sums.withColumn("k", F.row_number().over(order)).filter("k = 1").select("class", "low", "n")


def enrichment(sizes: DataFrame, enzyme: str) -> DataFrame:
    """One row: ms, ref, enrichment = ms / (ms + ref) of fragments with the enzyme on both sides."""
    total = lambda kind: F.coalesce(F.sum(F.when(F.col("class") == kind + enzyme, F.col("n"))), F.lit(0))
    return sizes.agg(total("MS_").alias("ms"), total("ref_").alias("ref")).withColumn("enrichment", F.try_divide("ms", F.col("ms") + F.col("ref")))


def probe_table(probes: DataFrame, bad: DataFrame) -> DataFrame:
    """target, probe_list, n_probes: the good probes of each target that isn't bad, with adapters, in order."""
    good = probes.filter("code = 'good'").join(bad.select("target"), "target", "left_anti")
    listed = F.transform(F.array_sort(F.collect_list(F.struct("probe_no", with_adapters(F.col("seq")).alias("probe")))), lambda x: x["probe"])  # a target's probes
    return good.groupBy("target").agg(listed.alias("probe_list"), F.count(F.lit(1)).alias("n_probes"))


def within_budget(targets: DataFrame, budget: int, seed: int = 1) -> DataFrame:
    """Targets (with n_probes) in random order until the budget is reached; the last may exceed it.

    Targets are first summed by their draw's leading digits, so only sums meet in one place.
    """
    drawn = targets.withColumn("_draw", draw(seed, "target")).withColumn("_part", F.substring("_draw", 1, 4))
    parts = drawn.groupBy("_part").agg(F.sum("n_probes").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # 65,536 sums at most
    own = F.coalesce(F.sum("n_probes").over(Window.partitionBy("_part").orderBy("_draw", "target").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return drawn.join(parts.select("_part", before.alias("_before")), "_part").filter(F.col("_before") < budget).withColumn("_own", own).filter(F.col("_before") + F.col("_own") < budget).drop("_draw", "_part", "_before", "_own")


def probe_counts(targets: DataFrame) -> DataFrame:
    """One row: targets, probes, probes per target."""
    return targets.agg(F.count_distinct("target").alias("targets"), F.coalesce(F.sum("n_probes"), F.lit(0)).alias("probes")).withColumn("tile_ratio", F.try_divide("probes", "targets"))


def aligned_well(rows: DataFrame, least_length: int = 120, least_quality: int = 1) -> DataFrame:
    """Rows with a long enough sequence and good enough mapping, ``:`` in names made ``_``."""
    return rows.filter((F.char_length("seq") >= least_length) & (F.col("mapq") >= least_quality)).withColumn("target", F.replace("target", F.lit(":"), F.lit("_")))
