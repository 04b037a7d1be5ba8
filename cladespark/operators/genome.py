"""Sequences of chromosome size as tiles: rows of ``size`` bases that overlap the next by ``OVERLAP``, so that no task holds a chromosome.

A tiled genome has chrom, tile, start, own (bases that are the tile's own), seq (these and the overlap, in capitals). What is found in a tile
is found once: it begins among the tile's own bases. Where a find depends on what came before (matches that
must not overlap, runs longer than a tile), each tile tells in a few numbers what it hands on, and only those numbers are
looked at in the order of tiles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequence import cut_sites, found_between, plain_site

SIZE, OVERLAP = 1 << 16, 64


def tiles(genome: DataFrame, size: int = SIZE) -> DataFrame:
    """Tiles of whole sequences (chrom, seq)."""
    return tiled(genome.select("chrom", F.lit(0).cast("long").alias("at"), F.upper("seq").alias("seq")), size)


def tiled(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """Tiles of pieces of sequences: chrom, at (how many bases come before), seq. Pieces may be lines or whole chromosomes."""
    if size < OVERLAP:
        raise ValueError(f"tiles have {OVERLAP} bases at least")
    length = F.octet_length("seq").cast("long")
    known = pieces.filter(length > 0).withColumns({"bytes": F.col("seq").cast("binary"), "end": F.col("at") + length})
    first, last = F.floor(F.greatest(F.col("at") - OVERLAP, F.lit(0)) / size), F.floor((F.col("end") - 1) / size)
    spread = known.select("chrom", "at", "end", "bytes", F.explode(F.sequence(first, last)).alias("tile"))
    low = F.greatest(F.col("at"), F.col("tile") * size)
    high = F.least(F.col("end"), (F.col("tile") + 1) * size + OVERLAP)
    cut = F.substring(F.col("bytes"), (low - F.col("at") + 1).cast("int"), (high - low).cast("int")).cast("string")  # of bytes: letters would be counted from the start
    parts = spread.select("chrom", "tile", low.alias("low"), cut.alias("cut")).filter(F.octet_length("cut") > 0)
    whole = parts.groupBy("chrom", "tile").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("low", "cut"))), lambda p: p["cut"]), "").alias("seq"))  # the pieces of one tile
    return whole.select("chrom", "tile", (F.col("tile") * size).alias("start"), F.least(F.octet_length("seq"), F.lit(size)).alias("own"), "seq").filter(F.octet_length("seq") > 0)


def overlaps_itself(plain: str) -> bool:
    return any(plain.startswith(plain[k:]) for k in range(1, len(plain)))


def cuts(tiled_genome: DataFrame, site: str) -> DataFrame:
    """chrom, pos: the cuts of a restriction site, from matches that don't overlap, as if the chromosome were searched from its start.

    A match that reaches into the next tile blocks so many of its first bases. For a site that can overlap
    itself, each tile tells for every number of blocked bases how many it blocks in turn; from tile to tile that gives the numbers.
    """
    plain = plain_site(site)
    if len(plain) > OVERLAP:
        raise ValueError(f"a site has {OVERLAP} bases at most")
    text = F.substring("seq", F.lit(1), F.col("own") + len(plain) - 1)
    from_base = lambda blocked: F.transform(cut_sites(F.substring(text, blocked + 1, F.octet_length("seq")), site), lambda p: p + blocked)
    searched = tiled_genome.withColumn("blocked", F.lit(0))
    if overlaps_itself(plain):
        end_of = lambda found: F.greatest(F.coalesce(F.element_at(found, -1) + (len(plain) - site.index("|")) - F.col("own"), F.lit(0)), F.lit(0))
        hands_on = F.array(*(end_of(F.when(F.size(from_base(F.lit(b))) > 0, from_base(F.lit(b)))) for b in range(len(plain))))
        handed = tiled_genome.select("chrom", "tile", hands_on.alias("on"))
        in_order = handed.groupBy("chrom").agg(F.array_sort(F.collect_list(F.struct("tile", "on"))).alias("tiles"))  # a few numbers for each tile
        start = F.struct(F.lit(0).alias("now"), F.array().cast("array<int>").alias("seen"))
        step = lambda a, t: F.struct(F.get(t["on"], a["now"]).alias("now"), F.concat(a["seen"], F.array(a["now"])).alias("seen"))
        states = in_order.select("chrom", F.explode(F.arrays_zip(F.transform("tiles", lambda t: t["tile"]).alias("tile"), F.aggregate("tiles", start, step, lambda a: a["seen"]).alias("blocked"))).alias("s")).select("chrom", "s.tile", "s.blocked")
        searched = tiled_genome.join(states, ["chrom", "tile"])
    return searched.select("chrom", "start", F.explode(from_base(F.col("blocked"))).alias("p")).select("chrom", (F.col("start") + F.col("p")).alias("pos"))


def runs(tiled_genome: DataFrame, least: int = 11) -> DataFrame:
    """chrom, start, end, count, letter: as ``sequence.runs``, for runs of any length.

    Runs inside a tile are found there; the runs at its two edges are put together with those of its neighbours.
    """
    own = tiled_genome.select("chrom", "start", "own", F.substring("seq", F.lit(1), F.col("own")).alias("seq"))
    found, ends = found_between(F.col("seq"), "|".join(f"{b}{{{least},}}" for b in "ACGT"))
    inside = own.select("chrom", "start", "own", F.explode(F.zip_with(found, ends, lambda r, e: F.struct(F.char_length(r).alias("n"), e.alias("e"), F.left(r, F.lit(1)).alias("letter")))).alias("r"))
    inside = inside.filter("r.e < own and r.e > r.n").select("chrom", (F.col("start") + F.col("r.e") - F.col("r.n")).alias("first"), (F.col("start") + F.col("r.e")).alias("end"), "r.letter")
    edge = r"^(?:A+|C+|G+|T+)"
    head, tail = F.char_length(F.regexp_extract("seq", edge, 0)), F.char_length(F.regexp_extract(F.reverse("seq"), edge, 0))
    piece = lambda low, high: F.struct((F.col("start") + low).alias("first"), (F.col("start") + high).alias("end"), F.substring("seq", low.cast("int") + 1, F.lit(1)).alias("letter"))
    both = F.array(F.when(head > 0, piece(F.lit(0), head)), F.when((tail > 0) & (tail < F.col("own")), piece(F.col("own") - tail, F.col("own"))))
    edges = own.select("chrom", F.explode(F.array_compact(both)).alias("e")).select("chrom", "e.*")
    order = Window.partitionBy("chrom").orderBy("first")  # two rows for each tile
    goes_on = (F.lag("end").over(order) == F.col("first")) & (F.lag("letter").over(order) == F.col("letter"))
    numbered = edges.withColumn("new", F.when(goes_on, 0).otherwise(1)).withColumn("run", F.sum("new").over(order))
    joined = numbered.groupBy("chrom", "run").agg(F.min("first").alias("first"), F.max("end").alias("end"), F.min("letter").alias("letter")).filter(F.col("end") - F.col("first") >= least).drop("run")
    return inside.unionByName(joined).select("chrom", (F.col("first") + 1).alias("start"), "end", (F.col("end") - F.col("first") - 1).alias("count"), "letter")
