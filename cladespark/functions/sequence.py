"""Scalar functions on DNA sequences and the texts around them, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def reverse_complement(seq: Column) -> Column:
    """Other letters than A, C, G and T stay."""
    return F.reverse(F.translate(seq, "ATCG", "TAGC"))


def count_of(seq: Column, letter: str) -> Column:
    return F.char_length(seq) - F.char_length(F.replace(seq, F.lit(letter), F.lit("")))


def strip_affixes(name: Column, prefix: str, suffix: str) -> Column:
    without = F.when(name.startswith(prefix), F.substring(name, F.lit(len(prefix) + 1), F.char_length(name))).otherwise(name)
    return F.when(without.endswith(suffix), F.substring(without, F.lit(1), F.char_length(without) - len(suffix))).otherwise(without)


def without_chr(chrom: Column) -> Column:
    return F.regexp_replace(chrom, "^chr", "")


def target_id(chrom: Column, start: Column, end: Column, copies: Column, motif: Column) -> Column:
    """``chrom:start-end_copiesxmotif``"""
    return F.concat(chrom, F.lit(":"), start.cast("string"), F.lit("-"), end.cast("string"), F.lit("_"), copies.cast("string"), F.lit("x"), motif)


def parse_target_id(name: Column) -> Column:
    """chrom, start, end, num_copies, motif of a target name; null parts where it isn't one."""
    pattern = r"^(.+?)[:_](\d+)[-_](\d+)_(\d+)x([A-Z]+)$"
    part = lambda i: F.nullif(F.regexp_extract(name, pattern, i), F.lit(""))
    return F.struct(part(1).alias("chrom"), part(2).try_cast("int").alias("start"), part(3).try_cast("int").alias("end"), part(4).try_cast("int").alias("num_copies"), part(5).alias("motif"))


def running_sums(lengths: Column) -> Column:
    """The sums of an array of whole numbers up to each place, one step for each."""
    start = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("sums"))
    step = lambda a, x: F.struct((a["sum"] + x).alias("sum"), F.concat(a["sums"], F.array(a["sum"] + x)).alias("sums"))
    return F.aggregate(lengths, start, step, lambda a: a["sums"])


def found_between(seq: Column, pattern: str) -> tuple[Column, Column]:
    """The matches of a pattern without groups, and where each ends."""
    found = F.regexp_extract_all(seq, F.lit(f"({pattern})"), F.lit(1))
    before = F.split(seq, pattern, -1)
    steps = F.zip_with(F.slice(before, F.lit(1), F.size(found)), found, lambda b, f: F.char_length(b) + F.char_length(f))
    return found, running_sums(steps)


def runs(seq: Column, least: int = 11) -> Column:
    """start, end, count, letter of runs of one base of ``least`` bases and more.

    As in the tool that these lists come from, the count is one less than the run is long and the start
    is one past the run's first base. A run at the end of a sequence counts as well.
    """
    found, ends = found_between(F.upper(seq), "|".join(f"{b}{{{least},}}" for b in "ACGT"))
    return F.zip_with(found, ends, lambda r, e: F.struct((e - F.char_length(r) + 1).alias("start"), e.alias("end"), (F.char_length(r) - 1).alias("count"), F.left(r, F.lit(1)).alias("letter")))


def plain_site(site: str) -> str:
    """A restriction site without its bar, in capitals."""
    plain = site.replace("|", "").upper()
    if site.count("|") != 1 or not plain.isalpha():
        raise ValueError(f"{site!r} is no restriction site: letters and one bar are")
    return plain


def cut_sites(seq: Column, site: str) -> Column:
    """Positions of cuts of a restriction site, given with a bar where it cuts; matches don't overlap."""
    plain = plain_site(site)
    pieces = F.split(F.upper(seq), plain, -1)
    ends = running_sums(F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), lambda p: F.char_length(p) + len(plain)))
    return F.transform(ends, lambda e: e - (len(plain) - site.index("|")))


# The adapters of the probe order.
LEFT_ADAPTER = "TGTAAGGCACATCTCGGATC"
RIGHT_ADAPTER = "ATCCGACGAGAATCTTGCTTCCCTATAGTGAGTCGTATTA"


def with_adapters(probe: Column, left: str = LEFT_ADAPTER, right: str = RIGHT_ADAPTER) -> Column:
    return F.concat(F.lit(left), probe, F.lit(right))


def mapped(value: Column, names: dict[str, str]) -> Column:
    """The name for each value; others stay."""
    pairs = [F.lit(x) for pair in names.items() for x in pair]
    return F.coalesce(F.create_map(*pairs)[value], value) if names else value


def tissue_name(name: Column) -> Column:
    """The part before ``_Plate``, its underscores, hyphens and joined capitals made blanks."""
    part = F.regexp_extract(name, r"^(.+?)_Plate", 1)
    spaced = F.regexp_replace(F.regexp_replace(part, "[_-]", " "), r"(?<=[a-z])(?=[A-Z])", " ")
    return F.nullif(F.trim(F.regexp_replace(spaced, " +", " ")), F.lit(""))
