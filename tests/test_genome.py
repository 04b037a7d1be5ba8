"""Tiled sequences against plain searches of whole ones."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from cladespark.functions import sequence
from cladespark.operators import genome, probes
from cladespark.sources import text

ENZYMES = {"plain": "A|CG", "self": "AA|A", "period": "AC|AC", "end": "GG|"}


def chromosomes(seed=1):
    rng = random.Random(seed)
    parts = ["A" * 300, "ACAC" * 40, "ACG", "GGGGG", "TTTTTTTTTTTT", "N" * 70, "acgt", "AAAC", "CACA"]
    return {
        "mixed": "".join(rng.choice(parts) for _ in range(120)),
        "one": "A" * 1000,
        "period": "AC" * 700 + "A" * 201 + "AC" * 500,
        "short": "ACG",
        "edge": "T" * 64 + "A" * 64 + "ACG" * 64,
        "random": "".join(rng.choice("ACGT") for _ in range(5000)),
    }


def cuts_by_brute_force(seq, site):
    plain = site.replace("|", "")
    return [m.start() + site.index("|") for m in re.finditer(plain, seq.upper())]


def tiled(spark, size):
    return genome.tiles(spark.createDataFrame(list(chromosomes().items()) + [("none", ""), ("null", None)], "chrom string, seq string"), size)


@pytest.mark.parametrize("size", [64, 100, 1 << 16])
def test_cuts_across_tiles(spark, size):
    tiles = tiled(spark, size).cache()
    assert max(r[0] for r in tiles.select(F.char_length("seq")).collect()) <= size + genome.OVERLAP
    for site in ENZYMES.values():
        got = sorted((r.chrom, r.pos) for r in genome.cuts(tiles, site).collect())
        assert got == sorted((c, p) for c, s in chromosomes().items() for p in cuts_by_brute_force(s, site)), site


@pytest.mark.parametrize("size", [64, 1000])
def test_runs_across_tiles(spark, size):
    got = sorted(tuple(r) for r in genome.runs(tiled(spark, size), 11).collect())
    want = sorted((c, m.start() + 1, m.end(), m.end() - m.start() - 1, m[0][0]) for c, s in chromosomes().items() for m in re.finditer("A{11,}|C{11,}|G{11,}|T{11,}", s.upper()))
    assert got == want


def test_whole_sequences_give_the_same(spark):
    rows = spark.createDataFrame(list(chromosomes().items()), "chrom string, seq string")
    for site in ENZYMES.values():
        got = sorted((r[0], r[1]) for r in rows.select("chrom", F.explode(sequence.cut_sites(F.col("seq"), site))).collect())
        assert got == sorted((c, p) for c, s in chromosomes().items() for p in cuts_by_brute_force(s, site))
    with pytest.raises(ValueError):
        sequence.cut_sites(F.col("seq"), "A.G|")


def test_fasta_files_become_tiles(spark, tmp_path):
    rng = random.Random(2)
    for number, names in enumerate((["mixed", "one"], ["period", "short", "edge", "random"])):
        with (tmp_path / f"{number}.fa").open("w") as out:
            for name in names:
                out.write(f">{name} some words\n")
                seq, at = chromosomes()[name], 0
                while at < len(seq):
                    n = rng.choice([1, 60, 61, 333])
                    out.write(seq[at : at + n] + rng.choice(["\n", "\r\n", "\n\n"]))
                    at += n
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        got = sorted(tuple(r) for r in text.fasta_tiles(spark, str(tmp_path), 128).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == sorted(tuple(r) for r in genome.tiles(spark.createDataFrame(list(chromosomes().items()), "chrom string, seq string"), 128).collect())


@pytest.mark.parametrize("span", [50, 700, 1 << 22])
def test_fragments_by_spans(spark, span):
    rng = random.Random(3)
    rows = []
    for chrom in "ab":
        at = 0
        for i in range(150):
            at += rng.randrange(1, 40)
            rows.append((chrom, at, rng.choice(["RE_x", "RE_y", "RE_x|RE_y", f"MS_t{i}", f"MS_t{i - 1}", f"RE_x|MS_t{i}"])))
    want = []
    for chrom in "ab":
        own = sorted((p, i) for c, p, i in rows if c == chrom)[:-1]
        left, before, inside = 0, "Start", []
        for pos, item in own:
            if "RE" not in item:
                inside.append((pos, item))
                continue
            one = len(inside) == 2 and len({i for _, i in inside}) == 1
            want.append((chrom, left, pos, before, item.replace("RE_", ""), inside[0][1][3:] if one else None, inside[0][0] if one else None, inside[1][0] if one else None))
            left, before, inside = pos, item.replace("RE_", ""), []
    got = [tuple(r) for r in probes.fragments(spark.createDataFrame(rows, "chrom string, pos int, item string"), span).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_time_follows_length(spark):
    rng = random.Random(4)
    base = "".join(rng.choice("ACGT") for _ in range(1_000_000))

    def took(times):
        rows = spark.createDataFrame([("c", base * times)], "chrom string, seq string")
        began = time.perf_counter()
        tiles = genome.tiles(rows)
        n = genome.cuts(tiles, "A|CG").count(), genome.cuts(tiles, "AA|A").count(), genome.runs(tiles).count()
        assert n[0] > 15_000 * times
        return time.perf_counter() - began

    took(1)
    assert took(4) < 30  # about 5 s here
