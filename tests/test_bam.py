"""BAM files: blocks, ranges with and without an index, regions, odd records."""

import io
import os
import random
import struct

import numpy as np
import pyarrow as pa
import pytest

from cladespark.sources import bam, bgzf
from cladespark.sources.bgzf import BlockFile

REFERENCES = {"chr1": 400_000, "chr2": 90_000}


def some_reads(count, seed=1, longest=300):
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        chrom = rng.choice(["chr1", "chr1", "chr2"])
        start = rng.randrange(REFERENCES[chrom] - longest)
        rows.append((chrom, start, start + rng.randrange(1, longest), f"read:{i}", rng.choice([0, 16]), rng.choice([0, 60]), rng.choice([None, "s1", "s02"])))
    return rows


def written(spark, rows, path, **more):
    df = spark.createDataFrame(rows, "chrom string, ref_start int, ref_end int, name string, flag int, mapq int, read_group string")
    bam.write_reads(df.repartition(3), str(path), REFERENCES, **more)
    return sorted(f for f in os.listdir(path) if f.endswith(".bam"))


def as_rows(df):
    return sorted(((r.chrom, r.ref_start, r.ref_end, r.name, r.flag, r.mapq, r.read_group) for r in df.collect()), key=str)


@pytest.mark.parametrize("index", [True, False])
def test_ranges_give_each_read_once(spark, tmp_path, index):
    rows = some_reads(30_000)
    files = written(spark, rows, tmp_path / "reads")
    if not index:
        for f in files:
            os.remove(tmp_path / "reads" / f"{f}.bai")
    size = max(os.path.getsize(tmp_path / "reads" / f) for f in files)
    for split in (1 << 26, 40_000, 7_001):
        got = bam.reads(spark, str(tmp_path / "reads"), split=split)
        assert got.rdd.getNumPartitions() >= size // split
        assert as_rows(got) == sorted(rows, key=str)
    one = bam.reads(spark, str(tmp_path / "reads" / files[0]))
    assert {r.sample for r in one.select("sample").distinct().collect()} == {"s1", "s02", files[0].split(".")[0]}
    pattern = bam.reads(spark, "file://" + str(tmp_path / "reads" / "part-*.bam"))
    assert pattern.count() == len(rows)


def test_no_range_reads_the_whole_file(spark, tmp_path, monkeypatch):
    files = written(spark, some_reads(60_000), tmp_path / "reads")
    path = str(tmp_path / "reads" / files[0])
    asked = []
    whole = BlockFile.blocks

    def noted(self, start, end=None):
        for place, after, data in whole(self, start, end):
            asked.append(place)
            yield place, after, data

    monkeypatch.setattr(BlockFile, "blocks", noted)
    reader = bam.BamReader({"path": path, "split": "100000"})
    total, blocks = 0, len(set(p for p, _, _ in whole(BlockFile(path), 0)))
    ranges = reader.partitions()
    assert len(ranges) > 2
    for part in ranges:
        asked.clear()
        total += sum(b.num_rows for b in reader.read(part))
        assert len(set(asked)) < blocks * 0.8
    assert total == sum(b.num_rows for b in bam.BamReader({"path": path}).read(bam.Range(path, 0, os.path.getsize(path))))


def test_regions_read_what_overlaps(spark, tmp_path, monkeypatch):
    rows = some_reads(20_000, 2) + [("chr1", 1000, 60_000, "long", 0, 60, "s1"), ("chr1", 16_380, 16_390, "over", 0, 60, "s1")]
    written(spark, rows, tmp_path / "reads")
    for regions in ([("chr1", 0, 10)], [("chr1", 16_384, 16_385)], [("chr2", 5000, 5600), ("chr1", 100_000, 140_000), ("chr1", 139_000, 150_000), ("none", 1, 2)], [("chr1", 399_999, 500_000)], [("chr2", 89_000, 90_000), ("chr2", 10, 20)]):
        want = sorted((r for r in rows if any(r[0] == c and r[1] < b and r[2] > a for c, a, b in regions)), key=str)
        for split in (1 << 26, 20_000):
            assert as_rows(bam.reads(spark, str(tmp_path / "reads"), regions=regions, split=split)) == want
    monkeypatch.setattr(bam, "linear_index", lambda path: None)
    reader = bam.BamReader({"path": str(tmp_path / "reads"), "regions": '[["chr1", 16384, 16385]]'})
    names = sorted(n for p in reader.partitions() for b in reader.read(p) for n in b.column(2).to_pylist())
    assert names == sorted(r[3] for r in rows if r[0] == "chr1" and r[1] < 16_385 and r[2] > 16_384)


def test_records_across_blocks_and_odd_ones(tmp_path):
    """Records longer than a block, without a place, with bases, tags and operations; blocks cut anywhere."""
    rng = random.Random(3)
    lines = b"@HD\tVN:1.6\n"
    text = b"BAM\x01" + struct.pack("<i", len(lines)) + lines + struct.pack("<i", 2)
    for name, length in REFERENCES.items():
        text += struct.pack("<i", len(name) + 1) + name.encode() + b"\0" + struct.pack("<i", length)
    want = []
    for i in range(3000):
        name, bases = f"r{i}/{'x' * rng.randrange(40)}", 200_000 if i == 700 else rng.choice([0, 35, 150])
        steps, ref, pos = rng.choice([[], [(50, 0)], [(5, 4), (20, 0), (7, 1), (9, 2), (1000, 3), (3, 7), (2, 8), (6, 5)]]), rng.choice([-1, 0, 1]), rng.randrange(80_000)
        tags = rng.choice([b"", b"NMi" + struct.pack("<i", 3) + b"RGZcell9\0", b"XBBS" + struct.pack("<iHH", 2, 1, 2) + b"XAAqMDZ12A\0"])
        body = struct.pack("<iiBBHHHiiii", ref, pos if ref >= 0 else -1, len(name) + 1, i % 61, 0, len(steps), 4 if ref < 0 else 0, bases, -1, -1, 0) + name.encode() + b"\0"
        body += b"".join(struct.pack("<I", n << 4 | o) for n, o in steps) + rng.randbytes((bases + 1) // 2) + rng.randbytes(bases) + tags
        text += struct.pack("<i", len(body)) + body
        covered = sum(n for n, o in steps if o in (0, 2, 3, 7, 8))
        want.append((name, list(REFERENCES)[ref] if ref >= 0 else None, pos if ref >= 0 else None, pos + covered if ref >= 0 and covered else None, i % 61, "cell9" if b"RG" in tags else None))
    path, at = tmp_path / "cell7.sorted.bam", 0
    with path.open("wb") as out:
        while at < len(text):
            n = rng.choice([1, 100, 5000, bgzf.PAYLOAD])
            out.write(bgzf.block(text[at : at + n]))
            at += n
            if rng.random() < 0.05:
                out.write(bgzf.block(b""))
        out.write(bgzf.END_OF_FILE)
    for split in (bgzf.PAYLOAD * 1000, 30_000, 3_000):
        reader = bam.BamReader({"path": str(path), "split": str(split)})
        got = []
        for part in reader.partitions():
            for b in reader.read(part):
                c = [x.to_pylist() for x in b.columns]
                got += zip(c[2], c[4], c[5], c[6], c[7], c[8])
                assert set(c[1]) <= {"cell7", "cell9"}
        assert got == want


def test_broken_files_raise(spark, tmp_path):
    rows = some_reads(3000)
    files = written(spark, rows, tmp_path / "reads")
    whole = (tmp_path / "reads" / files[0]).read_bytes()
    (tmp_path / "cut.bam").write_bytes(whole[: len(whole) // 2])
    (tmp_path / "text.bam").write_bytes(bgzf.block(b"no such thing here") + bgzf.END_OF_FILE)
    for name in ("cut", "text"):
        path = str(tmp_path / f"{name}.bam")
        with pytest.raises(ValueError):
            list(bam.BamReader({"path": path}).read(bam.Range(path, 0, os.path.getsize(path))))
    with pytest.raises(FileNotFoundError):
        bam.BamReader({"path": str(tmp_path / "none.bam")}).partitions()


def test_nothing_and_reads_without_a_place(spark, tmp_path):
    assert len(written(spark, [], tmp_path / "none")) == 1
    assert bam.reads(spark, str(tmp_path / "none")).count() == 0
    rows = [(None, None, None, "lost", 4, 0, "s1"), ("chr2", 5, 10, "found", 0, 60, None), ("chr9", 5, 10, "unknown", 0, 60, None)]
    written(spark, rows, tmp_path / "odd")
    assert [r[:4] for r in as_rows(bam.reads(spark, str(tmp_path / "odd")))] == sorted([("chr2", 5, 10, "found"), (None, None, None, "lost"), (None, None, None, "unknown")], key=str)
    written(spark, rows[:2], tmp_path / "odd", mode="append")
    assert bam.reads(spark, str(tmp_path / "odd")).count() == 5
    written(spark, rows[:2], tmp_path / "odd")
    assert bam.reads(spark, str(tmp_path / "odd")).count() == 2
    assert not [f for f in os.listdir(tmp_path / "odd") if f.startswith("_")]


def test_operations_give_the_end(spark, tmp_path):
    df = spark.createDataFrame([("chr1", 100, 5, "10S20M5D3I2N4M"), ("chr1", 7, 9, None)], "chrom string, ref_start int, ref_end int, cigar string")
    bam.write_reads(df, str(tmp_path / "x"), REFERENCES)
    assert sorted(r.ref_end for r in bam.reads(spark, str(tmp_path / "x")).collect()) == [9, 131]


def test_many_records_at_once_are_those_of_one_by_one():
    draw, references = np.random.default_rng(5), {"chr1": 10**6, "chr2": 10**6}
    n = 6000
    ref, start = np.sort(draw.integers(0, 2, n)), draw.integers(0, 10**6, n)
    order = np.lexsort((start, ref))
    ref, start = np.append(ref[order], -1), np.append(start[order], -1)
    end = np.where(ref < 0, start, start + draw.integers(0, 40_000, n + 1))
    names, groups = [f"r{i % 977}" for i in range(n)] + ["é"], [None if i % 3 == 0 else f"s{i % 5}" for i in range(n + 1)]
    flag, mapq = draw.integers(0, 1 << 16, n + 1), draw.integers(0, 256, n + 1)
    one, many = (bam.Output(references, io.BytesIO()) for _ in range(2))
    for o in (one, many):
        o.stream.close = lambda: None
    for i in range(n + 1):
        args = [x[i] if isinstance(x, list) else int(x[i]) for x in (names, flag, ref, start, end, mapq)]
        one.read(int(ref[i]), int(start[i]), int(end[i]), bam.record(*args, None, groups[i]))
    for i in range(0, n + 1, 1500):
        part = slice(i, i + 1500)
        data, sizes = bam.records(pa.array(names[part], pa.string()), flag[part], ref[part], start[part], end[part], mapq[part], pa.array(groups[part], pa.string()))
        many.reads(ref[part], start[part], end[part], data, sizes)
    assert one.close() == many.close() is not None
    assert one.stream.getvalue() == many.stream.getvalue()


def test_small_ranges_share_tasks():
    found = bgzf.ranges([("a", 10_000_000), ("b", 5)], 1 << 12)
    assert len(found) < 300
    assert [x for r in found if r.path == "a" for x in r.bounds[:-1]] == list(range(0, 10_000_000, 1 << 12))
    assert all(a.end == b.start for a, b in zip(found, found[1:]) if b.path == "a") and found[-1].bounds == [0, 5]
