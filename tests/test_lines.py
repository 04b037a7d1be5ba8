"""Numbered lines over parts of files, block-gzip in ranges."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from cladespark.sources import bgzf, lines, text
from cladespark.sources.bgzf import BlockFile


@pytest.fixture
def small_parts(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def some_lines(count, seed=1):
    rng = random.Random(seed)
    return ["x" * rng.choice([0, 1, 5, 40, 300]) + str(i) * rng.choice([0, 1]) for i in range(count - 1)] + ["end"] * (count > 0)


def as_lists(df):
    out = {}
    for r in df.collect():
        out.setdefault((r.file.rsplit("/", 1)[-1], r.file_no), []).append((r.line, r.value))
    return {k: [v for _, v in sorted(x)] if sorted(n for n, _ in x) == list(range(len(x))) else x for k, x in out.items()}


def test_order_over_parts(spark, tmp_path, small_parts):
    for name, n in (("b.txt", 700), ("a.txt", 3), ("c.txt", 60)):
        (tmp_path / name).write_text("\n".join(some_lines(n, n)) + "\n")
    with gzip.open(tmp_path / "d.txt.gz", "wt") as out:
        out.write("\n".join(some_lines(500, 5)))
    got = lines.numbered(spark, str(tmp_path))
    assert got.select("file", "part").distinct().count() > 40
    assert as_lists(got) == {("a.txt", 1): some_lines(3, 3), ("b.txt", 2): some_lines(700, 700), ("c.txt", 3): some_lines(60, 60), ("d.txt.gz", 4): some_lines(500, 5)}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan.split("BroadcastExchange")[0] and "SortMergeJoin" not in plan


def test_lines_without_a_broadcast(spark, tmp_path, small_parts, monkeypatch):
    monkeypatch.setattr(lines, "BROADCAST_PARTS", 0)
    (tmp_path / "a.txt").write_text("\n".join(some_lines(300)))
    assert as_lists(lines.numbered(spark, str(tmp_path))) == {("a.txt", 1): some_lines(300)}


def test_files_dealt_otherwise_raise(spark, tmp_path, small_parts):
    (tmp_path / "a.txt").write_text("\n".join(some_lines(300)))
    got = lines.numbered(spark, str(tmp_path))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    with pytest.raises(Exception, match="dealt otherwise"):
        got.collect()


@pytest.mark.parametrize("split", [1, 300, 5000, 1 << 20])
def test_block_gzip_in_ranges(spark, tmp_path, split):
    rng = random.Random(split)
    for name, n, last in (("a", 400, "\n"), ("b", 900, ""), ("c", 1, "\r\n"), ("long", 0, "y" * 200_000 + "\nz")):
        body = ("\n".join(some_lines(n, n)) + last).encode()
        at = 0
        with (tmp_path / f"{name}.txt.gz").open("wb") as out:
            while at < len(body):
                step = rng.choice([1, 50, 1000, bgzf.PAYLOAD])
                out.write(bgzf.block(body[at : at + step]))
                at += step
            out.write(bgzf.END_OF_FILE)
    assert gzip.open(tmp_path / "a.txt.gz").read().decode().split("\n")[:-1] == some_lines(400, 400)
    want = {"a": some_lines(400, 400), "b": some_lines(900, 900), "c": some_lines(1, 1), "long": ["y" * 200_000, "z"]}
    for name, expected in want.items():
        path = str(tmp_path / f"{name}.txt.gz")
        size = BlockFile(path).size
        got = []
        for start in range(0, size, split if split > 1 else max(1, size // 40)):
            end = min(size, start + (split if split > 1 else max(1, size // 40)))
            got += [x.removesuffix(b"\r").decode() for batch in lines.owned(BlockFile(path), start, end) for x in batch]
        assert got == expected
    if split == 5000:
        got = as_lists(lines.numbered(spark, [str(tmp_path / "*.gz")], split))
        assert got == {(f"{n}.txt.gz", i): want[n] for i, n in enumerate(("a", "b", "c", "long"), 1)}


def test_blocks_are_written_and_read(spark, tmp_path):
    rows = [f"line {i * 7919}" for i in range(60_000)]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "k int, value string").repartitionByRange(3, "k").sortWithinPartitions("k")
    lines.write_blocks(df, str(tmp_path / "out"))
    got = lines.numbered(spark, str(tmp_path / "out" / "*.gz"), 2000)
    assert got.select("part").distinct().count() > 5
    assert [r.value for r in got.orderBy("file_no", "line").collect()] == rows
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect()) == sorted(rows)
    lines.write_blocks(df.limit(0), str(tmp_path / "out"))
    assert not list((tmp_path / "out").glob("*.gz"))


def test_nothing(spark, tmp_path):
    (tmp_path / "a.txt").write_text("")
    assert lines.numbered(spark, str(tmp_path)).count() == 0
    assert text.fastq(spark, str(tmp_path)).count() == 0
