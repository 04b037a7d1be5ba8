"""Lines of text files with their numbers, without a shuffle of lines.

A first pass counts the lines of each part of a file (what one task reads of it); running sums of these few counts tell
how many lines come before a part. The second pass numbers lines in place: within a part they lie in order, so a line's number is its place in the
task less that of the part's first line. Every row is held against the counts of the first pass, and an error is raised if files
were dealt otherwise in the meantime.

A gzip file is one part, as it can only be read from its start. Block-gzip files (``bgzip``) are read in ranges of blocks: a range owns
the lines that follow its line ends.
"""

from __future__ import annotations

import dataclasses
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, WriterCommitMessage
from pyspark.sql.types import StructType

from .. import reach_workers
from ..storage import shared_dir
from .bgzf import END_OF_FILE, PAYLOAD, BlockFile, Range, block, listed, opened, ranges, size_of_block

#: Parts of files that are broadcast (some 100 bytes each); more are joined by a shuffle.
BROADCAST_PARTS = 500_000
SPLIT = 32 << 20
#: Bytes of lines that a worker hands on at once.
AT_ONCE = 4 << 20


def numbered(spark: SparkSession, paths: str | list[str], split: int = SPLIT) -> DataFrame:
    """file, file_no (its place among the files), part, line (from 0 in its file), value: the lines of each file in order."""
    blocks, others = [], []
    for path in [paths] if isinstance(paths, str) else paths:
        (blocks if in_blocks(path) else others).append(path)
    found = [placed(spark.read.text(others))] if others else []
    if blocks:
        reach_workers(spark)
        spark.dataSource.register(BlockLines)
        found += [spark.read.format("block_lines").option("split", split).load(path) for path in blocks]
    lines = found[0]
    for more in found[1:]:
        lines = lines.unionByName(more)
    shared_dir(spark)
    counts = lines.groupBy("file", "part").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n")).checkpoint()
    earlier = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = counts.select(F.col("file").alias("of_file"), F.col("part").alias("of_part"), "first", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    names = counts.select("file").distinct().select(F.col("file").alias("of_file"), F.row_number().over(Window.orderBy("file")).alias("file_no"))  # a row for each file
    parts = parts.join(names, "of_file")
    if counts.count() <= BROADCAST_PARTS:
        parts = F.broadcast(parts)
    k = F.col("row") - F.col("first")
    told = lines.join(parts, (F.col("file") == F.col("of_file")) & (F.col("part") == F.col("of_part")), "left")
    line = F.when((k >= 0) & (k < F.col("n")), k + F.col("before")).otherwise(F.raise_error(F.lit("files were dealt otherwise than when their lines were counted")).cast("long"))
    return told.select("file", "file_no", "part", line.alias("line"), "value")


def placed(lines: DataFrame) -> DataFrame:
    """file, part, row (growing by one within a part), value of text as Spark reads it."""
    return lines.select(F.input_file_name().alias("file"), F.col("_metadata.file_block_start").alias("part"), F.monotonically_increasing_id().alias("row"), "value")


def before_parts(lines: DataFrame, amount: Column) -> DataFrame:
    """file, part, _before: the sum of an amount over all earlier parts of the file."""
    sums = lines.groupBy("file", "part").agg(F.sum(amount).alias("_n"))
    earlier = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("file", "part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))


def in_blocks(path: str) -> bool:
    """Whether a path names block-gzip files, judged by its first one."""
    if not path.endswith((".gz", ".bgz")):
        return False
    try:
        first = listed(path, "")[:1]
        if not first:
            return False
        system, inner = opened(first[0][0])
        with system.open_input_stream(inner, compression=None) as stream:
            return size_of_block(stream.read(64), 0) > 0
    except (OSError, ValueError):  # a file system that only Spark reads
        return False


class LineReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.split = options["path"], int(options.get("split", SPLIT))

    def partitions(self) -> list[Range]:
        return ranges(listed(self.path, "gz"), self.split)

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        with BlockFile(partition.path) as file:
            for start, end in zip(partition.bounds, partition.bounds[1:]):
                row = 0
                for lines in owned(file, start, end):
                    values = pa.array([x.removesuffix(b"\r").decode("utf-8", "replace") for x in lines], pa.string())
                    n = len(lines)
                    yield pa.RecordBatch.from_arrays([pa.array([partition.path] * n, pa.string()), pa.array([start] * n, pa.int64()), pa.array(range(row, row + n), pa.int64()), values], ["file", "part", "row", "value"])
                    row += n


def owned(file: BlockFile, start: int, end: int) -> Iterator[list[bytes]]:
    """The lines that follow a line end in blocks that start from ``start`` to before ``end``, and the file's first line, some at once."""
    open_line = start == 0  # whether what is held is the start of a line of this range
    held, out, size = b"", [], 0
    for place, _, data in file.blocks(file.first_block(start)):
        if place >= end:  # only the last line is still to be completed
            if not open_line:
                return
            at = data.find(b"\n")
            held += data if at < 0 else data[:at]
            if at >= 0:
                yield [*out, held]
                return
            continue
        if not open_line:
            at = data.find(b"\n")
            if at < 0:
                continue
            data, open_line = data[at + 1 :], True
        *lines, held = (held + data).split(b"\n")
        out += lines
        size += len(data)
        if size >= AT_ONCE:
            yield out
            out, size = [], 0
    if open_line and held:  # the file ends without a line end
        out.append(held)
    if out:
        yield out


@dataclasses.dataclass
class Written(WriterCommitMessage):
    name: str | None


class LineWriter(DataSourceArrowWriter):
    """A block-gzip file for each task, under names of the attempt until all are written."""

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite, self.run = options["path"].rstrip("/"), overwrite, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        context, stream, held = TaskContext.get(), None, b""
        name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}-{self.run[:8]}.txt.gz"
        system, folder = opened(f"{self.path}/_temporary-{self.run}")
        for batch in iterator:
            if stream is None:
                system.create_dir(folder, recursive=True)
                stream = system.open_output_stream(f"{folder}/{name}", compression=None)
            held += b"".join((x or "").encode() + b"\n" for x in batch.column(0).to_pylist())
            while len(held) > PAYLOAD:
                stream.write(block(held[:PAYLOAD]))
                held = held[PAYLOAD:]
        if stream is None:
            return Written(None)
        stream.write((block(held) if held else b"") + END_OF_FILE)
        stream.close()
        return Written(name)

    def commit(self, messages: list[Written | None]) -> None:
        system, folder = opened(self.path)
        system.create_dir(folder, recursive=True)
        if self.overwrite:
            for path, _ in listed(self.path, "gz"):
                system.delete_file(opened(path)[1])
        for name in (m.name for m in messages if m and m.name):
            system.move(f"{folder}/_temporary-{self.run}/{name}", f"{folder}/{name}")
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        system, folder = opened(f"{self.path}/_temporary-{self.run}")
        if system.get_file_info(folder).type.name == "Directory":
            system.delete_dir(folder)


def write_blocks(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Lines (value) as block-gzip files, which other tools read as gzip."""
    spark = lines.sparkSession
    reach_workers(spark)
    spark.dataSource.register(BlockLines)
    lines.select("value").write.format("block_lines").mode(mode).save(path)


class BlockLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "block_lines"

    def schema(self) -> str:
        return "file string, part long, row long, value string"

    def reader(self, schema: StructType) -> LineReader:
        return LineReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> LineWriter:
        return LineWriter(self.options, overwrite)
