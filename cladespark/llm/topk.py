"""Exact top-k search by inner product over a pivot-distance index.

Vectors are turned into whole numbers. With one more component, sqrt(M - |x|^2) for the
largest squared length M, all have the same length, so the order of inner products is
that of distances. The index keys each vector by its nearest pivot and its distance to
it, and holds chunks of one pivot's vectors, sorted by distance: annuli.

A query is first answered within its own pivot's annuli, which gives a score to beat. Then
annuli are expanded around its distance to each pivot, and a chunk is left out as soon
as the triangle inequality bounds all its scores below that.

Blocks of queries meet chunks of vectors, never rows each other.

Defined results: null vectors and those with null or non-finite components take no part;
shorter vectors are filled with zeros; repeated rows are candidates each, but for those
with the query's own key; a repeated query key is searched with its smallest vector; null
keys are candidates with a null key, after all others in ties, and are never queries; scores must
fit 64 bits; further columns are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import scratch
from .batches import sliced
from .vectors import dimension, matrix

PIVOTS = 64
CHUNK = 2048
QUERIES_IN_BLOCK = 256


def whole_numbers(df: DataFrame, scale: float, key: str, vector: str, width: int) -> DataFrame:
    """key, whole (binary: 64-bit whole numbers), squares: of the vectors that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, whole = matrix(batch.column(1), width)
            numbers = np.floor(scale * rows[whole]).astype(np.int64)
            key = batch.column(0).filter(pa.array(whole))
            yield pa.RecordBatch.from_arrays([key, pa.array([x.tobytes() for x in numbers], pa.binary()), pa.array((numbers**2).sum(1), pa.int64())], ["key", "whole", "squares"])

    return df.select(F.col(key).cast("long").alias("key"), F.col(vector).alias("vector")).mapInArrow(run, "key long, whole binary, squares long")


def stacked(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(len(column), width)


def distances(numbers: np.ndarray, extra: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """From each vector with its further component to each pivot, whose further component is its last."""
    rows = np.hstack([numbers.astype(float), extra[:, None]])
    square = (rows**2).sum(1)[:, None] + (pivots**2).sum(1)[None] - 2 * rows @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def top_k(df: DataFrame, is_query: Callable[[Column], Column], k: int = 10, scale: float = 1024.0, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), key, score: the k best of all rows but the query's own, ties to smaller keys.

    is_query tells by its key whether a row is a query.
    """
    spark = df.sparkSession
    width = dimension(df, vector)
    with scratch(spark) as tables:
        numbers = tables.keep(whole_numbers(df, scale, key, vector, width), "numbers")
        most = numbers.agg(F.coalesce(F.max("squares"), F.lit(0))).first()[0]
        sample = numbers.orderBy(F.xxhash64("key"), "key", "whole").limit(PIVOTS).collect()
        pivots = np.array([[*np.frombuffer(r["whole"], np.int64), np.sqrt(most - r["squares"])] for r in sample], float).reshape(-1, width + 1)

        def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                away = distances(stacked(batch.column(1), width), np.sqrt((most - batch.column(2).to_numpy()).astype(float)), pivots)
                cell = away.argmin(1) if len(away) else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cell.astype(np.int32)), pa.array(away[np.arange(len(cell)), cell])], ["key", "whole", "cell", "away"])

        ordered = numbers.mapInArrow(keyed, "key long, whole binary, cell int, away double").repartitionByRange("cell", "away", "key").sortWithinPartitions("cell", "away", "key")
        chunks = tables.keep(ordered.mapInArrow(chunked, "cell int, low double, high double, keys binary, rows binary"), "index")
        asked = numbers.filter(F.col("key").isNotNull() & is_query(F.col("key"))).groupBy("key").agg(F.min("whole").alias("whole"))
        blocks = max(1, -(-asked.count() // QUERIES_IN_BLOCK))
        asked = asked.repartition(blocks, "key").sortWithinPartitions("key").mapInArrow(query_blocks(width, pivots), "keys binary, rows binary, aways binary")
        asked = tables.keep(asked, "queries")

        def best(home: bool, queries: DataFrame) -> DataFrame:
            """The best of each chunk for each query that it may serve, in home chunks or in all."""
            pairs = queries.crossJoin(chunks.select("cell", "low", "high", F.col("keys").alias("chunk_keys"), F.col("rows").alias("chunk_rows")))  # blocks of queries by chunks
            found = pairs.select("keys", "rows", "aways", "least", "cell", "low", "high", "chunk_keys", "chunk_rows").mapInArrow(answers(width, k, most, home), "query_id long, key long, score long")
            order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("key").asc_nulls_last())
            return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

        none = asked.withColumn("least", F.lit(None).cast("binary"))
        first = best(True, none).groupBy("query_id").agg(F.when(F.count(F.lit(1)) == k, F.min("score")).alias("least"))
        first = tables.keep(first, "least")
        found = best(False, tables.keep(with_least(asked, first), "asked"))
        return found.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("key").alias(key), "score").checkpoint()


def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of one pivot's vectors in the order of their distance."""
    for batch in batches:
        cells, away = batch.column(2).to_numpy(), batch.column(3).to_numpy()
        keys = batch.column(0).to_pylist()
        rows = batch.column(1).to_pylist()
        cuts = np.unique(np.concatenate([[0], np.flatnonzero(np.diff(cells)) + 1, [len(cells)]]).astype(int))
        spans = [(a, min(b, a + CHUNK)) for start, b in zip(cuts, cuts[1:]) for a in range(start, b, CHUNK)]
        missing = np.iinfo(np.int64).max
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([cells[a] for a, _ in spans], pa.int32()), pa.array([away[a] for a, _ in spans], pa.float64()), pa.array([away[b - 1] for _, b in spans], pa.float64()),
                pa.array([np.array([missing if x is None else x for x in keys[a:b]], np.int64).tobytes() for a, b in spans], pa.binary()), pa.array([b"".join(rows[a:b]) for a, b in spans], pa.binary()),
            ], ["cell", "low", "high", "keys", "rows"])


def query_blocks(width: int, pivots: np.ndarray):  # noqa: ANN201
    """Blocks of queries with their distances to all pivots; a query's further component is 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, QUERIES_IN_BLOCK):
                part = batch.slice(a, QUERIES_IN_BLOCK)
                rows = stacked(part.column(1), width)
                away = distances(rows, np.zeros(len(rows)), pivots)
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in (part.column(0).to_numpy().astype(np.int64).tobytes(), rows.tobytes(), away.tobytes())], ["keys", "rows", "aways"])

    return run


def with_least(asked: DataFrame, first: DataFrame) -> DataFrame:
    """Adds to each block the score that each of its queries has to reach."""
    at = F.posexplode("_ids")
    unpacked = asked.withColumn("_block", F.xxhash64("keys")).withColumn("_ids", unpack("keys"))
    rows = unpacked.select("_block", at.alias("_pos", "query_id")).join(first, "query_id", "left")
    packed = rows.groupBy("_block").agg(F.sort_array(F.collect_list(F.struct("_pos", F.coalesce("least", F.lit(-(1 << 63))).alias("least")))).alias("_found"))  # a block's queries
    return unpacked.join(packed.select("_block", pack(F.col("_found.least")).alias("least")), "_block").select("keys", "rows", "aways", "least")


@F.pandas_udf(T.ArrayType(T.LongType()))
def unpack(keys):  # noqa: ANN001, ANN201
    return keys.map(lambda x: np.frombuffer(x, np.int64))


@F.pandas_udf(T.BinaryType())
def pack(values):  # noqa: ANN001, ANN201
    return values.map(lambda x: np.asarray(x, np.int64).tobytes())


def answers(width: int, k: int, most: int, home: bool):  # noqa: ANN201
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1, 8, rows=16):  # of blocks and chunks
            out: list[list[np.ndarray]] = [[], [], []]
            for keys, rows, aways, least, cell, low, high, chunk_keys, chunk_rows in zip(*(c.to_pylist() for c in batch.columns)):
                keys, chunk_keys = np.frombuffer(keys, np.int64), np.frombuffer(chunk_keys, np.int64)
                queries, chunk = np.frombuffer(rows, np.int64).reshape(len(keys), width), np.frombuffer(chunk_rows, np.int64).reshape(len(chunk_keys), width)
                away = np.frombuffer(aways, float).reshape(len(keys), -1)
                gap = np.maximum(np.maximum(away[:, cell] - high, low - away[:, cell]) - 1e-6 * (1 + high), 0)
                bound = ((queries.astype(float) ** 2).sum(1) + most - gap**2) / 2
                reach = np.frombuffer(least, np.int64) if least is not None else np.full(len(keys), np.iinfo(np.int64).min)
                may = away.argmin(1) == cell if home else bound * (1 + 1e-9) + 1 >= reach
                for a in np.flatnonzero(may):
                    scores = chunk @ queries[a]
                    good = np.flatnonzero((scores >= reach[a]) & (chunk_keys != keys[a]))
                    order = good[np.lexsort((chunk_keys[good], -scores[good]))[:k]]
                    for column, values in zip(out, (np.full(len(order), keys[a]), chunk_keys[order], scores[order])):
                        column.append(values)
            flat = [np.concatenate([*x, np.zeros(0, np.int64)]) for x in out]
            found = pa.array(flat[1], mask=flat[1] == np.iinfo(np.int64).max)
            yield pa.RecordBatch.from_arrays([pa.array(flat[0]), found, pa.array(flat[2])], ["query_id", "key", "score"])

    return run
