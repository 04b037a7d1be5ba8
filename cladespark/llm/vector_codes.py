"""Vector code compression: product codes from whole-number k-means, exact to the last tie.

A component x becomes floor(1024 * x), x as double; a vector is cut into PARTS equal consecutive
parts, and each part becomes the index of the nearest entry of its part's codebook. The nearest
entry is found in two steps. A product of matrices in single precision gives every squared
distance with an interval that provably holds it (``Codebook.screened``); every entry whose
interval overlaps the best one is computed again in 64-bit whole numbers, and the smallest
distance wins, ties going to the lower index. So screening saves work and decides nothing.

Codebooks start as the parts of the ENTRIES smallest keys (ties by vector). Each round is one pass over the
table: tasks hand on a sum and a count for each entry that they used, these are added up where
an entry's shares meet, and only the new entries come to the driver (PARTS * ENTRIES of them
at any size of table). The table is read again in each pass instead of being copied: write a
costly input as a table before. Nothing but the keys, labels and codes of the result is shuffled.

Defined results: vectors that are null or hold a component that is null, or not finite once it is
multiplied by 1024, are left out; shorter vectors are filled with zeros, to the length of the longest
and that to a multiple of PARTS; repeated rows and null keys are rows like others, null keys being the
last to start an entry; with fewer than ENTRIES rows there are as many entries as rows; an empty table gives no rows.
Components so large that squares leave 64 bits are computed in Python's whole numbers, errors beyond
2^63 - 1 are given as that. Further columns are left out, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import scratch
from .batches import sliced
from .joins import attached
from .vectors import dimension, matrix

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: Vectors whose distances a worker holds at once.
AT_ONCE = 1024
LARGEST = (1 << 63) - 1


def scaled(rows: np.ndarray) -> np.ndarray:
    """floor(1024 x) of doubles: exact, as only the exponent changes before the floor."""
    return np.floor(rows * SCALE)


def whole(vector: Column) -> Column:
    """Whether each component is there and finite, times 1024 too; NaN is above infinity in Spark's order."""
    return vector.isNotNull() & F.coalesce(F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double") * SCALE) < float("inf"))), F.lit(False))


class Codebook:
    """The entries of one part: whole numbers of any size, searched by screening."""

    def __init__(self, entries: list[list[int]], safe: int):
        self.whole = np.array(entries, object).reshape(len(entries), -1)
        self.width = self.whole.shape[1]
        seen: dict[tuple, int] = {}
        for at, entry in enumerate(entries):
            seen.setdefault(tuple(entry), at)
        self.index = np.array(sorted(seen.values()))  # of equal entries only the first can be nearest
        self.about = self.whole[self.index].astype(float)
        self.small = (np.abs(self.about) <= safe).all(1)
        self.exact = np.where(self.small[:, None], self.about, 0).astype(np.int64)

    def screened(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and entry of all pairs whose interval overlaps the best one of the row.

        All numbers are first divided by a power of two that makes them 1 at most, which is exact. With u = 2^-24, n
        products in single precision, added in any order, err by no more than (n + 4) u / (1 - (n + 4) u) times the sum of
        their sizes (Higham), of which the last 4 stand for turning both factors into doubles and then into single precision;
        that sum is at most the product of the norms. What is too small for single precision errs by 2^-140 for each component.
        The rest is computed in doubles, whose errors the last term is far above. Of what is compared, |c|^2 - 2 x c, the
        square of x is missing, which is the same for all entries.
        """
        largest = max(np.abs(x).max(initial=1), np.abs(self.about).max(initial=1))
        shift = -int(np.frexp(largest)[1])
        xs, cs = np.ldexp(x, shift), np.ldexp(self.about, shift)
        products = (xs.astype(np.float32) @ cs.T.astype(np.float32)).astype(float)
        x_norm, c_squares = np.sqrt((xs * xs).sum(1)), (cs * cs).sum(1)
        terms = (self.width + 4) * 2.0**-24
        error = 2 * terms / (1 - terms) * (1 + 2.0**-20) * np.outer(x_norm, np.sqrt(c_squares)) + self.width * 2.0**-138
        between = c_squares - 2 * products
        error += (np.abs(between) + 2 * c_squares) * ((self.width + 8) * 2.0**-52)
        best = (between + error).min(1)
        return np.nonzero(between - error <= best[:, None])

    def nearest(self, x: np.ndarray, small: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry of each row; small: which rows fit 64-bit squares."""
        row, entry = self.screened(x)
        exact = small[row] & self.small[entry]
        distance = np.zeros(len(row), np.int64 if exact.all() else object)
        ints = np.where(small[:, None], x, 0).astype(np.int64)
        distance[exact] = ((ints[row[exact]] - self.exact[entry[exact]]) ** 2).sum(1)
        for at in np.flatnonzero(~exact).tolist():
            distance[at] = sum((int(a) - b) ** 2 for a, b in zip(x[row[at]].tolist(), self.whole[self.index[entry[at]]].tolist()))
        starts = np.flatnonzero(np.diff(row, prepend=-1))
        least = np.minimum.reduceat(distance, starts)
        ties = np.flatnonzero(distance == least[row])  # every row has pairs, in order of the entries
        first = ties[np.flatnonzero(np.diff(row[ties], prepend=-1))]
        return self.index[entry[first]], least


class Books:
    """The codebooks of all parts."""

    def __init__(self, entries: list[list[list[int]]]):
        """entries: by part, entry and position."""
        self.entries = entries
        width = max(1, sum(len(part[0]) for part in entries))
        self.safe = int(np.sqrt(2.0**62 / width) / 2)  # squares of differences, added over a vector, stay under 2^63
        self.parts = [Codebook(part, self.safe) for part in entries]

    def assigned(self, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For chunks of rows (doubles): the scaled rows, which of them are small, their codes and squared distances by part."""
        for start in range(0, len(rows), AT_ONCE):
            x = scaled(rows[start : start + AT_ONCE])
            small = (np.abs(x) <= self.safe).all(1)
            found = [book.nearest(part, small) for book, part in zip(self.parts, np.split(x, len(self.parts), 1))]
            yield x, small, np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(v) for part in self.entries for entry in part for v in entry).encode()).hexdigest()


def shares(vectors: DataFrame, books: Books, width: int) -> DataFrame:
    """part, entry, times, total (comma-joined whole numbers): what a task adds to the entries that are nearest to its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, own = len(books.entries), width // len(books.entries)
        sums = [np.zeros((len(e), own), np.int64) for e in books.entries]
        times = [np.zeros(len(e), np.int64) for e in books.entries]
        added = 0

        def handed() -> pa.RecordBatch:
            rows = [(p, e, int(times[p][e]), ",".join(map(str, sums[p][e].tolist()))) for p in range(parts) for e in np.flatnonzero(times[p]).tolist()]
            for s, t in zip(sums, times):
                s[:], t[:] = 0, 0
            return table(rows)

        def table(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows) if rows else [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.string()))], ["part", "entry", "times", "total"])

        for batch in sliced(batches, rows=4 * AT_ONCE):
            for x, small, codes, _ in books.assigned(matrix(batch.column(0), width)[0]):
                if added + books.safe * len(x) > LARGEST:
                    yield handed()
                    added = 0
                added += books.safe * len(x)
                for p, part in enumerate(np.split(x, parts, 1)):
                    mine = codes[small, p]
                    if len(mine):
                        order = np.argsort(mine, kind="stable")
                        used, starts = np.unique(mine[order], return_index=True)
                        sums[p][used] += np.add.reduceat(part[small][order].astype(np.int64), starts)
                        times[p] += np.bincount(mine, minlength=len(times[p]))
                    large = [(p, int(codes[i, p]), 1, ",".join(str(int(v)) for v in part[i].tolist())) for i in np.flatnonzero(~small).tolist()]
                    if large:
                        yield table(large)
        yield handed()

    return vectors.select("vector").mapInArrow(run, "part int, entry int, times long, total string")


def added_up(found: DataFrame) -> DataFrame:
    """The shares of each entry as one; a task holds no more than the sums of its entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], list] = {}
        for batch in batches:
            for part, entry, times, total in zip(*(c.to_pylist() for c in batch.columns)):
                values = [int(v) for v in total.split(",")] if total else []
                held = sums.setdefault((part, entry), [0, [0] * len(values)])
                held[0] += times
                held[1] = [a + b for a, b in zip(held[1], values)]
        rows = [(*k, times, ",".join(map(str, values))) for k, (times, values) in sums.items()]
        columns = zip(*rows) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.string()))], ["part", "entry", "times", "total"])

    return found.repartition("part", "entry").mapInArrow(run, "part int, entry int, times long, total string")


def moved(books: Books, found: DataFrame) -> Books:
    """Each entry as the floor of the mean of its parts; unused ones stay."""
    entries = [[list(e) for e in part] for part in books.entries]
    for part, entry, times, total in added_up(found).collect():  # PARTS * ENTRIES rows at most
        entries[part][entry] = [int(v) // times for v in total.split(",")] if total else []
    return Books(entries)


def trained(vectors: DataFrame, width: int, rounds: int = ROUNDS, parts: int = PARTS, entries: int = ENTRIES) -> Books | None:
    """Codebooks of whole vectors (key, vector); None for no vectors."""
    first = vectors.orderBy(F.col("key").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    if not first:
        return None
    start = np.zeros((len(first), width))
    for at, (vector,) in enumerate(first):
        start[at, : len(vector)] = vector
    books = Books([[[int(v) for v in entry] for entry in part.tolist()] for part in np.split(scaled(start), parts, 1)])
    for _ in range(rounds):
        books = moved(books, shares(vectors, books, width))
    return books


def coded(vectors: DataFrame, books: Books, width: int, carried: list[str]) -> DataFrame:
    """code, error (squared distances added over the parts) and the carried columns of each row."""
    fields = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in vectors.select(*carried).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, rows=4 * AT_ONCE):
            code, error = [], []
            for _, _, codes, distances in books.assigned(matrix(batch.column(0), width)[0]):
                code += ["".join(f"{c:02x}" for c in row) for row in codes.tolist()]
                error += [min(sum(row), LARGEST) for row in distances.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(code, pa.string()), pa.array(error, pa.int64()), *batch.columns[1:]], ["code", "error", *carried])

    return vectors.select("vector", *carried).mapInArrow(run, f"code string, error long{fields}")


def with_sums(rows: DataFrame, label: str, value: str, out: str) -> DataFrame:
    """Adds the sum of ``value`` over equal labels, nulls together. A label may hold most of the rows."""
    sums = rows.groupBy(F.col(label).alias("_of")).agg(F.least(F.sum(F.col(value).cast("decimal(19,0)")), F.lit(LARGEST).cast("decimal(38,0)")).cast("long").alias(out))
    return attached(rows, sums, label, "_of")


def compress(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """key, code, error, label_error, codebooks_sha256, one row for each row whose vector is whole."""
    spark = df.sparkSession
    given = df.select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    vectors = given.filter(whole(F.col("vector")))
    width = max(1, -(-dimension(vectors, "vector") // PARTS)) * PARTS
    books = trained(vectors, width)
    names = [F.col("key").alias(key), "code", "error", "label_error", "codebooks_sha256"]
    if books is None:
        return vectors.select("key", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256")).select(*names)
    with scratch(spark) as tables:
        rows = tables.keep(coded(vectors, books, width, ["key", "label"]), "codes")
        return with_sums(rows, "label", "error", "label_error").withColumn("codebooks_sha256", F.lit(books.digest())).select(*names).checkpoint()
