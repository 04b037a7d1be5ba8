"""Best-fit packing of documents into sequences, after Martello-Toth reduction.

Only the number of items of each length matters to a packing, and a length is
at most the capacity. So the instance that the driver solves has ``capacity``
counts at most, whatever the number of documents; items then find their places
by their rank within their length, which is dealt out in small salted groups.

The reduction looks at an item j, largest first, with R = capacity - j to spare,
and fixes a set of items around j that dominates every other set around j:

- nothing fits beside j: j alone;
- k fills R exactly: {j, k};
- at most one more item fits, or no two or more items have a sum over k (the
  largest that fits) and up to R: {j, k};
- at most two more fit, k and the largest b beside it leave no pair that is
  neither within (k, b) nor within k alone: {j, k, b}.

What is left is packed best-fit, longest first. Equal bins are handled together.

Defined results: null or empty text has the end id alone; repeated rows are packed
each; an empty table gives no rows; further columns of the input are left out.
"""

from __future__ import annotations

import bisect
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ..storage import scratch
from .batches import sliced
from .bpe import byte_letters

#: About so many pieces share a salt.
PIECES_IN_GROUP = 2000

Pattern = tuple[int, list[tuple[int, int]]]


class ByteBpe:
    """A byte-level tokenizer file. Where ids are in the order of its merges, a rank tokenizer gives the same ids sooner."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.specials = {x["content"]: x["id"] for x in spec["added_tokens"]}
        made = [vocabulary[a + b] for a, b in merges]
        byte = {x: i for i, x in enumerate(byte_letters())}
        ranks = {bytes(map(byte.__getitem__, t)): i for t, i in vocabulary.items() if t not in self.specials}
        plain = spec["normalizer"] is None and spec["pre_tokenizer"]["type"] == "ByteLevel" and not spec["pre_tokenizer"]["add_prefix_space"]
        self.path, self.fast, self.library = path, None, None
        if plain and made == sorted(made) and len(self.specials) < 2:
            import public_tokenizers

            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=self.specials)

    def encode(self, text: str) -> np.ndarray:
        if self.fast is not None:
            try:
                return np.asarray(self.fast.encode_to_numpy(text, allowed_special="all"), "<u4")
            except ValueError:  # its pattern gives up on very long runs of white space
                pass
        if self.library is None:
            self.library = Tokenizer.from_file(self.path)
            self.library.no_padding()
            self.library.no_truncation()
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")


_coders: dict[str, ByteBpe] = {}


def pieces(df: DataFrame, path: str, capacity: int = 2048, end: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, piece, start, length, ids_crc32: a row for each piece of each text's ids and the end id.

    Only texts of more than ``capacity`` ids are cut; the first piece takes what whole pieces leave.
    """
    names = ["key", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _coders:
            _coders[path] = ByteBpe(path)
        coder, tail = _coders[path], np.array([end], "<u4")
        for batch in sliced(batches, 1):
            at, piece, start, length, crc = [], [], [], [], []
            for row, value in enumerate(batch.column(1).to_pylist()):
                ids = np.concatenate([coder.encode(value), tail]) if value else tail
                first = len(ids) % capacity or capacity
                cuts = [0, *range(first, len(ids) + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    at.append(row)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(ids[a:b].tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))], names)

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"key {kind}, piece int, start long, length long, ids_crc32 long").withColumnRenamed("key", key)


class Supply:
    """How many items of each length are left."""

    def __init__(self, counts: dict[int, int]):
        self.left = {k: v for k, v in counts.items() if v > 0}
        self.sizes = sorted(self.left)

    def take(self, length: int, count: int) -> None:
        self.left[length] -= count
        if not self.left[length]:
            del self.left[length]
            self.sizes.pop(bisect.bisect_left(self.sizes, length))

    def has(self, length: int, used: tuple[int, ...]) -> bool:
        return self.left[length] > used.count(length)

    def largest(self, most: int, used: tuple[int, ...]) -> int:
        """The largest length up to ``most`` of which one is left beside those used; 0 if none."""
        at = bisect.bisect_right(self.sizes, most) - 1
        while at >= 0 and not self.has(self.sizes[at], used):
            at -= 1
        return self.sizes[at] if at >= 0 else 0

    def smallest(self, used: tuple[int, ...], number: int) -> list[int]:
        """The smallest items, ``number`` at most, beside those used."""
        out: list[int] = []
        for size in self.sizes:
            out += [size] * min(self.left[size] - used.count(size), number - len(out))
            if len(out) == number:
                break
        return out

    def pair_between(self, least: int, over: int, most: int, used: tuple[int, ...]) -> bool:
        """Whether two items, each over ``least``, have a sum over ``over`` and up to ``most``."""
        sizes = [s for s in self.sizes[bisect.bisect_right(self.sizes, least) : bisect.bisect_right(self.sizes, most)] if self.has(s, used)]
        high = len(sizes) - 1
        for low, size in enumerate(sizes):
            while high >= low and size + sizes[high] > most:
                high -= 1
            if high < low:
                return False
            if high == low and self.left[size] - used.count(size) < 2:
                return False
            if size + sizes[high] > over:
                return True
        return False


def dominating(supply: Supply, j: int, capacity: int) -> tuple[int, ...] | None:
    """The items that stand beside j in a set that dominates all others with j; None if none is proven to."""
    room = capacity - j
    k = supply.largest(room, (j,))
    if not k:
        return ()
    if k == room:
        return (k,)
    few = supply.smallest((j,), 3)
    if len(few) < 2 or few[0] + few[1] > room:
        return (k,)
    if len(few) == 3 and sum(few) <= room:
        return None
    if not supply.pair_between(0, k, room, (j,)):
        return (k,)
    b = supply.largest(room - k, (j, k))
    if b and not supply.pair_between(b, k, room, (j,)):
        return (k, b)
    return None


def solve(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Patterns, each a number of sequences and the (length, how many) in each of them."""
    supply, out = Supply(counts), []
    for j in sorted(supply.left, reverse=True):
        while supply.left.get(j):
            beside = dominating(supply, j, capacity)
            if beside is None:
                break
            items = (j, *beside)
            times = min(supply.left[x] // items.count(x) for x in items)
            if not beside:
                times = supply.left[j]
            for x in set(items):
                supply.take(x, times * items.count(x))
            out.append((times, [(x, items.count(x)) for x in dict.fromkeys(items)]))
    rooms: dict[int, list[Pattern]] = {}
    sizes: list[int] = []

    def put(room: int, pattern: Pattern) -> None:
        if room not in rooms:
            bisect.insort(sizes, room)
        rooms.setdefault(room, []).append(pattern)

    for length, left in sorted(supply.left.items(), reverse=True):
        while left:
            at = bisect.bisect_left(sizes, length)
            if at == len(sizes):
                each = capacity // length
                whole, rest = divmod(left, each)
                if whole:
                    put(capacity - each * length, (whole, [(length, each)]))
                if rest:
                    put(capacity - rest * length, (1, [(length, rest)]))
                break
            room = sizes[at]
            bins, held = rooms[room].pop()
            if not rooms[room]:
                del rooms[room], sizes[at]
            each = room // length
            whole = min(bins, left // each)
            left -= whole * each
            if whole:
                put(room - each * length, (whole, [*held, (length, each)]))
            if whole < bins and left:
                put(room - left * length, (1, [*held, (length, left)]))
                left, whole = 0, whole + 1
            if whole < bins:
                put(room, (bins - whole, held))
    return out + [p for room in sizes for p in rooms[room]]


def places(patterns: list[Pattern]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: the first rank, sequence, offset and number in a sequence of each pattern that holds it."""
    found: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for bins, held in patterns:
        offset = 0
        for length, each in held:
            found.setdefault(length, []).append((used.get(length, 0), sequence, offset, each))
            used[length] = used.get(length, 0) + bins * each
            offset += length * each
        sequence += bins
    return {k: tuple(np.array(x, np.int64) for x in zip(*v)) for k, v in found.items()}


def pack(items: DataFrame, capacity: int = 2048) -> DataFrame:
    """The columns of ``items`` (which have a length) with sequence_id and offset.

    ``items`` is read three times: give a table that is written.
    """
    spark = items.sparkSession
    groups = max(1, items.count() // PIECES_IN_GROUP)
    salted = items.withColumn("_salt", F.pmod(F.xxhash64(*items.columns), F.lit(groups)).cast("int"))
    sizes = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.withColumn("_before", F.sum("_n").over(Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)))
    totals = {r["length"]: r["n"] for r in items.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # capacity rows at most
    place = places(solve(totals, capacity))
    order = Window.partitionBy("length", "_salt").orderBy(*items.columns)
    ranked = salted.withColumn("_rank", F.row_number().over(order)).join(before.select("length", "_salt", F.coalesce("_before", F.lit(0)).alias("_before")), ["length", "_salt"])
    ranked = ranked.select(*items.columns, (F.col("_rank") - 1 + F.col("_before")).cast("long").alias("_rank"))
    held = items.columns
    at = held.index("length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column(at).to_numpy(), batch.column(len(held)).to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for size in np.unique(length):
                rows = np.flatnonzero(length == size)
                first, base, within, each = place[int(size)]
                k = np.searchsorted(first, rank[rows], "right") - 1
                nth = rank[rows] - first[k]
                sequence[rows] = base[k] + nth // each[k]
                offset[rows] = within[k] + nth % each[k] * size
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sequence), pa.array(offset)], [*held, "sequence_id", "offset"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema)
    return ranked.mapInArrow(run, f"{fields}, sequence_id long, offset long")


def pack_documents(df: DataFrame, path: str, capacity: int = 2048, end: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The pieces of all documents with their sequence and their place there."""
    with scratch(df.sparkSession) as tables:
        return pack(tables.keep(pieces(df, path, capacity, end, key, text), "pieces"), capacity).checkpoint()
