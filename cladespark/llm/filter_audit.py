"""What filters do to each other: every order of the filters, counted from one histogram of each part.

Each document becomes a mask, a bit for each filter that it fails. For each part (a value of ``lang``)
three rows are stacked: how many documents have each mask, how many of them have the label quality = 1, and how many toxic = 1.
These rows are multiplied by whole-number matrices with a row for each of 32 masks and a column for each of the 600
steps (5 places in 120 orders): which masks are kept after the step, removed at it, removed before though they fail its filter
(redundant), or fail its filter alone (unique). Filters are therefore run once, not 600 times, whatever their number of orders.

Filters: A: fewer than 100 words; B: 100 * distinct words < 80 * words; C: 100 * letters A-Z > 10 * code points; D: holds one of
``#$%&*|``; E: the text is that of a smaller doc_id anywhere in the table. Words are runs of other bytes than 20 and 09 to 0D.

For E the smallest doc_id of each text (by SHA-256) is found by a sum that is partial before it is shuffled, and joined back by (text, doc_id): only
first documents find a partner, so the copies of a text spread over all tasks. Rows that are shuffled have no text.

Defined results: null texts are empty, and are copies of empty ones; null parts are the part ''; rows without a doc_id
fail E never, make nothing a copy and have no labels; rows of the same doc_id and text are no copies of each other; labels
of the same doc_id count as one that has all their marks; documents without labels count as neither; an empty table gives no rows.
Words of a text are held a slice at a time, its distinct words together. Further columns are left out, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import scratch
from .batches import sliced

FILTERS = "ABCDE"
MASKS = 1 << len(FILTERS)
ORDERS = ["".join(p) for p in permutations(FILTERS)]
WHITE, CAPITALS, SIGNS = b" \t\n\x0b\x0c\r", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|"
#: Bytes of UTF-8 that begin no code point.
CONTINUED = bytes(range(0x80, 0xC0))
#: Bytes of a text that are cut into words at once.
SLICE = 1 << 20
RESULT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def word_counts(text: bytes) -> tuple[int, int]:
    """Words and distinct words of UTF-8 text."""
    distinct: set[bytes] = set()
    count, start = 0, 0
    while start < len(text):
        end = min(len(text), start + SLICE)
        while end < len(text) and text[end : end + 1] not in WHITE:  # a slice ends with a word
            end += 1
        words = text[start:end].split()
        distinct.update(words)
        count += len(words)
        start = end
    return count, len(distinct)


def own_mask(text: bytes) -> int:
    """The bits of the filters that need the text alone."""
    words, distinct = word_counts(text)
    points = len(text.translate(None, CONTINUED))
    capitals = len(text) - len(text.translate(None, CAPITALS))
    failed = (words < 100, 100 * distinct < 80 * words, 100 * capitals > 10 * points, len(text.translate(None, SIGNS)) < len(text))
    return sum(1 << i for i, f in enumerate(failed) if f)


def masked(docs: DataFrame) -> DataFrame:
    """key, part, mark (of the text), mask (without E), from key, part, text."""
    kind = docs.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 3):
            masks = [own_mask(t) for t in batch.column(3).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(masks, pa.int32())], ["key", "part", "mark", "mask"])

    return docs.select("key", "part", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("mark"), "text").mapInArrow(run, f"key {kind}, part string, mark binary, mask int")


def with_copies(rows: DataFrame) -> DataFrame:
    """part, key, mask with the bit of E."""
    first = rows.filter("key is not null").groupBy("mark").agg(F.min("key").alias("key")).withColumn("first", F.lit(True))
    told = rows.join(first, ["mark", "key"], "left")
    copy = F.col("key").isNotNull() & F.col("first").isNull()
    return told.select("part", "key", (F.col("mask") + F.when(copy, MASKS >> 1).otherwise(0)).alias("mask"))


def histograms(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """part, everything, good, toxic: how many documents have each of the masks (arrays), by part."""
    marks = labels.filter("key is not null").groupBy("key").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    known = rows.filter("key is not null").join(marks, "key", "left").select("part", "mask", "good", "toxic")
    told = known.unionByName(rows.filter("key is null").select("part", "mask", F.lit(None).cast("int").alias("good"), F.lit(None).cast("int").alias("toxic")))
    counts = told.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("everything"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))
    at = lambda m, c: F.coalesce(F.sum(F.when(F.col("mask") == m, F.col(c))), F.lit(0))
    return counts.groupBy("part").agg(*(F.array(*(at(m, c) for m in range(MASKS))).alias(c) for c in ("everything", "good", "toxic")))


def incidence() -> dict[str, np.ndarray]:
    """Matrices of masks by steps: kept, removed, redundant, unique; and of steps by filters: whose step it is."""
    steps = [(order, s) for order in ORDERS for s in range(len(FILTERS))]
    own = np.array([1 << FILTERS.index(order[s]) for order, s in steps])
    earlier = np.array([sum(1 << FILTERS.index(c) for c in order[:s]) for order, s in steps])
    mask = np.arange(MASKS)[:, None]
    fails, gone = (mask & own) != 0, (mask & earlier) != 0
    found = {"kept": ~fails & ~gone, "removed": fails & ~gone, "redundant": fails & gone, "unique": np.broadcast_to(mask == own, fails.shape)}
    return {k: v.astype(np.int64) for k, v in found.items()} | {"whose": (own[:, None] == 1 << np.arange(len(FILTERS))).astype(np.int64)}


def products(parts: DataFrame) -> DataFrame:
    """The 600 rows of each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = incidence()
        steps = len(ORDERS) * len(FILTERS)
        for batch in sliced(batches, rows=64):
            if not batch.num_rows:
                continue
            rows = [np.array(batch.column(1 + i).to_pylist(), np.int64) for i in range(3)]
            stacked = np.stack(rows, 1).reshape(-1, MASKS)  # everything, good, toxic of each part
            removed = (stacked @ m["removed"]).reshape(-1, 3, steps)
            shapley = removed[:, 0] @ m["whose"] @ m["whose"].T
            columns = [rows[0] @ m["kept"], removed[:, 0], rows[0] @ m["redundant"], rows[0] @ m["unique"], removed[:, 1], removed[:, 2], shapley]
            names = batch.column(0).take(pa.array(np.repeat(np.arange(batch.num_rows), steps)))
            orders = pa.array(np.tile(np.repeat(ORDERS, len(FILTERS)), batch.num_rows).tolist())
            places = pa.array(np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), batch.num_rows * len(ORDERS)))
            yield pa.RecordBatch.from_arrays([names, orders, places, *(pa.array(c.ravel()) for c in columns)], [f.split()[0] for f in RESULT.split(", ")])

    return parts.select("part", "everything", "good", "toxic").mapInArrow(run, RESULT)


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """A row for each part, order and step: part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    given = docs.select(F.col(key).alias("key"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    marks = labels.select(F.col(key).alias("key"), "quality", "toxic")
    with scratch(docs.sparkSession) as tables:
        rows = tables.keep(masked(given), "masks")
        return products(histograms(with_copies(rows), marks)).checkpoint()
