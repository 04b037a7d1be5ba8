"""N-gram Jaccard join: exact links between documents of like word shingles, and their groups.

Sets skip each other in two ways.

*By position.* A set is sorted by hash and cut at fixed hash positions into k blocks. Sets
that link differ in fewer elements than there are blocks, so some block is the same in
both. Index lists are kept for each size class, block position and block content, and a set
meets only the sets in the lists of its own blocks; all others are skipped unseen. There are
some blocks more than that needs, so each set leaves as many of its lists, the longest ones.
A member knows its place in a list: how many of its elements come before the block. Two members
differ by at least the difference of their elements before plus that of those after, so members
are read in order of place, in blocks, and blocks too far apart are skipped whole.

*By answers.* A set is compared with a leader alone at first: of the sets that lead its lists
(those in most lists), the one in most. A set that links with the leader has the leader's
component. All other answers derive from this one: what two sets share with their leader
bounds what they share, and of pairs that this bound leaves, the intersection is counted from
the few elements in which each differs from the leader (``derived``), without the sets.
Only members of different components are looked at, so what is left of a list is the members
outside its leader's component; each meets the others in parts of LONG_LIST.

Equal sets are one class from the start. Pairs pass a comparison of parities, one bit for each
place of a table of hashes, whose number of different bits is a lower bound on how much sets
differ, before elements are compared.

Elements are 64-bit hashes of word sequences, as are classes.

Defined results: null or empty text has no shingles and is in a group of its own, as is
each row with it; repeated rows are in one group and each have a row; a null key is never
a group's smallest key unless there is no other; further columns are left out.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..storage import Scratch, scratch
from .batches import WORD, sliced
from .components import components

LONG_LIST = 2048
#: Members of a list that are compared with others, or skipped, at once.
BLOCK = 256
#: The growth of size classes, the share of its lists that a set may leave, and the size up to which it leaves none.
GROWTH, SPARE, SMALL_LIST = 1.3, 0.15, 16
CACHED_WORDS = 400_000
#: Bits in a sketch at least; there is one for each element or more.
SKETCH = 64
#: Bytes of sketches that are compared at once.
COMPARED = 8_000_000
#: So many ids, 8 bytes each, are broadcast at most; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: So many of its lists does a member carry, to tell that a pair meets in an earlier list.
CARRIED = 8
#: So many pairs does a task remember to hand each on once, and so many classes to index each once.
REMEMBERED = 300_000
#: Kinds of parts of a list: members among themselves, or those of the leader's component with others.
INSIDE, ACROSS = 1, 0

_words = re.compile(WORD).findall
_odd = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: each bit of the result depends on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Join(NamedTuple):
    """words: in a shingle; percent: sets link if 100 * intersection >= percent * union."""

    words: int
    percent: int

    def apart(self, sizes: int) -> int:
        """The most elements in which two sets that link can differ, by the sum of their sizes."""
        return (100 - self.percent) * sizes // (100 + self.percent)

    def largest(self, size: int) -> int:
        """The largest set that can link with one of this size."""
        return size * 100 // self.percent


@functools.cache
def size_class(join: Join, number: int) -> tuple[int, int, int]:
    """The first and last size of a class, and how many blocks its sets have; without blocks no two sets link."""
    first = 1 if not number else size_class(join, number - 1)[1] + 1
    last = max(first, int(first * GROWTH) - 1)
    apart = join.apart(last + join.largest(last))
    return first, last, 0 if not apart else int((apart + 1) / (1 - SPARE)) + 1


@functools.cache
def classes_of(join: Join, size: int) -> tuple[int, ...]:
    """The classes in whose lists a set of this size is: its own, and smaller ones whose sets it can link with."""
    number, out = 0, []
    while size_class(join, number)[0] <= size:
        _, last, blocks = size_class(join, number)
        if join.largest(last) >= size and blocks:
            out.append(number)
        number += 1
    return tuple(out)


class Shingler:
    def __init__(self, join: Join):
        self.join, self.known = join, {}

    def shingles(self, text: str | None) -> np.ndarray:
        """The distinct shingles of a text as sorted hashes."""
        words = _words((text or "").encode().lower())
        new = {*words}.difference(self.known)
        if new:
            if len(self.known) + len(new) > CACHED_WORDS:
                self.known.clear()
                new = {*words}
            self.known.update((w, xxhash.xxh3_64_intdigest(w)) for w in new)
        if not words:
            return np.zeros(0, np.uint64)
        hashes = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        length = min(self.join.words, len(words))
        count = len(words) - length + 1
        total = np.full(count, length, np.uint64)
        for k in range(length):
            total += hashes[k : k + count] * _odd[k % 5] + np.uint64(k // 5)
            total = mixed(total)
        return np.unique(total)


def block_keys(join: Join, sorted_hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The index lists of a set, a hash of size class, block position and block content each, and its place in each."""
    keys, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    high = sorted_hashes >> np.uint64(32)
    content = mixed(sorted_hashes)
    for number in classes_of(join, len(sorted_hashes)):
        blocks = size_class(join, number)[2]
        block = ((high * np.uint64(blocks)) >> np.uint64(32)).astype(np.int64)
        counts = np.bincount(block, minlength=blocks)
        starts = np.cumsum(counts) - counts
        full = np.flatnonzero(counts)
        sums = np.zeros(blocks, np.uint64)
        sums[full] = np.add.reduceat(content, starts[full])
        at = np.arange(blocks, dtype=np.uint64) + np.uint64(number << 32)
        keys.append(mixed(sums * _odd[0] + at * _odd[1]))
        places.append(starts)
    return np.concatenate(keys), np.concatenate(places)


def spare_lists(join: Join, size: int) -> int:
    """How many of its lists a set of this size may leave and still meet all sets that it links with."""
    found = [size_class(join, number) for number in classes_of(join, size)]
    return min((blocks - 1 - join.apart(last + join.largest(last)) for _, last, blocks in found), default=0)


def set_class(sorted_hashes: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(sorted_hashes.tobytes()) - (1 << 63)


def indexed(rows: DataFrame, join: Join) -> DataFrame:
    """list, class, place for each list of the first of equal sets in a task; and doc (key, n, spare, sketch) with its class for each row.

    n is the number of shingles. ``list`` of the latter rows only spreads them.
    """
    kind = rows.schema["key"].dataType.simpleString()
    fields = ["key", "n", "spare", "sketch"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seen, count = Shingler(join), set(), 0
        for batch in sliced(batches, 1):
            n, own, sketch, lists, listed = [], [], [], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for text in batch.column(1).to_pylist():
                hashes = shingler.shingles(text)
                n.append(len(hashes))
                own.append(set_class(hashes) if len(hashes) else None)
                again = own[-1] in seen or not len(hashes)
                if len(seen) < REMEMBERED:
                    seen.add(own[-1])
                sketch.append(None if again else parities(hashes))
                if not again:
                    keys, places = block_keys(join, hashes)
                    lists.append(keys)
                    listed.append(places)
            lengths = [len(x) for x in lists[1:]]
            flat = np.concatenate([*lists, mixed(np.arange(count, count + len(n), dtype=np.uint64))]).view(np.int64)
            count += len(n)
            empty = len(flat) - len(n)
            whole = np.repeat(np.array([x for x, y in zip(own, sketch) if y is not None], np.int64), lengths)
            docs = [batch.column(0), pa.array(n, pa.int64()), pa.array([spare_lists(join, x) for x in n], pa.int32()), pa.array(sketch, pa.binary())]
            docs = [pa.concat_arrays([pa.nulls(empty, x.type), x]) for x in docs]
            doc = pa.StructArray.from_arrays(docs, fields, mask=pa.array(np.arange(len(flat)) < empty))
            classes = pa.concat_arrays([pa.array(whole), pa.array(own, pa.int64())])
            places = pa.array(np.concatenate([*listed, np.zeros(len(n), np.int64)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(flat), classes, places, doc], ["list", "class", "place", "doc"])

    return rows.select("key", "text").mapInArrow(run, f"list long, class long, place int, doc struct<key:{kind},n:long,spare:int,sketch:binary>")


def parities(sorted_hashes: np.ndarray) -> bytes:
    """A bit for each remainder of a power of two, whether an odd number of elements has it."""
    places = max(SKETCH, 1 << (len(sorted_hashes) - 1).bit_length())
    counts = np.bincount((sorted_hashes % np.uint64(places)).astype(np.int64), minlength=places)
    return np.packbits((counts & 1).astype(bool), bitorder="little").tobytes()


def folded(sketches: list[bytes], size: int) -> np.ndarray:
    """Sketches by a smaller power of two, of ``size`` bytes: what they would have been by it. Rows of 64-bit numbers."""
    if all(len(x) == size for x in sketches):
        return np.frombuffer(b"".join(sketches), np.uint64).reshape(len(sketches), -1)
    return np.array([np.bitwise_xor.reduce(np.frombuffer(x, np.uint64).reshape(-1, size // 8), 0) for x in sketches])


def apart_at_least(x: bytes, y: bytes) -> int:
    """A lower bound on how many elements two sets differ in, from their sketches."""
    size = min(len(x), len(y))
    return int(np.bitwise_count(folded([x], size) ^ folded([y], size)).sum())


def sets_of(rows: DataFrame, join: Join) -> DataFrame:
    """class, elements (binary: sorted 64-bit hashes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(join)
        for batch in sliced(batches, 0):
            sets = [shingler.shingles(x) for x in batch.column(0).to_pylist()]
            sets = [x for x in sets if len(x)]
            yield pa.RecordBatch.from_arrays([pa.array([set_class(x) for x in sets], pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary())], ["class", "elements"])

    return rows.select("text").mapInArrow(run, "class long, elements binary").dropDuplicates(["class"])


def in_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """The rows of each run of equal first columns, without these."""
    now, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:keys] != now:
                if held:
                    yield now, held
                now, held = row[:keys], []
            held.append(row[keys:])
    if held:
        yield now, held


def near_by_sketch(pairs: DataFrame, classes: DataFrame, join: Join) -> DataFrame:
    """a, b: the pairs that sketches don't keep apart."""
    side = lambda x: classes.select(F.col("class").alias(x), F.col("n").alias("n" + x), F.col("sketch").alias("s" + x))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [apart_at_least(x, y) <= join.apart(m + n) for m, n, x, y in zip(*(batch.column(i).to_pylist() for i in range(2, 6)))]
            kept = pa.array(near, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(kept) for i in (0, 1)], ["a", "b"])

    joined = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "sa", "sb")
    return joined.mapInArrow(run, "a long, b long")


def numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint64)


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, common, na, nb, lost, new: the exact intersection of each pair, and what b lacks of a and has besides it.

    lost and new are null where sets are so different that these are no shorter than b.
    """
    names = ["a", "b", "common", "na", "nb", "lost", "new"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 2, 3):
            found = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                p, q = numbers(x), numbers(y)
                both = np.concatenate([p, q])
                order = both.argsort(kind="stable")
                ordered = both[order]
                twice = ordered[1:] == ordered[:-1]
                single = ~(np.append(twice, False) | np.insert(twice, 0, False))
                alone, from_p = ordered[single], order[single] < len(p)
                kept = 2 * len(alone) < len(q)
                found.append((int(twice.sum()), len(p), len(q), alone[from_p].tobytes() if kept else None, alone[~from_p].tobytes() if kept else None))
            kinds = [pa.int64()] * 3 + [pa.binary()] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array([x[i] for x in found], kind) for i, kind in enumerate(kinds))], names)

    side = lambda x: sets.select(F.col("class").alias(x), F.col("elements").alias("e" + x))
    joined = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").select("a", "b", "ea", "eb")
    return joined.mapInArrow(run, "a long, b long, common long, na long, nb long, lost binary, new binary")


def derived(pairs: DataFrame, exact: DataFrame) -> tuple[DataFrame, DataFrame]:
    """a, b, common, na, nb of the pairs with one leader, from how each differs from it; and the other pairs.

    exact: what ``compared`` found of each class (b) and its leader (a).
    """
    own = exact.filter(F.col("lost").isNotNull())
    side = lambda x: own.select(F.col("b").alias(x), F.struct(F.col("a").alias("leader"), F.col("na").alias("of_leader"), F.col("nb").alias("n"), "lost", "new").alias("d" + x))
    joined = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left").withColumn("one", F.coalesce(F.col("da.leader") == F.col("db.leader"), F.lit(False)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, *range(5, 9)):
            a, b, whole, na, nb, *differences = (c.to_pylist() for c in batch.columns)
            common = []
            for size, lost_a, new_a, lost_b, new_b in zip(whole, *differences):
                either = np.concatenate([numbers(lost_a), numbers(lost_b)])
                common.append(size - len(np.unique(either)) + len(np.intersect1d(numbers(new_a), numbers(new_b), assume_unique=True)))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, common, na, nb)], ["a", "b", "common", "na", "nb"])

    ready = joined.filter("one").select("a", "b", "da.of_leader", F.col("da.n").alias("na"), F.col("db.n").alias("nb"), F.col("da.lost").alias("lost_a"), F.col("da.new").alias("new_a"), F.col("db.lost").alias("lost_b"), F.col("db.new").alias("new_b"))
    return ready.mapInArrow(run, "a long, b long, common long, na long, nb long"), joined.filter("not one").select("a", "b")


class Block(NamedTuple):
    """Members of a list: class, component, place, n, what each shares with the list's leader (-1: not known), sketch, the lists that it carries."""

    own: np.ndarray
    component: np.ndarray
    place: np.ndarray
    n: np.ndarray
    common: np.ndarray
    sketch: np.ndarray
    carried: list[list[int]]

    @property
    def after(self) -> np.ndarray:
        return self.n - self.place


def blocks_of(rows: list[tuple], size: int) -> list[Block]:
    """Members in blocks by place; those of a component that fills blocks have blocks of their own."""
    if not rows:
        return []
    own, component, place, n, common = (np.array(x, np.int64) for x in list(zip(*rows))[:5])
    _, which, counts = np.unique(component, return_inverse=True, return_counts=True)
    order = np.lexsort((n, place, np.where(counts[which] >= BLOCK, which, -1)))
    out = []
    for k in range(0, len(order), BLOCK):
        at = order[k : k + BLOCK]
        out.append(Block(own[at], component[at], place[at], n[at], common[at], folded([rows[i][5] for i in at], size), [rows[i][6] for i in at]))
    return out


def skipped(x: Block, y: Block, join: Join) -> bool:
    """Whether no two members of two blocks can link, or all are in one component."""
    gap = lambda p, q: max(0, p.min() - q.max(), q.min() - p.max())
    if gap(x.place, y.place) + gap(x.after, y.after) > join.apart(int(x.n.max() + y.n.max())):
        return True
    return x.component.min() == x.component.max() == y.component.min() == y.component.max()


def within_reach(x: Block, y: Block, join: Join) -> Iterator[tuple[int, int]]:
    """Places in two blocks of pairs in different components that no bound keeps apart."""
    may = x.component[:, None] != y.component[None]
    if x is y:
        may = np.triu(may, 1)
    p, q = np.nonzero(may)
    sizes = x.n[p] + y.n[q]
    apart = np.abs(x.place[p] - y.place[q]) + np.abs(x.after[p] - y.after[q])
    common, other = x.common[p], y.common[q]
    most = np.minimum(common, other) + np.minimum(x.n[p] - common, y.n[q] - other)  # of what both may share
    far = (common >= 0) & (other >= 0) & (100 * most < join.percent * (sizes - most))
    ok = (apart * (100 + join.percent) <= (100 - join.percent) * sizes) & ~far
    p, q, sizes = p[ok], q[ok], sizes[ok]
    step = max(1, COMPARED // (8 * x.sketch.shape[1]))
    for k in range(0, len(p), step):
        r, s = p[k : k + step], q[k : k + step]
        apart = np.bitwise_count(x.sketch[r] ^ y.sketch[s]).sum(1, dtype=np.int64)
        ok = apart * (100 + join.percent) <= (100 - join.percent) * sizes[k : k + step]
        yield from zip(r[ok].tolist(), s[ok].tolist())


def candidates(dealt: DataFrame, join: Join) -> DataFrame:
    """a, b: pairs of a list in different components that no bound keeps apart."""

    def here_first(listed: int, x: list[int], y: list[int]) -> bool:
        """Whether no list that both are known to be in comes before this one."""
        common = {*x}.intersection(y)
        return not common or min(common) >= listed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: set[tuple[int, int]] = set()
        for (listed, kind, _, _), rows in in_groups(batches, 4):
            size = min(len(r[6]) for r in rows)
            left, right = (blocks_of([r[1:] for r in rows if r[0] == side], size) for side in (0, 1))
            if kind == INSIDE and not right:
                pairs = ((x, y) for i, x in enumerate(left) for y in left[i:])
            else:
                pairs = ((x, y) for x in left for y in right)
            for x, y in pairs:
                if skipped(x, y, join):
                    continue
                new = {tuple(sorted((int(x.own[m]), int(y.own[n])))) for m, n in within_reach(x, y, join) if here_first(listed, x.carried[m], y.carried[n])}.difference(told)
                if new:
                    if len(told) > REMEMBERED:
                        told.clear()
                    told |= new
                    yield pa.RecordBatch.from_arrays([pa.array(list(v), pa.int64()) for v in zip(*new)], ["a", "b"])

    return dealt.select("list", "kind", "i", "j", "side", "class", "component", "place", "n", "common", "sketch", "carried").mapInArrow(run, "a long, b long")


def checked_broadcast(ids: DataFrame) -> DataFrame:
    """Few enough ids are broadcast."""
    return F.broadcast(ids) if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else ids


def linked(join: Join) -> F.Column:
    return 100 * F.col("common") >= join.percent * (F.col("na") + F.col("nb") - F.col("common"))


def groups(df: DataFrame, words: int = 3, percent: int = 90, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_shingles, component_id, one row for each row of ``df``."""
    spark, join = df.sparkSession, Join(words, percent)
    rows = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    with scratch(spark) as tables:
        in_list = Window.partitionBy("list", F.col("doc").isNull())
        found = indexed(rows, join).withColumns({"c0": F.min("class").over(in_list), "c1": F.max("class").over(in_list), "size": F.count(F.lit(1)).over(in_list)})
        found = tables.keep(found.filter(F.col("doc").isNotNull() | (F.col("c0") != F.col("c1"))).drop("c0", "c1"), "index")  # lists of one class are of no use
        index = found.filter(F.col("doc").isNotNull()).select("class", "doc.*")
        lists = found.filter(F.col("doc").isNull()).select("list", "class", "place", "size")
        classes = tables.keep(index.filter(F.col("class").isNotNull()).groupBy("class").agg(F.min("key").alias("key"), F.max("n").alias("n"), F.max("spare").alias("spare"), F.max("sketch").alias("sketch")), "classes")
        tables.free()
        links = tables.keep(class_links(rows, lists, classes, join, tables), "links")
        tables.free()
        found = components(links, tables)
        own = classes.join(found.withColumnRenamed("id", "class"), "class", "left").select("class", "key", F.coalesce("component", "class").alias("component"))
        smallest = own.groupBy("component").agg(F.min("key").alias("component_id"))
        named = own.join(smallest, "component").select("class", "component_id")
        out = index.select("key", "n", "class").join(named, "class", "left").select(F.col("key").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component_id", "key").alias("component_id"))
        return out.checkpoint()


def dealt_out(members: DataFrame) -> DataFrame:
    """kind, i, j, side for each member of a list: the parts in which it meets others.

    Members of the leader's component (inner) meet all others (outer), which meet each other too.
    A short list is one part.
    """
    cell = lambda kind, i, j, side: F.struct(F.lit(kind).cast("int").alias("kind"), i.cast("int").alias("i"), j.cast("int").alias("j"), side.cast("int").alias("side"))
    zero = F.lit(0)
    parts = lambda c: F.greatest(F.ceil(F.col(c) / LONG_LIST).cast("int"), F.lit(1))
    rows = members.withColumns({"_inner": parts("inner"), "_outer": parts("outer")})
    rows = rows.withColumn("_own", F.pmod(F.xxhash64("class"), F.when(F.col("is_inner"), F.col("_inner")).otherwise(F.col("_outer"))))
    own = F.col("_own")
    among = F.transform(F.sequence(zero, F.col("_outer") - 1), lambda t: cell(INSIDE, F.least(own, t), F.greatest(own, t), own > t))
    across = F.when(F.col("is_inner"), F.transform(F.sequence(zero, F.col("_outer") - 1), lambda t: cell(ACROSS, own, t, zero))).otherwise(F.transform(F.sequence(zero, F.col("_inner") - 1), lambda t: cell(ACROSS, t, own, F.lit(1))))
    long_ = F.when(F.col("is_inner"), across).otherwise(F.concat(across, among))
    return rows.withColumn("_cell", F.explode(F.when(F.col("size") > LONG_LIST, long_).otherwise(F.array(cell(INSIDE, zero, zero, zero))))).select("*", "_cell.*")


def class_links(rows: DataFrame, lists: DataFrame, classes: DataFrame, join: Join, tables: Scratch) -> DataFrame:
    """a, b: links between classes that connect all that any link connects."""
    in_list = Window.partitionBy("list")
    lists = lists.repartition("class").dropDuplicates(["class", "list"]).join(classes.select("class", "spare"), "class")  # equal sets of several tasks
    # a list's size is the same for all its sets, so of the lists that two sets share at most the spare ones of one of them go
    as_long = F.count(F.lit(1)).over(Window.partitionBy("class").orderBy(F.col("size").desc()).rangeBetween(Window.unboundedPreceding, 0))
    kept = lists.withColumn("as_long", as_long).filter((F.col("size") <= SMALL_LIST) | (F.col("as_long") > F.col("spare")))
    kept = kept.withColumn("degree", F.count(F.lit(1)).over(Window.partitionBy("class")))
    led = kept.select("list", "class", "place", "degree").withColumns({"first": F.max(F.struct("degree", "class")).over(in_list), "size": F.count(F.lit(1)).over(in_list)}).filter("size > 1")
    led = tables.keep(led.select("list", "class", "place", "size", F.col("first.class").alias("leader"), F.col("first.degree").alias("of_leader")), "led")
    first = led.filter("class <> leader").groupBy("class").agg(F.max(F.struct("of_leader", "leader")).alias("l")).select(F.col("l.leader").alias("a"), F.col("class").alias("b"))

    def compare(pairs: DataFrame) -> DataFrame:
        """The exact intersections of the pairs."""
        wanted = pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct()
        keys = tables.keep(classes.join(wanted, "class", "left_semi").select("key").distinct(), "keys")
        own = rows.join(checked_broadcast(keys), "key", "left_semi")
        if keys.filter("key is null").limit(1).count():  # a class of which no row has a key
            own = own.union(rows.filter("key is null"))
        sets = tables.keep(sets_of(own, join).join(wanted, "class", "left_semi"), "sets")
        return tables.keep(compared(pairs, sets), "compared")

    tables.free()
    exact = compare(tables.keep(near_by_sketch(first, classes, join), "first"))
    tables.free()
    links = exact.filter(linked(join)).select("a", "b")
    near = components(links, tables).withColumnRenamed("id", "class")
    members = led.join(near, "class", "left").withColumn("component", F.coalesce("component", "class"))
    inner = F.max(F.when(F.col("class") == F.col("leader"), F.col("component"))).over(in_list)
    open_ = members.withColumns({"c0": F.min("component").over(in_list), "c1": F.max("component").over(in_list), "inner": inner}).filter("c0 <> c1").drop("c0", "c1")
    open_ = open_.withColumn("is_inner", F.col("component") == F.col("inner"))
    open_ = tables.keep(open_.withColumn("inner", F.count_if("is_inner").over(in_list)).withColumn("outer", F.col("size") - F.col("inner")), "open")
    tables.free()
    two = open_.filter("size = 2").groupBy("list").agg(F.min("class").alias("a"), F.max("class").alias("b")).select("a", "b").distinct()
    open_ = open_.filter("size > 2")
    shared = exact.select(F.col("a").alias("leader"), F.col("b").alias("class"), "common")
    carried = open_.groupBy("class").agg(F.slice(F.array_sort(F.collect_list("list")), 1, CARRIED).alias("carried"))  # a set's lists
    known = classes.select("class", "n", "sketch").join(carried, "class")
    open_ = open_.join(shared, ["leader", "class"], "left").join(known, "class")
    open_ = open_.withColumn("common", F.when(F.col("class") == F.col("leader"), F.col("n")).otherwise(F.coalesce("common", F.lit(-1))))
    dealt = dealt_out(open_).repartition("list", "kind", "i", "j").sortWithinPartitions("list", "kind", "i", "j", "side")
    done = exact.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    second = near_by_sketch(two.join(done, ["a", "b"], "left_anti"), classes, join).union(candidates(dealt, join)).distinct()
    second = tables.keep(second.join(done, ["a", "b"], "left_anti"), "second")
    tables.free()
    if not second.limit(1).count():
        return links
    soon, others = derived(second, exact)
    links = links.union(tables.keep(soon, "derived").filter(linked(join)).select("a", "b"))
    others = tables.keep(others, "others")
    return links.union(compare(others).filter(linked(join)).select("a", "b")) if others.limit(1).count() else links
