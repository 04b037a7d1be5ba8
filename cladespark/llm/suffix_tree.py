"""Language-model scores by a probabilistic suffix tree over words.

Symbols are words of ASCII-lower-cased text and one end at the end of each text. A
context is a run of up to ``DEPTH`` words. A run counts where it occurs LEAST times in
the training texts, at any size of corpus, so the tree grows with them. The tree grows
from its root: a context is retained if its suffix is and the distribution after it
diverges from that after its suffix by ``DIVERGENCE`` nats at least.

Next-symbol probabilities: (n(s, x) - DISCOUNT) / n(s) for symbols that count after s;
what is left goes to all others, in proportion to the suffix, and at the root to the
smoothed word counts (c + 0.1) / (N + 0.1 (V + 1)). Each text is scored from the longest
retained context before each symbol.

Texts are read once, into chunks of about CHUNK symbols, numbered within the chunk. From
then on chunks ask and stores answer: a chunk sends its distinct runs of a length, as
sorted and packed hashes with its own counts, to the stores of their ranges of hashes; a
store adds up what all chunks send and sends each chunk the sums, in the chunk's own
order. Longer runs are asked for only where both shorter ones count. In the same way one
chunk for each run (its owner) adds the run to its context's divergence, and chunks learn
which contexts are retained. No part of the tree is on the driver or broadcast, a hot run
is one number in each chunk, and a worker holds one chunk or one range of hashes.

Words are compared by 63 bits of a 64-bit hash, runs by 64 bits; sums of contexts and what
is left after them are sent in single precision.

Defined results: null text is empty and has the end alone; a null key is held out of
nothing and trains nothing (held_out null); repeated rows count and are scored each;
with no training text every word is unknown; further columns are left out.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import scratch
from .batches import WORD, remainder, sliced

DEPTH = 3
#: Occurrences that a run needs to count.
LEAST = 2
DIVERGENCE = 0.02
DISCOUNT = 0.5
SMOOTHING = 0.1
#: Stand for the end of a text: a word that none is, and its hash.
END, END_HASH = b"", 1
#: Symbols in a chunk, about: a text is in one chunk.
CHUNK = 1_200_000
#: Chunks for each range of hashes.
CHUNKS_TO_STORE = 3
#: What is sent besides counts of runs of k + 1 symbols (k): sums of contexts of k symbols (CONTEXTS + k).
CONTEXTS = 10
TRAINS, HELD, NEITHER = 0, 1, 2

_words = re.compile(WORD).findall


def word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) >> 1 if word else END_HASH


class Numbers(dict):
    """A number for each word, given when it is first asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def joined(runs: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """The hashes of runs with one more symbol each."""
    z = runs * np.uint64(0x9E3779B97F4A7C15) + symbols
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def packed(ordered: np.ndarray) -> bytes:
    """Rising 64-bit numbers as differences, of as many bytes as the largest needs."""
    steps = np.diff(ordered, prepend=np.uint64(0))
    width = max(1, (int(steps.max()).bit_length() + 7) // 8) if len(steps) else 1
    return bytes([width]) + np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    width = data[0]
    rows = np.frombuffer(data, np.uint8, offset=1).reshape(-1, width)
    out = np.zeros((len(rows), 8), np.uint8)
    out[:, :width] = rows
    return np.cumsum(out.view(np.uint64).ravel(), dtype=np.uint64)


def packed_counts(counts: np.ndarray) -> bytes:
    """A byte each, and 64-bit numbers for those that don't fit."""
    low = np.minimum(counts, 255).astype(np.uint8)
    return np.int64(len(counts)).tobytes() + low.tobytes() + counts[low == 255].astype(np.int64).tobytes()


def unpacked_counts(data: bytes) -> np.ndarray:
    count = int(np.frombuffer(data, np.int64, 1)[0])
    out = np.frombuffer(data, np.uint8, count, 8).astype(np.int64)
    out[out == 255] = np.frombuffer(data[8 + count :], np.int64)
    return out


def without_gaps(values: np.ndarray) -> bytes:
    """Single-precision numbers, of which nan takes a bit."""
    known = np.isfinite(values)
    return np.int64(len(values)).tobytes() + np.packbits(known).tobytes() + values[known].tobytes()


def with_gaps(data: bytes) -> np.ndarray:
    count = int(np.frombuffer(data, np.int64, 1)[0])
    size = 8 + (count + 7) // 8
    out = np.full(count, np.nan, np.float32)
    out[np.unpackbits(np.frombuffer(data, np.uint8, size - 8, 8), count=count).astype(bool)] = np.frombuffer(data[size:], np.float32)
    return out


def in_planes(ids: np.ndarray) -> bytes:
    """All low bytes, then all second ones and so on, which compress well."""
    return np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def chunks_of(documents: DataFrame) -> DataFrame:
    """chunk, ids (words of all texts, numbered in the chunk), words (their hashes), texts (length and state of each), keys."""
    key = documents.schema["key"].dataType.simpleString()
    names = ["chunk", "ids", "words", "texts", "keys"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        numbers = Numbers({END: 0})
        ids, lengths, states, keys, size = [], [], [], [], 0
        end = np.zeros(1, np.uint32)

        def flush() -> pa.RecordBatch:
            nonlocal made, size
            c = np.array([lengths, states], np.int64).tobytes()
            whole = pa.concat_arrays(keys)
            columns = [[(part << 32) + made], [in_planes(np.concatenate(ids))], [np.fromiter(map(word_hash, numbers), np.uint64, len(numbers)).tobytes()], [c]]
            out = [pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.binary(), pa.binary(), pa.binary()))]
            made, size = made + 1, 0
            for x in (ids, lengths, states, keys):
                x.clear()
            numbers.clear()
            numbers[END] = 0
            return pa.RecordBatch.from_arrays([*out, pa.ListArray.from_arrays(pa.array([0, len(whole)], pa.int32()), whole)], names)

        for batch in sliced(batches, 2):
            states += [NEITHER if x is None else HELD if x else TRAINS for x in batch.column(1).to_pylist()]
            keys.append(batch.column(0))
            for text in batch.column(2).to_pylist():
                own = _words((text or "").encode().lower())
                ids.append(np.fromiter(map(numbers.__getitem__, own), np.uint32, len(own)))
                ids.append(end)
                lengths.append(len(own) + 1)
                size += len(own) + 1
            if size >= CHUNK:
                yield flush()
        if size:
            yield flush()

    return documents.select("key", "held_out", "text").mapInArrow(run, f"chunk long, ids binary, words binary, texts binary, keys array<{key}>")


class Chunk:
    """The symbols of some texts and what stores have answered so far."""

    def __init__(self, own: tuple[bytes, bytes, bytes], answers: Iterable[tuple[int, int, bytes, bytes]], base: tuple[int, int]):
        """own: ids, words, texts; answers: level, bucket, a, b in any order; base: training tokens and distinct words."""
        self.ids, words = from_planes(own[0]), np.frombuffer(own[1], np.uint64)
        self.lengths, self.states = np.frombuffer(own[2], np.int64).reshape(2, -1)
        self.symbols = words[self.ids]
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.place = (np.arange(len(self.ids)) - np.repeat(self.starts, self.lengths)).astype(np.int32)
        self.trains = np.repeat(self.states == TRAINS, self.lengths)
        self.tokens, self.distinct = base
        self.answers: dict[int, list[tuple[bytes, bytes]]] = {}
        for level, _, a, b in sorted(answers, key=lambda x: x[:2]):
            self.answers.setdefault(level, []).append((a, b))
        order = np.argsort(words)
        rank = np.empty(len(words), np.int32)
        rank[order] = np.arange(len(words))
        #: Of each length of runs: where they end, their distinct hashes, and which of these each is.
        self.at, self.distinct_runs, self.which = [np.arange(len(self.ids), dtype=np.int32)], [words[order]], [rank[self.ids]]
        self.runs = self.symbols  # the longest so far, at each place
        self.counts: list[np.ndarray] = []  # at each place, of the run that ends there
        self.own: list[np.ndarray] = []
        self.left: list[np.ndarray] = []  # at each place, what is left after the context that ends there (log10), nan if it isn't retained

    @property
    def z(self) -> float:
        return self.tokens + SMOOTHING * (self.distinct + 1)

    def learn(self, counts: int, contexts: int) -> None:
        """Takes in the counts of runs of up to ``counts`` symbols and the contexts of up to ``contexts``. A chunk that asked nothing has no answer."""
        for k in range(counts):
            if k:
                self.find(k)
            answers = self.answers.get(k, [])
            n = [unpacked_counts(a) for a, _ in answers]
            own = [np.unpackbits(np.frombuffer(b, np.uint8), count=len(x)) for x, (_, b) in zip(n, answers)]
            self.own.append(np.concatenate([*own, np.zeros(0, np.uint8)]).astype(bool))
            here = np.zeros(len(self.ids), np.int64)
            here[self.at[k]] = np.concatenate([*n, np.zeros(0, np.int64)])[self.which[k]]
            self.counts.append(here)
            if 0 < k <= contexts:
                self._learn_contexts(k)

    def find(self, k: int) -> None:
        """Runs of k + 1 symbols of which both shorter ones count."""
        self.runs = joined(np.concatenate([np.zeros(1, np.uint64), self.runs[:-1]]), self.symbols)
        enough = self.counts[k - 1] >= LEAST
        at = np.flatnonzero(enough & np.concatenate([np.zeros(1, bool), enough[:-1]]) & (self.place >= k)).astype(np.int32)
        distinct, which = np.unique(self.runs[at], return_inverse=True)
        self.at.append(at)
        self.distinct_runs.append(distinct)
        self.which.append(which.astype(np.int32))

    def some(self, k: int) -> np.ndarray:
        """A place where each distinct run of k + 1 symbols ends."""
        out = np.empty(len(self.distinct_runs[k]), np.int32)
        out[self.which[k]] = self.at[k]
        return out

    def contexts(self, k: int) -> np.ndarray:
        """Which of the distinct runs of k symbols may be contexts: those that count after retained suffixes."""
        some = self.some(k - 1)
        may = self.counts[k - 1][some] >= LEAST
        return may if k == 1 else may & np.isfinite(self.left[k - 2][some])

    def _learn_contexts(self, k: int) -> None:
        of_run = np.full(len(self.distinct_runs[k - 1]), np.nan, np.float32)
        of_run[self.contexts(k)] = np.concatenate([with_gaps(a) for a, _ in self.answers.get(CONTEXTS + k, [])] + [np.zeros(0, np.float32)])
        left = np.full(len(self.ids), np.nan, np.float32)
        left[self.at[k - 1]] = of_run[self.which[k - 1]]
        self.left.append(left)

    def ask_counts(self, k: int) -> tuple[np.ndarray, Callable[[slice], bytes]]:
        """The distinct runs of k + 1 symbols, and how often training texts have them."""
        counts = np.bincount(self.which[k][self.trains[self.at[k]]], minlength=len(self.distinct_runs[k]))
        return self.distinct_runs[k], lambda part: packed_counts(counts[part])

    def ask_contexts(self, k: int) -> tuple[np.ndarray, Callable[[slice], bytes]]:
        """Runs of k symbols that may be contexts, and the sums over the runs that this chunk owns: divergence, p after them and p after their suffixes."""
        may = self.contexts(k)
        place = self.some(k)
        place = place[self.own[k] & (self.counts[k][place] >= LEAST)]
        of_run = np.cumsum(may) - 1
        context = np.empty(len(self.ids), np.int32)
        context[self.at[k - 1]] = self.which[k - 1]
        place = place[may[context[place - 1]]]
        total = self.counts[k - 1][place - 1]
        p = (self.counts[k][place] - DISCOUNT) / total
        before = (self.counts[0][place] + SMOOTHING) / self.z if k == 1 else (self.counts[k - 1][place] - DISCOUNT) / self.counts[k - 2][place - 1]
        at = of_run[context[place - 1]]
        size = int(may.sum())
        sums = np.stack([np.bincount(at, x, size) for x in (p * np.log(p / before), p, before)])
        some = sums[1] > 0

        def part(cut: slice) -> bytes:
            own = some[cut]
            return np.packbits(own).tobytes() + sums[:, cut][:, own].astype(np.float32).tobytes()

        return self.distinct_runs[k - 1][may], part

    def scores(self) -> tuple[np.ndarray, ...]:
        """Of each text: known words, base and score."""
        known = self.counts[0] if self.counts else np.zeros(len(self.ids), np.int64)
        score = np.log10((known + SMOOTHING) / self.z)
        base = np.add.reduceat(score, self.starts)
        going = np.ones(len(self.ids), bool)
        for k, left in enumerate(self.left, 1):
            before = np.concatenate([np.full(1, np.nan, np.float32), left[:-1]])
            going &= np.isfinite(before) & (self.place >= k)
            counted = going & (self.counts[k] >= LEAST)
            at = np.flatnonzero(counted)
            score = np.where(going, score + before, score)
            score[at] = np.log10((self.counts[k][at] - DISCOUNT) / self.counts[k - 1][at - 1])
        return np.add.reduceat((known > 0).astype(np.int64), self.starts), base, np.add.reduceat(score, self.starts)


def grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """The rows of each run of equal first columns, without these."""
    now, held = None, []
    for batch in batches:
        for i in range(batch.num_rows):
            row = tuple(c[i].as_py() for c in batch.columns)
            if row[:keys] != now:
                if held:
                    yield now, held
                now, held = row[:keys], []
            held.append(row[keys:])
    if held:
        yield now, held


SENT = "chunk long, kind int, bucket int, a binary, b binary"


def chunk_of(own: pa.Table, answers: pa.Table, base: tuple[int, int]) -> Chunk:
    columns = (answers.column(c).to_pylist() for c in ("level", "bucket", "a", "b"))
    return Chunk(tuple(own.column(c)[0].as_py() for c in ("ids", "words", "texts")), zip(*columns), base)


def with_answers(chunks: DataFrame, answers: list[DataFrame], run: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """Each chunk beside all answers to it. Chunks lie dealt, so only answers are shuffled."""
    rows = chunks.sparkSession.createDataFrame([], "chunk long, level int, bucket int, a binary, b binary")
    for found in answers:
        rows = rows.union(found.select("chunk", "level", "bucket", "a", "b"))
    return chunks.groupBy("chunk").cogroup(rows.groupBy("chunk")).applyInArrow(run, schema)


def sent(chunks: DataFrame, answers: list[DataFrame], known: int, counts: int | None, contexts: int | None, stores: int, base: tuple[int, int]) -> DataFrame:
    """What chunks ask for, in a row for each range of hashes: counts of runs, or sums of contexts. known: answers of counts so far."""
    width = (1 << 64) // stores + 1

    def run(own: pa.Table, found: pa.Table) -> pa.Table:
        number = own.column("chunk")[0].as_py()
        chunk = chunk_of(own, found, base)
        chunk.learn(known, contexts - 1 if contexts else 0)
        if counts:
            chunk.find(counts)
        asked = [(k, chunk.ask_counts(k)) for k in (counts,) if k is not None] + [(CONTEXTS + k, chunk.ask_contexts(k)) for k in (contexts,) if k is not None]
        columns: list[list] = [[], [], [], [], []]
        for kind, (hashes, part) in asked:
            cuts = np.searchsorted(hashes, np.array([width * i for i in range(stores)], np.uint64)).tolist() + [len(hashes)]
            for i, (x, y) in enumerate(zip(cuts, cuts[1:])):
                if y > x:
                    for column, value in zip(columns, (number, kind, i, packed(hashes[x:y]), part(slice(x, y)))):
                        column.append(value)
        return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))], ["chunk", "kind", "bucket", "a", "b"])

    return with_answers(chunks.select("chunk", "ids", "words", "texts"), answers, run, SENT)


def add_counts(rows: list[tuple], least: int) -> Iterator[tuple[int, bytes, bytes, int, int]]:
    """For each chunk: the sums of its runs (0 if they don't count), which of them it owns, its own count of all and how many it owns."""
    hashes = np.concatenate([unpacked(a) for _, a, _ in rows])
    own = [unpacked_counts(b) for _, _, b in rows]
    counts = np.concatenate(own)
    order = np.argsort(hashes, kind="stable")
    first = np.flatnonzero(np.concatenate([np.ones(1, bool), np.diff(hashes[order]) != 0]))
    sums = np.add.reduceat(counts[order], first)
    total = np.empty(len(hashes), np.int64)
    total[order] = np.repeat(sums, np.diff(np.append(first, len(hashes))))
    total[total < least] = 0
    owner = np.zeros(len(hashes), bool)
    owner[order[first]] = True
    owner &= total > 0
    start = 0
    for (chunk, _, _), x in zip(rows, own):
        part = slice(start, start + len(x))
        yield chunk, packed_counts(total[part]), np.packbits(owner[part]).tobytes(), int(x.sum()), int(owner[part].sum())
        start += len(x)


def add_contexts(rows: list[tuple]) -> Iterator[tuple[int, bytes, bytes, int, int]]:
    """For each chunk: what is left after each of its contexts (log10), nan for those that aren't retained."""
    asked = [unpacked(a) for _, a, _ in rows]
    hashes = np.unique(np.concatenate(asked))
    sums = np.zeros((3, len(hashes)))
    at = [np.searchsorted(hashes, x) for x in asked]
    for (_, _, b), x in zip(rows, at):
        size = (len(x) + 7) // 8
        some = np.unpackbits(np.frombuffer(b[:size], np.uint8), count=len(x)).astype(bool)
        sums[:, x[some]] += np.frombuffer(b[size:], np.float32).reshape(3, -1)
    rest, before = (np.maximum(1e-9, 1 - x) for x in sums[1:])
    retained = (sums[0] + rest * np.log(rest / before) >= DIVERGENCE) & (sums[1] > 0)
    left = np.where(retained, np.log10(rest / before), np.nan).astype(np.float32)
    for (chunk, _, _), x in zip(rows, at):
        yield chunk, without_gaps(left[x]), b"", 0, 0


def answered(asked: DataFrame) -> DataFrame:
    """chunk, level, bucket, a, b, total, owned: the answers of stores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (kind, bucket), held in grouped(batches, 2):
            for chunk, a, b, total, owned in add_contexts(held) if kind > CONTEXTS else add_counts(held, LEAST if kind else 1):
                columns = [[chunk], [kind], [bucket], [a], [b], [total], [owned]]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64()))], ["chunk", "level", "bucket", "a", "b", "total", "owned"])

    dealt = asked.repartition("kind", "bucket").sortWithinPartitions("kind", "bucket", "chunk").select("kind", "bucket", "chunk", "a", "b")
    return dealt.mapInArrow(run, "chunk long, level int, bucket int, a binary, b binary, total long, owned long")


def scored(chunks: DataFrame, answers: list[DataFrame], base: tuple[int, int], kind: str) -> DataFrame:
    """key, state, n_tokens, n_known, base, score of each text."""

    def run(own: pa.Table, found: pa.Table) -> pa.Table:
        chunk = chunk_of(own, found, base)
        chunk.learn(DEPTH + 1 if base[0] else 1, DEPTH if base[0] else 0)
        known, low, high = chunk.scores()
        keys = own.column("keys").combine_chunks().flatten()
        return pa.Table.from_arrays([keys, pa.array(chunk.states), pa.array(chunk.lengths), pa.array(known), pa.array(low), pa.array(high)], ["key", "state", "n_tokens", "n_known", "base", "score"])

    return with_answers(chunks, answers, run, f"key {kind}, state long, n_tokens long, n_known long, base double, score double")


def score_texts(documents: DataFrame, divisor: int = 10, held: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score, score, a row for each row.

    Held out are keys whose crc32 as text, modulo ``divisor``, is ``held``; all others train.
    """
    spark = documents.sparkSession
    kind = documents.schema[key].dataType.simpleString()
    texts = documents.select(F.col(key).alias("key"), (remainder(F.col(key), divisor) == held).alias("held_out"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    with scratch(spark) as tables:
        chunks = tables.keep_dealt(chunks_of(texts), "chunk", int(spark.conf.get("spark.sql.shuffle.partitions")))
        stores = max(2, -(-chunks.count() // CHUNKS_TO_STORE))
        answers = [tables.keep(answered(sent(chunks, [], 0, 0, None, stores, (0, 0))), "answers")]
        tokens, distinct = answers[0].agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("owned"), F.lit(0))).first()
        base = (int(tokens), int(distinct))
        for k in range(1, DEPTH + 2 if tokens else 1):
            tables.free()
            answers.append(tables.keep(answered(sent(chunks, answers, k, k if k <= DEPTH else None, k - 1 if k > 1 else None, stores, base)), "answers"))
        tables.free()
        rows = scored(chunks, answers, base, kind)
        out = rows.select(
            F.col("key").cast(kind).alias(key), F.when(F.col("state") != NEITHER, F.col("state") == HELD).alias("held_out"), "n_tokens", "n_known", F.lit(base[0]).cast("long").alias("train_tokens"),
            F.col("base").alias("base_score"), "score",
        )
        return out.checkpoint()
