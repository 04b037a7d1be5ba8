"""Byte-pair encoding and decoding by a contiguous rank array.

A word is held as two lists side by side: the ids of its parts, and the merge
rank of each part with its right neighbour. The smallest rank is found by a
scan, its boundary is deleted, and the two ranks beside it are refreshed. For
short words this beats any linked structure; words beyond ``LONG`` parts use a
heap over the same boundaries, which gives the same merges.

Defined results: null text is the empty text, which has no tokens and decodes to
the empty text; every input row gives one row, so repeated rows repeat; further
columns of the input are left out and can't clash.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .batches import sliced

NONE = 1 << 60
LONG = 96
#: Words whose tokens a worker remembers; beyond it the memory starts anew.
CACHED_WORDS = 200_000


def byte_letters() -> list[str]:
    """The printable letter of each byte in byte-level vocabularies."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    letters, spare = [], 0x100
    for byte in range(0x100):
        if byte in shown:
            letters.append(chr(byte))
        else:
            letters.append(chr(spare))
            spare += 1
    return letters


def lower_by_character(text: str) -> str:
    """Lower case that looks at one character at a time, so a final sigma stays a sigma."""
    return text.lower() if "Σ" not in text else "σ".join(part.lower() for part in text.split("Σ"))


@functools.cache
def newer_characters() -> re.Pattern:
    """Finds a character that Unicode 3.2 has not assigned; all tables agree on the classes of the others."""
    category, ranges, start = unicodedata.ucd_3_2_0.category, [], None
    for at in range(sys.maxunicode + 2):
        new = at <= sys.maxunicode and category(chr(at)) == "Cn"
        if new and start is None:
            start = at
        elif not new and start is not None:
            ranges.append(f"\\U{start:08x}-\\U{at - 1:08x}")
            start = None
    return re.compile(f"[{''.join(ranges)}]")


class WordBpe:
    """A tokenizer file of the word-end kind: NFC, white space folded, lower case, byte letters."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocabulary, self.suffix = model["vocab"], model["end_of_word_suffix"] or ""
        self.specials = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.tokens = [""] * (1 + max(*vocabulary.values(), *self.specials.values()))
        for token, at in [*vocabulary.items(), *self.specials.items()]:
            self.tokens[at] = token
        self.encoded_tokens = [t.encode() for t in self.tokens]
        letters = byte_letters()
        self.inner = [vocabulary[x] for x in letters]
        self.last = [vocabulary[x + self.suffix] for x in letters]
        self.ranks, self.merged = {}, []
        for rank, (left, right) in enumerate(model["merges"]):
            self.ranks[vocabulary[left], vocabulary[right]] = rank
            self.merged.append(vocabulary[left + right])
        split = next(x for x in spec["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"])
        self.special = regex.compile("|".join(regex.escape(x) for x in self.specials)) if self.specials else None
        self.path, self.library, self.newer = path, None, newer_characters()
        self.letter_bytes = {x: i for i, x in enumerate(letters)}
        self.known: dict[str, bytes] = {}

    def word(self, data: bytes) -> list[int]:
        """The ids of one word, given as UTF-8."""
        parts = [self.inner[x] for x in data]
        parts[-1] = self.last[data[-1]]
        if len(parts) > LONG:
            return self._long(parts)
        rank_of, merged = self.ranks.get, self.merged
        ranks = [rank_of(pair, NONE) for pair in zip(parts, parts[1:])]
        while ranks:
            lowest = min(ranks)
            if lowest == NONE:
                break
            at = ranks.index(lowest)
            parts[at] = merged[lowest]
            del parts[at + 1], ranks[at]
            if at:
                ranks[at - 1] = rank_of((parts[at - 1], parts[at]), NONE)
            if at < len(ranks):
                ranks[at] = rank_of((parts[at], parts[at + 1]), NONE)
        return parts

    def _long(self, parts: list[int]) -> list[int]:
        count = len(parts)
        following, before = [*range(1, count), -1], [-1, *range(count - 1)]
        heap = [(r, i) for i in range(count - 1) if (r := self.ranks.get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, at = heapq.heappop(heap)
            right = following[at]
            if parts[at] < 0 or right < 0 or self.ranks.get((parts[at], parts[right])) != rank:
                continue
            parts[at], parts[right] = self.merged[rank], -1
            following[at] = following[right]
            if following[at] >= 0:
                before[following[at]] = at
            for left in (before[at], at):
                if left >= 0 and following[left] >= 0 and (r := self.ranks.get((parts[left], parts[following[left]]))) is not None:
                    heapq.heappush(heap, (r, left))
        return [x for x in parts if x >= 0]

    def _split(self, text: str) -> list[str]:
        """The words of a text. Characters newer than the oldest Unicode tables go by the library's own tables."""
        if not self.newer.search(text):
            return self.words.findall(lower_by_character(unicodedata.normalize("NFC", text)))
        if self.library is None:
            self.library = Tokenizer.from_file(self.path)
        pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(map(self.letter_bytes.__getitem__, x)).decode() for x, _ in pieces]

    def _plain(self, text: str) -> bytes:
        known, found = self.known, self._split(text)
        for word in set(found).difference(known):
            if len(known) >= CACHED_WORDS:
                known.clear()
                for again in set(found):
                    known[again] = np.array(self.word(again.encode()), "<u4").tobytes()
                break
            known[word] = np.array(self.word(word.encode()), "<u4").tobytes()
        return b"".join(map(known.__getitem__, found))

    def encode(self, text: str) -> bytes:
        """The ids of a text, little-endian, 32 bits each."""
        if self.special is None or "<" not in text:
            return self._plain(text)
        out, end = [], 0
        for found in self.special.finditer(text):
            out += [self._plain(text[end : found.start()]), np.uint32(self.specials[found[0]]).tobytes()]
            end = found.end()
        return b"".join([*out, self._plain(text[end:])])

    def decode(self, ids: bytes) -> bytes:
        """The text of ids, special tokens included, as UTF-8: tokens with a space between."""
        return b" ".join(map(self.encoded_tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_codecs: dict[str, WordBpe] = {}


def codec(path: str) -> WordBpe:
    """One codec for each worker and file."""
    if path not in _codecs:
        _codecs[path] = WordBpe(path)
    return _codecs[path]


def encode_decode(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ids (binary: little-endian unsigned 32-bit integers), decoded (the text of these ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for batch in sliced(batches, 1):
            ids = [bpe.encode(x or "") for x in batch.column(1).to_pylist()]
            decoded = pa.array([bpe.decode(x) for x in ids], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary()), decoded], ["key", "ids", "decoded"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(run, f"key {kind}, ids binary, decoded string").withColumnRenamed("key", key)


def decode_ids(df: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """key, decoded: the text of each row's ids; null ids are none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for batch in sliced(batches, 1):
            decoded = pa.array([bpe.decode(x or b"") for x in batch.column(1).to_pylist()], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), decoded], ["key", "decoded"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("key"), F.col(ids).alias("ids")).mapInArrow(run, f"key {kind}, decoded string").withColumnRenamed("key", key)
