"""Aligned reads in BAM files, as a Spark data source that reads and writes.

    reach_workers(spark); spark.dataSource.register(BamSource)
    spark.read.format("bam").load(folder)                      # or ``reads(spark, folder)``
    write_reads(df, folder, {"chr1": 248956422})

Reading. A file is cut into byte ranges (option ``split``), of which a task takes one, or as many small ones as make some MB; a range owns the records that start between two places of its
own finding: the first record start at or after the start of its range, and that of the next range. With an index (.bai beside
the file) both come from the index; without one they are sought in the text, where a start is what the format's own
rules hold for in a run of records. A task follows the records from one place to the other and raises an error if the last
one doesn't end exactly there. So, the first range starting behind the heading, a file that reads without error has given every
record once. Neither the driver nor a task reads a whole file, but a task reads the heading and the index.

Option ``regions`` (JSON: a list of [chromosome, start, end]) gives the reads that overlap one of them; with an index only
the blocks that its linear part names for them are read. Files without records give no rows.

Fields are decoded for many records at once; only the step from record to record is a loop. Records with the read group tag have that as
their sample, others the file's name up to its first dot.

Writing. Each task writes a file of its own, with heading, and with an index if its rows are in order and short of 2^29; files are
named by task attempts, and moved to their place when all are written.
"""

from __future__ import annotations

import dataclasses
import json
import re
import struct
import uuid
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, WriterCommitMessage
from pyspark.sql.types import StructType

from .. import reach_workers
from .bgzf import END_OF_FILE, LARGEST_BLOCK, PAYLOAD, BlockFile, Range, block, listed, opened, ranges

SCHEMA = "file string, sample string, name string, flag int, chrom string, ref_start int, ref_end int, mapq int, read_group string"
SPLIT = 64 << 20
#: Text that is decoded at once, records in a run that tell a start, and the largest record that is taken for one.
AT_ONCE, RUN, LARGEST_RECORD = 4 << 20, 12, 1 << 26
WINDOW = 14  # fixed by the format: the linear index has windows of 2^14 bases
SKIPS = {"A": 1, "c": 1, "C": 1, "s": 2, "S": 2, "i": 4, "I": 4, "f": 4}  # fixed by the format: sizes of tag values
OPERATIONS = "MIDNSHP=X"  # fixed by the format
ON_REFERENCE = np.isin(np.arange(16), [0, 2, 3, 7, 8])  # M, D, N, =, X


@dataclasses.dataclass
class Heading:
    names: list[str]
    lengths: np.ndarray
    end: int  # virtual offset of the first record


def heading(file: BlockFile) -> Heading:
    """The reference sequences of a file; ``end`` is where the first record starts: block place << 16 | place in its text."""
    text, places = b"", []

    def more(size: int) -> None:
        nonlocal text
        while len(text) < size:
            at, _, data = next(source)
            places.append((len(text), at))
            text += data

    source = file.blocks(0)
    more(8)
    if text[:4] != b"BAM\x01":
        raise ValueError(f"{file.path} is no BAM file")
    at = 8 + struct.unpack_from("<i", text, 4)[0]
    more(at + 4)
    count, at = struct.unpack_from("<i", text, at)[0], at + 4
    names, lengths = [], []
    for _ in range(count):
        more(at + 4)
        length = struct.unpack_from("<i", text, at)[0]
        more(at + 8 + length)
        names.append(text[at + 4 : at + 3 + length].decode())
        lengths.append(struct.unpack_from("<i", text, at + 4 + length)[0])
        at += 8 + length
    start, place = max(p for p in places if p[0] <= at)
    if at == len(text):  # the next block's first byte
        return Heading(names, np.array(lengths, np.int64), next((b for b, _, _ in source), file.size) << 16)
    return Heading(names, np.array(lengths, np.int64), place << 16 | at - start)


def linear_index(path: str) -> list[list[int]] | None:
    """By reference, the virtual offset of the first record that overlaps each window; None where there is no index."""
    for name in (path + ".bai", re.sub(r"\.bam$", "", path) + ".bai"):
        system, inner = opened(name)
        if system.get_file_info(inner).is_file:
            with system.open_input_stream(inner) as stream:
                data = stream.read()
            break
    else:
        return None
    if data[:4] != b"BAI\x01":
        raise ValueError(f"{name} is no index")
    count, at, found = struct.unpack_from("<i", data, 4)[0], 8, []
    for _ in range(count):
        bins, at = struct.unpack_from("<i", data, at)[0], at + 4
        for _ in range(bins):
            at += 8 + 16 * struct.unpack_from("<i", data, at + 4)[0]
        windows, at = struct.unpack_from("<i", data, at)[0], at + 4
        found.append(list(struct.unpack_from(f"<{windows}Q", data, at)))
        at += 8 * windows
    return found


def plausible(text: bytes, lengths: np.ndarray) -> np.ndarray:
    """Places of a text where the fixed fields are those of a record."""
    count = len(text) - 36
    if count <= 0:
        return np.zeros(0, np.int64)
    data = np.frombuffer(text, np.uint8)
    number = lambda shift: np.lib.stride_tricks.as_strided(data[shift:].view(), (count, 4), (1, 1)).copy().view("<i4").ravel().astype(np.int64)
    size, ref, pos, flag_cigar, length, next_ref, next_pos = (number(s) for s in (0, 4, 8, 16, 20, 24, 28))
    name, cigar = data[12 : 12 + count].astype(np.int64), flag_cigar & 0xFFFF
    most = np.append(lengths, 0)  # place -1: none
    known = lambda r: (r >= -1) & (r < len(lengths))
    ok = (size >= 32) & (size <= LARGEST_RECORD) & known(ref) & known(next_ref) & (name > 0) & (length >= 0) & (pos >= -1) & (next_pos >= -1)
    at = np.flatnonzero(ok)
    fits = 32 + name[at] + 4 * cigar[at] + (length[at] + 1) // 2 + length[at] <= size[at]
    inside = ((ref[at] < 0) | (pos[at] < most[ref[at]])) & ((next_ref[at] < 0) | (next_pos[at] < most[next_ref[at]]))
    return at[fits & inside]


def named(text: bytes, at: int) -> bool:
    """Whether the name of the record there is printable and ends."""
    length = text[at + 12]
    name = text[at + 36 : at + 36 + length]
    return len(name) == length and name[-1] == 0 and all(33 <= c <= 126 for c in name[:-1])


def sought(file: BlockFile, lengths: np.ndarray, start: int) -> int:
    """Virtual offset of the first record start in blocks that start at or after a byte, or the end of the file."""
    text, places = b"", []
    for place, _, data in file.blocks(file.first_block(start)):
        places.append((len(text), place))
        text += data
        if len(text) < AT_ONCE // 4:
            continue
        if (found := run_start(text, lengths, False)) is not None:
            return virtual(places, found)
        if len(text) > 4 * LARGEST_RECORD:
            raise ValueError(f"no record starts after byte {start} of {file.path}")
    found = run_start(text, lengths, True)
    return file.size << 16 if found is None else virtual(places, found)


def virtual(places: list[tuple[int, int]], at: int) -> int:
    start, place = places[bisect_left(places, (at + 1,)) - 1]
    return place << 16 | at - start


def run_start(text: bytes, lengths: np.ndarray, ends: bool) -> int | None:
    """The first place from which RUN records follow each other, or fewer that end where the file does."""
    places = plausible(text, lengths)
    known = set(places.tolist())
    for first in places.tolist():
        at, seen = first, 0
        while seen < RUN and at in known and named(text, at):
            at, seen = at + 4 + struct.unpack_from("<i", text, at)[0], seen + 1
        if seen == RUN or ends and seen and at == len(text):
            return first
    return None


def bound(file: BlockFile, head: Heading, index: list[list[int]] | None, start: int) -> int:
    """Virtual offset of the first record that the range from ``start`` owns; the same for all who ask."""
    if start <= head.end >> 16:
        return head.end
    if start >= file.size:
        return file.size << 16
    if index is not None:
        offsets = sorted({o for windows in index for o in windows if o})  # windows without reads may have 0
        at = bisect_left(offsets, start << 16)
        return offsets[at] if at < len(offsets) else file.size << 16
    return sought(file, head.lengths, start)


def chunks(file: BlockFile, start: int, end: int) -> Iterator[tuple[bytes, list[int], int]]:
    """Texts of whole records from one virtual offset to the other, the places where these start, and the offset behind the last one."""
    rest, marks, last = b"", [], end >> 16
    for place, after, data in file.blocks(start >> 16):
        if place > last or place == last and not end & 0xFFFF:
            break
        low = start & 0xFFFF if place == start >> 16 else 0
        marks.append((len(rest) - low, place))
        rest += data[low : end & 0xFFFF] if place == last else data[low:]
        if len(rest) >= AT_ONCE:
            places, at = starts(rest)
            if places:
                yield rest[:at], places, virtual(marks, at) if at < len(rest) else after << 16
            rest, marks = rest[at:], [(p - at, b) for p, b in marks if b == place or p > at - LARGEST_BLOCK]
    places, at = starts(rest)
    if places:
        yield rest[:at], places, end
    if at < len(rest):
        raise ValueError(f"records of {file.path} don't end at virtual offset {end}")


def starts(text: bytes) -> tuple[list[int], int]:
    """Where whole records start, and where the last one ends."""
    places, at, read = [], 0, struct.Struct("<i").unpack_from
    while at + 4 <= len(text):
        size = read(text, at)[0]
        if size < 32:
            raise ValueError("a record is shorter than its fixed fields")
        if at + 4 + size > len(text):
            break
        places.append(at)
        at += 4 + size
    return places, at


def read_group(text: bytes, at: int, end: int) -> str | None:
    """The RG tag among the tags from one place to another."""
    while at + 3 <= end:
        tag, kind = text[at : at + 2], chr(text[at + 2])
        at += 3
        if kind in "ZH":
            stop = text.index(b"\0", at)
            if tag == b"RG":
                return text[at:stop].decode()
            at = stop + 1
        elif kind == "B":
            at += 5 + SKIPS[chr(text[at])] * struct.unpack_from("<i", text, at + 1)[0]
        else:
            at += SKIPS[kind]
    return None


def gathered(data: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Places of the bytes of many stretches, one stretch behind the other."""
    return np.repeat(begin - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))


def strings(data: np.ndarray, begin: np.ndarray, end: np.ndarray, known: np.ndarray | None = None) -> pa.Array:
    """The texts between these places; null where not ``known``."""
    length = end - begin if known is None else np.where(known, end - begin, 0)
    offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
    bits = None if known is None else pa.py_buffer(np.packbits(known, bitorder="little").tobytes())
    out = pa.StringArray.from_buffers(len(begin), pa.py_buffer(offsets), pa.py_buffer(data[gathered(data, begin, length)]), bits)
    out.validate(full=True)  # names must be UTF-8
    return out


def read_groups(text: bytes, tags: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The RG tag of each record; at once where it is the first tag or there is none."""
    data = np.frombuffer(text, np.uint8)
    room = ends - tags >= 4
    first = room.copy()
    for at, letter in enumerate(b"RGZ"):
        first[room] &= data[tags[room] + at] == letter
    zeros = np.flatnonzero(data == 0)
    stop = np.append(zeros, len(data))[np.searchsorted(zeros, tags + 3)]
    found = strings(data, tags + 3, stop, first & (stop < ends))
    others = np.flatnonzero(~first & (ends - tags >= 3))
    if len(others):
        found = found.to_pylist()
        for i in others.tolist():
            found[i] = read_group(text, int(tags[i]), int(ends[i]))
        found = pa.array(found, pa.string())
    return found


def decoded(text: bytes, places: list[int], head: Heading) -> dict[str, np.ndarray]:
    """Fields of the records at these places, many at once."""
    data, at = np.frombuffer(text, np.uint8), np.array(places, np.int64)
    fixed = data[at[:, None] + np.arange(36)]
    whole = lambda a, b, kind: fixed[:, a:b].copy().view(kind).ravel().astype(np.int64)
    size, ref, pos, n_cigar, flag, length = whole(0, 4, "<i4"), whole(4, 8, "<i4"), whole(8, 12, "<i4"), whole(16, 18, "<u2"), whole(18, 20, "<u2"), whole(20, 24, "<i4")
    n_name = fixed[:, 12].astype(np.int64)
    begin = at + 36 + n_name
    covered = np.zeros(len(at), np.int64)
    total = int(n_cigar.sum())
    if total:
        row = np.repeat(np.arange(len(at)), n_cigar)
        nth = np.arange(total) - np.repeat(np.cumsum(n_cigar) - n_cigar, n_cigar)
        operation = data[(begin[row] + 4 * nth)[:, None] + np.arange(4)].copy().view("<u4").ravel()
        np.add.at(covered, row, np.where(ON_REFERENCE[operation & 15], operation >> 4, 0).astype(np.int64))
    tags = begin + 4 * n_cigar + (length + 1) // 2 + length
    return {"ref": ref, "pos": pos, "flag": flag, "mapq": fixed[:, 13].astype(np.int64), "covered": covered, "name_end": begin - 1, "tags": tags, "end": at + 4 + size, "at": at}


def apart(regions: list[tuple[str, int, int]]) -> dict[str, np.ndarray]:
    """By chromosome, starts and ends (rows) of the regions, those that touch as one, in order."""
    found: dict[str, list[list[int]]] = {}
    for chrom, start, end in sorted(regions):
        own = found.setdefault(chrom, [])
        if own and start <= own[-1][1]:
            own[-1][1] = max(own[-1][1], end)
        else:
            own.append([start, end])
    return {c: np.array(r, np.int64).T for c, r in found.items()}


class BamReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.split = options["path"], int(options.get("split", SPLIT))
        self.regions = apart([(c, int(a), int(b)) for c, a, b in json.loads(options["regions"])]) if "regions" in options else None

    def partitions(self) -> list[Range]:
        return ranges(listed(self.path, ".bam"), self.split)

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        with BlockFile(partition.path) as file:
            head, index = heading(file), linear_index(partition.path)
            bounds = [bound(file, head, index, at) for at in partition.bounds]
            for at, high in zip(bounds, bounds[1:]):
                yield from self.between(file, head, index, partition.path, at, high)

    def between(self, file: BlockFile, head: Heading, index: list[list[int]] | None, path: str, at: int, high: int) -> Iterator[pa.RecordBatch]:
        """The records of one range."""
        if self.regions is None or index is None:
            for text, places, _ in chunks(file, at, high):
                yield self.batch(path, text, places, head)
        else:
            for ref, name in enumerate(head.names):
                for start, end in self.regions.get(name, np.zeros((2, 0), np.int64)).T.tolist():
                    # the first read of this or a later window: none before it reaches the region
                    at = max(at, next((o for o in index[ref][start >> WINDOW :] if o), 0))
                    if not any(index[ref][start >> WINDOW :]) or at >= high:
                        continue
                    for text, places, after in chunks(file, at, high):
                        yield self.batch(path, text, places, head)
                        at = after
                        if struct.unpack_from("<Ii", text, places[-1] + 4) >= (ref, end):  # reads are in order, those without a place last
                            break

    def batch(self, path: str, text: bytes, places: list[int], head: Heading) -> pa.RecordBatch:
        found = decoded(text, places, head)
        ref, pos, covered = found["ref"], found["pos"], found["covered"]
        placed = (ref >= 0) & (pos >= 0)
        ends = placed & (covered > 0)
        if self.regions is not None:
            keep = np.zeros(len(ref), bool)
            for number, name in enumerate(head.names):
                if name in self.regions:
                    begins, ends_of = self.regions[name]
                    own = np.flatnonzero((ref == number) & placed)
                    nth = np.searchsorted(ends_of, pos[own], "right")
                    keep[own] = (nth < len(begins)) & (begins[np.minimum(nth, len(begins) - 1)] < pos[own] + np.maximum(covered[own], 1))
            found, placed, ends = {k: v[keep] for k, v in found.items()}, placed[keep], ends[keep]
            ref, pos, covered = found["ref"], found["pos"], found["covered"]
        groups = read_groups(text, found["tags"], found["end"])
        stem = path.rsplit("/", 1)[-1].split(".")[0]
        columns = [
            pa.array([path], pa.string()).take(pa.array(np.zeros(len(ref), np.int64))),
            groups.fill_null(stem),
            strings(np.frombuffer(text, np.uint8), found["at"] + 36, found["name_end"]),
            pa.array(found["flag"], pa.int32()),
            pa.array(head.names, pa.string()).take(pa.array(ref, pa.int64(), mask=ref < 0)),
            pa.array(pos, pa.int32(), mask=~placed),
            pa.array(pos + covered, pa.int32(), mask=~ends),
            pa.array(found["mapq"], pa.int32()),
            groups,
        ]
        return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in SCHEMA.split(", ")])


def bin_of(start: int, end: int) -> int:
    """The smallest bin of the format's six levels that holds an interval."""
    for level, shift in ((5, 14), (4, 17), (3, 20), (2, 23), (1, 26)):
        if start >> shift == (end - 1) >> shift:
            return ((1 << 3 * level) - 1) // 7 + (start >> shift)
    return 0


def record(name: str, flag: int, ref: int, start: int, end: int, mapq: int, cigar: str | None, group: str | None) -> bytes:
    """One read without bases."""
    called = name.encode() + b"\0"
    steps = [(int(n), OPERATIONS.index(o)) for n, o in re.findall(r"(\d+)([MIDNSHP=X])", cigar)] if cigar else [(end - start, 0)] if ref >= 0 and end > start else []
    tags = b"RGZ" + group.encode() + b"\0" if group is not None else b""
    body = struct.pack("<iiBBHHHiiii", ref, start, len(called), mapq, bin_of(max(start, 0), max(end, start + 1, 1)), len(steps), flag, 0, -1, -1, 0) + called + struct.pack(f"<{len(steps)}I", *(n << 4 | o for n, o in steps)) + tags
    return struct.pack("<i", len(body)) + body


def bins_of(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """``bin_of`` for many intervals."""
    out = np.zeros(len(start), np.int64)
    for level, shift in ((1, 26), (2, 23), (3, 20), (4, 17), (5, 14)):
        out = np.where(start >> shift == end - 1 >> shift, ((1 << 3 * level) - 1) // 7 + (start >> shift), out)
    return out


FIXED = np.dtype([("size", "<i4"), ("ref", "<i4"), ("pos", "<i4"), ("name", "u1"), ("mapq", "u1"), ("bin", "<u2"), ("steps", "<u2"), ("flag", "<u2"), ("length", "<i4"), ("next_ref", "<i4"), ("next_pos", "<i4"), ("span", "<i4")])


def records(names: pa.Array, flag: np.ndarray, ref: np.ndarray, start: np.ndarray, end: np.ndarray, mapq: np.ndarray, groups: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and sizes of many reads as ``record`` makes them, without cigar strings."""
    for what, values, most in (("a flag", flag, 1 << 16), ("a mapping quality", mapq, 1 << 8), ("a position", np.maximum(start, end), 1 << 31)):
        if len(values) and (values.max() >= most or values.min() < (-1 if most == 1 << 31 else 0)):
            raise ValueError(f"{what} doesn't fit the format")
    texts = {}
    for kind, values in (("name", names), ("group", groups)):
        values = values.cast(pa.large_binary())
        length = pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        given = pc.is_valid(values).to_numpy(zero_copy_only=False)
        texts[kind] = (np.frombuffer(b"".join(pc.fill_null(values, b"").to_pylist()), np.uint8), length, given)
    (name, n_name, _), (group, n_group, grouped) = texts["name"], texts["group"]
    if len(n_name) and n_name.max() > 254:
        raise ValueError("a read's name has more than 254 bytes")
    steps = ((ref >= 0) & (end > start)).astype(np.int64)
    sizes = 36 + n_name + 1 + 4 * steps + np.where(grouped, n_group + 4, 0)
    at = np.cumsum(sizes) - sizes
    fixed = np.zeros(len(ref), FIXED)
    for column, values in (("size", sizes - 4), ("ref", ref), ("pos", start), ("name", n_name + 1), ("mapq", mapq), ("bin", bins_of(np.maximum(start, 0), np.maximum(np.maximum(end, start + 1), 1)) & 0xFFFF), ("steps", steps), ("flag", flag), ("next_ref", -1), ("next_pos", -1)):
        fixed[column] = values
    out = np.zeros(int(sizes.sum()), np.uint8)
    out[at[:, None] + np.arange(36)] = fixed.view(np.uint8).reshape(-1, 36)
    out[gathered(out, at + 36, n_name)] = name
    own = np.flatnonzero(steps)
    out[(at + 37 + n_name)[own, None] + np.arange(4)] = ((end - start)[own] << 4).astype("<u4").view(np.uint8).reshape(-1, 4)
    tags = at + 37 + n_name + 4 * steps
    out[tags[grouped, None] + np.arange(3)] = np.frombuffer(b"RGZ", np.uint8)
    out[gathered(out, tags + 3, n_group)] = group
    return out, sizes


class Output:
    """A BAM file and its index as they grow."""

    def __init__(self, references: dict[str, int], stream):  # noqa: ANN001
        self.stream, self.place, self.held = stream, 0, bytearray()
        self.bins: list[dict[int, list[list[int]]]] = [{} for _ in references]
        self.windows: list[dict[int, int]] = [{} for _ in references]
        self.last, self.ordered = (0, 0), True
        lines = "@HD\tVN:1.6\tSO:coordinate\n" + "".join(f"@SQ\tSN:{n}\tLN:{m}\n" for n, m in references.items())
        self.add(b"BAM\x01" + struct.pack("<i", len(lines)) + lines.encode() + struct.pack("<i", len(references)) + b"".join(struct.pack("<i", len(n.encode()) + 1) + n.encode() + b"\0" + struct.pack("<i", m) for n, m in references.items()))
        self.flush()

    def flush(self) -> None:
        while self.held:
            data = block(self.held[:PAYLOAD])
            self.stream.write(data)
            self.place, self.held = self.place + len(data), self.held[PAYLOAD:]

    def add(self, data: bytes) -> None:
        if self.held and len(self.held) + len(data) > PAYLOAD:
            self.flush()
        self.held += data

    def read(self, ref: int, start: int, end: int, data: bytes) -> None:
        if self.held and len(self.held) + len(data) > PAYLOAD:
            self.flush()
        begin = self.place << 16 | len(self.held)
        self.held += data
        if len(self.held) > PAYLOAD:
            self.flush()
        key = (ref if ref >= 0 else 1 << 31, start)
        self.ordered &= key >= self.last and end < 1 << 29
        self.last = key
        if ref >= 0 and start >= 0 and self.ordered:
            stop = self.place << 16 | len(self.held)
            parts = self.bins[ref].setdefault(bin_of(start, max(end, start + 1)), [])
            if parts and parts[-1][1] == begin:
                parts[-1][1] = stop
            else:
                parts.append([begin, stop])
            for window in range(start >> WINDOW, (max(end, start + 1) - 1 >> WINDOW) + 1):
                self.windows[ref].setdefault(window, begin)

    def reads(self, ref: np.ndarray, start: np.ndarray, end: np.ndarray, data: np.ndarray, sizes: np.ndarray) -> None:
        """As ``read``, for many records that lie one behind the other."""
        upto = np.cumsum(sizes)
        begin, stop = (np.zeros(len(sizes), np.int64) for _ in range(2))
        at = 0
        while at < len(sizes):
            before = int(upto[at - 1]) if at else 0
            after = int(np.searchsorted(upto, before + PAYLOAD - len(self.held), "right"))  # those that fit the block
            if after == at:
                if self.held:
                    self.flush()
                    continue
                after = at + 1  # larger than a block
            own = upto[at:after] - before + len(self.held)
            begin[at:after], stop[at:after] = self.place << 16 | own - sizes[at:after], self.place << 16 | own
            self.held += data[before : upto[after - 1]].tobytes()
            if len(self.held) > PAYLOAD:
                self.flush()
                stop[after - 1] = self.place << 16 | len(self.held)
            at = after
        first = np.where(ref >= 0, ref, 1 << 31)
        keys = [self.last, *((int(first[i]), int(start[i])) for i in (0, -1))]
        self.ordered = self.ordered and keys[0] <= keys[1] and not ((first[1:] < first[:-1]) | (first[1:] == first[:-1]) & (start[1:] < start[:-1])).any() and not (end >= 1 << 29).any()
        self.last = keys[2]
        placed = np.flatnonzero((ref >= 0) & (start >= 0))
        if not self.ordered or not len(placed):
            return
        ref, start, end, begin, stop = (x[placed] for x in (ref, start, np.maximum(end, start + 1), begin, stop))
        bins = bins_of(start, end)
        turn = np.flatnonzero(np.concatenate([[True], (ref[1:] != ref[:-1]) | (bins[1:] != bins[:-1]) | (begin[1:] != stop[:-1])]))
        for i, j in zip(turn.tolist(), np.append(turn[1:], len(ref)).tolist()):
            parts = self.bins[ref[i]].setdefault(int(bins[i]), [])
            if parts and parts[-1][1] == begin[i]:
                parts[-1][1] = int(stop[j - 1])
            else:
                parts.append([int(begin[i]), int(stop[j - 1])])
        low, high = start >> WINDOW, end - 1 >> WINDOW
        which = np.repeat(np.arange(len(ref)), high - low + 1)
        window = low[which] + np.arange(len(which)) - np.repeat(np.cumsum(high - low + 1) - (high - low + 1), high - low + 1)
        _, firsts = np.unique(ref[which] << 32 | window, return_index=True)
        for i in firsts.tolist():
            self.windows[ref[which[i]]].setdefault(int(window[i]), int(begin[which[i]]))

    def close(self) -> bytes | None:
        """Ends the file; its index, if it can have one."""
        self.flush()
        self.stream.write(END_OF_FILE)
        self.stream.close()
        if not self.ordered:
            return None
        out = b"BAI\x01" + struct.pack("<i", len(self.bins))
        for bins, windows in zip(self.bins, self.windows):
            out += struct.pack("<i", len(bins)) + b"".join(struct.pack("<Ii", b, len(parts)) + b"".join(struct.pack("<QQ", *p) for p in parts) for b, parts in sorted(bins.items()))
            count = max(windows, default=-1) + 1
            out += struct.pack(f"<i{count}Q", count, *(windows.get(w, 0) for w in range(count)))
        return out


@dataclasses.dataclass
class Written(WriterCommitMessage):
    names: list[str]


class BamWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, schema: StructType, overwrite: bool):
        self.path, self.overwrite = options["path"].rstrip("/"), overwrite
        self.references = json.loads(options["references"])
        self.columns = [f.name for f in schema]
        self.run = uuid.uuid4().hex
        self.temporary = f"{self.path}/_temporary-{self.run}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        context = TaskContext.get()
        name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}-{self.run[:8]}.bam"
        system, folder = opened(self.temporary)
        system.create_dir(folder, recursive=True)
        out, number = None, {n: i for i, n in enumerate(self.references)}
        for batch in iterator:
            if not batch.num_rows:
                continue
            out = out or Output(self.references, system.open_output_stream(f"{folder}/{name}"))
            if "cigar" in self.columns and batch.column(self.columns.index("cigar")).null_count < batch.num_rows:
                self.one_by_one(out, batch, number)
            else:
                self.at_once(out, batch)
        if out is None:
            return Written([])
        index = out.close()
        if index is not None:
            with system.open_output_stream(f"{folder}/{name}.bai") as stream:
                stream.write(index)
        return Written([name] + [f"{name}.bai"] * (index is not None))

    def at_once(self, out: Output, batch: pa.RecordBatch) -> None:
        column = lambda c, kind: batch.column(self.columns.index(c)).cast(kind) if c in self.columns else pa.nulls(batch.num_rows, kind)
        numbers = lambda c, default: pc.fill_null(column(c, pa.int64()), default).to_numpy(zero_copy_only=False)
        ref = pc.fill_null(pc.index_in(column("chrom", pa.string()), value_set=pa.array(list(self.references), pa.string())), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        there = (ref >= 0) & pc.is_valid(column("ref_start", pa.int64())).to_numpy(zero_copy_only=False)  # with a place that the heading has
        ref, start = np.where(there, ref, -1), np.where(there, numbers("ref_start", -1), -1)
        end = np.where(there & pc.is_valid(column("ref_end", pa.int64())).to_numpy(zero_copy_only=False), numbers("ref_end", -1), start)
        data, sizes = records(pc.fill_null(column("name", pa.string()), "*"), numbers("flag", 0), ref, start, end, numbers("mapq", 255), column("read_group", pa.string()))
        out.reads(ref, start, end, data, sizes)

    def one_by_one(self, out: Output, batch: pa.RecordBatch, number: dict[str, int]) -> None:
        rows = {c: batch.column(i).to_pylist() for i, c in enumerate(self.columns)}
        given = lambda c, default: rows.get(c) or [default] * batch.num_rows
        for chrom, start, end, read, flag, mapq, cigar, group in zip(rows["chrom"], rows["ref_start"], rows["ref_end"], given("name", None), given("flag", 0), given("mapq", 255), given("cigar", None), given("read_group", None)):
            ref, start = (number[chrom], start) if chrom in number and start is not None else (-1, -1)  # no place, or one that the heading lacks
            end = start if end is None or ref < 0 else end
            out.read(ref, start, end, record("*" if read is None else read, flag or 0, ref, start, end, 255 if mapq is None else mapq, cigar, group))

    def commit(self, messages: list[Written | None]) -> None:
        system, folder = opened(self.path)
        system.create_dir(folder, recursive=True)
        if self.overwrite:
            for path, _ in listed(self.path, ".bam") + listed(self.path, ".bai"):
                system.delete_file(opened(path)[1])
        names = [n for m in messages if m for n in m.names]
        for name in names:
            system.move(f"{opened(self.temporary)[1]}/{name}", f"{folder}/{name}")
        if not names:  # a file that says that there is nothing
            Output(self.references, system.open_output_stream(f"{folder}/part-00000-{self.run[:8]}.bam")).close()
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        system, folder = opened(self.temporary)
        if system.get_file_info(folder).type.name == "Directory":
            system.delete_dir(folder)


class BamSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> BamReader:
        return BamReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> BamWriter:
        return BamWriter(self.options, schema, overwrite)


def reads(spark: SparkSession, path: str, regions: list[tuple[str, int, int]] | None = None, split: int = SPLIT) -> DataFrame:
    """file, sample, name, flag, chrom, ref_start, ref_end (null where nothing is aligned), mapq, read_group of the BAM files of a path."""
    reach_workers(spark)
    spark.dataSource.register(BamSource)
    source = spark.read.format("bam").option("split", split)
    return (source.option("regions", json.dumps(regions)) if regions is not None else source).load(path)


def write_reads(df: DataFrame, path: str, references: dict[str, int], mode: str = "overwrite") -> None:
    """Reads (chrom, ref_start, ref_end; name, flag, mapq, cigar, read_group if there) as a BAM file for each range of positions, in order.

    references: lengths of chromosomes in the order of the heading.
    """
    spark = df.sparkSession
    reach_workers(spark)
    spark.dataSource.register(BamSource)
    place = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, references)), F.col("chrom")), F.lit(0)), F.lit(1 << 30)) if references else F.lit(0)
    known = ["chrom", "ref_start", "ref_end", "name", "flag", "mapq", "cigar", "read_group"]
    rows = df.select(*(c for c in known if c in df.columns), place.alias("_place"))
    ordered = rows.repartitionByRange("_place", "ref_start").sortWithinPartitions(F.col("_place"), F.col("ref_start").asc_nulls_last()).drop("_place")
    ordered.write.format("bam").option("references", json.dumps(references)).mode(mode).save(path)
