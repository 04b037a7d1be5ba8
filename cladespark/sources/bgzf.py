"""Blocks of block-gzip files: gzip members of at most 64 KB that state their own size, so that a file can be read from any block."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from fnmatch import fnmatch

from pyarrow import fs
from pyspark.sql.datasource import InputPartition

# Fixed values of the format.
MAGIC = b"\x1f\x8b\x08\x04"
END_OF_FILE = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
LARGEST_BLOCK = 1 << 16
#: Text of a block that is written: what stays incompressible still fits a block.
PAYLOAD = 0xFF00
#: Bytes that are asked of the file system at once, and block headers that must follow each other to be taken for such.
READ_AT_ONCE, FOLLOWING = 1 << 20, 3
#: Bytes of small ranges that one task takes at most, where there are more than so many ranges.
OF_A_TASK, TASKS = 4 << 20, 200


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def listed(path: str, suffix: str) -> list[tuple[str, int]]:
    """Path and size of a file, of the files of a folder, or of those that fit a pattern in the last part of the path."""
    system, inner = opened(path)
    scheme = path[: len(path) - len(inner)] if path.endswith(inner) else ""
    found = system.get_file_info(inner)
    if found.type == fs.FileType.File:
        return [(path, found.size)]
    folder, pattern = (inner, f"*{suffix}") if found.type == fs.FileType.Directory else inner.rstrip("/").rsplit("/", 1)
    files = [f for f in system.get_file_info(fs.FileSelector(folder)) if f.type == fs.FileType.File and fnmatch(f.base_name, pattern) and f.base_name[0] not in "._"]
    if not files and found.type != fs.FileType.Directory:
        raise FileNotFoundError(path)
    return sorted((scheme + f.path, f.size) for f in files)


class Range(InputPartition):
    """Bytes of a file for one task, read from each of the bounds to the next; without these, in one go."""

    def __init__(self, path: str, start: int, end: int, bounds: list[int] | None = None):
        self.path, self.start, self.end = path, start, end
        self.bounds = bounds or [start, end]


def ranges(files: list[tuple[str, int]], split: int) -> list[Range]:
    """The ranges of all files; where there are many small ones, several for a task, whose start costs more than they do."""
    count = sum(-(-size // split) for _, size in files)
    many, out = max(1, min(OF_A_TASK // split, count // TASKS)), []
    for path, size in files:
        bounds = [*range(0, size, split), size]
        for i in range(0, len(bounds) - 1, many):
            own = bounds[i : i + many + 1]
            out.append(Range(path, own[0], own[-1], own))
    return out or [Range("", 0, 0)]


def block(data: bytes) -> bytes:
    """One block of at most PAYLOAD bytes of text."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    packed = packer.compress(data) + packer.flush()
    return MAGIC + struct.pack("<IBBHBBHH", 0, 0, 255, 6, 66, 67, 2, len(packed) + 25) + packed + struct.pack("<II", zlib.crc32(data), len(data))


def size_of_block(head: bytes, at: int) -> int:
    """The size of the block that starts there; 0 if none does."""
    if head[at : at + 4] != MAGIC or len(head) < at + 18:
        return 0
    extra = struct.unpack_from("<H", head, at + 10)[0]
    place, end = at + 12, min(len(head), at + 12 + extra)
    while place + 4 <= end:
        one, two, length = struct.unpack_from("<BBH", head, place)
        if (one, two, length) == (66, 67, 2) and place + 6 <= end:
            return struct.unpack_from("<H", head, place + 4)[0] + 1
        place += 4 + length
    return 0


class BlockFile:
    """A file of blocks, read in ranges."""

    def __init__(self, path: str):
        self.system, self.path = opened(path)
        self.size = self.system.get_file_info(self.path).size
        self.file = self.system.open_input_file(self.path)

    def __enter__(self) -> BlockFile:
        return self

    def __exit__(self, *_: object) -> None:
        self.file.close()

    def bytes_at(self, start: int, size: int) -> bytes:
        size = min(size, self.size - start)
        return self.file.read_at(size, start) if size > 0 else b""

    def first_block(self, start: int) -> int:
        """Where the first block at or after a byte starts; the size of the file if none does."""
        while start < self.size:
            data = self.bytes_at(start, 8 * LARGEST_BLOCK)
            at = data.find(MAGIC)
            while 0 <= at < LARGEST_BLOCK * 2:
                place, seen = at, 0
                while seen < FOLLOWING and start + place < self.size and (length := size_of_block(data, place)):
                    place, seen = place + length, seen + 1
                if seen == FOLLOWING or start + place == self.size and seen:
                    return start + at
                at = data.find(MAGIC, at + 1)
            start += LARGEST_BLOCK * 2
        return self.size

    def blocks(self, start: int, end: int | None = None) -> Iterator[tuple[int, int, bytes]]:
        """Place, place of the next one, and text of each block that starts from ``start`` to before ``end``."""
        held, base = b"", start
        end = self.size if end is None else end
        while start < end:
            length = size_of_block(held, start - base)
            if not length or start - base + length > len(held):
                held, base = self.bytes_at(start, READ_AT_ONCE), start
                length = size_of_block(held, 0)
                if not length or length > len(held):
                    raise ValueError(f"no whole block at byte {start} of {self.path}")
            at = start - base
            header = 12 + struct.unpack_from("<H", held, at + 10)[0]
            yield start, start + length, zlib.decompressobj(-15).decompress(held[at + header : at + length - 8])
            start += length
