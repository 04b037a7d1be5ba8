"""What the operators that run Python share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Rows and bytes of text that a worker turns into Python objects at once: bounds on its memory, not on what it reads.
ROWS_AT_ONCE, BYTES_AT_ONCE = 512, 4_000_000

#: Words of ASCII-lower-cased UTF-8 text: runs without white space.
WORD = rb"[^\x20\x09-\x0D]+"


def sliced(batches: Iterable[pa.RecordBatch], *columns: int, rows: int = ROWS_AT_ONCE, size: int = BYTES_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """Batches in slices of so many rows, and so many bytes in the columns, or single rows beyond that."""
    for batch in batches:
        ends = np.zeros(batch.num_rows, np.int64)
        for i in columns:
            lengths = pc.fill_null(pc.binary_length(batch.column(i)), 0)
            ends += np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            end = min(start + rows, batch.num_rows, max(start + 1, int(np.searchsorted(ends, before + size, "right"))))
            yield batch.slice(start, end - start)
            start = end


def remainder(key: Column, divisor: int) -> Column:
    """crc32 of a key as text, modulo; null for a null key."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(divisor))
