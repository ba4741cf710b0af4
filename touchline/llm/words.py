"""Word and window hashes over Arrow text, computed for many documents at once.

Words are runs of bytes other than space and ``\\t \\n \\v \\f \\r``. In UTF-8 those bytes never
occur inside another character, so the text is never decoded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Text handled at a time; bounds the memory of the arrays below (a longer document is one piece).
SLICE_BYTES = 500_000

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Everything but ASCII letters, digits and the parts of other characters.
PUNCTUATION = np.ones(256, bool)
PUNCTUATION[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_RANDOM = np.random.default_rng(20240229)
BYTE_VALUE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
LOWER_VALUE = BYTE_VALUE.copy()
LOWER_VALUE[65:91] = BYTE_VALUE[97:123]
#: Odd, so it has an inverse modulo 2**64; 3 modulo 8, so its powers repeat late.
BASE = 0x9E3779B97F4A7C13
BASE_INVERSE = pow(BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, count: int) -> np.ndarray:
    """The first ``count`` powers of ``base`` modulo 2**64."""
    known = _powers.get(base)
    if known is None or len(known) < count:
        steps = np.full(max(count, 1 << 16), base, np.uint64)
        steps[0] = 1
        known = _powers[base] = np.multiply.accumulate(steps)
    return known[:count]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``values[start:end]`` for every range; depends on the values and their order only."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(BASE, len(values)), out=total[1:])
    inverse = powers(BASE_INVERSE, len(values) + 1)[starts]
    length = (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return mixed((total[ends] - total[starts]) * inverse + length)


class Words:
    """The words of consecutive documents: hashes, and where each document's words begin."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False,
                 between: np.ndarray = SPACE):
        space = between[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        begins = ~space
        begins[1:] &= space[:-1] | edge[1:-1]
        ends = ~space
        ends[:-1] &= space[1:] | edge[1:-1]
        starts = np.flatnonzero(begins)
        stops = np.flatnonzero(ends) + 1
        self.hashes = range_hashes((LOWER_VALUE if lower else BYTE_VALUE)[data], starts, stops)
        self.first = np.searchsorted(starts, offsets)  # of each document, and the end
        self.counts = np.diff(self.first)
        self.document = np.repeat(np.arange(len(self.counts)), self.counts)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all windows of ``size`` words inside one document, and where they start."""
        count = len(self.hashes) - size + 1
        if count <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        starts = np.flatnonzero(self.document[:count] == self.document[size - 1:])
        return range_hashes(self.hashes, starts, starts + size), starts


def text_slices(batch: pa.RecordBatch, column: str = "text",
                limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, bytes, offsets) of parts of a batch; a null text has no bytes."""
    text = batch.column(column).cast(pa.large_string()).fill_null("")
    _, offset_buffer, bytes_buffer = text.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[text.offset:text.offset + len(text) + 1]
    data = np.frombuffer(bytes_buffer, np.uint8) if bytes_buffer else np.zeros(0, np.uint8)
    row = 0
    while row < len(text):
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), len(text))
        yield row, end, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
