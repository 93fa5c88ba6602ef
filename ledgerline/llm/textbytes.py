"""Arrow text columns as byte arrays, and hashes of many substrings at once.

A prefix polynomial turns the hash of any substring into one subtraction and one
multiplication, so all words or all k-byte strings of a slab of texts are hashed
with a few array operations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLAB = 1 << 19  # bytes handled at once; a longer text is a slab of its own

_P = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INV = pow(_P, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        out = np.full(max(n, SLAB + 1), base, np.uint64)
        out[0] = 1
        have = _powers[base] = np.multiply.accumulate(out)
    return have[:n]


def column(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (one more than rows) and UTF-8 bytes of a string column; null is empty."""
    arr = batch.column(batch.schema.get_field_index(name))
    if not (pa.types.is_string(arr.type) or pa.types.is_binary(arr.type)):
        arr = arr.cast(pa.string())
    if arr.null_count:
        arr = arr.fill_null(b"" if pa.types.is_binary(arr.type) else "")
    _, offsets, data = arr.buffers()
    at = np.zeros(1, np.int64)
    if len(arr):
        at = np.frombuffer(offsets, np.int32)[arr.offset : arr.offset + len(arr) + 1].astype(np.int64)
    return at, np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)


def slabs(offsets: np.ndarray, size: int = SLAB) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``size`` bytes, or of one row."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end
        row = end


def prefix(data: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums, one longer than ``data``."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.multiply(data.astype(np.uint64) + np.uint64(1), _power(_P, len(data)), out=out[1:])
    np.add.accumulate(out, out=out)
    return out


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread a hash's entropy over all bits."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def spans(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the substrings [start, end), the same wherever they stand."""
    return mixed((sums[end] - sums[start]) * _power(_INV, len(sums))[start])


def grams(sums: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k-byte substrings."""
    n = max(len(sums) - k, 0)
    return mixed((sums[k : k + n] - sums[:n]) * _power(_INV, len(sums))[:n])
