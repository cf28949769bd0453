"""Words of whole texts as byte ranges of Arrow buffers, many texts at a time.

The functions run inside tasks. Texts are cut into blocks of about ``BLOCK`` bytes (a
longer text is a block of its own), so memory follows the longest text, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20

_BYTES = np.arange(256, dtype=np.uint8)
#: A-Z to a-z, all else as it is
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
#: bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after lower-casing
ALNUM = ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
#: bytes of ``[^\x20\x09-\x0D]``
UNSPACED = ~((_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13)))

_BASE = 0x9E3779B97F4A7C15  # any odd number: it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def blocks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, row after the last, bytes and text offsets of each block; null is empty."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    n = len(texts)
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + n + 1].astype(np.int64)
    held = texts.buffers()[2]
    data = np.frombuffer(held, dtype=np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + BLOCK, "right")) - 1)
        yield row, stop, data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
        row = stop


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and each text's first word (with the total at the end)."""
    if not len(data):
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(len(offsets), dtype=np.int64)
    inside = table[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = offsets[:-1][np.diff(offsets) > 0]
    opens[edges] = inside[edges]
    ends = offsets[1:][np.diff(offsets) > 0] - 1
    closes[ends] = inside[ends]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets)


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range, equal for equal bytes wherever they stand."""
    power, inverse = _power(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def text_hashes(texts: list[str]) -> np.ndarray:
    """The same hash of whole strings."""
    raw = [t.encode() for t in texts]
    ends = np.cumsum([len(r) for r in raw], dtype=np.int64) if raw else np.zeros(0, np.int64)
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    return range_hashes(data, np.concatenate([[0], ends[:-1]]).astype(np.int64), ends)


def run_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` consecutive word hashes."""
    n = max(0, len(hashes) - width + 1)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        out = out * np.uint64(_BASE) + hashes[k : k + n]
    return mix(out)
