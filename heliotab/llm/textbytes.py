"""Words of Arrow text columns as NumPy arrays, without a Python object per word."""

import hashlib

import numpy as np
import pyarrow as pa

MULT = 0x9E3779B97F4A7C15 | 1
PIECE = 1 << 18  # bytes hashed at a time, which bounds the eight-byte arrays and the table of powers
LONG_WORD = 1 << 16  # longer words are hashed one by one


def byte_table(pattern_bytes) -> np.ndarray:
    """A 256-entry membership table."""
    t = np.zeros(256, bool)
    t[list(pattern_bytes)] = True
    return t


SPACES = bytes([0x20, *range(0x09, 0x0E)])
NOT_SPACE = ~byte_table(SPACES)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
LOWER_TABLE = LOWER.tobytes()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; nulls count as empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, column: int, most: int = 1 << 20):
    """The batch in runs of rows whose text has at most ``most`` bytes (a longer row stands alone)."""
    _, at = text_bytes(batch.column(column))
    row, n = 0, batch.num_rows
    while row < n:
        end = max(row + 1, int(np.searchsorted(at, at[row] + most, "right")) - 1)
        yield batch.slice(row, min(end, n) - row)
        row = min(end, n)


def word_spans(data: np.ndarray, at: np.ndarray, member: np.ndarray):
    """Start and end of every maximal run of member bytes within a row; word offsets of the rows."""
    inside = member[data]
    first, last = inside.copy(), inside.copy()
    if len(data):
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        begin, stop = at[:-1], at[1:]
        begin, stop = begin[begin < stop], stop[stop > at[:-1]] - 1
        first[begin] = inside[begin]
        last[stop] = inside[stop]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, at)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, base: int = MULT) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n (base is odd, so it has an inverse)."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(10, (n - 1).bit_length())
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        have = _POWERS[base] = tuple(out)
    return have[0][:n], have[1][:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each span of bytes; spans are in order and may overlap."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        low = starts[i]
        if ends[i] - low > LONG_WORD:
            out[i] = int.from_bytes(hashlib.blake2b(data[low : ends[i]].tobytes(), digest_size=8).digest(), "little")
            i += 1
            continue
        j = i + int(np.searchsorted(starts[i:], low + PIECE, "left"))
        long = np.flatnonzero(ends[i:j] - starts[i:j] > LONG_WORD)
        if len(long):
            j = i + int(long[0])
        s, e = starts[i:j] - low, ends[i:j] - low
        size = int(e.max())
        up, down = powers(PIECE + LONG_WORD + 1)
        total = np.zeros(size + 1, np.uint64)
        np.cumsum((data[low : low + size].astype(np.uint64) + np.uint64(1)) * up[:size], out=total[1:])
        out[i:j] = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
        i = j
    return out


def window_hashes(symbols: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each run of ``width`` consecutive symbols (empty if there are fewer)."""
    n = len(symbols) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(n, np.uint64)
    block = 1 << 18
    up, down = powers(block + width, 0xD6E8FEB86659FD93)
    for i in range(0, n, block):
        m = min(block, n - i)
        total = np.zeros(m + width, np.uint64)
        np.cumsum(symbols[i : i + m + width - 1] * up[: m + width - 1], out=total[1:])
        out[i : i + m] = mix((total[width : width + m] - total[:m]) * down[:m])
    return out


def binary_array(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary column from bytes and the offsets of its rows."""
    return pa.Array.from_buffers(
        pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))]
    )


def word_blocks(text: bytes, size: int = 1 << 20):
    """White-space separated words of a text, in lists that cover about ``size`` bytes each."""
    here = 0
    while here < len(text):
        end = here + size
        while end < len(text) and text[end] not in SPACES:
            end += 1
        yield text[here:end].split()
        here = end
