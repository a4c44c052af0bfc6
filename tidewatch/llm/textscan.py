"""Vectorised scans over the bytes and words of many texts at once.

Texts come as Arrow string columns, so their UTF-8 bytes lie one after another
in a buffer. Scans cut that buffer into pieces of bounded size that never mix
two documents in one window.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
POS_BITS = 24
LONG = 64
_MULT = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD1342543DE82EF95)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_BYTES = np.random.default_rng(20240101).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def give_back() -> None:
    """Free memory goes back to the system. Else a worker keeps what its largest batches took, for all later tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc; numpy's and Python's larger objects lie there
    if trim is not None:
        trim(0)


def lean(run: Callable) -> Callable:
    """``run`` over the batches of a task; free memory is given back after each of them and at the end."""
    def between(batches):
        for batch in batches:
            yield batch
            give_back()

    def task(batches):
        yield from run(between(batches))
        give_back()

    return task


def column_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``data, offsets`` of a string or binary column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type):
        kind = np.int64
    else:
        kind = np.int32
    if col.null_count:
        empty = pa.scalar(b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "", col.type)
        col = col.fill_null(empty)
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = col.buffers()
    offsets = np.frombuffer(offs, kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def groups_of(offsets: np.ndarray, limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Runs of rows ``[i, j)`` with about ``limit`` bytes; one longer row stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def pieces(data: np.ndarray, offsets: np.ndarray, window: int, limit: int = PIECE):
    """``(first row, buffer, row offsets in it, shift)``: each window lies whole in exactly one piece.

    A row over ``limit`` is cut into stretches that overlap by ``window - 1``;
    ``shift`` is where the stretch begins in its row.
    """
    for i, j in groups_of(offsets, limit):
        if j - i > 1 or offsets[j] - offsets[i] <= 2 * limit:
            yield i, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], 0
            continue
        row, step = data[offsets[i] : offsets[j]], limit
        for s in range(0, max(1, len(row) - window + 1), step):
            part = row[s : s + step + window - 1]
            yield i, part, np.array([0, len(part)], np.int64), s


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * _MULT
    return h ^ (h >> np.uint64(29))


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, grown as needed."""
    if len(_POWERS.get("up", ())) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        up, down = np.full(size, _BASE), np.full(size, np.uint64(pow(int(_BASE), -1, 1 << 64)))
        up[0] = down[0] = 1
        _POWERS["up"], _POWERS["down"] = np.cumprod(up), np.cumprod(down)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``span_hash`` gets the hash of any span."""
    _, down = _powers(max(1, len(values)))
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * down[: len(values)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of ``values[start:stop]`` wherever the span lies; equal spans have equal hashes."""
    up, _ = _powers(len(sums))
    return mixed((sums[stop] - sums[start]) * up[start] + (stop - start).astype(np.uint64))


def gram_hash(sums: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` values."""
    n = len(sums) - k
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, _ = _powers(n)
    return mixed((sums[k:] - sums[:-k]) * up + np.uint64(k))


def byte_sums(data: np.ndarray) -> np.ndarray:
    return prefix(_BYTES[data])


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``start, stop`` of the runs of ``[^\\x20\\x09-\\x0D]`` and ``first``: per row the index of its first word."""
    space = _SPACE[data]
    n = len(data)
    if n == 0:
        zero = np.zeros(0, np.int64)
        return zero, zero, np.zeros(len(offsets), np.int64)
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True  # a row's end ends its word
    edge = ~space
    begins = edge.copy()
    begins[1:] &= space[:-1] | cut[1:n]
    ends = edge.copy()
    ends[:-1] &= space[1:] | cut[1:n]
    start, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, stop, np.searchsorted(start, offsets)


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case; other bytes stay."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def word_hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of every word; those over ``LONG`` bytes by a digest.

    Sums modulo 2**64 are blind to some pairs of long words, whatever the base:
    a Thue-Morse word of 1024 letters and its complement have the same sum.
    """
    found = span_hash(byte_sums(data), start, stop)
    long = np.flatnonzero(stop - start > LONG)
    if len(long):
        raw = np.ascontiguousarray(data).data
        ends = zip(start[long].tolist(), stop[long].tolist())
        found[long] = np.frombuffer(b"".join(blake2b(raw[a:b], digest_size=8).digest() for a, b in ends), "<u8")
    return found


def _leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """Where the least of every run of ``width`` values stands, for positions that do not fit beside the hash."""
    at, step = np.arange(len(values)), 1
    while step < width:
        at = np.where(values[at[:-step]] <= values[at[step:]], at[:-step], at[step:])
        step *= 2
    return at


def anchors(grams: np.ndarray, first: np.ndarray, last: np.ndarray, width: int):
    """Choose one gram in every window of ``width`` (a power of two) grams, by content alone.

    Row ``r`` owns the windows that start in ``[first[r], last[r]]``. Returns the
    chosen positions with the first and last window start that chose each, and
    the row. Equal windows choose the same offset, so two equal windows share an
    anchor with equal grams.
    """
    none = np.zeros(0, np.int64)
    if len(grams) < width:
        return none, none, none, none
    mask = ~np.uint64((1 << POS_BITS) - 1)
    if len(grams) >> POS_BITS:
        at = _leftmost_least(grams & mask, width)
    else:
        # the position in the lower bits settles ties: the leftmost wins
        least = (grams & mask) | np.arange(len(grams), dtype=np.uint64)
        step = 1
        while step < width:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        at = (least & ~mask).astype(np.int64)
    rows = np.flatnonzero(last >= first)
    lens = (last - first + 1)[rows]
    row_begin = first[rows]
    mark = np.zeros(len(at) + 1, np.int32)
    mark[row_begin] += 1
    mark[row_begin + lens] -= 1
    own = np.cumsum(mark[:-1]) > 0
    new = np.zeros(len(at), bool)
    new[0] = True
    new[1:] = at[1:] != at[:-1]
    new[row_begin] = True
    new &= own
    begin = np.flatnonzero(new)
    stop = np.zeros(len(at) + 1, bool)
    stop[begin] = True
    stop[row_begin + lens] = True
    cuts = np.flatnonzero(stop)
    end = cuts[np.searchsorted(cuts, begin, "right")] - 1 if len(begin) else none
    row = rows[np.searchsorted(row_begin, begin, "right") - 1]
    return at[begin], begin, end, row
