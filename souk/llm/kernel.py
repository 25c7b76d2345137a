"""Vectorised text helpers used inside Arrow tasks.

All of them work on the UTF-8 bytes of an Arrow string column, without making
Python strings.  Identifiers are 64-bit; arithmetic wraps.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes that separate words: [\x20\x09-\x0D]; all other bytes belong to words.
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: The complement of [^\x00-\x2F\x3A-\x60\x7B-\x7F] after lower-casing.
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
#: A-Z to a-z, every other byte to itself.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the whole word."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Identifier of the ordered pair (a, b)."""
    return mix(a * U64(0x9E3779B97F4A7C15) + (b ^ U64(0x2545F4914F6CDD1D)))


def column_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = col.buffers()
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(offs, kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def segments(offsets: np.ndarray, size: int):
    """Ranges (first, last) of rows of at most ``size`` bytes together, or of one longer row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def word_bounds(raw: np.ndarray, offsets: np.ndarray, blank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (byte positions) of words, and the index of the first word of each row (and the total).

    Words never cross rows.
    """
    n = len(raw)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    inside = ~blank[raw]
    edge = np.zeros(n, bool)
    cut = offsets[(offsets < n)]
    edge[cut] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:]
    starts = np.flatnonzero(begins)
    stops = np.flatnonzero(ends) + 1
    return starts, stops, np.searchsorted(starts, offsets)


_R = 0x9E3779B97F4A7C15 | 1
_INV = pow(_R, -1, 1 << 64)
_TAB = np.random.default_rng(20240229).integers(0, 1 << 63, 256, np.int64).astype(U64) * U64(2) + U64(1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[:1] = 1
    return np.multiply.accumulate(out) if n else out


_PW, _PI = _powers(_R, 1 << 16), _powers(_INV, 1 << 16)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _PW, _PI
    if len(_PW) < n:
        size = 1 << (n - 1).bit_length()
        _PW, _PI = _powers(_R, size), _powers(_INV, size)
    return _PW, _PI


def word_ids(raw: np.ndarray, starts: np.ndarray, stops: np.ndarray, chunk: int = 1 << 16) -> np.ndarray:
    """64-bit identifier of each word's bytes: Rabin-Karp prefix sums, a piece of the text at a time."""
    out = np.empty(len(starts), U64)
    i, n = 0, len(starts)
    while i < n:
        base = starts[i]
        j = max(int(np.searchsorted(stops, base + chunk, "right")), i + 1)
        span = int(stops[j - 1] - base)
        pw, inv = _power_tables(span + 1)
        sums = np.zeros(span + 1, U64)
        np.cumsum(_TAB[raw[base:base + span]] * pw[:span], out=sums[1:])
        s, e = starts[i:j] - base, stops[i:j] - base
        out[i:j] = mix((sums[e] - sums[s]) * inv[s] + (e - s).astype(U64))
        i = j
    return out


def rows_of(counts_from: np.ndarray) -> np.ndarray:
    """Row index of each item, from the index of each row's first item (and the total)."""
    return np.repeat(np.arange(len(counts_from) - 1), np.diff(counts_from))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[p : p + width] for each p where it fits; a few passes of doubling."""
    if len(x) < width:
        return x[:0]
    have, cur = 1, x
    while have * 2 <= width:
        cur = np.minimum(cur[:-have], cur[have:])
        have *= 2
    rest = width - have
    return np.minimum(cur[:len(cur) - rest], cur[rest:]) if rest else cur


POS_BITS = 20
POS_MASK = U64((1 << POS_BITS) - 1)


def shared_runs(grams: np.ndarray, windows: np.ndarray, valid: np.ndarray, per_window: int):
    """Split the valid window starts into runs that have the same least gram.

    ``grams[i]`` identifies the gram at i, ``windows[p]`` the whole window at
    p; a window holds ``per_window`` grams.  Equal windows have equal least
    grams, so two windows are equal only if their runs have the same bucket.
    Returns bucket (44 bits), content identifier of all that the run covers,
    first window and number of windows of each run.  At most 2**20 grams.
    """
    n = len(valid)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z.astype(U64), z.astype(U64), z, z
    # an independent mixing: the gram's own identifier also decides nothing else
    keys = (mix(grams + U64(0x632BE59BD9B4E019)) & ~POS_MASK) | np.arange(len(grams), dtype=U64)
    low = sliding_min(keys, per_window)[:n]
    p = np.flatnonzero(valid)
    if len(p) == 0:
        z = np.zeros(0, np.int64)
        return z.astype(U64), z.astype(U64), z, z
    low = low[p]
    new = np.ones(len(p), bool)
    new[1:] = (low[1:] != low[:-1]) | (p[1:] != p[:-1] + 1)
    at = np.flatnonzero(new)
    lo = p[at]
    count = np.diff(np.append(at, len(p)))
    whole = pair(pair(windows[lo], windows[lo + count - 1]), count.astype(U64))
    return low[at] >> U64(POS_BITS), whole, lo, count


def joined_length(starts: np.ndarray, lengths: np.ndarray) -> int:
    """Number of positions that the intervals cover."""
    if len(starts) == 0:
        return 0
    s, e = merged(starts, starts + lengths)
    return int((e - s).sum())


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal intervals that the half-open ones form; touching ones join."""
    if len(starts) == 0:
        return starts, ends
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(s), bool)
    new[1:] = s[1:] > e[:-1]
    at = np.flatnonzero(new)
    return s[at], e[np.append(at[1:], len(s)) - 1]
