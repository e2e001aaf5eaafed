"""Hashes of many spans of one byte array at once, for tasks that hold texts as Arrow buffers."""

from __future__ import annotations

import numpy as np

_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _up_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers 0 to n of the multiplier and of its inverse modulo 2**64; kept for the next call."""
    global _powers
    if len(_powers[0]) <= n:
        size = 1 << int(n).bit_length()
        _powers = tuple(np.cumprod(np.concatenate(([np.uint64(1)], np.full(size, x, np.uint64)))) for x in (_MULTIPLIER, _INVERSE))
    return _powers


def mixed(h: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of `h`; one to one."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of raw[start:end] for every span. They come from one running sum of bytes times powers: equal spans
    have equal hashes wherever they stand; different ones nearly always have different ones, and callers that need
    certainty compare the bytes."""
    up, down = _up_to(len(raw))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every span, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


def utf8_column(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string or binary column and the offsets of its rows in them (nulls are empty)."""
    column = column.fill_null("" if str(column.type).endswith("string") else b"") if column.null_count else column
    _, offsets, data = column.buffers()
    width = np.int64 if str(column.type).startswith("large") else np.int32
    at = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return raw, at - at[0]
