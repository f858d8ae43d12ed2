"""Runs of fixed-length byte windows that share an anchor, and digests of byte ranges.

A window is the string of ``width`` bytes that starts at a position. Its anchor is the place in
it where the hash of ``gram`` bytes is smallest (the leftmost such place). Equal windows have
their anchors at equal offsets, wherever they stand, and neighbours mostly share theirs: a text
of n bytes has about 2n / (width - gram + 2) runs of window starts with one anchor. No two
windows of a run are equal, since their anchors stand at different offsets.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np

GRAM = 64
# Window starts hashed at once. Places inside a chunk fit the low PLACE_BITS of a composite key.
CHUNK = 1 << 16
PLACE_BITS = 17

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_MIX = np.uint64(0xD6E8FEB86659FD93)
_PLACES = np.uint64((1 << PLACE_BITS) - 1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = _powers(_BASE, 2 * CHUNK)
_INVERSES = _powers(pow(_BASE, -1, 1 << 64), 2 * CHUNK)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of every ``gram``-byte string of ``data``, the same wherever the string stands."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _INVERSES[:n], out=sums[1:])
    h = (sums[gram:] - sums[:-gram]) * _POWERS[: n - gram + 1]
    h ^= h >> np.uint64(32)
    h *= _MIX
    h ^= h >> np.uint64(29)
    return h


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours, by doubling the reach of each step."""
    reach = 1
    while reach * 2 <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def runs(data: np.ndarray, bounds: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of (anchor hash, anchor place, first start, last start) over texts that lie one after another.

    ``bounds`` holds where each text starts, and the end of the last. Windows across a border
    are left out.
    """
    gram = min(GRAM, width)
    span = width - gram + 1
    total = int(bounds[-1]) - width + 1
    for at in range(int(bounds[0]), max(total, 0), CHUNK):
        here = min(CHUNK, total - at)
        ends = bounds[np.searchsorted(bounds, at, "right") : np.searchsorted(bounds, at + here + width)]
        valid = np.ones(here, bool)
        for end in ends[ends < at + here + width - 1].tolist():
            valid[max(0, end - width + 1 - at) : max(0, end - at)] = False
        starts = np.flatnonzero(valid)
        if not len(starts):
            continue
        hashes = gram_hashes(data[at : at + here + width - 1], gram)
        keys = (hashes & ~_PLACES) | np.arange(len(hashes), dtype=np.uint64)
        least = sliding_minimum(keys, span)[starts]
        new = np.flatnonzero((least[1:] != least[:-1]) | (starts[1:] != starts[:-1] + 1)) + 1
        first = np.concatenate(([0], new))
        last = np.append(new, len(starts)) - 1
        place = (least[first] & _PLACES).astype(np.int64)
        yield hashes[place].view(np.int64), place + at, starts[first] + at, starts[last] + at


def digests(data: memoryview, starts: list[int], ends: list[int]) -> np.ndarray:
    """The two 64-bit halves of a strong digest of each ``data[start:end]``."""
    joined = b"".join([blake2b(data[a:b], digest_size=16).digest() for a, b in zip(starts, ends)])
    return np.frombuffer(joined, np.int64).reshape(-1, 2)
