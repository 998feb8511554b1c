"""Content-defined runs of fixed-size byte windows, with vectorised rolling hashes.

Every window of SIZE bytes is assigned to its anchor, the leftmost of its GRAM-byte grams with the
smallest hash. Equal windows have equal anchors at the same distance, so windows are gathered into
runs: consecutive starts with one anchor, and a distance in the same half. All windows of a run
contain its core, the bytes that a window with any distance of that half must contain.
"""

from __future__ import annotations

import functools

import numpy as np

SIZE = 400
GRAM = 64
PARTS = 2
# Most bytes that a window of a run starts before the core.
SPREAD = -(-(SIZE - GRAM + 1) // PARTS) - 1
# Window starts hashed together; bounds the memory for a long text.
AT_ONCE = 1 << 20
BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse
MASK = (1 << 64) - 1


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A value per byte, and powers of the base and of its inverse modulo 2**64."""
    values = np.random.default_rng(42).integers(1, MASK, 256, dtype=np.uint64) | np.uint64(1)
    n = AT_ONCE + SIZE + 1
    power, inverse = np.full(n, BASE, np.uint64), np.full(n, pow(BASE, -1, 1 << 64), np.uint64)
    power[0] = inverse[0] = 1
    return values, np.cumprod(power), np.cumprod(inverse)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def runs_of(data: bytes) -> tuple[np.ndarray, ...]:
    """(core hash, run hash, first window start, last window start, bytes from the first start to
    the core) of every run, in text order.

    The core hash covers the core and the part, the run hash all bytes of the run and its shape.
    """
    found = [
        _runs(data[at : at + AT_ONCE + SIZE - 1], at)
        for at in range(0, max(len(data) - SIZE + 1, 0), AT_ONCE)
    ]
    if not found:
        none = np.empty(0, np.int64)
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none
    return tuple(np.concatenate(c) for c in zip(*found))


def _runs(data: bytes, base: int):
    values, power, inverse = _tables()
    octets = np.frombuffer(data, np.uint8)
    n = len(octets)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(values[octets] * power[:n], out=prefix[1:])

    def hash_of(start, end):
        return mix((prefix[end] - prefix[start]) * inverse[start])

    grams = mix((prefix[GRAM:] - prefix[:-GRAM]) * inverse[: n - GRAM + 1])
    order = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    wide = SIZE - GRAM + 1
    anchor = _window_min(order, wide) & np.uint64(0xFFFFFFFF)
    anchor = anchor.astype(np.int64)
    starts = np.arange(len(anchor))
    part = (anchor - starts) * PARTS // wide
    new = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(part) != 0)) + 1
    first = np.concatenate(([0], new))
    last = np.append(new, len(anchor)) - 1
    own, half = anchor[first], part[first]
    low = -(-half * wide // PARTS)  # distances of the half
    high = -(-(half + 1) * wide // PARTS) - 1
    core = mix(hash_of(own - low, own - high + SIZE) + half.astype(np.uint64))
    shape = (own - first) * SIZE + (last - first)
    run = mix(hash_of(first, last + SIZE) ^ mix(shape.astype(np.uint64)))
    return core, run, first + base, last + base, own - low - first


def _window_min(values: np.ndarray, wide: int) -> np.ndarray:
    """Minimum of every `wide` consecutive values, from running minima inside blocks."""
    n = len(values)
    padded = np.full(-(-n // wide) * wide, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, wide)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - wide + 1], ahead[wide - 1 : n])
