"""XXH64 of many slices of one buffer at once, in numpy.

The constants and rounds are those of the published XXH64 specification.
"""

from __future__ import annotations

import numpy as np
import xxhash

# The five primes of XXH64.
P1 = np.uint64(11400714785074694791)
P2 = np.uint64(14029467366897019727)
P3 = np.uint64(1609587929392839161)
P4 = np.uint64(9650029242287828579)
P5 = np.uint64(2870177450012600261)

#: Slices of more bytes are hashed one by one.
LONG = 256
#: Slices hashed at a time, so that all of their state stays in cache.
CHUNK = 16_384


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rotl(acc + lane * P2, 31) * P1


def _merge(acc: np.ndarray, v: np.ndarray) -> np.ndarray:
    return (acc ^ _round(np.zeros_like(v), v)) * P1 + P4


def _chunk(lanes: np.ndarray, data: np.ndarray, start: np.ndarray, size: np.ndarray, seed: int):
    seed = np.uint64(seed)
    acc = np.full(len(start), seed + P5, np.uint64)
    stripes = size >> 5
    long = np.flatnonzero(stripes)
    if len(long):
        v = [np.full(len(long), x, np.uint64) for x in (seed + P1 + P2, seed + P2, seed, seed - P1)]
        for s in range(int(stripes.max())):
            live = np.flatnonzero(stripes[long] > s)
            at = start[long[live]] + 32 * s
            for k in range(4):
                v[k][live] = _round(v[k][live], lanes[at + 8 * k])
        total = _rotl(v[0], 1) + _rotl(v[1], 7) + _rotl(v[2], 12) + _rotl(v[3], 18)
        for k in range(4):
            total = _merge(total, v[k])
        acc[long] = total
    acc += size.astype(np.uint64)
    at = start + (stripes << 5)
    rest = size & 31
    for k in range(3):
        live = np.flatnonzero(rest >= 8 * (k + 1))
        lane = lanes[at[live] + 8 * k]
        acc[live] = _rotl(acc[live] ^ _round(np.zeros_like(lane), lane), 27) * P1 + P4
    at = at + (rest & ~7)
    rest = rest & 7
    live = np.flatnonzero(rest >= 4)
    word = lanes[at[live]] & np.uint64(0xFFFFFFFF)
    acc[live] = _rotl(acc[live] ^ (word * P1), 23) * P2 + P3
    at[live] += 4
    rest = rest & 3
    for k in range(3):
        live = np.flatnonzero(rest > k)
        byte = data[at[live] + k].astype(np.uint64)
        acc[live] = _rotl(acc[live] ^ (byte * P5), 11) * P1
    acc ^= acc >> np.uint64(33)
    acc *= P2
    acc ^= acc >> np.uint64(29)
    acc *= P3
    return acc ^ (acc >> np.uint64(32))


def xxh64(data: np.ndarray, start: np.ndarray, size: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hash of each ``data[start:start + size]``; ``data`` is uint8."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lanes = np.lib.stride_tricks.as_strided(
        padded.view(np.uint8)[:8].view("<u8"), shape=(len(data) + 1,), strides=(1,)
    ) if len(data) == 0 else np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))
    out = np.empty(len(start), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(0, len(start), CHUNK):
            part = slice(i, i + CHUNK)
            short = np.flatnonzero(size[part] <= LONG) + i
            out[short] = _chunk(lanes, padded, start[short], size[short], seed)
    for i in np.flatnonzero(size > LONG):
        out[i] = xxhash.xxh64_intdigest(data[start[i] : start[i] + size[i]].tobytes(), seed)
    return out
