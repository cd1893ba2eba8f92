"""Phrases of texts by a rolling hash, and hashes of the byte strings around their ends."""

from __future__ import annotations

import numpy as np

GRAM = 16  # bytes the rolling hash looks at
LEVELS = (1, 2, 4, 8, 16, 32, 64, 128)
_RNG = np.random.default_rng(20240601)
BYTES = _RNG.integers(0, 1 << 63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
FACTORS = _RNG.integers(0, 1 << 63, 8, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
SHIFT = np.uint64(31)


def levels(data: np.ndarray, *kept: int) -> dict[int, np.ndarray]:
    """64-bit hashes of the ``kept`` numbers of bytes from each byte on (meaningless where those run over the end)."""
    now, out = BYTES[data], {}
    for size, factor in zip(LEVELS, FACTORS):
        if size in kept:
            out[size] = now
        if size >= max(kept):
            return out
        longer = now * factor
        longer ^= longer >> SHIFT
        longer[: max(0, len(now) - size)] += now[size:]
        now = longer
    return out


def mixed(*parts: np.ndarray) -> np.ndarray:
    """One 64-bit hash of several, in order."""
    value = np.zeros(len(parts[0]), np.uint64)
    for part in parts:
        value = (value ^ part.astype(np.uint64)) * np.uint64(0x9FB21C651E98DF25)
        value ^= value >> np.uint64(28)
    return value


def block_of(size: int) -> int:
    return max(s for s in LEVELS if s <= size)


def hash_of(known: dict[int, np.ndarray], start: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the ``size`` bytes from each start: whole blocks and one that ends with the string."""
    block = block_of(size)
    parts, at = [], 0
    while at + block < size:
        parts.append(known[block][start + at])
        at += block
    return mixed(*parts, known[block][start + size - block])


def span_hash(known: dict[int, np.ndarray], start: np.ndarray, end: np.ndarray, least: int) -> np.ndarray:
    """Hashes of strings of different lengths, all from ``least`` (128 or more) to twice ``least``, the length included."""
    parts = [hash_of(known, start, least), hash_of(known, end - least, least), (end - start)]
    return mixed(*parts)


def least_in_window(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of the ``width`` values from each place on; shorter by width - 1."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[: len(values) - size], values[size:])
        size *= 2
    more = width - size
    return np.minimum(values[: len(values) - more], values[more:]) if more else values


def triggers(known: dict[int, np.ndarray], reach: int) -> np.ndarray:
    """For each byte the trigger of the string that starts there: the place of the least rolling hash among the
    ``reach`` next places, the last of equal ones. Shorter by reach - 1.

    Triggers depend on the ``reach + GRAM - 1`` bytes from the start only, so equal strings have them at equal places.
    """
    place = np.arange(len(known[GRAM]), dtype=np.uint64)
    low = np.uint64((1 << 24) - 1)
    order = mixed(known[GRAM]) & ~low | (low - place)
    return (low - (least_in_window(order, reach) & low)).astype(np.int64)
