"""Hashes of all the words, shingles or pieces of a text at once, in numpy.

Words are hashed by eight bytes at a time, each mixed into what came before, so no structure of a word carries over to its
hash. Pieces of a text have a polynomial hash of prefixes, which gives each piece's hash as a difference: `Prefixes`
works modulo 2**64 and is fast, but words built for the purpose can collide in it, so it only finds candidates;
`Exact` adds a second hash modulo a prime with a base of its own, and decides.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_BYTES = np.random.default_rng(7).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_IS_WHITE = np.isin(np.arange(256), [32, *range(9, 14)])
_PRIME = 2**31 - 1
_SECOND = np.random.default_rng(11).integers(1, _PRIME, 257, dtype=np.uint64)  # the bytes' values, and the base
#: Of eight bytes, those that belong to a word of so many.
_MASKS = np.array([2 ** (8 * k) - 1 for k in range(9)], np.uint64)
#: Words of more bytes are hashed one by one.
LONG_WORD = 256


@functools.cache
def _powers_to(size: int) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, np.uint64(b))])) for b in (_BASE, pow(_BASE, -1, 2**64)))


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse. The tables of long texts are not kept."""
    room = 1 << max(17, (size - 1).bit_length())
    up, down = _powers_to(room) if room <= 1 << 21 else _powers_to.__wrapped__(room)
    return up[:size], down[:size]


def _modulo_powers(base: int, size: int) -> np.ndarray:
    """Powers modulo the prime, by doubling."""
    out = np.ones(size, np.uint64)
    done = 1
    while done < size:
        step = min(done, size - done)
        out[done : done + step] = out[:step] * np.uint64(pow(base, done, _PRIME)) % np.uint64(_PRIME)
        done += step
    return out


@functools.cache
def _second_powers_to(size: int) -> tuple[np.ndarray, np.ndarray]:
    base = int(_SECOND[256])
    return _modulo_powers(base, size), _modulo_powers(pow(base, -1, _PRIME), size)


def _second_powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    room = 1 << max(17, (size - 1).bit_length())
    up, down = _second_powers_to(room) if room <= 1 << 21 else _second_powers_to.__wrapped__(room)
    return up[:size], down[:size]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Prefixes:
    """Prefix hashes of bytes; of() hashes the pieces from start to stop."""

    def __init__(self, raw: np.ndarray):
        up, self.down = powers(len(raw) + 1)
        self.sums = np.empty(len(raw) + 1, np.uint64)
        self.sums[0] = 0
        np.cumsum(_BYTES[raw] * up[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mixed((self.sums[stop] - self.sums[start]) * self.down[start])


class Exact(Prefixes):
    """Two hashes of each piece, modulo 2**64 and modulo a prime."""

    def __init__(self, raw: np.ndarray):
        super().__init__(raw)
        up, self.second_down = _second_powers(len(raw) + 1)
        self.second = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_SECOND[raw] * up[:-1] % np.uint64(_PRIME), out=self.second[1:])

    def both(self, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        prime = np.uint64(_PRIME)
        return self.of(start, stop), (self.second[stop] - self.second[start]) % prime * self.second_down[start] % prime


def words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words start and stop."""
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~_IS_WHITE[raw]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_hashes(raw: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    padded = np.zeros(len(raw) + 8, np.uint8)
    padded[: len(raw)] = raw
    eights = np.ndarray((len(raw) + 1,), "<u8", buffer=padded, strides=(1,))
    left = stop - start
    out = mixed(left.astype(np.uint64) + np.uint64(_BASE))
    on, at = np.arange(len(start)), start
    long = np.flatnonzero(left > LONG_WORD)
    if len(long):
        for k in long:
            out[k] = int.from_bytes(hashlib.blake2b(raw[start[k] : stop[k]].tobytes(), digest_size=8).digest(), "little")
        on = np.flatnonzero(left <= LONG_WORD)
        at, left = start[on], left[on]
    while len(on):
        out[on] = mixed(out[on] ^ (eights[at] & _MASKS[np.minimum(left, 8)]))
        more = left > 8
        on, at, left = on[more], at[more] + 8, left[more] - 8
    return out


def shingles(text: str, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the runs of `size` words, A to Z in lower case; with fewer words, of the whole run."""
    raw = _LOWER[np.frombuffer(text.encode(), np.uint8)]
    start, stop = words(raw)
    if not len(start):
        return np.empty(0, np.uint64)
    each = word_hashes(raw, start, stop)
    n = min(size, len(each))
    out = np.full(len(each) - n + 1, n, np.uint64)
    for k in range(n):  # ((h + a) * odd ^ ...) + b: the order of words counts
        out = (out + each[k : len(each) - n + 1 + k]) * np.uint64(_BASE)
        out ^= out >> np.uint64(29)
    return distinct(mixed(out))


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted, each value once."""
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x
