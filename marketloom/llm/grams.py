"""Hashed word and character n-grams of many texts at once, as numpy arrays.

Texts are joined with a blank between them and handled as one array of code points, so all
work is vectorised. A character n-gram lies inside one word; its first or last character may
be the blank that marks the word's border. A word n-gram never leaves its text.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np

_U32, _U64 = np.uint32, np.uint64
_PRIME = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_MULTIPLIERS = np.array([0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F, 0x165667B1, 0x9E3779B1], dtype=_U32)


_KNOWN_POWERS: list[np.ndarray] = []  # of the largest size asked for so far


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``size`` powers of the prime and of its inverse modulo 2**64."""
    if not _KNOWN_POWERS or len(_KNOWN_POWERS[0]) < size:
        found = []
        with np.errstate(over="ignore"):
            for base in (_PRIME, pow(_PRIME, -1, 1 << 64)):
                steps = np.full(size, base, dtype=_U64)
                steps[0] = 1
                found.append(np.multiply.accumulate(steps))
        _KNOWN_POWERS[:] = found
    return _KNOWN_POWERS[0], _KNOWN_POWERS[1]


@cache
def blanks() -> np.ndarray:
    """True for the code points that separate words."""
    return np.array([chr(i).isspace() for i in range(0x110000)])


@cache
def no_letters() -> np.ndarray:
    """True for the code points that are neither letters nor digits."""
    return np.array([not chr(i).isalnum() for i in range(0x110000)])


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> _U64(32))) * _U64(0xD6E8FEB86659FD93)
        h = (h ^ (h >> _U64(32))) * _U64(0xD6E8FEB86659FD93)
        return h ^ (h >> _U64(32))


@dataclass
class Joined:
    """Several texts as one array: code points, where words are separated, and each text's place."""

    points: np.ndarray
    gap: np.ndarray
    starts: np.ndarray  # the place before each text
    stops: np.ndarray  # the last place whose n-grams count

    @classmethod
    def of(cls, texts: list[str], separators: np.ndarray, own: list[int] | None = None) -> Joined:
        joined = " " + " ".join(texts) + "  "
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
        return cls(points, separators[points], starts, starts + (lengths if own is None else np.array(own, np.int64)))

    def character_grams(self, n: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Bucket and text index of every character n-gram."""
        size = len(self.points) - n + 1
        with np.errstate(over="ignore"):
            h = self.points[:size] * _MULTIPLIERS[0]
            for k in range(1, n):
                h ^= h >> _U32(15)
                h += self.points[k : k + size] * _MULTIPLIERS[k]
            h ^= h >> _U32(16)
            h *= _U32(0x7FEB352D + 2 * n)
        inside = ~self.gap[1 : 1 + size]
        for k in range(2, n - 1):
            inside &= ~self.gap[k : k + size]
        place = np.flatnonzero(inside)
        owner = np.searchsorted(self.starts, place, side="right") - 1
        counts = place < self.stops[owner]
        if not counts.all():
            place, owner = place[counts], owner[counts]
        return h[place] >> _U32(32 - bits), owner

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """64-bit hash and text index of every word, and whether it counts."""
        edge = np.flatnonzero(self.gap[1:] != self.gap[:-1]) + 1
        begin, end = edge[::2], edge[1::2]
        up, down = _powers(1 << int(len(self.points) - 1).bit_length())
        with np.errstate(over="ignore"):
            sums = np.cumsum((self.points + _U32(1)) * up[: len(self.points)], dtype=_U64)
            hashes = mixed((sums[end - 1] - sums[begin - 1]) * down[begin])
        owner = np.searchsorted(self.starts, begin, side="right") - 1
        return hashes, owner, begin <= self.stops[owner]


def paired(hashes: np.ndarray, owner: np.ndarray, step: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word with the one ``step`` later, and whether that is in the same text."""
    if len(hashes) <= step:
        return np.zeros(0, _U64), np.zeros(0, bool)
    with np.errstate(over="ignore"):
        both = mixed(hashes[:-step] * _U64(3) + hashes[step:] * _U64(0xA24BAED4963EE407) + _U64(salt))
    return both, owner[step:] == owner[:-step]


def bucket(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> _U64(64 - bits)).astype(np.int64)
