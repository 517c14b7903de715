"""Words of many texts at once: byte spans and 64-bit hashes by prefix sums in numpy."""

from __future__ import annotations

import numpy as np

#: Odd multiplier of the polynomial hash and its inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64; kept, and doubled as needed."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        have = np.empty(size, np.uint64)
        have[0] = 1
        done = 1
        while done < size:
            have[done : 2 * done] = have[:done] * np.uint64(pow(base, done, 1 << 64))
            done *= 2
        _powers[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts with one space after each, and where each begins (one more entry than texts)."""
    buf = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1, out=starts[1:])
    return buf, starts


def spans(is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True; the last entry must be False."""
    flips = np.flatnonzero(is_word[1:] != is_word[:-1]) + 1
    if len(is_word) and is_word[0]:
        flips = np.concatenate(([0], flips))
    return flips[::2], flips[1::2]


def hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every span of bytes, mixed with its length."""
    n = len(buf)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * powers(BASE, n), out=sums[1:])
    h = (sums[ends] - sums[starts]) * powers(INVERSE, n)[starts] if len(starts) else np.empty(0, np.uint64)
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def first_eight(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The first eight bytes of every span as a number, zeros after its end."""
    padded = np.concatenate((buf, np.zeros(8, np.uint8)))
    words = np.ndarray((len(buf) + 1,), "<u8", padded, 0, (1,))
    size = np.minimum(ends - starts, 8)
    masks = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
    return words[starts] & masks[size]


class HashIndex:
    """(hash, check) -> 0, 1, 2 ... in the order added; open addressing in flat arrays."""

    def __init__(self, bits: int = 16) -> None:
        self._make(bits)
        self.n = 0

    def _make(self, bits: int) -> None:
        self.bits = bits
        self.key, self.check = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.uint64)
        self.value = np.full(1 << bits, -1, np.int32)

    def get(self, key: np.ndarray, check: np.ndarray) -> np.ndarray:
        at = (key >> np.uint64(64 - self.bits)).astype(np.int64)
        out = self.value[at]
        todo = np.flatnonzero((out >= 0) & ((self.key[at] != key) | (self.check[at] != check)))
        while len(todo):
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)
            slot = at[todo]
            out[todo] = self.value[slot]
            todo = todo[(out[todo] >= 0) & ((self.key[slot] != key[todo]) | (self.check[slot] != check[todo]))]
        return out

    def add(self, key: np.ndarray, check: np.ndarray) -> None:
        """New and different entries only."""
        if 2 * (self.n + len(key)) > 1 << self.bits:
            full = self.value >= 0
            old = self.key[full], self.check[full], self.value[full]
            self._make(max(self.bits + 1, int(4 * (self.n + len(key))).bit_length()))
            self._put(*old)
        self._put(key, check, np.arange(self.n, self.n + len(key), dtype=np.int32))
        self.n += len(key)

    def _put(self, key: np.ndarray, check: np.ndarray, value: np.ndarray) -> None:
        at = (key >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(at):
            free = self.value[at] < 0
            slots, first = np.unique(np.where(free, at, -1), return_index=True)
            won = first[slots >= 0]
            self.key[at[won]], self.check[at[won]], self.value[at[won]] = key[won], check[won], value[won]
            left = np.ones(len(at), bool)
            left[won] = False
            at, key, check, value = at[left], key[left], check[left], value[left]
            at = np.where(self.value[at] < 0, at, (at + 1) & ((1 << self.bits) - 1))
