"""Vectorised hashing shared by the operators: words, shingles, minwise signatures, sliding minima."""

from __future__ import annotations

from itertools import chain

import numpy as np
import regex
import xxhash

WORD = regex.compile(r"[\p{L}\p{N}]+")
_ASCII_WORDS = bytes(c if c < 128 and chr(c).isalnum() else 32 for c in range(256))
_U = np.uint64


def words_of(text: str) -> list[str]:
    """Maximal runs of Unicode letters or digits of the lower-cased text."""
    text = text.lower()
    return text.encode().translate(_ASCII_WORDS).decode().split() if text.isascii() else WORD.findall(text)


class WordHashes(dict):
    """64-bit hashes of words, remembered; the memory is emptied when it holds limit words."""

    def __init__(self, limit: int = 500_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def flat(self, lists: list[list[str]]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, chain.from_iterable(lists)), dtype=_U, count=sum(map(len, lists)))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def odd_numbers(n: int, seed: int) -> np.ndarray:
    return mixed(np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed)) | _U(1)


def shingles(values: np.ndarray, width: int) -> np.ndarray:
    """Hashes of each width consecutive values; as many as values less width - 1."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, dtype=_U)
    total = np.zeros(n, dtype=_U)
    for k, m in enumerate(odd_numbers(width, 7)):
        total += mixed(values[k : k + n] ^ m) * m if k == 0 else values[k : k + n] * m
    return mixed(total)


#: Values hashed at once by minwise(), so that they stay in the processor's cache.
CACHED = 1 << 15


def minwise(values: np.ndarray, starts: np.ndarray, coordinates: int) -> np.ndarray:
    """For each run of values that begins at starts (none of them empty), the minimum under each of so many hash functions, as 31 bits."""
    out = np.empty((len(starts), coordinates), dtype=np.int32)
    factors, ends = odd_numbers(coordinates, 99), np.append(starts, len(values))
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + CACHED)))
        part, at = values[ends[first] : ends[last]], starts[first:last] - starts[first]
        h, high = np.empty_like(part), np.empty_like(part)
        for c, m in enumerate(factors):
            np.multiply(part, m, out=h)
            np.right_shift(h, _U(29), out=high)
            h ^= high
            h *= _U(0x9E3779B97F4A7C15)
            out[first:last, c] = np.minimum.reduceat(h, at) >> _U(33)
        first = last
    return out


def nibbles(signatures: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Four low bits of each of 32 coordinates, packed into two 64-bit numbers a record."""
    bits = (mixed(signatures.astype(_U)) & _U(15)).reshape(len(signatures), 2, 16)
    packed = np.zeros((len(signatures), 2), dtype=_U)
    for k in range(16):
        packed |= bits[:, :, k] << _U(4 * k)
    return packed[:, 0].view(np.int64), packed[:, 1].view(np.int64)


#: Bins of a wide sketch, and 64-bit numbers it takes.
BINS, WIDE = 128, 8


def bin_minima(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For each run of values of these lengths, the least hash of those in each of BINS bins, as 31 bits; the greatest such number where there are none."""
    h = mixed(values + _U(0x632BE59BD9B4E019))
    at = np.repeat(np.arange(len(lengths)), lengths) * BINS + (h >> _U(57)).astype(np.int64)
    least = np.full(len(lengths) * BINS, (1 << 31) - 1, dtype=np.uint32)
    np.minimum.at(least, at, ((h & _U(0xFFFFFFFF)) >> _U(1)).astype(np.uint32))
    return least.reshape(len(lengths), BINS)


def packed_bins(least: np.ndarray) -> np.ndarray:
    """WIDE numbers for each row of bin_minima(): a nibble a bin, 0 of an empty one."""
    bits = np.where(least == (1 << 31) - 1, _U(0), mixed(least.astype(_U)) % _U(15) + _U(1)).reshape(len(least), WIDE, 16)
    packed = np.zeros((len(least), WIDE), dtype=_U)
    for k in range(16):
        packed |= bits[:, :, k] << _U(4 * k)
    return packed.view(np.int64)


def filled_nibbles(x: np.ndarray) -> np.ndarray:
    """How many of each number's 16 nibbles aren't 0."""
    x = x.view(_U)
    x = x | (x >> _U(1))
    x = (x | (x >> _U(2))) & _U(0x1111111111111111)
    return np.bitwise_count(x).astype(np.int64)


def equal_nibbles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many of 16 nibbles agree."""
    x = (a ^ b).view(_U)
    x = x | (x >> _U(1))
    x = (x | (x >> _U(2))) & _U(0x1111111111111111)
    return 16 - np.bitwise_count(x).astype(np.int64)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each width consecutive values, in time that doesn't depend on width."""
    n = len(x)
    if width <= 1 or n < width:
        return x.copy() if width <= 1 else x[:0]
    pad = -n % width
    full = np.concatenate([x, np.full(pad, np.iinfo(x.dtype).max, dtype=x.dtype)]).reshape(-1, width)
    left = np.minimum.accumulate(full, axis=1).ravel()
    right = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])
