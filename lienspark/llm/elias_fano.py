"""Monotone sequences in Elias-Fano form, searched for many values at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_WORD = 64


def _packed(values: np.ndarray, width: int) -> np.ndarray:
    """Numbers of ``width`` bits, one after the other in 64-bit words."""
    words = np.zeros(len(values) * width // _WORD + 2, np.uint64)
    if width:
        at = np.arange(len(values), dtype=np.int64) * width
        word, shift = at // _WORD, (at % _WORD).astype(np.uint64)
        np.bitwise_or.at(words, word, values << shift)
        over = shift + np.uint64(width) > _WORD
        np.bitwise_or.at(words, word[over] + 1, values[over] >> (np.uint64(_WORD) - shift[over]))
    return words


def _unpacked(words: np.ndarray, index: np.ndarray, width: int) -> np.ndarray:
    if not width:
        return np.zeros(len(index), np.uint64)
    at = index * width
    word, shift = at // _WORD, (at % _WORD).astype(np.uint64)
    high = np.where(shift > 0, words[word + 1] << (np.uint64(_WORD) - np.maximum(shift, np.uint64(1))), np.uint64(0))
    return (words[word] >> shift | high) & np.uint64((1 << width) - 1)


def _kth_bit(words: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the bit number ``k`` (from 0) that is set in each word."""
    place = np.zeros(len(words), np.int64)
    k = k.astype(np.int64)
    for width in (32, 16, 8, 4, 2, 1):
        low = words & np.uint64((1 << width) - 1)
        count = np.bitwise_count(low).astype(np.int64)
        up = k >= count
        k = np.where(up, k - count, k)
        place += np.where(up, width, 0)
        words = np.where(up, words >> np.uint64(width), low)
    return place


@dataclass(frozen=True)
class EliasFano:
    """``size`` ascending numbers: low bits packed, high bits as gaps in unary.

    The high bits are a bit vector in which number i sets the bit at its high part
    plus i; counts of set bits before each word lead to a bit by its number.
    """

    size: int
    top: int
    width: int
    low: np.ndarray
    high: np.ndarray
    before: np.ndarray

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        width = max(0, ((top + 1) // max(n, 1)).bit_length() - 1)
        low = _packed(values & np.uint64((1 << width) - 1), width)
        place = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        high = np.zeros((top >> width) // _WORD + n // _WORD + 3, np.uint64)
        np.bitwise_or.at(high, place // _WORD, np.uint64(1) << (place % _WORD).astype(np.uint64))
        before = np.concatenate(([0], np.cumsum(np.bitwise_count(high), dtype=np.int64)))
        return cls(n, top >> width, width, low, high, before)

    def access(self, index: np.ndarray) -> np.ndarray:
        """The numbers at the given places."""
        word = np.searchsorted(self.before, index, "right") - 1
        bit = word * _WORD + _kth_bit(self.high[word], index - self.before[word])
        return ((bit - index).astype(np.uint64) << np.uint64(self.width)) | _unpacked(self.low, index, self.width)

    def _smaller_high(self, part: np.ndarray) -> np.ndarray:
        """How many numbers have a high part less than ``part``: the place of zero
        bit number part - 1, less the zeros before it."""
        zeros = np.arange(len(self.before)) * _WORD - self.before
        k = np.clip(part - 1, 0, self.top)
        word = np.searchsorted(zeros, k, "right") - 1
        bit = word * _WORD + _kth_bit(~self.high[word], k - zeros[word])
        return np.where(part > self.top, self.size, np.where(part > 0, bit - k, 0))

    def successor(self, value: np.ndarray) -> np.ndarray:
        """The place of the first number that is at least each value."""
        value = value.astype(np.uint64)
        part = (value >> np.uint64(self.width)).astype(np.int64)
        low, high = self._smaller_high(part), self._smaller_high(part + 1)
        wanted = value & np.uint64((1 << self.width) - 1)
        while (open_ := low < high).any():
            middle = (low + high) // 2
            less = _unpacked(self.low, np.minimum(middle, max(self.size - 1, 0)), self.width) < wanted
            low = np.where(open_ & less, middle + 1, low)
            high = np.where(open_ & ~less, middle, high)
        return low
