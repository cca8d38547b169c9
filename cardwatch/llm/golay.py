"""The binary Golay code [23, 12], vectorised over numpy arrays.

Perfect: every 23-bit word lies within distance 3 of exactly one codeword, so
the 2048 syndromes stand for the 2048 error patterns of weight 0 to 3.  All
tables are derived from the generator polynomial.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

LENGTH, CHECK_BITS = 23, 11
# x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 (fixed value)
GENERATOR = 0b110001110101


def _remainder(word: int) -> int:
    for bit in range(LENGTH - 1, CHECK_BITS - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECK_BITS)
    return word


def _half_table(shift: int, bits: int) -> np.ndarray:
    units = [_remainder(1 << (shift + i)) for i in range(bits)]
    table = np.zeros(1 << bits, dtype=np.int32)
    for i, unit in enumerate(units):
        table[1 << i: 2 << i] = table[: 1 << i] ^ unit
    return table


def _error_table() -> np.ndarray:
    errors = np.zeros(1 << CHECK_BITS, dtype=np.int32)
    for weight in range(4):
        for bits in combinations(range(LENGTH), weight):
            word = sum(1 << b for b in bits)
            errors[_remainder(word)] = word
    return errors


_LOW, _HIGH = _half_table(0, 12), _half_table(12, LENGTH - 12)
_ERRORS = _error_table()
_BALL = np.array([0] + [1 << b for b in range(LENGTH)], dtype=np.int32)


def decode(words: np.ndarray) -> np.ndarray:
    """Index (12 message bits) of the codeword nearest to each word."""
    words = words.astype(np.int32)
    syndrome = _LOW[words & 0xFFF] ^ _HIGH[words >> 12]
    return (words ^ _ERRORS[syndrome]) >> CHECK_BITS


def nearby_indices(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(position, index)`` pairs: the codewords nearest to each word and to
    the 23 words one bit away, one to six different ones.

    Two words at most two bits apart have a word within one bit of both, and
    so an index in common."""
    found = np.sort(decode(words.astype(np.int32)[:, None] ^ _BALL[None, :]), axis=1)
    new = np.ones(found.shape, dtype=bool)
    new[:, 1:] = found[:, 1:] != found[:, :-1]
    at = np.nonzero(new)
    return at[0], found[at]
