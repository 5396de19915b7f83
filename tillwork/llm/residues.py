"""Exact integer matrix products from float32 products of remainders.

An integer is held by its remainders modulo several small primes. A float32 has 24 bits
for whole numbers, so a product of matrices of centred remainders is exact as long as a
row's terms add up to less than 2^24. Chinese remaindering puts the integers together.
"""

from __future__ import annotations

import math
from functools import cache

import numpy as np

# Components multiplied at once; more are added up after a reduction.
DEPTH = 64
_EXACT = 2**24


@cache
def primes_below(limit: int) -> tuple[int, ...]:
    """Odd primes below ``limit``, largest first."""
    return tuple(
        n
        for n in range(limit - 1, 2, -1)
        if n % 2 and all(n % f for f in range(3, math.isqrt(n) + 1, 2))
    )


def moduli_for(most: int) -> tuple[int, ...]:
    """Primes whose product exceeds ``2 * most``, so that -most ... most stay apart.

    The largest centred remainder is (p - 1) / 2, and ``DEPTH`` products of two of them must
    be exact.
    """
    limit = 2 * math.isqrt((_EXACT - 1) // DEPTH) + 2
    chosen, product = [], 1
    for p in primes_below(limit):
        if product > 2 * most:
            break
        chosen.append(p)
        product *= p
    return tuple(chosen)


def remainders(values: np.ndarray, modulus: int) -> np.ndarray:
    """Remainders between -(p - 1) / 2 and (p - 1) / 2, as float32."""
    half = modulus // 2
    return ((values + half) % modulus - half).astype(np.float32)


def product(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """``left @ right.T`` of int64 matrices; exact if all results fit an int64."""
    width = left.shape[1]
    if not width or not left.size or not right.size:
        return np.zeros((len(left), len(right)), np.int64)
    most = width * int(np.abs(left).max()) * int(np.abs(right).max())
    most = min(most, 2**63 - 1)
    moduli = moduli_for(most)
    digits: list[np.ndarray] = []
    total = np.zeros((len(left), len(right)), np.uint64)
    place = 1
    for i, p in enumerate(moduli):
        own = np.zeros((len(left), len(right)), np.float32)
        a, b = remainders(left, p), remainders(right, p)
        for start in range(0, width, DEPTH):
            part = a[:, start : start + DEPTH] @ b[:, start : start + DEPTH].T
            own = np.fmod(own + np.fmod(part, p), p)
        # Moved by ``most``, so that what is put together is between 0 and the product.
        digit = (own.astype(np.int64) + most % p) % p
        # Garner: the digit of place m1 * m2 * ... * m(i-1) in mixed radix.
        for q, earlier in zip(moduli[:i], digits, strict=True):
            digit = (digit - earlier) * pow(q, -1, p) % p
        digits.append(digit)
        total += digit.astype(np.uint64) * np.uint64(place % 2**64)
        place *= p
    return (total - np.uint64(most)).view(np.int64)
