"""Hashes that both Spark and DuckDB evaluate to the same value.

``element_hash(x)`` is the first 28 bits of md5 over the UTF-8 text of ``x``
(F3).  With 28-bit inputs and 31-bit multipliers ``a*x + b`` stays below 2^62,
so the permutation ``(a*x + b) mod p`` never overflows BIGINT under ANSI mode.
"""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Modulus of the universal hash family, and the number of
# permutations, bands and rows per band used for signatures and LSH.
MERSENNE_PRIME = 2147483647  # 2^31 - 1
NUM_PERM = 128
NUM_BANDS = 9
ROWS_PER_BAND = 13
SEED = 42
# Fixed value: modulus of the wide family, 2^61 - 1.
WIDE_PRIME = (1 << 61) - 1


def element_hash(col: Column) -> Column:
    """28-bit element hash: ``conv(substr(md5(str(x)), 1, 7), 16, 10)``."""
    return F.conv(F.substring(F.md5(col.cast("string")), 1, 7), 16, 10).cast("bigint")


def seeded_hash(*parts) -> Column:
    """Element hash of ``'part1:part2:...'`` (every part cast to string)."""
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return element_hash(F.concat_ws(":", *[c.cast("string") for c in cols]))


def wide_seeded_hash(*parts) -> Column:
    """60 bits in place of the 28 of ``seeded_hash``."""
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    text = F.concat_ws(":", *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def wide_element_hash(col: Column) -> Column:
    """60-bit element hash: two sets of 10^8 items differ in theirs all but
    surely, where 28 bits would give most items a namesake."""
    return F.conv(F.substring(F.md5(col.cast("string")), 1, 15), 16, 10).cast("bigint")


def wide_params(num_perm: int = NUM_PERM, seed: int = SEED) -> list[tuple[int, int]]:
    """(a, b) of the wide family, drawn like ``minhash_params``."""
    rng = random.Random(seed)
    return [(rng.randrange(1, WIDE_PRIME), rng.randrange(0, WIDE_PRIME)) for _ in range(num_perm)]


def wide_permute(h: np.ndarray, a: int, b: int) -> np.ndarray:
    """(a*h + b) mod 2^61 - 1 for h below it, in unsigned 64-bit numbers: both
    factors are split at 31 bits, and 2^61 counts as 1."""
    p, half = np.uint64(WIDE_PRIME), np.uint64(31)
    low = np.uint64((1 << 31) - 1)
    ah, al = np.uint64(a >> 31), np.uint64(a & ((1 << 31) - 1))
    hh, hl = h >> half, h & low
    mid = ah * hl + al * hh                                        # below 2^62
    high = (ah * hh << np.uint64(1)) + (mid >> np.uint64(30))      # 2^62 is 2
    high += (mid & np.uint64((1 << 30) - 1)) << half
    rest = al * hl
    rest = (rest & p) + (rest >> np.uint64(61)) + np.uint64(b)
    return ((high & p) + (high >> np.uint64(61)) + rest) % p


def minhash_params(num_perm: int = NUM_PERM, seed: int = SEED) -> list[tuple[int, int]]:
    """(a, b) for each permutation, drawn in order from ``random.Random(seed)``:
    ``a`` in [1, p), ``b`` in [0, p)."""
    rng = random.Random(seed)
    out = []
    for _ in range(num_perm):
        a = rng.randrange(1, MERSENNE_PRIME)
        b = rng.randrange(0, MERSENNE_PRIME)
        out.append((a, b))
    return out
