"""Search in sorted arrays and hashes that any SQL engine can repeat."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _count_leading(bounds: Column, max_len: int, holds) -> Column:
    """Length of the prefix of ``bounds`` whose elements satisfy ``holds``, by binary search.

    Takes log2(max_len) steps: ``get`` past the end is null, which never advances.
    """
    steps, step = [], 1
    while step <= max_len:
        steps.insert(0, step)
        step *= 2
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda pos, s: F.when(holds(F.get(bounds, pos + s - 1)), pos + s).otherwise(pos),
    )


def lower_bound(bounds: Column, x: Column, max_len: int) -> Column:
    """Number of elements of the ascending array ``bounds`` that are below ``x``."""
    return _count_leading(bounds, max_len, lambda b: b < x)


def upper_bound(bounds: Column, x: Column, max_len: int) -> Column:
    """Number of elements of the ascending array ``bounds`` that are at most ``x``."""
    return _count_leading(bounds, max_len, lambda b: b <= x)


# fixed values: a hash of integer arithmetic alone. x -> x**5 is a permutation modulo this prime.
HASH_PRIME = 1_000_003
HASH_FOLD = 7919
HASH_SEED = 104_729


def portable_hash(id_col: str, seed: int) -> Column:
    """Integer in [0, HASH_PRIME) from an integer id; no intermediate exceeds a bigint."""
    folded = F.col(id_col) + F.expr(f"`{id_col}` div {HASH_PRIME}") * HASH_FOLD + seed * HASH_SEED
    x = folded % HASH_PRIME
    square = x * x % HASH_PRIME
    return square * square % HASH_PRIME * x % HASH_PRIME


def portable_uniform(id_col: str, seed: int, lo: float, hi: float) -> Column:
    return F.lit(lo) + portable_hash(id_col, seed) / F.lit(float(HASH_PRIME)) * F.lit(hi - lo)
