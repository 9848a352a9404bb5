"""A keyed permutation of ``0 .. n - 1`` as a column expression.

A Feistel network over the grid ``a x b`` that just holds n: a number is a pair
(l, r) with l below a and r below b, and each round adds a hash of one half (and
of the key and the round) to the other half, modulo a or b. Rounds can be undone,
so a key permutes the whole grid. A result of n or more is put in again (cycle
walking); the grid has ``a * b - n`` such numbers, so at most that many times.
Different places 0, 1, 2, … of one key are different numbers, and their order
looks random: a sample without replacement, without pairs, arrays or state.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import hash_bucket

ROUNDS = 6
#: Sides looked at for the grid with the least waste.
SIDES = 100


def grid(n: int) -> tuple[int, int]:
    """Sides (a, b) of the grid: a from the root of n on, with the least a * b
    that holds n; the smallest such a."""
    root = math.isqrt(n - 1) + 1 if n > 1 else 1
    a = min(range(root, root + SIDES), key=lambda s: (s * -(-n // s), s))
    return a, -(-n // a)


def permuted(place: Column, key: Column, n: int, seed: int | str) -> Column:
    """The number below ``n`` that ``key`` has at ``place`` (0 to n - 1)."""
    a, b = grid(n)

    def turn(s: Column, i: Column) -> Column:
        # 31 bits of hash, cut down to the side of the half that changes
        h = lambda half: hash_bucket(key, i, half, seed=seed, space=2**31 - 1).cast("long")
        left = F.struct(((s["l"] + h(s["r"])) % F.lit(a)).alias("l"), s["r"].alias("r"))
        right = F.struct(s["l"].alias("l"), ((s["r"] + h(s["l"])) % F.lit(b)).alias("r"))
        return F.when(i % 2 == 0, left).otherwise(right)

    def once(x: Column) -> Column:
        start = F.struct(F.floor(x / F.lit(b)).cast("long").alias("l"), (x % F.lit(b)).cast("long").alias("r"))
        rounds = F.sequence(F.lit(0), F.lit(ROUNDS - 1))
        return F.aggregate(rounds, start, turn, lambda s: s["l"] * F.lit(b) + s["r"])

    first = F.struct(place.cast("long").alias("x"), F.lit(True).alias("walk"))
    walks = F.sequence(F.lit(0), F.lit(a * b - n))

    def walk(s: Column, _: Column) -> Column:
        moved = F.transform(F.array(once(s["x"])), lambda y: F.struct(y.alias("x"), (y >= F.lit(n)).alias("walk")))
        return F.when(s["walk"], F.get(moved, F.lit(0))).otherwise(s)

    return F.aggregate(walks, first, walk, lambda s: s["x"])
