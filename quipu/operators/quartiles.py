"""Exact order statistics of many numeric columns at once, by radix selection.

A double's bits, read as a whole number with the sign folded in, are in the order of the doubles. A round counts the next
16 of those bits among the values that share the bits found so far, for all columns and ranks in one scan; four
rounds give all 64. Each task sends at most 65,536 counts per column and open prefix, whatever the values are, and there
is no sketch that could miss and nothing to widen. When few values are left below the prefixes they are counted
whole, which saves the last rounds.
"""

from __future__ import annotations

import struct
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIGIT = 16
_INFINITE = 0x7FF0 << 48


def order_key(x: Column) -> Column:
    """The bits of a double as a number in the order of the doubles; both zeros are 0.

    The exponent comes from a logarithm, which may be off by one next to a power of two; dividing by the power
    is exact and shows that.
    """
    size = F.abs(x)
    guess = F.least(F.greatest(F.floor(F.log2(size)), F.lit(-1022)), F.lit(1023))
    near = size / F.pow(F.lit(2.0), guess)  # exact, within [1/2, 4) for normal doubles
    low, high = near < 1.0, near >= 2.0
    part = F.when(low, near * 2.0).when(high, near / 2.0).otherwise(near)
    power = F.when(low, guess - 1).when(high, guess + 1).otherwise(guess)
    normal = F.shiftleft((power + 1023).cast("long"), 52) + ((part - 1.0) * float(1 << 52)).cast("long")
    tiny = (size * 2.0**537 * 2.0**537).cast("long")
    key = F.when(size == 0, F.lit(0).cast("long")).when(size < 2.0**-1022, tiny)
    key = key.when(size == float("inf"), F.lit(_INFINITE)).otherwise(normal)
    return F.when(x < 0, -key - 1).otherwise(key)


def value_of(key: int) -> float:
    """The double of a key; keys beyond the infinities are these."""
    key = max(min(key, _INFINITE), -_INFINITE - 1)
    return struct.unpack(">d", (key if key >= 0 else -key - 1).to_bytes(8, "big"))[0] * (1 if key >= 0 else -1)


@dataclass(frozen=True)
class _Prefix:
    """The upper bits that some values of a column share."""

    column: str
    bits: int
    value: int

    def holds(self) -> Column:
        c = F.col(self.column)
        if not self.bits:
            return c.isNotNull()
        rest = 64 - self.bits
        return c.between(F.lit(value_of(self.value << rest)), F.lit(value_of(((self.value + 1) << rest) - 1)))


def order_statistics(
    values: DataFrame, ranks: Mapping[str, Sequence[int]], few: int = 1_000_000
) -> dict[tuple[str, int], float]:
    """The value at each rank (from 0, nulls not counted) of each column of doubles, in at most four scans."""
    at = {(c, r): (_Prefix(c, 0, 0), r) for c, own in ranks.items() for r in set(own)}
    out: dict[tuple[str, int], float] = {}
    left = None
    while at:
        bits = next(iter(at.values()))[0].bits
        width = 64 - bits if left is not None and left <= few else DIGIT
        found = _counted(values, at, bits, width)
        following, left, seen = {}, 0, set()
        for (column, rank), (prefix, inside) in at.items():
            digit, before, n = found[prefix, inside]
            whole = _Prefix(column, bits + width, (prefix.value << width) + digit)
            if whole.bits == 64:
                out[column, rank] = value_of(whole.value)
                continue
            following[column, rank] = (whole, inside - before)
            if whole not in seen:
                seen.add(whole)
                left += n
        at = following
    return out


def _counted(
    values: DataFrame, at: Mapping[tuple[str, int], tuple[_Prefix, int]], bits: int, width: int
) -> dict[tuple[_Prefix, int], tuple[int, int, int]]:
    """Of each prefix and rank within it: the next digit, the values before that digit, and those that have it.

    Whether a prefix holds a value is two comparisons; keys are worked out for those it holds alone.
    """
    wanted: dict[_Prefix, list[int]] = {}
    for prefix, inside in at.values():
        wanted.setdefault(prefix, []).append(inside)
    prefixes = list(wanted)
    tests = [p.holds() for p in prefixes]
    tagged = [F.when(t, F.struct(F.lit(j).alias("j"), F.col(p.column).alias("x"))) for j, (p, t) in enumerate(zip(prefixes, tests))]
    rows = values.where(reduce(or_, tests)) if bits else values
    held = rows.select(F.explode(F.array_compact(F.array(*tagged))).alias("t")).select("t.j", order_key(F.col("t.x")).alias("key"))
    first = F.array(*[F.lit(p.value << width if bits else 0).cast("long") for p in prefixes])[F.col("j")]
    digit = F.shiftright("key", 64 - bits - width) - first
    tally = held.groupBy("j", digit.alias("d")).agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("j").orderBy("d"))
    ranks = F.array(*[F.array(*[F.lit(r).cast("long") for r in sorted(set(wanted[p]))]) for p in prefixes])
    placed = tally.select("j", "d", "n", (upto - F.col("n")).alias("before"), ranks[F.col("j")].alias("ranks"))
    found = placed.select("j", "d", "n", "before", F.explode("ranks").alias("rank"))
    found = found.where((F.col("before") <= F.col("rank")) & (F.col("rank") < F.col("before") + F.col("n")))
    return {(prefixes[r.j], r["rank"]): (r.d, r.before, r.n) for r in found.collect()}  # one row per column and rank
