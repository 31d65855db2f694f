"""Window-array expressions.

A window is one ``ARRAY<STRUCT<datetime, measures...>>`` column, oldest first.
The helpers below turn it into row-wise statistics with higher-order functions,
so every feature is a projection on the same row (no extra shuffle, no UDF).
NULL elements are skipped by mean/std/min/max/median/quantile/sum (pandas
``skipna``), but propagate through dot products (slope, EWMA), as NaN does in
numpy matrix products.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def field(w: Column, name: str) -> Column:
    return F.transform(w, lambda x: x[name])


def lag(a: Column, k: int, size: int) -> Column:
    """Element ``lag_k`` (lag_1 = newest = last element)."""
    return F.get(a, size - k)


def tail(a: Column, k: int, size: int) -> Column:
    """The newest ``k`` elements, still oldest first."""
    return a if k == size else F.slice(a, size - k + 1, k)


def nonnull(a: Column) -> Column:
    return F.filter(a, lambda x: x.isNotNull())


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x)


def nsum(a: Column) -> Column:
    """Sum skipping NULLs; empty -> 0 (pandas ``sum``)."""
    return _sum(nonnull(a))


def mean(a: Column) -> Column:
    nn = nonnull(a)
    n = F.size(nn)
    return F.when(n > 0, _sum(nn) / n)


def std(a: Column, ddof: int = 1) -> Column:
    """Standard deviation over non-NULL elements, in one pass (running mean and squares)."""

    def add(s: Column, x: Column) -> Column:
        n, d = s["n"] + 1, x - s["mean"]
        mean = s["mean"] + d / n
        return F.when(x.isNull(), s).otherwise(
            F.struct(n.alias("n"), mean.alias("mean"), (s["m2"] + d * (x - mean)).alias("m2"))
        )

    zero = F.struct(F.lit(0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    return F.aggregate(a, zero, add, lambda s: F.when(s["n"] > ddof, F.sqrt(s["m2"] / (s["n"] - F.lit(ddof)))))


def amin(a: Column) -> Column:
    return F.array_min(a)


def amax(a: Column) -> Column:
    return F.array_max(a)


def quantile(a: Column, q: float, presorted: bool = False) -> Column:
    """Linear-interpolation quantile of the non-NULL elements (``presorted``:
    ``a`` is already the sorted non-NULL array, e.g. a column made once)."""
    s = a if presorted else F.array_sort(nonnull(a))
    n = F.size(s)
    h = (n - 1).cast("double") * F.lit(float(q))
    lo = F.floor(h).cast("int")
    x_lo = F.try_element_at(s, lo + 1)
    x_hi = F.try_element_at(s, F.least(lo + 2, n))
    return F.when(n > 0, x_lo + (h - lo) * (x_hi - x_lo))


def dot(a: Column, weights: list[float]) -> Column:
    """Sum of element x weight; any NULL element makes the result NULL."""
    wl = F.array(*[F.lit(float(w)) for w in weights])
    return F.aggregate(F.zip_with(a, wl, lambda x, w: x * w), F.lit(0.0), lambda acc, x: acc + x)


def slope_weights(k: int) -> list[float]:
    """OLS slope on positions 0..k-1 as a fixed linear combination."""
    xs = [i - (k - 1) / 2.0 for i in range(k)]
    den = sum(x * x for x in xs)
    return [x / den for x in xs]


def ewma_weights(alpha: float, size: int) -> list[float]:
    """Weights (1-alpha)^(lag-1), oldest first, normalised to sum 1."""
    raw = [(1.0 - alpha) ** i for i in range(size - 1, -1, -1)]
    tot = sum(raw)
    return [r / tot for r in raw]


# --------------------------------------------------------------------------- the same as SQL text

def sql_tail(a: str, k: int, size: int) -> str:
    return a if k == size else f"slice({a}, {size - k + 1}, {k})"


def sql_stats(a: str) -> str:
    """A struct of count ``n``, sum ``s``, ``mean`` and squared deviations ``m2`` of the non-NULL elements."""
    step = ("named_struct('n', z.n + 1, 's', z.s + x, 'mean', z.mean + (x - z.mean) / (z.n + 1), "
            "'m2', z.m2 + (x - z.mean) * (x - (z.mean + (x - z.mean) / (z.n + 1))))")
    return f"aggregate({a}, named_struct('n', 0, 's', 0D, 'mean', 0D, 'm2', 0D), (z, x) -> if(x IS NULL, z, {step}))"


def sql_quantile(s: str, q: float) -> str:
    """Linear-interpolation quantile of a sorted array without NULLs."""
    h = f"((size({s}) - 1) * {q}D)"
    low = f"try_element_at({s}, CAST(floor({h}) AS INT) + 1)"
    return f"if(size({s}) > 0, {low} + ({h} - floor({h})) * (try_element_at({s}, least(CAST(floor({h}) AS INT) + 2, size({s}))) - {low}), NULL)"


def sql_dot(a: str, weights: list[float]) -> str:
    """Sum of element x weight; any NULL element makes the result NULL."""
    return f"aggregate(zip_with({a}, array({', '.join(f'{w!r}D' for w in weights)}), (x, w) -> x * w), 0D, (z, x) -> z + x)"
