"""Linear models from sufficient statistics (R3-R6, R12, E3 by group).

A Ridge fit needs its rows only through the Gram matrix of (1, features, label).  ``gram``
computes that matrix per group in one pass: each task multiplies Arrow batches with numpy
and keeps one K x K matrix a group; two small aggregations (by group and task number, then by group)
add them up, so no task adds more than its share of the partial matrices.

* **Sweep (R12).**  Rows are cut into consecutive time blocks and one Gram matrix is kept per
  block.  The training matrix of an expanding fold is a prefix sum of blocks and its
  validation error a quadratic form in the next block, so all candidates (penalty and
  feature group) x folds follow from one pass over the rows.  Scaling is refitted per fold
  from the same matrix, NULLs included: the indicator of each column that has NULLs is one more column.
* **Many series (R3, R4).**  One-hot columns of the series make the normal equations
  larger than any solver's limit, but their block is diagonal.  It is eliminated (Schur
  complement) with per-series sums, a distributed table of a row per series; what is left
  has the size of the features.  Effects are a projection of that table and are joined
  back for prediction.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourcast.functions.scalar import clip_nonneg
from hourcast.operators.models import feature_group, scaled, scaler_stats
from hourcast.operators.splits import expanding_folds, ts_lit
from hourcast.session import cut_lineage

#: First-level partial sums of one group.
FAN = 64
#: Doubles that a task's matrices may take before they are passed on.
HELD = 1 << 23
#: Most one-hot levels of the dense columns; a column with more belongs in ``series``.
MOST_LEVELS = 2000


def _added(rows: DataFrame, by: Sequence[str], k: int) -> DataFrame:
    """Sum of the packed k x k matrices of each group, a group at a time."""
    schema = rows.select(*by, "gram").schema

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(key: tuple, total: np.ndarray) -> pa.RecordBatch:
            cells = [pa.array([v], t.type) for v, t in zip(key, types, strict=True)]
            return pa.RecordBatch.from_arrays([*cells, pa.array([total.tobytes()], pa.binary())], [*by, "gram"])

        now, total, types = None, None, None
        for batch in batches:
            types = [batch.schema.field(i) for i in range(len(by))]
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(len(by))), strict=True)) if by else [()] * batch.num_rows
            for key, packed in zip(keys, batch.column(len(by)).to_pylist(), strict=True):
                if key != now:
                    if now is not None:
                        yield made(now, total)
                    now, total = key, np.zeros(k * k)
                total += np.frombuffer(packed)
        if now is not None:
            yield made(now, total)

    split = rows.select(*by, "gram")
    split = split.repartition(*by).sortWithinPartitions(*by) if by else split.coalesce(1)
    return split.mapInArrow(add, schema)


def gram(df: DataFrame, columns: Sequence[Column], by: Sequence[str] = (), weight: Column | None = None) -> DataFrame:
    """``(by..., gram binary)``: sum of w z z' over the rows of each group, z the ``columns`` (K doubles, none NULL),
    as K x K packed doubles.  One pass; groups without rows have no matrix."""
    by, k = list(by), len(columns)
    one = F.lit(1.0) if weight is None else weight.cast("double")
    rows = df.select(*by, F.array(*[c.cast("double") for c in columns], one).alias("_z"))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}
        types: list = []
        task = TaskContext.get().partitionId() % FAN

        def out() -> pa.RecordBatch:
            cells = [pa.array([key[i] for key in held], types[i]) for i in range(len(by))]
            return pa.RecordBatch.from_arrays(
                [*cells, pa.array([task] * len(held), pa.int32()), pa.array([g.tobytes() for g in held.values()], pa.binary())], [*by, "_task", "gram"]
            )

        for batch in batches:
            types = [batch.schema.field(i).type for i in range(len(by))]
            z = batch.column(len(by)).flatten().to_numpy(zero_copy_only=False).reshape(-1, k + 1)
            if not len(z):
                continue
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(len(by))), strict=True)) if by else [()] * len(z)
            number: dict[tuple, int] = {}
            group = np.array([number.setdefault(key, len(number)) for key in keys])
            order = np.argsort(group, kind="stable")
            edges = np.searchsorted(group[order], np.arange(len(number) + 1))
            for key, i, j in zip(number, edges[:-1], edges[1:], strict=True):
                x = z[order[i:j]]
                g = (x[:, :k] * x[:, k:]).T @ x[:, :k]
                if key in held:
                    held[key] += g
                else:
                    held[key] = g
            if len(held) * k * k > HELD:
                yield out()
                held.clear()
        if held:
            yield out()

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields if f.name in by)
    parts = rows.mapInArrow(partial, f"{fields}_task int, gram binary")
    return _added(_added(parts, [*by, "_task"], k), by, k)


def matrices(grams: DataFrame, by: Sequence[str] = ()) -> dict[tuple, np.ndarray]:
    """The matrices of a few groups (time blocks) on the driver."""
    out = {}
    for r in grams.collect():
        g = np.frombuffer(bytes(r["gram"]))
        out[tuple(r[c] for c in by)] = g.reshape(math.isqrt(len(g)), -1)
    return out


# --------------------------------------------------------------------------- designs

@dataclass
class Design:
    """Columns of the matrix: 1, shifted numerics, indicators of their NULLs, one-hot levels, label."""

    numeric: list[str]
    shift: dict[str, tuple[float, float]]
    gaps: list[str]
    levels: dict[str, list[str]]

    @classmethod
    def of(cls, df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> Design:
        """Shifts (one aggregation) only keep the sums well scaled; they drop out of every result."""
        numeric = list(numeric)
        nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(numeric)], F.count(F.lit(1)).alias("n")).first()
        gaps = [c for i, c in enumerate(numeric) if nulls[f"n{i}"]]
        return cls(numeric, scaler_stats(df, numeric), gaps, levels_of(df, categorical))

    def columns(self, label: str) -> list[Column]:
        shifted = [F.coalesce((F.col(c) - F.lit(m)) / F.lit(s or 1.0), F.lit(0.0)) for c, (m, s) in self.shift.items()]
        gaps = [F.col(c).isNull().cast("double") for c in self.gaps]
        hot = [F.coalesce(F.col(c) == v, F.lit(False)).cast("double") for c, vs in self.levels.items() for v in vs]
        return [F.lit(1.0), *shifted, *gaps, *hot, F.col(label)]

    def standardised(self, g: np.ndarray, numeric: Sequence[str], categorical: Sequence[str]) -> np.ndarray:
        """Matrix that turns the columns into (1, standardised ``numeric``, one-hot ``categorical``), with the means
        and population deviations of the rows behind ``g``; a NULL becomes 0, that is the mean."""
        at = {c: 1 + i for i, c in enumerate(self.numeric)}
        gap = {c: 1 + len(self.numeric) + i for i, c in enumerate(self.gaps)}
        start = 1 + len(self.numeric) + len(self.gaps)
        hot = []
        for c, vs in self.levels.items():
            if c in categorical:
                hot += range(start, start + len(vs))
            start += len(vs)
        t = np.zeros((len(g) - 1, 1 + len(numeric) + len(hot)))
        t[0, 0] = 1.0
        for j, c in enumerate(numeric, 1):
            i = at[c]
            n = g[0, 0] - (g[0, gap[c]] if c in gap else 0.0)
            mean = g[0, i] / n if n else 0.0
            var = g[i, i] / n - mean * mean if n else 0.0
            sd = math.sqrt(var) if var > 1e-13 else 1.0
            t[i, j], t[0, j] = 1.0 / sd, -mean / sd
            if c in gap:
                t[gap[c], j] = mean / sd
        for j, i in enumerate(hot, 1 + len(numeric)):
            t[i, j] = 1.0
        return t


def levels_of(df: DataFrame, categorical: Sequence[str]) -> dict[str, list[str]]:
    """The levels of each categorical column, NULL apart; at most ``MOST_LEVELS`` each."""
    levels = {}
    for c in categorical:
        found = [r[0] for r in df.where(F.col(c).isNotNull()).select(c).distinct().limit(MOST_LEVELS + 1).collect()]
        if len(found) > MOST_LEVELS:
            raise ValueError(f"{c} has more than {MOST_LEVELS} levels; fit it as the series of series_ridge")
        levels[c] = sorted(found)
    return levels


def solve(g: np.ndarray, b: np.ndarray, alpha: float) -> np.ndarray:
    """Ridge coefficients; the first column (intercept) bears no penalty."""
    penalty = np.full(len(g), float(alpha))
    penalty[0] = 0.0
    return np.linalg.lstsq(g + np.diag(penalty), b, rcond=None)[0] if alpha <= 0 else np.linalg.solve(g + np.diag(penalty), b)


def ridge_from(g: np.ndarray, design: Design, numeric: Sequence[str], categorical: Sequence[str], alpha: float) -> np.ndarray:
    """Coefficients, on the design's own columns, of the Ridge fitted to the rows behind ``g``."""
    t = design.standardised(g, numeric, categorical)
    return t @ solve(t.T @ g[:-1, :-1] @ t, t.T @ g[:-1, -1], alpha)


def squared_error(g: np.ndarray, coef: np.ndarray) -> float:
    """Sum of squared errors of a linear prediction over the rows behind ``g``."""
    return max(float(g[-1, -1] - 2 * coef @ g[:-1, -1] + coef @ g[:-1, :-1] @ coef), 0.0)


# --------------------------------------------------------------------------- R12

def ridge_candidates(n: int, seed: int = 42, groups: Sequence[str] = ("all_features",)) -> list[dict]:
    """A seeded table of candidates: penalty log-uniform in [0.001, 1000], feature group uniform."""
    rng = np.random.default_rng(seed)
    return [{"alpha": float(10 ** rng.uniform(-3, 3)), "group": groups[int(rng.integers(len(groups)))]} for _ in range(n)]


def ridge_sweep(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], candidates: Sequence[dict],
                n_splits: int = 3, time: str = "window_end", label: str = "y_true") -> DataFrame:
    """Every candidate on every expanding fold (W12), from one pass over the rows.

    Rows ``(candidate, alpha, feature_group, fold, train_rows, valid_rows, rmse)``; predictions are not clipped."""
    folds = expanding_folds(df, time, n_splits)
    edges = [folds[0][0], *[end for _, end in folds]]
    block = reduce(lambda a, e: a + (F.col(time) > ts_lit(e)).cast("int"), edges, F.lit(0))
    design = Design.of(df, numeric, categorical)
    known = df.where(F.col(label).isNotNull()).withColumn("_block", block).where(F.col("_block") <= n_splits)
    by_block = matrices(gram(known, design.columns(label), ["_block"]), ["_block"])
    rows = []
    for fold in range(n_splits):
        train = sum(by_block[b,] for b in range(fold + 1))
        valid = by_block[fold + 1,]
        n = valid[0, 0]
        for i, c in enumerate(candidates):
            coef = ridge_from(train, design, *feature_group(numeric, categorical, c["group"]), c["alpha"])
            rows.append((i, c["alpha"], c["group"], fold, int(train[0, 0]), int(n), math.sqrt(squared_error(valid, coef) / n)))
    return df.sparkSession.createDataFrame(
        rows, "candidate int, alpha double, feature_group string, fold int, train_rows long, valid_rows long, rmse double"
    )


def sweep_summary(scores: DataFrame, params: Sequence[str] = ("alpha", "feature_group")) -> DataFrame:
    """A row per candidate: its parameters, mean fold rmse, folds, rank (ties: first candidate) and the parameters as JSON."""
    from pyspark.sql import Window

    mean = scores.groupBy("candidate", *params).agg(F.avg("rmse").alias("mean_rmse"), F.count(F.lit(1)).alias("folds"))
    order = Window.orderBy(F.asc_nulls_last("mean_rmse"), "candidate")  # a row per candidate
    return mean.select("*", F.row_number().over(order).alias("rank"), F.to_json(F.struct(*params)).alias("params"))


def best_params(summary: DataFrame, path: str | None = None) -> dict:
    """The best candidate's parameters; written as one line of JSON to ``path`` where given."""
    best = summary.orderBy("rank").limit(1)
    if path:
        best.select(F.col("params").alias("value")).coalesce(1).write.mode("overwrite").text(path)
    return json.loads(best.first()["params"])


# --------------------------------------------------------------------------- many series

@dataclass
class SeriesRidge:
    """A Ridge with one-hot series, the series' effects apart: ``effects(series, rows, effect)``."""

    series: str
    stats: dict[str, tuple[float, float]]
    levels: dict[str, list[str]]
    coef: np.ndarray
    effects: DataFrame

    def predict(self, df: DataFrame, keys: Sequence[str], name: str = "ridge_series", clip: bool = True) -> DataFrame:
        """``(keys..., model, prediction)``; a series the fit has not seen has no effect."""
        keep = list(dict.fromkeys([*keys, self.series, *self.levels]))
        rows = scaled(df, self.stats, keep).join(self.effects.select(F.col("series").alias(self.series), "effect"), self.series, "left")
        dense = _dense(self.stats, self.levels)
        p = reduce(lambda a, b: a + b, [c * F.lit(float(w)) for c, w in zip(dense, self.coef, strict=True)]) + F.coalesce("effect", F.lit(0.0))
        return rows.select(*keys, F.lit(name).alias("model"), (clip_nonneg(p) if clip else p).alias("prediction"))


def _dense(stats: dict, levels: dict[str, list[str]]) -> list[Column]:
    hot = [F.coalesce(F.col(c) == v, F.lit(False)).cast("double") for c, vs in levels.items() for v in vs]
    return [F.lit(1.0), *[F.col(f"`{c}`") for c in stats], *hot]


def series_ridge(train: DataFrame, numeric: Sequence[str], series: str = "station", categorical: Sequence[str] = (),
                 alpha: float = 10.0, label: str = "y_true", weight: str | None = None) -> SeriesRidge:
    """R3-R5 with a one-hot column per series, for any number of series: equal to the plain fit.

    Four jobs: scaler statistics, per-series sums, the Gram matrix of the dense columns, and that of the sums
    over ``n + alpha``, which is what the series take away from it."""
    if alpha <= 0:
        raise ValueError("series effects need a penalty above zero")
    stats = scaler_stats(train, numeric)
    levels = levels_of(train, categorical)
    w = [weight] if weight else []
    rows = scaled(train.where(F.col(label).isNotNull()), stats, list(dict.fromkeys([series, *categorical, label, *w])))
    z = [*_dense(stats, levels), F.col(label)]
    k = len(z) - 1
    one = F.col(weight).cast("double") if weight else F.lit(1.0)
    sums = cut_lineage(
        rows.groupBy(F.col(series).alias("series")).agg(F.count(F.lit(1)).alias("rows"), *[F.sum(c * one).alias(f"s{i}") for i, c in enumerate(z)])
    )
    whole = matrices(gram(rows, z, weight=one if weight else None))[()]
    hidden = sums.where(F.col("series").isNotNull())  # a row without series has no one-hot column
    cells = [F.col(f"s{i}") for i in range(k + 1)]
    found = matrices(gram(hidden, cells, weight=1.0 / (F.col("s0") + F.lit(float(alpha)))))
    left = whole - found.get((), np.zeros_like(whole))
    coef = solve(left[:k, :k], left[:k, k], alpha)
    fitted = reduce(lambda a, b: a + b, [F.col(f"s{i}") * F.lit(float(c)) for i, c in enumerate(coef)])
    effects = hidden.select("series", "rows", ((F.col(f"s{k}") - fitted) / (F.col("s0") + F.lit(float(alpha)))).alias("effect"))
    return SeriesRidge(series, stats, levels, coef, effects)
