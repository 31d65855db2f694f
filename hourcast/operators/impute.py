"""Imputation operators (forward/back fill per series, train-only fallbacks).

Fills run on windows partitioned by ``(series, time bucket)``; the value that
crosses a bucket edge comes from a small per-bucket carry table (one row per
series and bucket), so no task ever holds a whole series.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourcast.functions import arrays as A
from hourcast.functions.quantiles import column_medians, most_frequent
from hourcast.functions.scalar import hour_index
from hourcast.session import cut_lineage
from hourcast.spec import PanelSpec

UNKNOWN = "UNKNOWN"


def _fill(df: DataFrame, spec: PanelSpec, cols: Sequence[str], forward: bool) -> DataFrame:
    s, t = spec.series, spec.time
    cols = [c for c in cols if c in df.columns]
    pick = (lambda c: F.last(c, ignorenulls=True)) if forward else (lambda c: F.first(c, ignorenulls=True))
    if not cols:
        return df
    if not spec.chunk_hours:
        w = Window.partitionBy(s).orderBy(t)
        frame = w.rowsBetween(Window.unboundedPreceding, 0) if forward else w.rowsBetween(0, Window.unboundedFollowing)
        return df.select(*[pick(c).over(frame).alias(c) if c in cols else F.col(c) for c in df.columns])

    d = df.withColumn("_chunk", F.floor(hour_index(t) / F.lit(spec.chunk_hours)))
    w = Window.partitionBy(s, "_chunk").orderBy(t)
    frame = w.rowsBetween(Window.unboundedPreceding, 0) if forward else w.rowsBetween(0, Window.unboundedFollowing)
    within = d.select(*[pick(c).over(frame).alias(c) if c in cols else F.col(c) for c in df.columns], "_chunk")
    # Edge value of each bucket: its last (forward) / first (backward) non-NULL value.
    edge = F.max_by if forward else F.min_by
    summ = d.groupBy(s, "_chunk").agg(
        *[edge(F.col(c), F.when(F.col(c).isNotNull(), F.col(t))).alias(c) for c in cols]
    )
    cw = Window.partitionBy(s).orderBy("_chunk")
    cframe = cw.rowsBetween(Window.unboundedPreceding, -1) if forward else cw.rowsBetween(1, Window.unboundedFollowing)
    carry = summ.select(s, "_chunk", *[pick(c).over(cframe).alias(f"_carry_{c}") for c in cols])
    out = within.join(carry, [s, "_chunk"], "left")
    return out.select(*[F.coalesce(c, f"_carry_{c}").alias(c) if c in cols else F.col(c) for c in df.columns])


def ffill_by_series(df: DataFrame, spec: PanelSpec = PanelSpec(), cols: Sequence[str] | None = None) -> DataFrame:
    """M1: last non-NULL value so far within each series."""
    spec = spec.present(df)
    return _fill(df, spec, cols or [*spec.numeric, *spec.categorical], forward=True)


def bfill_by_series(df: DataFrame, spec: PanelSpec = PanelSpec(), cols: Sequence[str] | None = None) -> DataFrame:
    """M2: next non-NULL value within each series (non-causal)."""
    spec = spec.present(df)
    return _fill(df, spec, cols or [*spec.numeric, *spec.categorical], forward=False)


@dataclass
class ImputeStats:
    """Fallback values fitted on training rows: exact medians + categorical mode."""

    medians: dict[str, float | None]
    modes: dict[str, str] = field(default_factory=dict)

    def to_df(self, spark) -> DataFrame:
        cols = [F.lit(v).cast("double").alias(f"median_{k}") for k, v in self.medians.items()]
        cols += [F.lit(v).cast("string").alias(f"mode_{k}") for k, v in self.modes.items()]
        return spark.range(1).select(*cols)

    def fill_exprs(self, df: DataFrame) -> list:
        out = []
        for c in df.columns:
            if c in self.medians and self.medians[c] is not None:
                out.append(F.coalesce(F.col(c), F.lit(float(self.medians[c]))).alias(c))
            elif c in self.modes:
                out.append(F.coalesce(F.col(c), F.lit(self.modes[c])).alias(c))
            else:
                out.append(F.col(c))
        return out


def impute_stats_fit(train: DataFrame, spec: PanelSpec = PanelSpec()) -> ImputeStats:
    """M4: exact training-period medians per measure, mode per categorical
    (ties -> smallest, none -> 'UNKNOWN')."""
    spec = spec.present(train)
    meds = column_medians(train, spec.numeric)
    modes = {}
    for c in spec.categorical:
        m = most_frequent(train, c)
        modes[c] = UNKNOWN if m is None else str(m)
    return ImputeStats(meds, modes)


def keep_raw_target(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Copy the un-imputed target so windows can score raw labels only."""
    if spec.raw_target in df.columns:
        return df
    return df.withColumn(spec.raw_target, F.col(spec.target))


def causal_impute(df: DataFrame, stats: ImputeStats, spec: PanelSpec = PanelSpec(), keep_raw: bool = False) -> DataFrame:
    """M5: forward fill within series, then training median / mode."""
    spec = spec.present(df)
    if keep_raw:
        df = keep_raw_target(df, spec)
    filled = _fill(df, spec, [*spec.numeric, *spec.categorical], forward=True)
    return filled.select(*stats.fill_exprs(filled))


def median_impute(df: DataFrame, stats: ImputeStats) -> DataFrame:
    """M6: training median / mode only, no fill along time."""
    return df.select(*stats.fill_exprs(df))


def stationwise_time_impute(df: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """M3 (first-day, non-causal): ffill -> bfill -> median of the filled
    columns; categoricals ffill -> bfill -> mode -> 'UNKNOWN'."""
    spec = spec.present(df)
    cols = [*spec.numeric, *spec.categorical]
    filled = cut_lineage(_fill(_fill(df, spec, cols, True), spec, cols, False))  # read by each statistic
    stats = impute_stats_fit(filled, spec)
    return filled.select(*stats.fill_exprs(filled))


def interpolated_windows(panel: DataFrame, stats: ImputeStats, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """M7 from the panel, in O(size) per window.

    Within a window ending at ``e`` the interpolated value at hour ``h`` only
    depends on the last observed (time, value) at or before ``h`` and the next
    observed (time, value) at or after ``h``, provided they fall inside
    ``[e-size+1, e]``.  Those four numbers are series-level forward / back
    fills (the bucketed ``_fill``), carried into the window array; one scalar
    transform then applies linear interpolation, nearest value at the edges
    and the train median for an all-missing window.  Equal to interpolating
    each window array by position (valid windows are consecutive hours)."""
    from hourcast.operators.windows import build_windows

    spec = spec.present(panel)
    t = spec.time
    ms = list(spec.numeric)
    h = hour_index(t)
    aug = panel.select(
        "*", h.alias("_h"),
        *[F.when(F.col(m).isNotNull(), h).alias(f"_pt_{m}") for m in ms],
        *[F.col(m).alias(f"_pv_{m}") for m in ms],
        *[F.when(F.col(m).isNotNull(), h).alias(f"_nt_{m}") for m in ms],
        *[F.col(m).alias(f"_nv_{m}") for m in ms],
    )
    aug = _fill(aug, spec, [f"_p{k}_{m}" for m in ms for k in ("t", "v")], forward=True)
    aug = _fill(aug, spec, [f"_n{k}_{m}" for m in ms for k in ("t", "v")], forward=False)
    fields = ["_h", *[f"_{a}{k}_{m}" for m in ms for a in ("p", "n") for k in ("t", "v")], *spec.categorical]
    wins = build_windows(aug, spec, fields=fields)
    size = spec.window
    e = hour_index(F.col("window_end"))
    lo = e - (size - 1)

    def elem(x):
        vals = []
        for m in ms:
            pt, pv, nt, nv = x[f"_pt_{m}"], x[f"_pv_{m}"], x[f"_nt_{m}"], x[f"_nv_{m}"]
            p_in = pt.isNotNull() & (pt >= lo)
            n_in = nt.isNotNull() & (nt <= e)
            v = (
                F.when(p_in & n_in & (pt == nt), pv)
                .when(p_in & n_in, pv + (nv - pv) * (x["_h"] - pt) / (nt - pt))
                .when(n_in, nv)
                .when(p_in, pv)
            )
            med = stats.medians.get(m)
            vals.append((F.coalesce(v, F.lit(med).cast("double")) if med is not None else v).alias(m))
        return F.struct(*vals, *[x[c].alias(c) for c in spec.categorical])

    out = wins.withColumn("w", F.transform("w", elem))
    if "wd_lag_1" in out.columns and "wd" in stats.modes:
        out = out.withColumn("wd_lag_1", F.coalesce(F.col("wd_lag_1"), F.lit(stats.modes["wd"])))
    return out


def rowwise_impute_supplied(windows: DataFrame, stats: ImputeStats, spec: PanelSpec = PanelSpec(),
                            key: str = "id", w: str = "w") -> DataFrame:
    """M8: supplied windows (array ``w`` per ``key``) -> long rows
    ``(key, lag, measures..., wd)`` with numeric lags linearly interpolated by
    position (edges nearest, all-NULL -> train median) and string lags
    forward- then back-filled along the lags (then train mode).

    Each window is exploded and handled by window functions partitioned by its
    key: partitions hold exactly ``size`` rows, and there is no per-element
    scan inside the array."""
    size = spec.window
    spec = spec.present(windows.select(F.explode(w).alias("_x")).select("_x.*"))
    ms, cats = list(spec.numeric), list(spec.categorical)
    e = windows.select(key, F.posexplode(w).alias("_pos", "_x")).select(
        key, "_pos", *[F.col(f"_x.{c}").alias(c) for c in (*ms, *cats)])
    o = Window.partitionBy(key).orderBy("_pos")
    bw = o.rowsBetween(Window.unboundedPreceding, 0)
    aw = o.rowsBetween(0, Window.unboundedFollowing)
    edges = []
    for m in ms:
        c = F.col(m)
        edges += [
            F.last(c, True).over(bw).alias(f"_pv_{m}"), F.first(c, True).over(aw).alias(f"_nv_{m}"),
            F.last(F.when(c.isNotNull(), F.col("_pos")), True).over(bw).alias(f"_pp_{m}"),
            F.first(F.when(c.isNotNull(), F.col("_pos")), True).over(aw).alias(f"_np_{m}"),
        ]
    for c in cats:
        edges += [F.last(c, True).over(bw).alias(f"_pv_{c}"), F.first(c, True).over(aw).alias(f"_nv_{c}")]
    staged = e.select(key, "_pos", *edges)
    cols = []
    for m in ms:
        pv, nv, pp, np_ = (F.col(f"_{k}_{m}") for k in ("pv", "nv", "pp", "np"))
        v = (F.when(pp.isNull(), nv).when(np_.isNull(), pv).when(pp == np_, pv)
             .otherwise(pv + (nv - pv) * (F.col("_pos") - pp) / (np_ - pp)))
        med = stats.medians.get(m)
        cols.append((F.coalesce(v, F.lit(med).cast("double")) if med is not None else v).alias(m))
    for c in cats:
        cols.append(F.coalesce(F.col(f"_pv_{c}"), F.col(f"_nv_{c}"), F.lit(stats.modes.get(c, UNKNOWN))).alias(c))
    return staged.select(key, (F.lit(size) - F.col("_pos")).alias("lag"), *cols)


def refold(long: DataFrame, key: str = "id", cols=None) -> DataFrame:
    """Long (key, lag, values...) back to one window array per key, oldest first."""
    cols = cols or [c for c in long.columns if c not in (key, "lag")]
    return long.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct((-F.col("lag")).alias("_o"), *cols))).alias("_w")
    ).select(key, F.transform("_w", lambda x: x.dropFields("_o")).alias("w"))


def matrix_fill(train: DataFrame, others: Sequence[DataFrame], numeric: Sequence[str], categorical: Sequence[str]):
    """M9: keep model columns common to all frames; numeric <- train median,
    categorical <- train mode (as string); same values applied to every frame."""
    common = [c for c in [*numeric, *categorical] if all(c in o.columns for o in [train, *others])]
    num = [c for c in numeric if c in common]
    cat = [c for c in categorical if c in common]
    meds = column_medians(train, num)
    modes = {}
    for c in cat:
        m = most_frequent(train, c)
        modes[c] = UNKNOWN if m is None else str(m)
    stats = ImputeStats(meds, modes)

    def apply(df):
        df = df.select(*[F.col(c).cast("string").alias(c) if c in cat else F.col(c) for c in df.columns])
        return df.select(*stats.fill_exprs(df))

    return stats, apply(train), [apply(o) for o in others]
