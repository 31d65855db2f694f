"""One-step-ahead alignment and sliding history windows.

Windows are computed per ``(series, time bucket)`` partition.  Every row is
emitted into its own bucket, and also into the next bucket when it lies in the
last ``size-1`` hours of its bucket (history of windows that end just after the
edge), and into the previous bucket when it is the bucket's first hour (the
one-step-ahead target of the previous bucket's last window).  Only rows in
their home bucket produce output.  A valid window spans ``size`` consecutive
hours plus its target hour, so it always fits in one bucket: results equal the
unbucketed computation while no task ever holds a whole series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourcast.functions.scalar import cyclic, hour_index, radians
from hourcast.spec import PanelSpec



def _hours(n: int):
    return F.expr(f"INTERVAL {int(n)} HOURS")


def bucketed(df: DataFrame, spec: PanelSpec, back_hours: int, fwd_hours: int) -> tuple[DataFrame, list[str]]:
    """Rows copied into neighbouring time buckets; returns (frame, partition cols).

    Adds ``_part`` (bucket the copy belongs to) and ``_home`` (copy is in its own
    bucket).  With ``chunk_hours=None`` the partition is the series alone.
    """
    s, t = spec.series, spec.time
    if "_cell" in df.columns:  # a stored panel: its rows lie in their buckets, copies and all
        return df, ["_cell", s, "_part"]
    if not spec.chunk_hours:
        return df.withColumn("_home", F.lit(True)), [s]
    size = spec.chunk_hours
    if size < back_hours + fwd_hours + 1:
        raise ValueError("chunk_hours must exceed the window overlap")
    h = hour_index(t)
    chunk = F.floor(h / F.lit(size))
    parts = F.array(
        chunk,
        F.when(h >= (chunk + 1) * size - back_hours, chunk + 1) if back_hours > 0 else F.lit(None).cast("long"),
        F.when(h < chunk * size + fwd_hours, chunk - 1) if fwd_hours > 0 else F.lit(None).cast("long"),
    )
    out = df.withColumn("_chunk", chunk).withColumn("_part", F.explode(F.filter(parts, lambda x: x.isNotNull())))
    return out.withColumn("_home", F.col("_part") == F.col("_chunk")), [s, "_part"]


def one_hour_ahead(df: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Next target and next time per series; keep rows whose next row is
    exactly one hour later and has an observed target."""
    s, t, y = spec.series, spec.time, spec.target
    cols = df.columns
    b, part = bucketed(df, spec, 0, 1)
    w = Window.partitionBy(*part).orderBy(t)
    out = b.select(
        *cols, "_home",
        F.lead(y, 1).over(w).alias("target_next"),
        F.lead(t, 1).over(w).alias("next_time"),
    )
    return out.where(
        F.col("_home") & (F.col("next_time") == F.col(t) + _hours(1)) & F.col("target_next").isNotNull()
    ).drop("_home")


def alignment_diagnostics(df: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Raw rows, stations, candidate rows (= rows - stations), valid
    one-hour rows and dropped rows, as one row."""
    raw = df.agg(F.count(F.lit(1)).alias("raw_rows"), F.count_distinct(spec.series).alias("stations"))
    valid = one_hour_ahead(df.select(spec.series, spec.time, spec.target), spec).agg(
        F.count(F.lit(1)).alias("valid_one_hour_rows")
    )
    r, v = raw.first(), valid.first()
    cand = r["raw_rows"] - r["stations"]
    return df.sparkSession.createDataFrame(
        [(r["raw_rows"], r["stations"], cand, v["valid_one_hour_rows"], cand - v["valid_one_hour_rows"])],
        "raw_rows long, stations long, candidate_one_step_rows long, valid_one_hour_rows long, "
        "dropped_nonconsecutive_or_missing_target_rows long",
    )


def build_windows(
    df: DataFrame,
    spec: PanelSpec = PanelSpec(),
    size: int | None = None,
    raw_target: str | None = None,
    keep_invalid: bool = False,
    fields: list[str] | None = None,
) -> DataFrame:
    """Sliding windows of ``size`` rows per series, anchored at the
    window end.

    Output: ``station, window_end, target_time, y_true, wd_lag_1, w`` where
    ``w`` is ``ARRAY<STRUCT<measures..., categoricals...>>`` oldest first.
    Features come from ``df`` (typically imputed); the target is the raw
    (un-imputed) value of the next row, taken from ``raw_target`` (default
    ``<target>_raw`` if present).  A window is kept when its rows are
    ``size`` consecutive hours, the next row is one hour later and the raw
    target is observed.  ``keep_invalid`` returns every candidate end with a
    ``continuous`` flag instead (W4).
    """
    size = size or spec.window
    if size < 2:
        raise ValueError("window size must be at least 2")
    spec = spec.present(df)
    s, t = spec.series, spec.time
    raw_target = raw_target or (spec.raw_target if spec.raw_target in df.columns else spec.target)
    b, part = bucketed(df, spec, size - 1, 1)
    w = Window.partitionBy(*part).orderBy(t)
    frame = w.rowsBetween(-(size - 1), 0)
    fields = fields or [*spec.numeric, *spec.categorical]
    cand = b.select(
        s, t, "_home",
        *([F.col("wd").alias("wd_lag_1")] if "wd" in spec.categorical else []),
        F.collect_list(F.struct(*fields)).over(frame).alias("w"),
        F.count(F.lit(1)).over(frame).alias("_n"),
        F.min(t).over(frame).alias("_first"),
        F.lead(raw_target, 1).over(w).alias("y_true"),
        F.lead(t, 1).over(w).alias("target_time"),
    ).where("_home")
    continuous = (
        (F.col("_n") == size)
        & (F.col("_first") == F.col(t) - _hours(size - 1))
        & (F.col("target_time") == F.col(t) + _hours(1))
    )
    cols = [s, F.col(t).alias("window_end"), "target_time", "y_true",
            *(["wd_lag_1"] if "wd" in spec.categorical else []), "w"]
    if keep_invalid:
        return cand.select(*cols, continuous.alias("continuous"))
    return cand.where(continuous & F.col("y_true").isNotNull()).select(*cols)


def flatten_lags(windows: DataFrame, spec: PanelSpec = PanelSpec(), size: int | None = None,
                 measures=None, keep_window: bool = False) -> DataFrame:
    """Window array -> scalar columns ``<m>_lag_<size> ... <m>_lag_1``.
    Only meant for the model boundary; features read the array directly."""
    size = size or spec.window
    measures = measures or spec.numeric
    lag_cols = [
        # get(): NULL instead of an ANSI error if a pushed-down predicate is
        # evaluated on a not-yet-filtered short window
        F.get(F.col("w"), size - k)[m].alias(f"{m}_lag_{k}") for m in measures for k in range(size, 0, -1)
    ]
    base = [c for c in windows.columns if c != "w" or keep_window]
    return windows.select(*base, *lag_cols)


def fold_lags(flat: DataFrame, spec: PanelSpec = PanelSpec(), size: int | None = None) -> DataFrame:
    """Inverse of W5 for supplied flattened windows: ``<m>_lag_k`` columns
    (and ``wd_lag_k`` when present) -> one window array ``w``."""
    size = size or spec.window
    present = set(flat.columns)
    fields = [m for m in [*spec.numeric, *spec.categorical] if f"{m}_lag_1" in present]
    elems = []
    for k in range(size, 0, -1):
        elems.append(F.struct(*[
            (F.col(f"{m}_lag_{k}") if f"{m}_lag_{k}" in present else F.lit(None).cast("string")).alias(m)
            for m in fields
        ]))
    lagged = {f"{m}_lag_{k}" for m in fields for k in range(1, size + 1)}
    keep = [c for c in flat.columns if c not in lagged or c == "wd_lag_1"]
    return flat.select(*keep, F.array(*elems).alias("w"))


#: The channels of a sequence after the measures, in order.
SEQUENCE_EXTRA = ("sin_hour", "cos_hour", "sin_month", "cos_month", "station_code", "wd_sin", "wd_cos")


def sequence_rows(df: DataFrame, codes: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """The rows of a panel with the calendar, series and wind channels of W14.  ``codes(series, station_code)`` is P21's table."""
    spec = spec.present(df)
    t = F.col(spec.time)
    sh, ch = cyclic(F.hour(t), 24.0)
    sm, cm = cyclic(F.month(t), 12.0)
    wind = radians(F.col("wd")) if spec.wind else None
    return df.join(codes, spec.series).select(
        *[F.col(c) for c in df.columns], sh.alias("sin_hour"), ch.alias("cos_hour"), sm.alias("sin_month"), cm.alias("cos_month"), "station_code",
        (F.lit(0.0) if wind is None else F.sin(wind)).alias("wd_sin"), (F.lit(0.0) if wind is None else F.cos(wind)).alias("wd_cos"),
    )


def sequence_tensor(rows: DataFrame, stats: dict[str, tuple[float, float]], spec: PanelSpec = PanelSpec(), size: int | None = None) -> DataFrame:
    """Valid windows of :func:`sequence_rows` as ``seq ARRAY<ARRAY<FLOAT>>`` (time x channel), each channel
    standardised by ``stats`` (mean, population std of training rows; std 0 counts as 1), and ``channels``."""
    spec = spec.present(rows)
    channels = [c for c in (*spec.numeric, *SEQUENCE_EXTRA) if c in stats]
    value = lambda c: ((F.col(c) - F.lit(stats[c][0])) / F.lit(stats[c][1] or 1.0)).cast("float")
    step = F.array(*[value(c) for c in channels]).alias("_step")
    raw = spec.raw_target if spec.raw_target in rows.columns else spec.target
    helpers = [c for c in ("_part", "_home", "_cell") if c in rows.columns]
    slim = rows.select(spec.series, spec.time, *helpers, F.col(raw).alias("_raw"), step)
    out = build_windows(slim, spec, size, raw_target="_raw", fields=["_step"])
    return out.select(*[c for c in out.columns if c != "w"], F.transform("w", lambda x: x["_step"]).alias("seq"),
                      F.array(*[F.lit(c) for c in channels]).alias("channels"))


def write_tensor(tensor: DataFrame, path: str, files: int | None = None) -> None:
    """W14 as a training sink: ``x`` (time x channel floats in one flat array of fixed length), ``y``, and the keys
    of each window, range-partitioned and sorted by target time; the shape lies beside it as one line of JSON."""
    from hourcast.sources.files import write_sorted

    shape = tensor.select(F.to_json(F.struct(F.size("seq").alias("steps"), F.size("channels").alias("width"), "channels")).alias("value")).limit(1)
    flat = tensor.select("station", "window_end", "target_time", F.col("y_true").cast("float").alias("y"), F.flatten("seq").alias("x"))
    write_sorted(flat, path, ["target_time", "station"], files=files)
    shape.coalesce(1).write.mode("overwrite").text(f"{path}-shape")


def standardise_target(df: DataFrame, mean: float, std: float, col: str = "y_true") -> DataFrame:
    """(y - mean) / (std + 1e-6) with population std of training targets."""
    return df.withColumn(f"{col}_std", (F.col(col) - F.lit(mean)) / F.lit(std + 1e-6))
