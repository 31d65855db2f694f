"""Chronological cutoffs, splits and folds.

Cutoffs and fold edges are order statistics of the distinct timestamps.  ``TimeRanks`` finds any
number of them together by counting: times are counted per coarse interval, the interval that holds
a rank is divided again, and only the last, small interval of each rank is read.  No task sorts or
ranks the whole time axis, however fine it is.  A cutoff is one scalar, applied as a literal
filter, so it prunes parquet row groups / partitions when the panel is stored by time.
"""

from __future__ import annotations

import bisect
import datetime as _dt
import itertools
import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourcast.session import cut_lineage


def ts_lit(x: _dt.datetime) -> Column:
    """A driver-side naive datetime as a TIMESTAMP_NTZ literal."""
    return F.expr(f"TIMESTAMP_NTZ '{x.isoformat(sep=' ')}'")


def time_index(df: DataFrame, time: str) -> Column:
    """A long that orders ``time`` (timestamp, timestamp_ntz, date or integer) and is the same in every time zone."""
    kind, t = df.schema[time].dataType.typeName(), F.col(time)
    if kind == "timestamp_ntz":
        second = F.hour(t) * 3600 + F.minute(t) * 60 + F.extract(F.lit("SECOND"), t)
        return F.unix_date(t.cast("date")).cast("long") * 86_400_000_000 + (second * 1_000_000).cast("long")
    return F.unix_micros(t) if kind == "timestamp" else F.unix_date(t).cast("long") if kind == "date" else t.cast("long")


class TimeRanks:
    """Order statistics of a time column, by distinct time or by row.

    The rows are read once, into a written table of row counts per time.  ``at`` then looks up any number of ranks
    together: a job per level of intervals (``fan`` parts each, so one or two for any real time axis) and one that
    reads the last intervals, of at most ``leaf`` times a rank."""

    def __init__(self, df: DataFrame, time: str, fan: int = 1024, leaf: int = 4096):
        self.fan, self.leaf = fan, leaf
        counted = df.where(F.col(time).isNotNull()).groupBy(time).agg(F.count(F.lit(1)).alias("rows"))
        self.table = cut_lineage(counted.select(F.col(time).alias("time"), time_index(counted, time).alias("u"), "rows"))
        r = self.table.agg(F.min("u"), F.max("u"), F.count(F.lit(1)), F.coalesce(F.sum("rows"), F.lit(0))).first()
        self.lo, self.hi, self.times, self.rows = r

    def at(self, ranks: Sequence[int], by_row: bool = False) -> list[tuple[_dt.datetime, int]]:
        """``(time, before)`` of each 0-based rank: the time that holds it, and how many times (``by_row``: rows) are earlier."""
        size = self.rows if by_row else self.times
        if any(not 0 <= r < size for r in ranks):
            raise ValueError(f"ranks {sorted(ranks)} outside 0 to {size - 1}")
        weight = F.col("rows") if by_row else F.lit(1).cast("long")
        # open interval -> what comes before it
        open_ = {(self.lo, self.hi): 0} if ranks else {}
        small: dict[tuple[int, int], int] = {}
        if self.times <= self.leaf:
            small, open_ = open_, {}
        while open_:
            parts = {span: -(-(span[1] - span[0] + 1) // self.fan) for span in open_}
            inside = [F.when(F.col("u").between(lo, hi), F.struct(
                F.lit(lo).cast("long").alias("lo"), F.call_function("div", F.col("u") - lo, F.lit(w).cast("long")).alias("part"))) for (lo, hi), w in parts.items()]
            found = self.table.select(F.coalesce(*inside).alias("p"), weight.alias("w")).where("p is not null").groupBy("p").agg(
                F.sum("w").alias("w"), F.count(F.lit(1)).alias("n")).collect()
            of: dict[int, list] = {}
            for r in sorted(found, key=lambda r: (r["p"]["lo"], r["p"]["part"])):
                of.setdefault(r["p"]["lo"], []).append(r)
            nxt: dict[tuple[int, int], int] = {}
            for span, before in open_.items():
                ends = list(itertools.accumulate((r["w"] for r in of[span[0]]), initial=before))
                for rank in ranks:
                    if before <= rank < ends[-1]:
                        i = bisect.bisect_right(ends, rank) - 1
                        lo = span[0] + of[span[0]][i]["p"]["part"] * parts[span]
                        part = (lo, min(lo + parts[span] - 1, span[1]))
                        (small if of[span[0]][i]["n"] <= self.leaf else nxt)[part] = ends[i]
            open_ = nxt
        if not ranks:
            return []
        wanted = reduce(lambda a, b: a | b, [F.col("u").between(*span) for span in small])
        rows = sorted(self.table.where(wanted).select("u", "time", weight.alias("w")).collect())
        out = []
        for rank in ranks:
            (lo, hi), before = max(((s, b) for s, b in small.items() if b <= rank), key=lambda x: (x[1], x[0]))
            for u, time, w in rows:
                if lo <= u <= hi:
                    if before + w > rank:
                        out.append((time, before))
                        break
                    before += w
        return out

    def nth(self, ranks: Sequence[int]) -> list[_dt.datetime]:
        """The distinct times of these 0-based ranks."""
        return [t for t, _ in self.at(ranks)]


def nth_distinct_time(df: DataFrame, time: str, k: int) -> _dt.datetime:
    """k-th (0-based) smallest distinct value of ``time``."""
    return TimeRanks(df, time).nth([k])[0]


def cutoff_index(n: int, fraction: float) -> int:
    """Index rule of the chronological cutoff: max(0, min(n-2, int(n*f)-1))."""
    if n < 2:
        raise ValueError("Need at least two unique timestamps for a chronological split.")
    return max(0, min(n - 2, int(math.floor(n * fraction)) - 1))


def chronological_cutoff(df: DataFrame, time: str = "datetime", fraction: float = 0.8) -> _dt.datetime:
    """Cutoff over the distinct timestamps of all series."""
    return chronological_cutoffs(df, time, [fraction])[0]


def chronological_cutoffs(df: DataFrame, time: str, fractions: Sequence[float]) -> list[_dt.datetime]:
    """W6 for several fractions (W13) from one look at the times."""
    ranks = TimeRanks(df, time)
    return ranks.nth([cutoff_index(ranks.times, f) for f in fractions])


def split_by_time(df: DataFrame, cutoff: _dt.datetime, time: str = "window_end") -> tuple[DataFrame, DataFrame]:
    """train = time <= cutoff, valid = the rest."""
    return df.where(F.col(time) <= ts_lit(cutoff)), df.where(F.col(time) > ts_lit(cutoff))


def split_guard(train: DataFrame, valid: DataFrame) -> None:
    if train.isEmpty() or valid.isEmpty():
        raise ValueError("Chronological split produced an empty train or validation set.")


def late_split_time(df: DataFrame, time: str = "target_time", fraction: float = 0.5) -> _dt.datetime:
    """Split time over distinct target times: index max(1,min(n-1,int(n*f)))-1."""
    ranks = TimeRanks(df, time)
    return ranks.nth([max(1, min(ranks.times - 1, int(math.floor(ranks.times * fraction)))) - 1])[0]


def holdout_boundary(df: DataFrame, time: str, fraction: float = 0.2) -> tuple[_dt.datetime, int]:
    """W8 helper: the time at which the last ``fraction`` of rows in time order begins, and how many of
    that time's rows come before it."""
    ranks = TimeRanks(df, time)
    if not ranks.rows:
        raise ValueError("No aligned rows are available for validation.")
    start = int(math.floor(ranks.rows * (1.0 - fraction)))  # rows of 0-based global rank >= start are held out
    boundary, before = ranks.at([start], by_row=True)[0]
    return boundary, start - before


def holdout_tail(df: DataFrame, time: str, tie: str, fraction: float = 0.2) -> DataFrame:
    """Rows with global (time, tie) rank in the last ``fraction``.

    Only rows of the boundary hour are ranked (by ``tie``); all others are
    decided by a literal time comparison."""
    bt, skip = holdout_boundary(df, time, fraction)
    b = ts_lit(bt)
    inside = df.where(F.col(time) == b).withColumn("_r", F.row_number().over(Window.partitionBy(time).orderBy(tie)) - 1)
    return df.where(F.col(time) > b).unionByName(inside.where(F.col("_r") >= skip).drop("_r"))


def latest_rows(df: DataFrame, n: int, time: str = "window_end", tie: str = "station") -> DataFrame:
    """The latest ``n`` rows by time (ties by ``tie``); n <= 0 -> all.
    Top-k with a bounded heap per task (TakeOrderedAndProject)."""
    if n <= 0:
        return df
    return df.orderBy(F.col(time).desc(), F.col(tie).desc()).limit(n)


def expanding_folds(df: DataFrame, time: str, n_splits: int = 3) -> list[tuple[_dt.datetime | None, _dt.datetime]]:
    """Expanding-window folds on time.

    Mirrors an n_splits time-series split on the distinct timestamps: the
    timestamps are cut into n_splits+1 consecutive blocks (the first takes the
    remainder); fold i trains on blocks 0..i and validates on block i+1.
    Returns (train_end, valid_end) boundaries per fold."""
    ranks = TimeRanks(df, time)
    test = ranks.times // (n_splits + 1)
    if test < 1:
        raise ValueError("too few timestamps for the requested folds")
    first = ranks.times - n_splits * test
    edges = ranks.nth([first + i * test - 1 for i in range(n_splits + 1)])
    return list(itertools.pairwise(edges))


def assign_folds(df: DataFrame, time: str, folds) -> DataFrame:
    """Long (fold, role, row) table from fold boundaries: one narrow pass per
    fold, unioned; a row can be train in one fold and valid in the next."""
    parts = []
    for i, (tr_end, va_end) in enumerate(folds):
        t = F.col(time)
        parts.append(df.where(t <= ts_lit(tr_end)).withColumn("fold", F.lit(i)).withColumn("role", F.lit("train")))
        parts.append(df.where((t > ts_lit(tr_end)) & (t <= ts_lit(va_end)))
                     .withColumn("fold", F.lit(i)).withColumn("role", F.lit("valid")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def rolling_origin_folds(df: DataFrame, time: str, folds: dict) -> DataFrame:
    """Named folds; train = time < start, valid = start <= time <= end.
    ``folds`` maps name -> (start, end) datetimes; empty folds are skipped."""
    parts = []
    for name, (start, end) in folds.items():
        t = F.col(time)
        parts.append(df.where(t < ts_lit(start)).withColumn("fold", F.lit(name)).withColumn("role", F.lit("train")))
        parts.append(df.where((t >= ts_lit(start)) & (t <= ts_lit(end)))
                     .withColumn("fold", F.lit(name)).withColumn("role", F.lit("valid")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
