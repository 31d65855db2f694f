"""Scalar column expressions (all JVM-side built-ins, no UDFs)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from hourcast.spec import COMPASS_DEGREES

# Right-closed PM2.5 bands and their labels.
BAND_EDGES = (35.0, 75.0, 150.0)
BAND_LABELS = ("low_<=35", "moderate_35_75", "high_75_150", "severe_>150")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def make_hour_ts(year, month, day, hour) -> Column:
    """(year, month, day, hour) -> TIMESTAMP_NTZ."""
    return F.make_timestamp_ntz(_c(year), _c(month), _c(day), _c(hour), F.lit(0), F.lit(0))


def hour_index(t) -> Column:
    """Whole hours since 1970-01-01 (a time-zone free bucket coordinate)."""
    return F.timestamp_diff("HOUR", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), _c(t))


def weekday_mon0(t) -> Column:
    """Monday=0 ... Sunday=6 (Spark ``weekday``; ``dayofweek`` is Sunday=1)."""
    return F.weekday(_c(t))


def wind_degrees(code) -> Column:
    """Compass code -> bearing in degrees; unknown or NULL -> 0.0."""
    lookup = F.create_map(*[x for k, v in COMPASS_DEGREES.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(lookup, _c(code)), F.lit(0.0))


def radians(code) -> Column:
    return wind_degrees(code) * F.lit(math.pi / 180.0)


def safe_ratio(num, den) -> Column:
    """num / (|den| + 1)."""
    return _c(num) / (F.abs(_c(den)) + F.lit(1.0))


def finite_or_null(x) -> Column:
    """NaN and +/-inf -> NULL."""
    x = _c(x)
    return F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(None).cast("double")).otherwise(x)


def clip_nonneg(x) -> Column:
    """max(x, 0); NULL stays NULL (``greatest`` would skip it and give 0)."""
    x = _c(x)
    return F.when(x < 0.0, F.lit(0.0)).otherwise(x)


def band(y) -> Column:
    """Right-closed bins (-inf,35], (35,75], (75,150], (150,inf)."""
    y = _c(y)
    return (
        F.when(y <= BAND_EDGES[0], F.lit(BAND_LABELS[0]))
        .when(y <= BAND_EDGES[1], F.lit(BAND_LABELS[1]))
        .when(y <= BAND_EDGES[2], F.lit(BAND_LABELS[2]))
        .when(y.isNotNull(), F.lit(BAND_LABELS[3]))
    )


def severe_weights(y, high: float = 1.0, severe: float = 4.0) -> Column:
    """1 + high*[y >= 75] + severe*[y >= 150] (cumulative, closed at the edge)."""
    y = _c(y)
    return (
        F.lit(1.0)
        + F.lit(float(high)) * (y >= 75.0).cast("double")
        + F.lit(float(severe)) * (y >= 150.0).cast("double")
    )


def cyclic(value, period: float) -> tuple[Column, Column]:
    angle = F.lit(2 * math.pi) * _c(value) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)
