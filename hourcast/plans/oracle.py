"""DuckDB text of the shared pipeline, for the oracle side of every query.

``prelude()`` defines ``panel`` (events -> hourly panel), ``cut`` (the
chronological cutoff), ``stats``/``wdmode`` (train-only medians and mode) and
``imp`` (causal forward fill + fallback).  ``windows()`` adds ``wq`` (window
functions over ``imp``) and ``win`` (valid 24 h windows with their target),
with extra per-row expressions computed over the named frames ``o`` (ordered
series), ``f3/f6/f12/f24`` (trailing frames).
"""

from __future__ import annotations

from hourcast.sources.events_panel import PANEL_CTE
from hourcast.spec import MEASURES

FRAMES = (2, 3, 6, 12, 24)


def prelude(fraction: float = 0.8) -> str:
    meds = ",\n  ".join(
        f"quantile_cont({m}, 0.5) FILTER (WHERE datetime <= (SELECT cutoff FROM cut)) AS med_{m}" for m in MEASURES
    )
    fills = ",\n    ".join(
        f"coalesce(last_value({m} IGNORE NULLS) OVER fw, (SELECT med_{m} FROM stats)) AS {m}" for m in MEASURES
    )
    return f"""WITH {PANEL_CTE},
times AS (SELECT datetime, row_number() OVER (ORDER BY datetime) - 1 AS i, count(*) OVER () AS n
          FROM (SELECT DISTINCT datetime FROM panel) d),
cut AS (SELECT datetime AS cutoff FROM times
        WHERE i = greatest(0, least(n - 2, CAST(floor(n * CAST({fraction} AS DOUBLE)) AS BIGINT) - 1))),
stats AS (SELECT {meds} FROM panel),
wdmode AS (SELECT coalesce((SELECT wd FROM panel WHERE datetime <= (SELECT cutoff FROM cut) AND wd IS NOT NULL
                            GROUP BY wd ORDER BY count(*) DESC, wd LIMIT 1), 'UNKNOWN') AS mode_wd),
imp AS (
  SELECT station, datetime, pm25 AS pm25_raw,
    {fills},
    coalesce(last_value(wd IGNORE NULLS) OVER fw, (SELECT mode_wd FROM wdmode)) AS wd
  FROM panel
  WINDOW fw AS (PARTITION BY station ORDER BY datetime ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


def lag(m: str, k: int) -> str:
    """Value of ``m`` at lag k (lag 1 = the window-end row itself)."""
    return m if k == 1 else f"lag({m}, {k - 1}) OVER o"


def windows(extra: dict[str, str] | None = None, size: int = 24, source: str = "imp") -> str:
    extras = "".join(f",\n    {expr} AS {name}" for name, expr in (extra or {}).items())
    frames = ",\n         ".join(
        f"f{k} AS (PARTITION BY station ORDER BY datetime ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"
        for k in sorted(set(FRAMES) | {size})
    )
    return f""",
wq AS (
  SELECT *, lead(pm25_raw) OVER o AS y_true, lead(datetime) OVER o AS target_time,
    count(*) OVER f{size} AS _n, min(datetime) OVER f{size} AS _first{extras}
  FROM {source}
  WINDOW o AS (PARTITION BY station ORDER BY datetime),
         {frames}),
win AS (
  SELECT * EXCLUDE (_n, _first), datetime AS window_end FROM wq
  WHERE _n = {size} AND _first = datetime - INTERVAL {size - 1} HOUR
    AND target_time = datetime + INTERVAL 1 HOUR AND y_true IS NOT NULL)"""


def r6(expr: str, name: str) -> str:
    return f"round({expr}, 6) AS {name}"
