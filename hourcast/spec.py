"""Panel description shared by all operators."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

# The eleven hourly measures of the panel, in the order the
# flattened window columns use (target first).
MEASURES = ("pm25", "pm10", "so2", "no2", "co", "o3", "temp", "pres", "dewp", "rain", "wspm")

# The sixteen compass codes and their bearings in degrees.
COMPASS_DEGREES = {
    "N": 0.0, "NNE": 22.5, "NE": 45.0, "ENE": 67.5,
    "E": 90.0, "ESE": 112.5, "SE": 135.0, "SSE": 157.5,
    "S": 180.0, "SSW": 202.5, "SW": 225.0, "WSW": 247.5,
    "W": 270.0, "WNW": 292.5, "NW": 315.0, "NNW": 337.5,
}
COMPASS_CODES = tuple(COMPASS_DEGREES)

# Prediction key columns of the long prediction table.
PRED_KEYS = ("station", "window_end", "target_time", "y_true")


@dataclass(frozen=True)
class PanelSpec:
    """Names of the series key, time column, target and measures of a panel.

    ``chunk_hours`` controls the time buckets used to split each series for
    window operators: rows are partitioned by ``(series, bucket)`` rather than
    by series alone, so one very long or very hot series never lands in a
    single task.  ``None`` partitions by series only.
    """

    series: str = "station"
    time: str = "datetime"
    target: str = "pm25"
    numeric: tuple[str, ...] = MEASURES
    categorical: tuple[str, ...] = ("wd",)
    window: int = 24
    chunk_hours: int | None = 24 * 30

    def present(self, df: DataFrame) -> "PanelSpec":
        """Restrict measures to the columns ``df`` actually has (driver-side schema check)."""
        cols = set(df.columns)
        return replace(
            self,
            numeric=tuple(c for c in self.numeric if c in cols),
            categorical=tuple(c for c in self.categorical if c in cols),
        )

    @property
    def wind(self) -> str | None:
        return "wd" if "wd" in self.categorical else None

    @property
    def raw_target(self) -> str:
        return f"{self.target}_raw"

    def with_chunk(self, hours: int | None) -> "PanelSpec":
        return replace(self, chunk_hours=hours)
