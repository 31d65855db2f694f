"""The shared causal pipeline: panel -> cutoff -> train stats -> impute -> windows.

The panel, the imputed panel and the windows are materialised once per session (reliable
checkpoint in the cluster's ``spark.checkpoint.dir``), since cutoff, statistics and
every query read them again.  Scalars (cutoff, medians, modes) travel as literals.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.operators.impute import ImputeStats, causal_impute, impute_stats_fit
from hourcast.operators.splits import chronological_cutoff, ts_lit
from hourcast.operators.windows import build_windows
from hourcast.session import cut_lineage
from hourcast.sources.events_panel import hourly_panel
from hourcast.spec import PanelSpec

SPEC = PanelSpec()
_CACHE: dict = {}


def once(spark: SparkSession, key: tuple, make):
    """``make()`` once per Spark application and key; what ended applications left is dropped."""
    app = spark.sparkContext.applicationId
    for old in [k for k in _CACHE if k[0] != app]:
        del _CACHE[old]
    if (app, *key) not in _CACHE:
        _CACHE[app, *key] = make()
    return _CACHE[app, *key]


@dataclass
class Prepared:
    spec: PanelSpec
    panel: DataFrame
    cutoff: _dt.datetime
    stats: ImputeStats
    imputed: DataFrame
    windows: DataFrame
    #: The flattened windows given for prediction, once they have been written.
    supplied: DataFrame | None = None

    @property
    def train_windows(self) -> DataFrame:
        return self.windows.where(F.col("window_end") <= ts_lit(self.cutoff))

    @property
    def valid_windows(self) -> DataFrame:
        return self.windows.where(F.col("window_end") > ts_lit(self.cutoff))


def panel_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return once(spark, ("panel", sf_dir), lambda: cut_lineage(hourly_panel(spark, sf_dir)))


def prepare(spark: SparkSession, sf_dir: str, fraction: float = 0.8, spec: PanelSpec = SPEC) -> Prepared:
    def make() -> Prepared:
        panel = panel_of(spark, sf_dir)
        cutoff = chronological_cutoff(panel, spec.time, fraction)
        stats = impute_stats_fit(panel.where(F.col(spec.time) <= ts_lit(cutoff)), spec)
        imputed = cut_lineage(causal_impute(panel, stats, spec, keep_raw=True))
        return Prepared(spec, panel, cutoff, stats, imputed, cut_lineage(build_windows(imputed, spec)))

    return once(spark, ("prep", sf_dir, fraction, spec), make)
