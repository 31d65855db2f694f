"""Registry of driver queries: Spark callables and their DuckDB oracle SQL.

Each ``@query(name)`` function takes ``(spark, sf_dir)`` and returns a
DataFrame; the oracle text for the same name lives in ``ORACLE``.  Double
columns are rounded to 6 decimals and integer columns are BIGINT on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, IntegerType, LongType, ShortType

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def positive_zero_rounds(sql: str) -> str:
    """Wrap every ``round(...)`` as ``(round(...) + 0.0)``: DuckDB rounds tiny
    negatives to -0.0 where Spark yields 0.0, and the two hash differently."""
    out, i, key = [], 0, "round("
    while True:
        j = sql.find(key, i)
        if j < 0 or (j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + len(key)])
            i = j + len(key)
            continue
        depth, k = 0, j + len(key) - 1
        while True:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        out.append(sql[i:j] + "(" + sql[j:k + 1] + " + 0.0)")
        i = k + 1


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = positive_zero_rounds(sql)
        return fn

    return deco


def normalise(df: DataFrame) -> DataFrame:
    """Round doubles to 6 places and widen integers to BIGINT (oracle contract)."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (DoubleType, FloatType)):
            out.append((F.round(c.cast("double"), 6) + F.lit(0.0)).alias(f.name))
        elif isinstance(f.dataType, (IntegerType, ShortType)):
            out.append(c.cast("long").alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def r6(c: Column, name: str) -> Column:
    return F.round(c.cast("double"), 6).alias(name)


# Import the query modules so their decorators run.
from hourcast.plans import (  # noqa: E402,F401
    queries_core, queries_experiments, queries_features, queries_models, queries_reports, queries_slices, queries_storage, queries_supplied, queries_sweeps,
)
