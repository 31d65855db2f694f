"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.session import ensure_checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: ``bytes.translate`` table that lower-cases A-Z only.
LOWER_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost
    executors, and gives later joins plain exchanges that AQE may split."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of :func:`materialise` that written tables have replaced: nothing reads them again."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._written_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def collect_garbage(df: DataFrame) -> None:
    """Have the driver collect its garbage between the parts of a long job: Spark drops shuffle files, broadcast
    tables and the state of jobs only when their plans are collected, which a driver with free heap puts off."""
    df.sparkSession._jvm.System.gc()


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only.  ``lower`` is that on texts without multi-byte
    characters, and several times cheaper than ``translate``."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)``: rows ``(id, component_id)`` for
    every node on an edge, ``component_id`` the smallest id reachable.

    Alternating large-star / small-star: each round is two grouped minima and two
    joins, written to the shared folder; links never reach the driver.  The
    number of rounds grows with the logarithm of the longest chain.  They end when
    every node has one smaller neighbour or only larger ones: links are stars then,
    which a further round would leave as they are.
    """
    e = materialise(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )
    for _ in range(most_rounds):
        ends = e.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
            e.select("v", F.lit(0), F.lit(1))
        )
        ends = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if not ends.where("up > 1 or (up = 1 and down = 1)").agg(F.count(F.lit(1))).first()[0]:
            return e.select(F.col("u").alias("id"), F.col("v").alias("component_id")).union(
                e.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct()
            )
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialise(
            both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "low"
        )
        large = materialise(
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large"
        )
        low = materialise(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        old, e = e, materialise(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "small")
        discard(old, least, large, low)
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def mix64(h: np.ndarray) -> np.ndarray:
    """A fixed 64-bit finaliser: spreads every input bit over the output."""
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0x9FB21C651E98DF25)
    h ^= h >> np.uint64(28)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h
