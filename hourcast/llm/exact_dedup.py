"""Operator 9: exact dedup with a persistent digest index (DataFrame operations only).

The index is a table ``(digest, keep_id)`` bucketed and sorted by digest.  A batch
is reduced to one row per digest, anti-joined against the index by a sort-merge
join that reads the index without a shuffle, and the new digests are appended.
Only 32-byte digests and ids are shuffled, never texts.

Defined cases: null text equals the empty text; groups whose ids are all null
keep all their rows (``keep_id`` null); rows that repeat both id and text are the
same row and share its fate; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.llm.common import LOWER, UPPER, ascii_lower, materialise, shared_path, table
from hourcast.sources.files import matches

BUCKETS = 64


def normalised(text: Column) -> Column:
    return ascii_lower(F.coalesce(text, F.lit("")))


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text).cast("binary"), 256))


class DigestIndex:
    """Bucketed table of the digests seen so far, at ``path`` (shared folder).

    An index that stands at ``path`` is opened with all its rows, in whatever session; else an empty one
    is made.  Each append writes one file a bucket, however many partitions a shuffle has."""

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = BUCKETS):
        self.spark = spark
        self.path = path or shared_path(spark, "digest-index")
        spec = f"{self.path}-spec"
        if matches(spark, spec):
            buckets = spark.read.schema("buckets int").json(spec).first()["buckets"]
        else:
            spark.range(1).select(F.lit(buckets).alias("buckets")).coalesce(1).write.json(spec)
        self.buckets = buckets
        self.name = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.name} (digest BINARY, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{self.path}'"
        )

    def _append(self, rows: DataFrame) -> None:
        bucket = F.pmod(F.hash("digest"), F.lit(self.buckets))  # as the writer deals rows over buckets
        (
            rows.select("digest", "keep_id").repartition(self.buckets, bucket)
            .write.bucketBy(self.buckets, "digest").sortBy("digest").mode("append").format("parquet").saveAsTable(self.name)
        )

    def forget(self) -> None:
        """Take the index out of the catalog; its files stay and can be opened by path."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, batch: DataFrame) -> None:
        """Register ``batch(doc_id, digest)``; a digest keeps the id it got first,
        within one batch the largest."""
        first = batch.groupBy("digest").agg(F.max("doc_id").alias("keep_id"))
        self._append(first.hint("merge").join(self.rows().hint("merge"), "digest", "left_anti"))


def exact_dedup(docs: DataFrame, batches: int = 2) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: doc_id, keep_id, group_size, kept, text_sha256.

    The table is fed to a fresh index in ``batches`` ranges of descending doc_id,
    as a growing corpus would be, so the largest id of equal texts stays."""
    spark = docs.sparkSession
    rows = materialise(docs.select("doc_id", digest_of(F.col("text")).alias("digest")), "digests")
    lo, hi = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
    index = DigestIndex(spark)
    if lo is None:
        index.add(rows)
    else:
        step = (hi - lo) // batches + 1
        for i in range(batches):
            top = hi - i * step
            batch = rows.where(F.col("doc_id").isNotNull() & (F.col("doc_id") <= top) & (F.col("doc_id") > top - step))
            index.add(batch)
        index.add(rows.where(F.col("doc_id").isNull()))
    sizes = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
    groups = materialise(sizes.join(index.rows(), "digest"), "groups")
    index.forget()
    return rows.join(groups, "digest").select(
        "doc_id", "keep_id", "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


SQL = f"""
WITH n AS (SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM n JOIN g USING (text_sha256)
"""
