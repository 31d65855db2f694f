"""Corpus pipeline over ``documents``: language ID, exact dedup, near dedup, mixing, BPE.

Each stage takes what its predecessor kept; all but the last return rows and columns of
``documents``.  ``run`` writes each stage's result to the cluster's shared folder and
rereads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.llm.bpe import token_digests
from hourcast.llm.common import materialise, table
from hourcast.llm.exact_dedup import exact_dedup
from hourcast.llm.language_id import fit_language_model, held_out, identify
from hourcast.llm.minhash_dedup import near_dups
from hourcast.llm.mixing import mix_sources

#: A document whose best language explains less of it than this is rejected.
LEAST_LANGUAGE_SCORE = 0.2
#: Near duplicates are judged on shingles of five words.
WIDTH = 5
#: Expected size of the mixed sample: this share of the tokens that reach the stage.
MIX_SHARE = 0.5


def keep(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id is in ``kept``; rows of null doc_id stay."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    ids = kept.where("doc_id is not null").select("doc_id").distinct()
    return docs.where("doc_id is not null").join(ids, "doc_id", "left_semi").select(columns).union(docs.where("doc_id is null"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the filters know; texts without a letter and null texts go."""
    model = fit_language_model(docs.where(~F.coalesce(held_out(F.col("doc_id"), 5, 0), F.lit(False))))
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # whatever the columns are called
    found = identify(plain, model, plain.columns, text=f"c{docs.columns.index('text')}")
    kept = found.where((F.col("lang_pred") != "und") & (F.col("lang_score") >= LEAST_LANGUAGE_SCORE))
    return kept.select(plain.columns).toDF(*docs.columns)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the largest doc_id, of each group of equal texts."""
    return keep(docs, exact_dedup(docs).where("kept"))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group of near duplicates."""
    return keep(docs, near_dups(docs, width=WIDTH).where("kept"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of documents in the target mix of sources, languages and topics, ``MIX_SHARE`` of the tokens."""
    return keep(docs, mix_sources(docs, keep_share=MIX_SHARE).where("kept"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and of the decoded text, per document."""
    return token_digests(docs)


STAGES = [
    ("language_id", language_stage),
    ("exact_dedup", exact_stage),
    ("minhash_near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("byte_bpe", bpe_stage),
]

#: Language filters, near-duplicate components and merges have no SQL form: tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
