"""The subpackage's registered queries and their DuckDB SQL."""

from __future__ import annotations

from hourcast.llm import divergence_audit, exact_dedup, fill_in_middle, line_dedup, mixing
from hourcast.llm.bpe import op3_byte_bpe
from hourcast.llm.divergence_audit import op13_divergence_audit
from hourcast.llm.embedding_dedup import op7_embedding_near_dedup
from hourcast.llm.exact_dedup import op9_exact_dedup
from hourcast.llm.fill_in_middle import op12_fill_in_middle
from hourcast.llm.language_id import op6_language_id
from hourcast.llm.license_scan import op10_license_scan
from hourcast.llm.line_dedup import op11_line_dedup
from hourcast.llm.minhash_dedup import op1_minhash_near_dedup
from hourcast.llm.mixing import op5_mixing
from hourcast.llm.secrets_scan import op4_secret_scan
from hourcast.llm.suffix_dedup import op2_suffix_dedup
from hourcast.llm.toxicity import op8_toxicity

QUERIES = {
    f.__name__: f
    for f in (
        op1_minhash_near_dedup, op2_suffix_dedup, op3_byte_bpe, op4_secret_scan, op5_mixing, op6_language_id, op7_embedding_near_dedup,
        op8_toxicity, op9_exact_dedup, op10_license_scan, op11_line_dedup, op12_fill_in_middle, op13_divergence_audit,
    )
}
ORACLE = {
    "op5_mixing": mixing.SQL, "op9_exact_dedup": exact_dedup.SQL, "op11_line_dedup": line_dedup.SQL,
    "op12_fill_in_middle": fill_in_middle.SQL, "op13_divergence_audit": divergence_audit.SQL,
}


def pipeline(spark, sf_dir):
    """The stages of ``corpus_pipeline.py`` over ``documents``."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES["pipeline"] = pipeline
