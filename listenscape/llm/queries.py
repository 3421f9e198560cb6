"""Registered queries of the subpackage."""

from __future__ import annotations

from . import (collocation, common, cover_tree, decontaminate, divergence, langid, line_dedup, minhash, quality, sample_pieces, sharding,
               suffix_dedup, token_orc, toxicity)


def _with_options(fn):
    def run(spark, sf_dir):
        return fn(common.configure(spark), sf_dir)

    run.__name__ = fn.__name__
    return run


QUERIES = {f.__name__: _with_options(f) for f in (
    suffix_dedup.op1_suffix_dedup, langid.op2_language_id, minhash.op3_minhash,
    sample_pieces.op4_sample_pieces, line_dedup.op5_line_dedup, toxicity.op6_toxicity, token_orc.op7_token_orc,
    decontaminate.op8_decontaminate, quality.op9_quality,
    cover_tree.op10_cover_tree, sharding.op11_sharding, divergence.op12_divergence, collocation.op13_collocations)}

#: The operators that DuckDB can express over whole tables; the others are tested against brute force in tests/llm.
ORACLE_SQL: dict[str, str] = {"op12_divergence": divergence.OP12_SQL, "op13_collocations": collocation.OP13_SQL}
