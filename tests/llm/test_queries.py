from __future__ import annotations

import pytest

from tidemark.llm import queries
from workload import check

CONTRACT = {
    "op1_string_kernel_toxicity": ("doc_id bigint", "held_out boolean", "score double", "predicted int"),
    "op4_url_rules": ("page_id bigint", "host string", "path string", "rule string", "verdict string"),
    "op5_mix_sources": ("doc_id bigint", "size bigint", "source_size bigint", "target double", "taken bigint"),
    "op6_graph_neighbours": ("query_id bigint", "rank int", "vec_id bigint", "score double"),
    "op7_best_fit_packing": ("doc_id bigint", "piece int", "start bigint", "length bigint", "ids_crc32 bigint",
                             "sequence_id bigint", "offset bigint"),
    "op8_weighted_fingerprints": ("doc_id bigint", "n_chars bigint", "edited_sha256 string", "fingerprint string",
                                  "edited_fingerprint string", "near_edited double", "near_next double"),
    "op9_minhash_near_dedup": ("doc_id bigint", "n_shingles bigint", "component_id bigint", "kept boolean"),
    "op10_suffix_array_dedup": ("doc_id bigint", "n_bytes bigint", "n_removed bigint", "n_spans bigint", "kept_sha256 string"),
    "op11_tokeniser_fertility": ("doc_id bigint", "n_words bigint", "word_chars bigint", "n_symbols bigint", "n_dup_lines bigint",
                                 "n_repeat_words bigint", "base_failed boolean", "kept boolean"),
    "op12_fill_in_middle": ("doc_id bigint", "n bigint", "form string", "prefix_chars bigint", "middle_chars bigint",
                            "output_sha256 string", "restored_sha256 string"),
    "op13_conversation_repair": ("conv_id bigint", "gaps bigint", "blank bigint", "duplicate bigint", "truncated bigint",
                                 "illegal bigint", "cost bigint", "audit string", "repaired_sha256 string"),
}


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_columns(spark, sf, name):
    dtypes = [f"{c} {t}" for c, t in queries.QUERIES[name](spark, sf).dtypes]
    assert tuple(dtypes[: len(CONTRACT[name])]) == CONTRACT[name]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, sf, name):
    assert check.compare(queries.QUERIES[name](spark, sf), check.duck(sf), queries.ORACLES[name]) is None


def test_no_python_in_the_native_queries(spark, sf):
    for name in ("op5_mix_sources", "op8_weighted_fingerprints"):
        plan = queries.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
