"""Registered corpus queries: their names, and those with SQL against DuckDB."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry_point
import corpus_pipeline
from strata.llm.queries import oracle_sql, queries
from tests.compare import differences, duckdb_views


def test_every_operator_and_the_pipeline_are_registered():
    names = entry_point.queries()
    assert [re.match(r"op(\d+)_", n)[1] for n in queries()] == [str(k) for k in range(1, 14)]
    assert set(queries()) | {"pipeline"} <= set(names)
    assert names["pipeline"] is corpus_pipeline.run
    assert set(oracle_sql()) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_duckdb(spark, sf_dir, name):
    result = queries()[name](spark, sf_dir)
    assert differences(result, duckdb_views(sf_dir), oracle_sql()[name]) == []


CONTRACT = {
    "op1_sharding": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op2_packing": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    "op3_minhash_dedup": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op4_url_filters": "page_id bigint, host string, path string, rule string, verdict string",
    "op6_quality_rules": (
        "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
        "n_repeat_words bigint, base_failed boolean, kept boolean"
    ),
    "op8_pii": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
    "op9_token_files": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op11_divergence": "lang string, source string, part string, item string, value bigint, rank int",
    "op12_infill": (
        "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, "
        "output_sha256 string, restored_sha256 string"
    ),
    "op13_byte_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
}


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_contract_columns(spark, sf_dir, name):
    got = dict(queries()[name](spark, sf_dir).dtypes)
    wanted = dict(part.split() for part in CONTRACT[name].split(", "))
    assert {c: got.get(c) for c in wanted} == wanted
