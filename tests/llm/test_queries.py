"""The registered queries: against their SQL, and their contracts."""

import re

import pytest

import __spark_entry__ as entry
from catalog.check import connect, differences
from opsgauge.llm import queries  # noqa: F401
from opsgauge.llm.registry import ORACLES, QUERIES

COLUMNS = {
    1: {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"},
    2: {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"},
    3: {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    7: {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    8: {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    9: {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    10: {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"},
    11: {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    12: {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"},
    13: {"conv_id": "bigint", "gaps": "bigint", "blank": "bigint", "duplicate": "bigint", "truncated": "bigint", "illegal": "bigint", "cost": "bigint", "audit": "string", "repaired_sha256": "string"},
}


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, key):
    want = connect(sf_dir).execute(ORACLES[key]).fetchdf()
    assert differences(QUERIES[key](spark, sf_dir).toPandas(), want) is None


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", k)[1]) for k in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= entry.queries().keys()


@pytest.mark.parametrize("n", sorted(COLUMNS))
def test_columns(spark, sf_dir, n):
    key = next(k for k in QUERIES if k.startswith(f"op{n}_"))
    assert COLUMNS[n].items() <= dict(QUERIES[key](spark, sf_dir).dtypes).items()
