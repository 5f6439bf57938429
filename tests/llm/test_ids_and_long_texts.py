"""Rows without a doc_id, ids that no double holds, and texts of several MB, through the operators that read each text by itself."""

import pytest

from docsink.llm import packing, quality_model, quality_rules, tokens, toxicity

from .conftest import prose

BIG = 2**53 + 1
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(None, prose(1, 120)), (None, None), (BIG, prose(2, 120)), (-BIG, ""), (5, prose(3, 400_000))]
    return spark.createDataFrame(rows + [(100 + k, prose(k, 100)) for k in range(40)], "doc_id long, text string").coalesce(2)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(100 + k, k % 2, k % 3 // 2) for k in range(40)], LABELS)


def ids(rows):
    return sorted((r["doc_id"] for r in rows), key=str)


def test_rules_and_tokens(spark, docs):
    want = ids(docs.collect())
    assert ids(quality_rules.quality_rules(spark, docs).collect()) == want
    counted = tokens.count_tokens(docs).collect()
    assert ids(counted) == want and max(r["n_bytes"] for r in counted) > 2_000_000


@pytest.mark.parametrize("model", [quality_model.quality, toxicity.toxicity])
def test_models(spark, docs, labels, model):
    rows = model(spark, docs, labels).collect()
    assert ids(rows) == ids(docs.collect())
    assert all(0 <= r["score"] <= 1 and (r["held_out"] is None) == (r["doc_id"] is None) for r in rows)


def test_packing(spark, docs):
    rows = packing.pack_documents(spark, docs).collect()
    assert set(ids(rows)) == set(ids(docs.collect()))
    assert sum(r["length"] for r in rows) == sum(r["n_tokens"] + 1 for r in tokens.count_tokens(docs).collect())
