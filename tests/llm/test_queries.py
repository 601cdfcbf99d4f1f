"""The registered queries against SQL, or against plain versions where SQL can't say it."""

from __future__ import annotations

import duckdb
import pytest
from compare import differences, duck

import __spark_entry__ as entry
from orderflow.llm import catalog, oracle

DIRECTORY = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def engine():
    return duck(DIRECTORY)


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_equals_sql(spark, engine, name):
    frame = entry.queries()[name](spark, DIRECTORY)
    assert differences(frame, engine, oracle.oracle_sql()[name]) is None


def test_every_operator_has_a_query():
    names = {name.split("_")[0] for name in catalog.queries()}
    assert names == {f"op{n}" for n in range(1, 14)}


def test_encoding_is_lossless_and_repeats(spark):
    rows = catalog.queries()["op1_sentencepiece"](spark, DIRECTORY)
    first = {r.doc_id: (r.ids, r.lossless) for r in rows.collect()}
    assert len(first) == spark.read.parquet(f"{DIRECTORY}/documents.parquet").count()
    assert all(lossless for _, lossless in first.values())
    again = {r.doc_id: (r.ids, r.lossless) for r in rows.repartition(3).collect()}
    assert again == first


def test_classifier_on_held_out_labels(spark):
    scored = catalog.queries()["op9_quality_classifier"](spark, DIRECTORY).toPandas()
    labels = duckdb.sql(f"SELECT * FROM '{DIRECTORY}/labels.parquet'").df()
    both = scored[scored.held_out].merge(labels, on="doc_id")
    assert len(scored) == scored.doc_id.nunique() and scored.score.between(0, 1).all()
    assert len(both) > 10 and (both.predicted == both.quality).mean() >= 0.95
