"""Every registered query against its DuckDB twin on the smallest tables."""

import pytest

import __spark_entry__ as ent
from callscore.plans import catalog
from callscore.plans.compare import compare, duck_connect

# trained models: no SQL gives their rows; test_models.py checks them
TRAINED = {"meta_model_cv", "best_meta_model", "text_model_eval", "matrix_model_eval"}
NAMES = sorted(set(catalog.queries()) - TRAINED)


@pytest.fixture(scope="module")
def con(small_dir):
    return duck_connect(small_dir)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, small_dir, name):
    df = ent.queries()[name](spark, small_dir)
    r = compare(df, con, ent.oracle_sql()[name])
    assert r["schema_match"] and r["values_match"], r


def test_every_query_has_an_oracle_except_trained_models():
    missing = set(catalog.queries()) - set(catalog.oracle_sql())
    assert missing == TRAINED, missing


def test_entry_runs(spark):
    df = ent.entry(spark)
    assert df.count() > 0 and "final_prob" in df.columns
