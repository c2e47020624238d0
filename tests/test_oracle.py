"""Every oracle-backed query against DuckDB on the smallest driver tables
(the driver repeats this at sf0.01)."""

import pytest

import __spark_entry__ as entry
from oracle_compare import compare, duck
from rankforge.plans.catalogue import QUERIES

SF = "/root/testdata/sf0.001"
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_callable_and_oracle_keys_exist():
    qs = entry.queries()
    assert set(ORACLE) <= set(qs)
    rows_only = set(QUERIES) - set(ORACLE)
    assert rows_only == {
        "lr_sweep", "rf_sweep", "mlp_sweep", "svc_sweep", "lr_iter_sweep", "rf_trees_sweep",
        "mlp_iter_sweep", "svc_iter_sweep", "binary_rf_sweep", "binary_mlp_rate_sweep",
        "binary_rf_trees_sweep", "binary_mlp_width_sweep",
        "lr_cv", "rf_cv", "mlp_cv", "cv_confusion", "family_comparison", "random_split_sizes",
        "sweep_confusion", "pca_variance", "feature_importance", "impute_similar", "rank_regression", "gbt_sweep",
    }


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    r = compare(df, con, ORACLE[name])
    assert r["cols_match"], r
    assert r["rows_spark"] == r["rows_oracle"], r
    assert r["hash_match"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["song", "artist", "class"]
    assert df.count() > 0
