import pytest

import check
from kelpfit.plans import load

QUERIES, ORACLES = load()


@pytest.fixture(scope="module")
def duck(folder):
    return check.connect(folder)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, duck, folder, name):
    assert check.compare(spark, duck, name, folder) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_driver_contract(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    df = entry.entry(spark)
    assert df.columns == ["vec_id", "prediction"] and df.count() > 0


@pytest.mark.parametrize("name", ["knn_vote", "knn_wmedian", "linreg_predict", "split_exact", "dist_euclidean",
                                  "union_synthetic_rows", "permute_rows", "kmeans_predict", "tree_predict"])
def test_plans_hold_no_cross_join(spark, folder, name):
    plan = QUERIES[name](spark, folder)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
