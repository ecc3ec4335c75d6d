"""Every SQL-expressible key against its DuckDB oracle on the smallest test tables."""
import pytest

from oracle.registry import ORACLE
from ratewise.plans.registry import QUERIES
from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck

SQL_KEYS = sorted(k for k in ORACLE if k in QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", SQL_KEYS)
def test_oracle(spark, con, key):
    problems = compare(QUERIES[key](spark, SF_SMALL), con, ORACLE[key])
    assert not problems, problems


def test_every_key_has_oracle_or_is_listed_rows_only():
    rows_only = {"pca_attributes", "pca_categories", "hybrid_predict", "feature_model_predict"}
    assert set(QUERIES) - set(ORACLE) <= rows_only
