"""Queries that SQL can express against DuckDB; every other one runs whole."""
import pytest

from ratewise.llm.queries import LLM_ORACLE, LLM_QUERIES
from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck


@pytest.mark.parametrize("key", sorted(LLM_ORACLE))
def test_oracle(spark, key):
    assert not compare(LLM_QUERIES[key](spark, SF_SMALL), duck(SF_SMALL), LLM_ORACLE[key])


def test_entry_lists_all_operators_and_the_pipeline():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names
    assert sorted(int(k[2:].split("_")[0]) for k in names if k.startswith("op")) == list(range(1, 14))
