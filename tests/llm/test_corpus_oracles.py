"""Registered queries of the subpackage against their DuckDB SQL."""
import pytest

import __spark_entry__ as entry
from compare import duck, duck_rows, spark_rows
from eventweir.llm.oracles import ORACLES
from eventweir.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, con, name):
    assert spark_rows(QUERIES[name](spark, SF)) == duck_rows(con, ORACLES[name])


def test_all_are_registered():
    names = entry.queries()
    assert set(QUERIES) | {"pipeline"} <= set(names)
    numbers = sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op"))
    assert numbers == list(range(1, 14))
    assert set(entry.oracle_sql()) <= set(names)
