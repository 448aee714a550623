"""Queries of the training-data operators against their DuckDB equivalents, by schema and values."""

import duckdb
import pytest

from cladeworks.llm import registry
from cladeworks.llm.oracles import ORACLES

SF = "/root/testdata/sf0.001"
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", ORACLES)
def test_same_as_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "labels"):
        duck.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = registry.queries()[name](spark, SF)
    result = duck.execute(ORACLES[name])
    names = [x[0] for x in result.description]
    assert {c: KINDS[k] for c, k in df.dtypes} == {x[0]: str(x[1]) for x in result.description}
    found = sorted(repr([r[n] for n in names]) for r in df.collect())
    assert found == sorted(map(repr, map(list, result.fetchall()))) and found
