"""Every query of the reference's operators against its DuckDB equivalent, by schema and values."""

import functools
import os

import duckdb
import pytest

from cladeworks.plans import queries as q
from cladeworks.plans.oracles import ORACLES
from cladeworks.plans.queries import QUERIES

SF = os.environ.get("CLADEWORKS_SF", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings labels".split()
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.fixture(scope="module", autouse=True)
def shared_steps():
    """Sketches, components and groups that many queries begin with are computed once."""
    own = {name: getattr(q, name) for name in ("_classes", "_components", "_clusters", "_grouped", "_chosen")}
    for name, step in own.items():
        setattr(q, name, functools.cache(step))
    yield
    for name, step in own.items():
        setattr(q, name, step)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([float(r[i]) if isinstance(r[i], float) else r[i] for i in order]) for r in rows)


@pytest.mark.parametrize("name", ORACLES)
def test_same_as_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    found = df.collect()
    result = duck.execute(ORACLES[name])
    names, kinds = [x[0] for x in result.description], {x[0]: str(x[1]) for x in result.description}
    expected = result.fetchall()
    assert sorted(df.columns) == sorted(names)
    assert {c: KINDS[k] for c, k in df.dtypes} == kinds
    assert rows_of(df.columns, found) == rows_of(names, expected)
    assert found


def test_all_queries_have_sql_but_those_it_cannot_say():
    assert set(QUERIES) - set(ORACLES) == {"nj_tree", "newick_edges"}
