"""Every query of the catalogue against its SQL in DuckDB, on the smallest tables."""

import math
import re
from pathlib import Path

import pytest

import __spark_entry__ as entry
from legispark.plans import catalog

ROOT = Path(__file__).resolve().parent.parent
DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    return str(v) if v is not None and not isinstance(v, (bool, int)) else v


def table(names, found):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return [names[k] for k in order], sorted((tuple(plain(r[k]) for k in order) for r in found), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, DATA)
    found = duck.execute(catalog.SQL[name])
    assert table(df.columns, df.collect()) == table([c[0] for c in found.description], found.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0 and set(entry.oracle_sql()) <= set(entry.queries())


def test_nothing_else_imports_the_text_operators():
    for path in ROOT.joinpath("legispark").rglob("*.py"):
        if "llm" not in path.parts:
            assert not re.search(r"legispark\.llm|from \.llm|corpus_pipeline", path.read_text()), path


def test_scans_are_pruned_and_filters_pushed(spark):
    plan = catalog.QUERIES["passage_rate_by_term"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderpriority), EqualTo(o_orderpriority,1-URGENT)" in plan
    assert "ReadSchema: struct<o_orderstatus:string,o_orderdate:timestamp_ntz,o_orderpriority:string>" in plan
