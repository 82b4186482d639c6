"""Every registered query against DuckDB on the smallest test tables."""

import datetime
import decimal
import math
import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from conftest import SF


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, (int, float, decimal.Decimal)):
        return ("number", float(value))
    if isinstance(value, (datetime.date, datetime.datetime)):
        return ("time", value.isoformat())
    return (type(value).__name__, str(value))


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, db, name):
    df = contract.queries()[name](spark, SF)
    found = df.collect()
    assert found, "an empty result proves nothing"
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return
    relation = db.execute(sql)
    names = [d[0] for d in relation.description]
    assert sorted(names) == sorted(df.columns)
    assert table(df.columns, found) == table(names, relation.fetchall())


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_every_declared_query_is_registered():
    """A query without a function to decorate would silently be missing."""
    source = "".join(p.read_text() for p in Path(contract.__file__).parent.glob("lexweave/catalogue/*.py"))
    literal = set(re.findall(r'query\("(\w+)"', source))
    assert literal <= set(contract.queries())
    for number in range(1, 25):
        assert any(q.startswith(f"s{number}_") for q in contract.queries()), number


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["People_ID", "People_Type_ID"]
    assert df.count() > 0
