"""Every registered query against its SQL twin, order ignored."""

import datetime
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_DIR

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
# spark type -> type the twin must have
TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, decimal.Decimal):
        return round(float(value), 6)
    if isinstance(value, datetime.datetime):
        return str(value)
    return value


def ordered(rows):
    return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_its_twin(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    found = ordered([tuple(plain(r[c]) for c in columns) for r in df.collect()])
    cursor = duck.execute(entry.oracle_sql()[name])
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    assert sorted(kinds) == columns
    place = [list(kinds).index(c) for c in columns]
    expected = ordered([tuple(plain(r[i]) for i in place) for r in cursor.fetchall()])
    assert found == expected
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == kinds


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() == 5


@pytest.mark.parametrize(
    "name", ["missingness", "offered_denominator", "quality_rules", "responses_enriched", "distribution_pct", "reachable"]
)
def test_no_join_without_a_key(spark, plan_of, name):
    plan = plan_of(entry.queries()[name](spark, SF_DIR))
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
