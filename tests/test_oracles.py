"""Every registered query against its DuckDB oracle at sf0.001 (the driver's check, locally)."""

import datetime
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from flatwatch.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "orders", "lineitem", "pages", "documents"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return repr(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t)}.parquet')")
    return con


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[-1] == "download_date"


SQL_TYPE = {"StringType()": "VARCHAR", "DoubleType()": "DOUBLE", "LongType()": "BIGINT", "IntegerType()": "INTEGER",
            "DateType()": "DATE", "BooleanType()": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    spark_types = {f.name: SQL_TYPE.get(str(f.dataType), str(f.dataType)) for f in df.schema.fields}
    assert spark_types == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert _rows(df.columns, df.collect()) == _rows(rel.columns, rel.fetchall())
