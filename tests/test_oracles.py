"""Every query of the library against its SQL, run by DuckDB on the same tables."""

import datetime
import decimal
import os

import duckdb
import pytest

from marlstone import chat_queries, order_queries, queries, record_queries, report_queries, structure_queries  # noqa: F401

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set temp_directory = ''")
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, int):
        return v
    if isinstance(v, (float, decimal.Decimal)):
        return f"{float(v):.9g}"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    got = table(df.columns, df.collect())
    if name not in queries.ORACLE_SQL:
        assert got[1]
        return
    result = duck.execute(queries.ORACLE_SQL[name])
    assert got == table([c[0] for c in result.description], result.fetchall())
