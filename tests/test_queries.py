"""Every registered query beside its SQL, on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from plumbago import queries

DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    return con


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    cell = lambda v: round(v, 6) if isinstance(v, float) and not math.isnan(v) else v
    return sorted(columns), sorted((tuple(cell(r[k]) for k in order) for r in records), key=repr)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_same_rows_as_sql(spark, duck, name):
    got = queries.QUERIES[name](spark, str(DATA))
    want = duck.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(columns, want.fetchall())


def test_others_run(spark):
    for name in set(queries.QUERIES) - set(queries.ORACLE_SQL):
        assert queries.QUERIES[name](spark, str(DATA)).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["doc_id", "word"]
