"""Each registered query with SQL gives what DuckDB gives; the others are stable under other partitions."""

from __future__ import annotations

from pathlib import Path

import pytest

from quire.plans import catalog, rules

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE_SQL = catalog.QUERIES | rules.QUERIES, catalog.ORACLE_SQL | rules.ORACLE_SQL


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from read_parquet('{p}')")
    return con


def plain(v):
    if isinstance(v, float):
        return round(v, 6) + 0.0
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(plain(r[i]) for i in order) for r in rows], key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, duck, name):
    own = QUERIES[name](spark, SF)
    got = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in got.description]
    assert sorted(own.columns) == sorted(names)
    left, right = rows_of(own.columns, [tuple(r) for r in own.collect()]), rows_of(names, got.fetchall())
    assert len(left) == len(right)
    assert [tuple(float(x) if isinstance(x, int) and not isinstance(x, bool) else x for x in r) for r in left] == [tuple(float(x) if isinstance(x, int) and not isinstance(x, bool) else x for x in r) for r in right]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_other_partitions(spark, name):
    first = sorted(map(repr, QUERIES[name](spark, SF).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        assert sorted(map(repr, QUERIES[name](spark, SF).collect())) == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
