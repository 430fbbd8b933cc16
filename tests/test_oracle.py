"""Every query that has SQL, against DuckDB on the smallest tables."""

import duckdb
import pytest

from mergewell.plans import queries as Q

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order) for r in rows]
    return sorted(columns), sorted(plain, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(Q.ORACLE_SQL))
def test_query(spark, sf, duck, name):
    df = Q.QUERIES[name](spark, sf)
    found = duck.execute(Q.ORACLE_SQL[name])
    columns = [c[0] for c in found.description]
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(found.fetchall(), columns)
