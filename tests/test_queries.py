"""Every query that has SQL gives the rows that DuckDB gives."""

import duckdb
import pytest

import __spark_entry__ as entry
from chronolex.queries import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings".split()


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    got = entry.queries()[name](spark, sf_dir).toPandas()
    if name not in ORACLE_SQL:
        assert len(got) > 0
        return
    want = duck.sql(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    got, want = rows(got), rows(want)
    assert len(got) == len(want)
    for c in got.columns:
        assert got[c].isna().tolist() == want[c].isna().tolist()
        assert got[c].dropna().tolist() == want[c].dropna().tolist(), c


def test_format_sizes_of_large_keys(spark, tmp_path):
    parts = [(0, 1), (1, 50), (100, 7), (2000, 3), (105131, 49), (119999, 50), (1199999, 50), (100450893, 50), (300000000, 50), (7, None), (None, 7)]
    spark.createDataFrame(parts, "p_partkey long, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    c = duckdb.connect()
    c.sql(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet/*.parquet'")
    want = c.sql(ORACLE_SQL["format_sizes"]).fetchall()
    got = [tuple(r) for r in entry.queries()["format_sizes"](spark, str(tmp_path)).collect()]
    assert len(want) == len(parts) and set(got) == set(want) and len(got) == len(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
