"""Every registered query of the library against its SQL in DuckDB, over whole small tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from terrasieve.plans import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def _shown(v):
    if v is None or v is pd.NA or v != v:
        return "null"
    return f"{float(v):.6f}" if isinstance(v, (int, float)) and not isinstance(v, bool) or hasattr(v, "dtype") and v.dtype.kind in "iuf" else str(v)


def _rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(_shown(v) for v in row) for row in frame.itertuples(index=False))


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, db, name):
    got = registry.QUERIES[name](spark, SF).toPandas()
    assert len(got.columns)
    if name in registry.ORACLES:
        want = db.sql(registry.ORACLES[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert _rows(got) == _rows(want)


def test_entry_points(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0


def test_span_islands_counts_ends_of_seconds(spark, db, tmp_path):
    at = [(1, "2024-01-01 00:00:00.9"), (1, "2024-01-01 06:00:00.1"), (1, "2024-01-01 12:00:00.0"), (2, "1969-12-31 23:59:59.5"), (2, "1970-01-01 05:59:59.7"), (3, None), (3, "2024-01-01 00:00:00.0"), (3, "2024-01-01 01:00:00.0"), (3, None)]
    rows = [(i, pd.Timestamp(t).to_pydatetime() if t else None, u) for i, (u, t) in enumerate(at)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long").write.parquet(f"{tmp_path}/events.parquet")
    c = duckdb.connect()
    c.sql(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    assert _rows(registry.QUERIES["span_islands"](spark, str(tmp_path)).toPandas()) == _rows(c.sql(registry.ORACLES["span_islands"]).df())
