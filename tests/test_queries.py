"""Every registered query against its SQL, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from siteweave import queries as engine

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.is_dir(), reason="the driver's tables are not here")


def rows(frame) -> list:
    frame = frame[sorted(frame.columns)]
    return sorted((tuple(None if v is None or v != v else round(v, 6) if isinstance(v, float) else str(v) for v in r) for r in frame.itertuples(index=False, name=None)), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(engine.QUERIES))
def test_query(spark, duck, name):
    got = engine.QUERIES[name](spark, str(DATA)).toPandas()
    if name in engine.ORACLES:
        assert rows(got) == rows(duck.execute(engine.ORACLES[name]).df())
    else:
        assert len(got)


def test_entry(spark):
    assert engine.flagship(spark, str(DATA)).count() > 0
