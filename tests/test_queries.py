"""Every query of the reference's operators against its SQL on DuckDB."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.operators import raster
from quire.plans import registry as Q

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_query_equals_sql(spark, db, name):
    got = Q.queries()[name](spark, SF)
    want = db.sql(Q.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    key = lambda r: tuple((x is None, str(x)) for x in r)
    a = sorted([tuple(r[c] for c in cols) for r in got.collect()], key=key)
    b = sorted([tuple(dict(zip(want.columns, r, strict=True))[c] for c in cols) for r in want.fetchall()], key=key)
    assert a == b


def test_text_presence_at_the_threshold(spark, tmp_path):
    """Scores next to the threshold in single precision, null and empty maps."""
    at = np.float32(0.35)
    maps = [[at], [np.nextafter(at, np.float32(0))], [np.nextafter(at, np.float32(1))], [0.1, None, at], [0.1, None], [float("nan")], [], None]
    rows = [(i, None if m is None else [None if x is None else float(x) for x in m]) for i, m in enumerate(maps)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    embeddings = duckdb.read_parquet(f"{tmp_path}/embeddings.parquet/*.parquet")  # noqa: F841  the name in the SQL
    got = Q.queries()["text_presence"](spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == sorted(duckdb.sql(Q.oracle_sql()["text_presence"]).fetchall())
    doubles = spark.createDataFrame([([0.3499999999],), ([0.35],)], "m array<double>").select(raster.confident(F.col("m"), 0.35))
    assert [r[0] for r in doubles.collect()] == [False, True]
