"""Every value-checked query against its DuckDB twin on the smallest tables."""

import math
import os

import duckdb
import pytest

from conftest import SF_SMALL
from engage.plans import catalog as C
from engage.plans.oracle import SQL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def v(x):
        if isinstance(x, float):
            return "nan" if math.isnan(x) else f"{x:.9g}"
        return repr(x)
    return sorted("|".join(v(r[i]) for i in order) for r in rows)


SPARK_TO_DUCK = {"StringType()": "VARCHAR", "IntegerType()": "INTEGER", "LongType()": "BIGINT",
                 "DoubleType()": "DOUBLE", "BooleanType()": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_types_match_duckdb(spark, con, name):
    df = C.QUERIES[name](spark, SF_SMALL)
    spark_types = {f.name: SPARK_TO_DUCK.get(str(f.dataType), str(f.dataType))
                   for f in df.schema.fields}
    duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {SQL[name]}").fetchall()}
    assert spark_types == duck_types


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_duckdb(spark, con, name):
    df = C.QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(SQL[name])
    dcols = [c[0] for c in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _canon(df.columns, srows) == _canon(dcols, drows)
