import duckdb
import pytest

import llm_cases as cases
from engage.llm.oracle import SQL
from engage.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "benchmark", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{cases.SF_SMALL}/{t}.parquet')")
    res = con.execute(SQL[name])
    cols = sorted(c[0] for c in res.description)
    want = sorted(map(str, res.df()[cols].astype(str).values.tolist()))
    df = QUERIES[name](spark, cases.SF_SMALL)
    assert sorted(df.columns) == cols
    assert sorted(map(str, df.toPandas()[cols].astype(str).values.tolist())) == want


PIPELINE = pytest.importorskip("corpus_pipeline")


def test_pipeline_stages(spark):
    assert [n for n, _ in PIPELINE.STAGES] == ["quality", "line_dedup", "simhash_dedup", "decontamination", "packing"]
    docs = cases.small(spark)
    before = docs
    for name, stage in PIPELINE.STAGES[:-1]:
        after = stage(spark, before, cases.SF_SMALL)
        assert after.columns == docs.columns
        ids = {r.doc_id for r in after.select("doc_id").collect()}
        assert ids and ids <= {r.doc_id for r in before.select("doc_id").collect()}
        before = spark.createDataFrame(after.collect(), docs.schema)
    packed = PIPELINE.run(spark, cases.SF_SMALL).collect()
    assert {r.doc_id for r in packed} == ids
