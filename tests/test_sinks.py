import random

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from conftest import rows
from engage.sinks import writers as WR
from engage.sources import readers as RD


def _recs(spark, data):
    return spark.createDataFrame(data, "UserID string, NewsID string, click_probability double")


def test_replace_keyed(spark, tmp_path):
    path = str(tmp_path / "recs")
    WR.replace_keyed(_recs(spark, [("U1", "N1", 0.9), ("U1", "N2", 0.8), ("U2", "N3", 0.7)]),
                     path, buckets=4)
    WR.replace_keyed(_recs(spark, [("U1", "N9", 0.5)]), path, buckets=4)
    got = rows(WR.read_keyed(spark, path).select("UserID", "NewsID"))
    assert got == [("U1", "N9"), ("U2", "N3")]
    one = WR.cached_recommendations(spark, path, "U2")
    assert [r.NewsID for r in one.collect()] == ["N3"]
    assert "timestamp" in one.columns


def test_csv_drops_vectors(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 2.0, 0)], "a double, b double, prediction int")
    vec = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    WR.write_csv(vec, str(tmp_path / "c"))
    back = spark.read.option("header", "true").csv(str(tmp_path / "c"))
    assert back.columns == ["a", "b", "prediction"]


def test_tsv_quote_option(spark, tmp_path):
    p = tmp_path / "n.tsv"
    p.write_text('N1\tc\ts\t"quoted\ttitle"\n')
    default = RD.read_news(spark, str(p)).first()
    assert default.Title == "quoted\ttitle"
    literal = RD.read_news(spark, str(p), quote="").first()
    assert literal.Title == '"quoted'


def test_escaped_tsv_brings_whole_texts_back(spark, tmp_path):
    texts = ["plain", "", None, "two\nlines\n", "\r\n\ttab", "back\\slash \\n not a feed", '"quoted" "', "\\", "\\\\n\n",
             " spaced ", '\\"', "ünï 日本 😀"]
    data = [(f"N{i}", None, t, t, t, None, None, None) for i, t in enumerate(texts)]
    df = spark.createDataFrame(data, RD.NEWS_SCHEMA)
    WR.write_tsv(df, str(tmp_path / "n"), escaped=True)
    assert rows(RD.read_news(spark, str(tmp_path / "n"), escaped=True)) == rows(df)
    assert spark.read.text(str(tmp_path / "n")).count() == len(texts)
    assert RD.read_news(spark, str(tmp_path / "n"), limit=3).count() == 3


def test_first_available(spark, tmp_path):
    good = str(tmp_path / "t")
    spark.range(3).write.parquet(good)
    df = RD.first_available([lambda: RD.read_table(spark, str(tmp_path / "nope")),
                             lambda: RD.read_table(spark, good)])
    assert df.count() == 3
    with pytest.raises(FileNotFoundError):
        RD.first_available([lambda: RD.read_table(spark, str(tmp_path / "nope"))])


def test_model_results_roundtrip(spark, tmp_path):
    m = spark.createDataFrame([("LR", 0.8, 0.7)], "model string, accuracy double, auc double")
    WR.write_model_results(m, str(tmp_path / "mr"))
    back = RD.read_model_results(spark, str(tmp_path / "mr"))
    assert back.columns == ["model", "accuracy", "auc"]
    assert spark.read.parquet(str(tmp_path / "mr")).filter(F.col("timestamp").isNull()).count() == 0


def test_replace_keyed_handles_empty_merges_and_emptied_users(spark, tmp_path):
    path = str(tmp_path / "recs")
    WR.replace_keyed(_recs(spark, [("U1", "N1", 0.9), ("U2", "N2", 0.8)]), path, buckets=16)
    none = _recs(spark, [("U1", "N1", 0.9)]).limit(0)
    WR.replace_keyed(none, path, buckets=16)
    assert WR.read_keyed(spark, path).count() == 2
    WR.replace_keyed(none, path, buckets=16, keys=spark.createDataFrame([("U1",)], "UserID string"))
    assert [r.UserID for r in WR.read_keyed(spark, path).collect()] == ["U2"]
    assert WR.cached_recommendations(spark, path, "U2").count() == 1
    with pytest.raises(ValueError):
        WR.replace_keyed(none, path, buckets=8)


def test_a_replace_that_dies_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "recs")
    WR.replace_keyed(_recs(spark, [(f"U{i}", "N1", 0.5) for i in range(40)]), path, buckets=4)
    before = rows(WR.read_keyed(spark, path))
    new = _recs(spark, [(f"U{i}", "N2", 0.9) for i in range(30)])

    # the write of the new folders dies half way
    real = WR.bucket_of
    calls = []

    def half(key, buckets):
        calls.append(1)
        b = real(key, buckets)
        return F.when(b < 2, b).otherwise(F.raise_error(F.lit("disk gone")).cast("int")) if len(calls) == 2 else b
    monkeypatch.setattr(WR, "bucket_of", half)
    with pytest.raises(Exception, match="disk gone"):
        WR.replace_keyed(new, path, buckets=4)
    monkeypatch.setattr(WR, "bucket_of", real)
    assert rows(WR.read_keyed(spark, path)) == before

    # all folders are written, but the switch dies
    def dies(*_):
        raise OSError("driver lost")
    with monkeypatch.context() as m:
        m.setattr(WR, "commit_manifest", dies)
        with pytest.raises(OSError):
            WR.replace_keyed(new, path, buckets=4)
    assert rows(WR.read_keyed(spark, path)) == before
    assert WR.cached_recommendations(spark, path, "U3").first().NewsID == "N1"

    # the next replace works and what the dead ones left goes
    WR.replace_keyed(new, path, buckets=4)
    got = {r.UserID: r.NewsID for r in WR.read_keyed(spark, path).collect()}
    assert got == {f"U{i}": "N2" if i < 30 else "N1" for i in range(40)}
    WR.replace_keyed(new, path, buckets=4)
    folders = [f for b in (tmp_path / "recs").glob("bucket=*") for f in b.glob("version=*")]
    assert len(folders) <= 8 and len(list((tmp_path / "recs" / "_manifests").glob("*.json"))) == 2


def test_two_writers_of_one_state_do_not_both_win(spark, tmp_path):
    path = str(tmp_path / "recs")
    WR.replace_keyed(_recs(spark, [("U1", "N1", 0.5)]), path, buckets=2)
    state = WR.read_manifest(spark, path)
    with pytest.raises(Exception):
        WR.commit_manifest(spark, path, state)          # the number is taken
    assert WR.read_keyed(spark, path).count() == 1


def test_lookups_by_either_key_skip_row_groups(spark, tmp_path):
    """Row groups whose statistics admit a key, from the files' own footers."""
    import pyarrow.parquet as pq
    rng = random.Random(2)
    data = [(f"U{rng.randrange(900):03d}", f"N{rng.randrange(700):03d}", i) for i in range(60000)]
    df = spark.createDataFrame(data, "UserID string, NewsID string, v long")
    path = str(tmp_path / "z")
    WR.write_zordered(df, path, ["UserID", "NewsID"], files=64)
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == sorted(data)
    groups = []
    for f in (tmp_path / "z").glob("*.parquet"):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            stats = [meta.row_group(g).column(c).statistics for c in (0, 1)]
            groups.append([(s.min, s.max) for s in stats])
    assert len(groups) >= 32
    for column, keys in ((0, [f"U{i:03d}" for i in range(0, 900, 37)]), (1, [f"N{i:03d}" for i in range(0, 700, 37)])):
        read = [sum(lo <= k <= hi for lo, hi in (g[column] for g in groups)) for k in keys]
        assert max(read) <= len(groups) / 2 and sum(read) / len(read) <= len(groups) / 4


def test_a_zorder_sorts_a_bounded_number_of_rows_in_a_task(spark, tmp_path, monkeypatch):
    """More rows make more files, not larger sorts, whatever the number of
    shuffle partitions."""
    monkeypatch.setattr(WR, "FILE_ROWS", 500)
    df = spark.range(20000).select(F.concat(F.lit("U"), F.col("id") % 97).alias("UserID"),
                                   F.concat(F.lit("N"), F.col("id") % 89).alias("NewsID"), "id")
    path = str(tmp_path / "z")
    WR.write_zordered(df, path, ["UserID", "NewsID"])
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(20000))
    assert len(list((tmp_path / "z").glob("*.parquet"))) > 20


def test_packed_csv_comes_back(spark, tmp_path):
    data = [("U1", ' "a",\tb ', 1), ("U2", None, 2)]
    df = spark.createDataFrame(data, "UserID string, Title string, n int")
    WR.write_csv(df, str(tmp_path / "c"), compression="gzip")
    assert list((tmp_path / "c").glob("*.csv.gz")) and not list((tmp_path / "c").glob("*.csv"))
    from engage.sources.readers import read_csv
    assert sorted(map(tuple, read_csv(spark, str(tmp_path / "c"), df.schema).collect())) == data
