"""End-to-end jobs on TSV logs written from the smallest fixture tables."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from engage.operators import ml as ML
from engage.plans import jobs as J
from engage.sinks import writers as WR
from engage.sources import fixtures as FX
from engage.sources import readers as RD
from engage.streaming import events as ST


def test_feature_train_recommend_cluster(spark, tmp_path):
    news_p, beh_p = str(tmp_path / "news"), str(tmp_path / "beh")
    WR.write_tsv(FX.news(spark, SF_SMALL), news_p)
    WR.write_tsv(FX.behaviors(spark, SF_SMALL), beh_p)
    out = str(tmp_path / "out")
    stats = J.feature_job(spark, [news_p], [beh_p], out)
    ds = RD.read_table(spark, f"{out}/featured_dataset")
    assert stats["featured_rows"] == ds.count() > 0
    assert stats["stored_rows"] == ds.count()
    serving = RD.read_table(spark, f"{out}/serving/interactions")
    assert sorted(serving.columns) == sorted(
        ["UserID", "NewsID", "Click", "Category", "Title", "article_ctr", "popularity_score",
         "user_ctr", "category_match", "activity_encoded", "title_len_encoded",
         "top_category_affinity", "TitleWordCount", "preferred_category"])

    models = str(tmp_path / "models")
    metrics = J.train_job(spark, out, models)
    assert metrics.count() == 3
    assert RD.read_model_results(spark, f"{models}/model_results").count() == 3
    model, again = ML.load_or_train(ML.model_path(models), ds)
    assert again is None           # loaded, not retrained

    recs = str(tmp_path / "recs")
    J.recommend_job(spark, out, models, recs, n=5)
    stored = WR.read_keyed(spark, recs)
    assert stored.groupBy("UserID").count().agg(F.max("count")).first()[0] <= 5
    user = stored.select("UserID").first()[0]
    got = WR.cached_recommendations(spark, recs, user).collect()
    probs = [r.click_probability for r in got]
    assert probs == sorted(probs, reverse=True)

    J.cluster_job(spark, out, str(tmp_path / "clusters"), level="article")
    back = spark.read.option("header", "true").csv(str(tmp_path / "clusters"))
    assert "prediction" in back.columns and "features" not in back.columns


def test_stream_job_from_files(spark, tmp_path):
    src = str(tmp_path / "msgs")
    FX.event_values(spark, SF_SMALL).select("value").write.json(src)
    q = J.stream_job(spark, "json", {}, "parquet", str(tmp_path / "ckpt"),
                     path=str(tmp_path / "sink"), source_path=src,
                     trigger={"availableNow": True})
    q.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "sink"))
    assert got.count() == FX.table(spark, SF_SMALL, "events").count()
    assert got.columns == ["UserID", "NewsID", "Category", "Click"]


def test_csv_reader_and_json_rows(spark, tmp_path):
    df = spark.createDataFrame([("U1", 0.5)], "UserID string, ctr double")
    WR.write_csv(df, str(tmp_path / "c"))
    back = RD.read_csv(spark, str(tmp_path / "c"), df.schema)
    assert back.collect() == df.collect()
    assert WR.to_json_rows(df).first().value == '{"UserID":"U1","ctr":0.5}'
    assert ST.events_to_json(df).first().value == '{"UserID":"U1","ctr":0.5}'


def test_broken_model_folder_raises_and_stays(spark, tmp_path):
    import pytest
    broken = tmp_path / "models" / "click_predictor"
    broken.mkdir(parents=True)
    (broken / "part").write_text("half")
    with pytest.raises(Exception):
        ML.load_or_train(str(broken), spark.range(1))
    assert (broken / "part").read_text() == "half"
