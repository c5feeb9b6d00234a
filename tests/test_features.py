from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from engage.functions import expressions as X
from engage.operators import features as FE
from engage.plans.catalog import featured, interactions
from engage.session import staged
from engage.sources import fixtures as FX


def test_word_count_and_title_buckets(spark):
    df = spark.createDataFrame([(None,), ("",), ("a  b",), ("one two",)], "t string")
    got = rows(df.select(X.word_count("t").alias("n"),
                         X.word_count("t", "whitespace").alias("w")), order=False)
    assert got == [(-1, -1), (1, 0), (3, 2), (2, 2)]


def test_bucket_edges(spark):
    df = spark.createDataFrame([(v,) for v in (5, 6, 15, 16, 30, 31, None)], "n int")
    got = [r[0] for r in df.select(X.activity_code("n")).collect()]
    assert got == [0, 1, 1, 2, 2, 3, 3]
    df2 = spark.createDataFrame([(v,) for v in (6, 7, 10, 11, 15, 16)], "n int")
    assert [r[0] for r in df2.select(X.title_len_code("n")).collect()] == [0, 1, 1, 2, 2, 3]
    df3 = spark.createDataFrame([(v,) for v in (0, 1, 5, 9999, 10000)], "n int")
    got = [r[0] for r in df3.select(X.bounded_bucket("n", X.ACTIVITY_EDGES,
                                                     X.ACTIVITY_MAX)).collect()]
    assert got == [None, 0, 0, 3, None]


def test_round_half_up_vs_half_even(spark):
    df = spark.createDataFrame([(1, 32)], "c long, i long")
    r = df.select(X.ratio("c", "i").alias("up"),
                  X.ratio("c", "i", half_even=True).alias("even")).first()
    assert (r.up, r.even) == (0.0313, 0.0312)


def _inter(spark, data):
    return spark.createDataFrame(data, "UserID string, NewsID string, Click int, Time string")


def test_top_category_ties(spark):
    inter = _inter(spark, [("U1", "N1", 1, "t"), ("U1", "N2", 1, "t"), ("U2", "N1", 1, "t")])
    news = spark.createDataFrame([("N1", "b"), ("N2", "a")], "NewsID string, Category string")
    aff = FE.category_affinity(inter, news)
    all_ = rows(FE.top_category(aff, "all").filter("UserID = 'U1'"))
    first = rows(FE.top_category(aff, "first").filter("UserID = 'U1'"))
    assert all_ == [("U1", "a", 0.5), ("U1", "b", 0.5)]
    assert first == [("U1", "a", 0.5)]


def test_missing_article_keeps_null_category(spark):
    inter = _inter(spark, [("U1", "N404", 1, "t"), ("U1", "N1", 0, "t")])
    news = spark.createDataFrame([("N1", None, None, None, None, None, None, None)],
                                 "NewsID string, Category string, SubCategory string, "
                                 "Title string, Abstract string, URL string, TitleEnt string, "
                                 "AbsEnt string")
    ds = FE.featured_dataset(inter, news)
    got = {r.NewsID: r for r in ds.collect()}
    # missing article: null category, title bucket 3 (otherwise), count filled 8
    assert got["N404"].Category is None
    assert got["N404"].title_len_encoded == 3 and got["N404"].TitleWordCount == 8
    # catalogue null category becomes "unknown"; null title counts -1 -> bucket 0
    assert got["N1"].Category == "unknown"
    assert got["N1"].TitleWordCount == -1 and got["N1"].title_len_encoded == 0
    # the user's only click is on the missing article -> preferred category null
    assert got["N1"].preferred_category is None and got["N1"].category_match == 0


def test_properties_on_fixture(spark):
    inter = interactions(spark, SF_SMALL)
    a = FE.article_stats(inter).agg(F.sum("total_clicks")).first()[0]
    u = FE.user_stats(inter).agg(F.sum("user_total_clicks")).first()[0]
    assert a == u
    aff = FE.category_affinity(inter, FE.news_clean(FX.news(spark, SF_SMALL)))
    worst = (aff.groupBy("UserID").agg(F.sum("category_affinity").alias("s"))
                .agg(F.max(F.abs(F.col("s") - 1))).first()[0])
    assert worst < 0.01
    first = featured(spark, SF_SMALL, ties="first")
    assert first.count() == inter.count()
    assert featured(spark, SF_SMALL).count() >= inter.count()


def test_dashboard_variant_edges(spark):
    inter = _inter(spark, [("U1", "N1", 1, "t"), ("U1", "N2", 0, "t"), ("U1", "N404", 1, "t")])
    news = spark.createDataFrame(
        [("N1", None, None, "", None, None, None, None),
         ("N2", "b", "s", "a  b\tc", None, None, None, None),
         ("N2", "b", "s", "a  b\tc", None, None, None, None)],
        "NewsID string, Category string, SubCategory string, Title string, Abstract string, "
        "URL string, TitleEnt string, AbsEnt string")
    got = {r.NewsID: r for r in FE.dashboard_featured(inter, news).collect()}
    # N404 is not in the catalogue: dropped; the duplicate N2 row does not multiply
    assert sorted(got) == ["N1", "N2"]
    # empty title: 0 words -> outside the bins -> 1; null category becomes ""
    assert got["N1"].TitleWordCount == 0 and got["N1"].title_len_encoded == 1
    assert got["N1"].Category == "" and got["N1"].preferred_category == ""
    assert got["N2"].TitleWordCount == 3 and got["N2"].title_len_encoded == 0
    assert got["N1"].category_match == 1 and got["N2"].category_match == 0


def test_hot_article_and_hot_user_are_split_without_broadcasts(spark):
    """A third of all rows on one article and a third on one user: with
    broadcasts off the skew rule splits both joins, and the rows are those of
    the default plan."""
    n = 30000
    inter = spark.range(n, numPartitions=8).select(
        F.when(F.col("id") % 3 == 1, F.lit("U0")).otherwise(F.concat(F.lit("U"), (F.col("id") % 977).cast("string")))
         .alias("UserID"),
        F.when(F.col("id") % 3 == 0, F.lit("N0")).otherwise(F.concat(F.lit("N"), (F.col("id") % 1483).cast("string")))
         .alias("NewsID"),
        (F.col("id") % 4 == 0).cast("int").alias("Click"), F.lit("2024-01-01").alias("Time"),
        F.col("id").cast("string").alias("ImpID"), F.lit(0).alias("ImpPos"))
    news = spark.range(1483).select(
        F.concat(F.lit("N"), F.col("id").cast("string")).alias("NewsID"),
        F.concat(F.lit("c"), (F.col("id") % 7).cast("string")).alias("Category"), F.lit("s").alias("SubCategory"),
        F.concat(F.lit("title of "), F.col("id").cast("string")).alias("Title"))
    # written, so that both plans read the same rows in the same files
    inter, news = staged(inter, "hot-inter"), staged(news, "hot-news")
    want = rows(FE.featured_dataset(inter, news))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        hot = FE.featured_dataset(inter, news)
        assert rows(hot) == want
        plan = hot._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "BroadcastHashJoin" not in plan
    assert plan.count("skew=true") >= 2, plan


def test_interactions_are_sorted_for_one_join_only(spark):
    """The first side is hashed; the last join sorts, as texts are written next."""
    inter = _inter(spark, [("U1", "N1", 1, "t"), ("U2", "N2", 0, "t")])
    news = spark.createDataFrame([("N1", "a", "s", "x y"), ("N2", "b", "s", None)],
                                 "NewsID string, Category string, SubCategory string, Title string")
    plan = FE.featured_dataset(inter, news)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join LeftOuter" in line]
    assert "shuffle_hash" not in joins[0] and "shuffle_hash" in joins[1]
    kept = FE.featured_dataset(inter, news, hashed=False)._jdf.queryExecution().optimizedPlan().toString()
    assert "shuffle_hash" not in kept
