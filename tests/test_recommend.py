import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from engage.operators import features as FE
from engage.operators import ml as ML
from engage.operators import recommend as RC
from engage.operators import retrieval as RT
from engage.operators.ordering import with_global_position, with_prefix_sums
from engage.plans.catalog import featured
from engage.sources import fixtures as FX


def _news_clean(spark, ids):
    return spark.createDataFrame([(i, "c" if i != "N3" else "d", "T " + i, 2) for i in ids],
                                 "NewsID string, Category string, Title string, "
                                 "TitleWordCount int")


def _ds(spark, data):
    return spark.createDataFrame(
        [(u, n, 0, "2024", str(k), 0, 0.1, 0.1, 0.2, "c", 1, 0, 0.5)
         for k, (u, n) in enumerate(data)],
        "UserID string, NewsID string, Click int, Time string, ImpID string, ImpPos int, "
        "article_ctr double, popularity_score double, user_ctr double, "
        "preferred_category string, activity_encoded int, title_len_encoded int, "
        "top_category_affinity double")


def test_global_position_matches_row_number(spark):
    df = spark.range(0, 1000).select(F.pmod(F.col("id") * 7919, F.lit(1000)).alias("k"))
    got = with_global_position(df, [F.col("k")], n=7).orderBy("k").collect()
    assert [(r.k, r.pos) for r in got] == [(i, i + 1) for i in range(1000)]


def test_prefix_sums(spark):
    df = spark.createDataFrame([(float(i), i % 3) for i in range(50)], "s double, v long")
    got = {r.s: r.v_before for r in with_prefix_sums(df, "s", ["v"], n=4).collect()}
    assert all(got[float(i)] == sum(j % 3 for j in range(i)) for i in range(50))


def test_first_unseen_and_exhausted(spark):
    ids = [f"N{i}" for i in range(1, 8)]
    cat = RC.ranked_catalogue(_news_clean(spark, ids))
    ds = _ds(spark, [("U1", "N1"), ("U1", "N3"), ("U1", "N99"), ("U3", "X1")] +
             [("U2", i) for i in ids])
    got = rows(RC.first_unseen(ds, cat, 3).select("UserID", "NewsID", "exhausted"))
    assert got == [("U1", "N2", False), ("U1", "N4", False), ("U1", "N5", False),
                   ("U2", "N1", True), ("U2", "N2", True), ("U2", "N3", True),
                   ("U3", "N1", False), ("U3", "N2", False), ("U3", "N3", False)]
    ranges = RC.unseen_ranges(ds, cat)
    assert rows(ranges) == [("U1", False, 2, 2, 0), ("U1", False, 4, 7, 1), ("U2", True, 1, 7, 0),
                            ("U3", False, 1, 7, 0)]
    empty = RC.unseen_ranges(ds, cat, exhausted="empty")
    assert empty.filter("UserID = 'U2'").count() == 0
    only = RC.unseen_ranges(ds, cat, users=spark.createDataFrame([("U3",), ("U9",)], "UserID string"))
    assert rows(only) == [("U3", False, 1, 7, 0)]


def test_first_unseen_matches_brute_force(spark):
    ds = featured(spark, SF_SMALL, with_position=True)
    nc = FE.news_clean(FX.news(spark, SF_SMALL))
    cat = RC.ranked_catalogue(nc)
    seen = {}
    for r in ds.select("UserID", "NewsID").distinct().collect():
        seen.setdefault(r.UserID, set()).add(r.NewsID)
    places = sorted((r.pos, r.NewsID) for r in cat.collect())
    want = sorted((u, p) for u, s in seen.items() for p in [p for p, i in places if i not in s][:100])
    assert sorted(map(tuple, RC.first_unseen(ds, cat, 100).select("UserID", "pos").collect())) == want


def test_gaps_of_marks(spark):
    marks = spark.createDataFrame([("a", 1, 2), ("a", 2, 3), ("a", 3, 7), ("b", 1, 1)], "g string, place long, at long")
    sizes = spark.createDataFrame([("a", 9), ("b", 1), ("c", 4)], "g string, n long")
    assert rows(RT.gaps(marks, ["g"], sizes)) == [("a", 1, 1, 0), ("a", 4, 3, 1), ("a", 8, 2, 4), ("c", 1, 4, 0)]


def _every_pair(spark, ds, nc):
    """All unseen (user, article) pairs with their features, by plain joins."""
    cat = RC.catalogue_features(RC.ranked_catalogue(nc), ds, with_title=False)
    users = RC.latest_user_rows(ds)
    seen = ds.select("UserID", "NewsID").distinct()
    pairs = users.crossJoin(cat).join(seen, ["UserID", "NewsID"], "left_anti")
    left = pairs.select("UserID").distinct()
    again = users.join(left, "UserID", "left_anti").crossJoin(cat)
    match = F.coalesce(F.col("Category") == F.col("preferred_category"), F.lit(False)).cast("int")
    out = pairs.unionByName(again).withColumn("category_match", match)
    fill = {"TitleWordCount": 8.0}
    return out.select("UserID", "NewsID", "pos", *[
        F.coalesce(F.col(c).cast("double"), F.lit(fill.get(c, 0.0))).alias(c) for c in ML.FEATURE_COLS])


def _messy(spark):
    """Few articles, equal features, null categories and users, a user who has
    seen everything, one who has seen all of the preferred category."""
    rng = random.Random(3)
    news = [(f"N{i:02d}", rng.choice(["a", "b", "c", None]), f"T{i}", rng.choice([None, 3, 3, 9])) for i in range(40)]
    nc = spark.createDataFrame(news, "NewsID string, Category string, Title string, TitleWordCount int")
    data = []
    for u in range(30):
        pref = rng.choice(["a", "b", "c", "nowhere", None])
        shown = rng.sample([n[0] for n in news] + ["X1", "X2"], rng.choice([1, 3, 12]))
        shown += [n[0] for n in news] if u == 4 else [n[0] for n in news if n[1] == pref and u % 5 == 0]
        ctr, aff = rng.choice([0.1, 0.4, None]), rng.choice([0.0, 0.5, 0.9])
        for k, i in enumerate(shown):
            h = int(i[1:]) % 4
            data.append((f"U{u}", i, int(rng.random() < 0.2 + 0.2 * h), "2024", str(k), 0, h / 10, 0.05 * (h % 2), ctr, pref,
                         rng.choice([None, 0, 1]), 1, aff, 1, 3))
    ds = spark.createDataFrame(data, "UserID string, NewsID string, Click int, Time string, ImpID string, ImpPos int, "
                               "article_ctr double, popularity_score double, user_ctr double, preferred_category string, "
                               "activity_encoded int, title_len_encoded int, top_category_affinity double, "
                               "category_match int, TitleWordCount int")
    return ds, nc


def _best(spark, ds, nc, model, n):
    """Top ``n`` of every pair scored by the model itself."""
    pairs = _every_pair(spark, ds, nc)
    order = ML.scoring_order(model)
    if isinstance(order, RT.LinearOrder):
        scored = order.part(order.score(pairs))
    else:
        scored = ML.score(model, pairs).withColumn("click_probability", F.col("p")).withColumn("_part", F.lit(0.0))
    w = Window.partitionBy("UserID").orderBy(F.desc("click_probability"), F.desc("_part"), "pos")
    top = scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
    return rows(top.select("UserID", "rank", "NewsID", "click_probability"))


@pytest.mark.parametrize("name", ["Logistic Regression", "Random Forest", "Gradient Boosting", "rule"])
@pytest.mark.parametrize("which", ["messy", "tables"])
def test_top_n_of_the_whole_catalogue_equals_scoring_every_pair(spark, name, which):
    if which == "messy":
        ds, nc = _messy(spark)
    else:
        ds = featured(spark, SF_SMALL, with_position=True)
        nc = FE.news_clean(FX.news(spark, SF_SMALL))
    model = ML.rule_order()
    if name != "rule":
        small = {"Logistic Regression": {"maxIter": 40, "C": 1.0}, "Random Forest": {"numTrees": 8, "maxDepth": 6},
                 "Gradient Boosting": {"maxIter": 5, "maxDepth": 4, "stepSize": 0.3}}
        train = ML.assemble_rows(ds)
        stats = ML.fit_scaler(train)
        model = ML.build_pipeline(stats, ML._estimator(name, small[name], train.count(), False)).fit(train)
    for n in (3, 10):
        got = RC.recommend_top_n(ds, nc, model, n, round_places=None)
        assert rows(got.select("UserID", "rank", "NewsID", "click_probability")) == _best(spark, ds, nc, model, n)


def test_cold_start_and_popular(spark):
    ds = _ds(spark, [("U1", "N1"), ("U1", "N2")]).withColumn(
        "Click", F.when(F.col("NewsID") == "N2", 1).otherwise(0))
    nc = _news_clean(spark, ["N1", "N2"])
    req = spark.createDataFrame([("U1",), ("U7",)], "UserID string")
    got = rows(RC.cold_start(req, ds, nc, k=2).select("UserID", "NewsID", "rank"))
    assert got == [("U7", "N1", 2), ("U7", "N2", 1)]


def test_plan_without_broadcasts_has_no_product_and_shuffles_no_generated_entry(spark):
    ds = featured(spark, SF_SMALL, with_position=True)
    nc = FE.news_clean(FX.news(spark, SF_SMALL))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        feats = RC.candidate_features(ds, RC.ranked_catalogue(nc), ML.rule_order(), 5)
        feats.collect()
        plan = feats._jdf.queryExecution().executedPlan().toString()
        recs = RC.recommend_top_n(ds, nc, ML.rule_order(), n=5)
        whole = recs._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for p in (plan, whole):
        assert "CartesianProduct" not in p and "NestedLoop" not in p
    lines = plan.split("Initial Plan")[0].splitlines()
    made = next(i for i, ln in enumerate(lines) if "Generate explode(filter(entries" in ln)
    assert not any("Exchange" in ln for ln in lines[:made])     # above the generated entries
    assert recs.join(ds.select("UserID", "NewsID").distinct(), ["UserID", "NewsID"]).count() == 0
    assert recs.groupBy("UserID").count().agg(F.max("count")).first()[0] == 5


