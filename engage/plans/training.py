"""Model-dependent queries.

Training is the expensive part, so fitted models are kept per (Spark
application, data folder, profile, balance): several registered queries of
one session share one training run.  Only the fitted models (a few KB of
coefficients / trees) and five metric numbers per model live on the driver;
no data does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from engage.operators import cluster as CL
from engage.operators import ml as ML
from engage.operators import recommend as RC
from engage.sources import fixtures as FX

_FITTED: dict[tuple, object] = {}


# The stored tables live in ``engage.plans.catalog``, which imports this
# module; it is imported lazily here.
def news_clean(spark: SparkSession, d: str) -> DataFrame:
    from engage.plans.catalog import news_clean as stored_news_clean
    return stored_news_clean(spark, d)


def featured_rows(spark: SparkSession, d: str) -> DataFrame:
    from engage.plans.catalog import featured_rows as stored_rows
    return stored_rows(spark, d)


def fitted(spark: SparkSession, d: str, profile: str = "batch",
           balance: str | None = "smote"):
    key = (spark.sparkContext.applicationId, d, profile, balance)
    if key not in _FITTED:
        train, test, stats = ML.prepare(featured_rows(spark, d), balance)
        models = ML.train_models(train, stats, profile)
        metrics = ML.evaluate(models, test)
        _FITTED[key] = (models, metrics)
    return _FITTED[key]


def train_evaluate(spark, d):
    return fitted(spark, d)[1]


def best(spark, d):
    return ML.best_model(fitted(spark, d)[1])


def metrics_long(spark, d):
    return ML.metrics_long(fitted(spark, d)[1].select("model", "accuracy", "auc", "f1"))


def importance(spark, d):
    return ML.feature_importance(fitted(spark, d)[0]["Random Forest"])


def _best_model(spark, d):
    models, metrics = fitted(spark, d)
    return models[ML.best_model(metrics).first()["model"]]


def recommend(spark, d):
    ds = featured_rows(spark, d)
    return RC.recommend_top_n(ds, news_clean(spark, d), _best_model(spark, d), 10)


def recommend_requested(spark, d):
    ds = featured_rows(spark, d)
    return RC.recommend_top_n(ds, news_clean(spark, d), _best_model(spark, d), 10,
                              users=FX.requested_users(spark, d))


def _clustered(spark, d):
    """The clustered rows; as for the models, one fit a session."""
    key = (spark.sparkContext.applicationId, d, "clusters")
    ds = featured_rows(spark, d)
    if key not in _FITTED:
        _FITTED[key] = CL.fit(ds)
    return CL.assign(ds, _FITTED[key])


def cluster_rows(spark, d):
    return _clustered(spark, d).select("UserID", "NewsID", *CL.CLUSTER_COLS,
                                                    "prediction", "segment")


def cluster_articles(spark, d):
    return CL.cluster(featured_rows(spark, d), level="article")[0]


def cluster_sizes(spark, d):
    return CL.cluster_sizes(_clustered(spark, d))


QUERIES = {
    "train_evaluate": train_evaluate,
    "best_model": best,
    "metrics_long": metrics_long,
    "feature_importance": importance,
    "recommend_top_n": recommend,
    "recommend_requested": recommend_requested,
    "cluster_rows": cluster_rows,
    "cluster_articles": cluster_articles,
    "cluster_sizes": cluster_sizes,
}


def smote_balance(spark, d):
    """Class counts of the SMOTE-balanced training side."""
    train, _, _ = ML.prepare(featured_rows(spark, d), "smote")
    return train.groupBy(ML.TARGET).agg(F.count("*").alias("n"))


def train_weighted(spark, d):
    """The metrics with class weights in place of synthetic rows."""
    return fitted(spark, d, balance="weight")[1]


QUERIES["smote_balance"] = smote_balance
QUERIES["train_weighted"] = train_weighted


# ---- properties that any right model must have, comparable with SQL
def model_properties(spark, d):
    """Per model: better than chance, measures within [0, 1], and whether the
    selection takes the highest AUC."""
    metrics = fitted(spark, d)[1]
    top = metrics.agg(F.max("auc").alias("top"))
    measures = ["accuracy", "auc", "f1", "precision", "recall"]
    best_auc = ML.best_model(metrics).select("auc").scalar()
    return metrics.select("model", "position", (F.col("auc") > 0.5).alias("beats_chance"),
                          F.array_min(F.array(*measures)).between(0, 1).alias("low_in_range"),
                          F.array_max(F.array(*measures)).between(0, 1).alias("high_in_range"),
                          (best_auc == top.scalar()).alias("best_has_top_auc"))


def importance_properties(spark, d):
    """Features of the forest, each with a share, all shares adding up to one."""
    imp = importance(spark, d)
    return imp.agg(F.count("*").alias("n"), F.countDistinct("feature").alias("n_features"),
                   F.round(F.sum("importance"), 6).alias("total"), (F.min("importance") >= 0).alias("none_negative"))


def recommend_properties(spark, d):
    """Counts over the best model's recommendations: users, rows, rows that the
    user has seen, articles outside the catalogue, ranks out of order."""
    recs = recommend(spark, d)
    seen = featured_rows(spark, d).select("UserID", "NewsID").distinct().withColumn("seen", F.lit(1))
    ids = news_clean(spark, d).select("NewsID").distinct().withColumn("known", F.lit(1))
    after = F.lag("click_probability").over(Window.partitionBy("UserID").orderBy("rank"))
    rows = (recs.withColumn("rises", (F.col("click_probability") > after).cast("int"))
            .join(seen, ["UserID", "NewsID"], "left").join(ids, "NewsID", "left"))
    return rows.agg(F.countDistinct("UserID").alias("users"), F.count("*").alias("n"), F.count("seen").alias("n_seen"),
                    (F.count("*") - F.count("known")).alias("n_unknown"),
                    F.coalesce(F.sum("rises"), F.lit(0)).alias("n_rising"), F.max("rank").alias("last_rank"))


def cluster_properties(spark, d):
    """Rows, clusters and segments of the clustered rows and of their sizes."""
    clustered = cluster_rows(spark, d)
    sizes = cluster_sizes(spark, d)
    n = sizes.agg(F.sum("count")).scalar()
    # counted by cluster first: distinct counts of the rows would triple them
    by_cluster = clustered.groupBy("prediction", "segment").agg(F.count("*").alias("n"))
    return by_cluster.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.countDistinct("prediction").alias("n_clusters"),
                          F.countDistinct("segment").alias("n_segments")).withColumn("sizes_add_up", F.col("n") == n)


QUERIES.update({"model_properties": model_properties, "importance_properties": importance_properties,
                "recommend_properties": recommend_properties, "cluster_properties": cluster_properties})
