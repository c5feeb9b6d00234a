"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query derives the click log from the raw test tables (so its work grows
with them) and then applies one operator of the library.  The DuckDB twins
live in ``engage.plans.oracle.SQL`` under the same names; model-dependent
queries come from ``engage.plans.training``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from engage.operators import analytics as AN
from engage.operators import features as FE
from engage.operators import ml as ML
from engage.operators import recommend as RC
from engage.operators.interactions import catalogue_semi_join, parse_impressions
from engage.plans import training as TR
from engage.schemas import STORED_SCHEMA
from engage.session import scratch_path
from engage.sinks import writers as WR
from engage.sources import fixtures as FX
from engage.sources import readers as RD
from engage.streaming import events as ST

Query = Callable[[SparkSession, str], DataFrame]


# Session-level store of the derived tables, computed once per (application,
# data folder) and persisted MEMORY_AND_DISK (a lost block is recomputed from
# lineage).  The parsed interactions feed four branches of the feature plan.
# The featured rows are kept without texts and totals, for the queries that
# pass over them several times; a query that reads them once takes its columns
# from the plan, so what it does not name is neither shuffled nor kept.
_STORE: dict[tuple, DataFrame] = {}
INTER_COLS = ["UserID", "NewsID", "Click", "Time"]
POS_COLS = ["ImpID", "ImpPos"]
ROW_COLS = ["UserID", "NewsID", "Click", "Time", "Category", "TitleWordCount", "article_ctr", "popularity_score",
            "user_ctr", "activity_encoded", "preferred_category", "top_category_affinity", "category_match",
            "title_len_encoded", *POS_COLS]


def _stored(spark: SparkSession, key: tuple, build) -> DataFrame:
    k = (spark.sparkContext.applicationId, *key)
    if k not in _STORE:
        _STORE[k] = build().persist(StorageLevel.MEMORY_AND_DISK)
    return _STORE[k]


def release(spark: SparkSession | None = None) -> None:
    """Unpersist the stored tables (of one application, or all)."""
    for k in list(_STORE):
        if spark is None or k[0] == spark.sparkContext.applicationId:
            _STORE.pop(k).unpersist()


def interactions(spark: SparkSession, d: str, strict: bool = False,
                 with_position: bool = False) -> DataFrame:
    if strict:
        inter = parse_impressions(FX.behaviors(spark, d), strict=True, with_position=True)
    else:
        inter = _stored(spark, ("inter", d), lambda: parse_impressions(
            FX.behaviors(spark, d), with_position=True))
    return inter if with_position else inter.select(*INTER_COLS)


def news_clean(spark: SparkSession, d: str) -> DataFrame:
    return _stored(spark, ("news_clean", d), lambda: FE.news_clean(FX.news(spark, d)))


def featured(spark: SparkSession, d: str, ties: str = "all",
             with_position: bool = False) -> DataFrame:
    ds = FE.featured_dataset(interactions(spark, d, with_position=True), FX.news(spark, d), ties=ties)
    return ds if with_position else ds.drop(*POS_COLS)


def featured_rows(spark: SparkSession, d: str) -> DataFrame:
    """The stored featured rows (``ROW_COLS``)."""
    return _stored(spark, ("rows", d), lambda: FE.featured_dataset(
        interactions(spark, d, with_position=True), FX.news(spark, d), articles_last=False, hashed=False)
        .select(*ROW_COLS))


def _once(spark: SparkSession, d: str) -> DataFrame:
    """Featured rows for one pass: the stored ones where this session has
    them, else the plan."""
    if (spark.sparkContext.applicationId, "rows", d) in _STORE:
        return featured_rows(spark, d)
    return featured(spark, d, with_position=True)


def _ds(op) -> Query:
    return lambda spark, d: op(featured(spark, d))


def _one_pass(op) -> Query:
    return lambda spark, d: op(_once(spark, d))


def _pos(s, d):
    return featured_rows(s, d)


# ---- recommendation helpers
def _catalogue(s, d):
    return RC.ranked_catalogue(news_clean(s, d))


def _candidate_features(s, d):
    return RC.candidate_features(_pos(s, d), _catalogue(s, d), ML.rule_order()).drop("_part", "k")


def _unseen_ranges(s, d):
    return RC.unseen_ranges(_once(s, d), _catalogue(s, d))


# ---- ML data-step helpers
def _train_side(s, d):
    train, _ = ML.stratified_split(_pos(s, d))
    return ML.assemble_rows(train)


def _rule_metrics(s, d):
    _, test = ML.stratified_split(_pos(s, d))
    return ML.model_metrics(ML.rule_score(test))


def _rules(s, d):
    return ML.rule_metrics(ML.stratified_split(_pos(s, d))[1])


# ---- sources and sinks: data written by Spark and read back
def _run_dir(s, what):
    return scratch_path(s, f"tables/{what}-{uuid.uuid4().hex}")


def _tsv_news(s, d):
    path = _run_dir(s, "news-tsv")
    WR.write_tsv(FX.news(s, d), path, escaped=True)
    return RD.read_news(s, path, escaped=True)


def _tsv_behaviors(s, d):
    path = _run_dir(s, "behaviors-tsv")
    WR.write_tsv(FX.behaviors(s, d), path)
    return parse_impressions(RD.read_behaviors(s, path))


def _serving(s, d):
    base = _run_dir(s, "serving")
    WR.save_interactions(FE.featured_projection(featured(s, d)), news_clean(s, d), base)
    return base


def _stored_news(s, d):
    path = _run_dir(s, "news")
    WR.write_table(news_clean(s, d), path, sort_by=["NewsID"])
    return RD.read_table(s, path)


def _saved_featured(s, d):
    base = _run_dir(s, "featured")
    WR.save_featured(featured(s, d), news_clean(s, d), base)
    return RD.read_table(s, f"{base}/featured_dataset")


def _csv_interactions(s, d):
    path = _run_dir(s, "csv")
    WR.write_csv(FE.featured_projection(featured(s, d)), path, compression="gzip")
    return RD.read_csv(s, path, STORED_SCHEMA)


def _json_categories(s, d):
    """Written as JSON records and read back."""
    rows = AN.category_ctr(_once(s, d))
    path = _run_dir(s, "json")
    WR.to_json_rows(rows).write.text(path)
    return s.read.text(path).select(F.from_json("value", rows.schema).alias("r")).select("r.*")


def _stored_model_results(s, d):
    path = _run_dir(s, "model-results")
    WR.write_model_results(_rules(s, d), path)
    return RD.read_model_results(s, path)


def _first_source(s, d):
    """The first source that exists of a missing one and the stored table."""
    base = _serving(s, d)
    return RD.first_available([lambda: RD.read_table(s, f"{base}/moved"), lambda: RD.read_table(s, f"{base}/news")])


# ---- entry points for one user, and the brands as a small catalogue
def _most_active(s, d) -> str:
    return AN.active_users(_once(s, d), 1).first()["UserID"]


def _recommend_rule(s, d):
    return RC.recommend_top_n(_pos(s, d), news_clean(s, d), ML.rule_order(), 10)


def _cached_recommendations(s, d):
    """Stored, replaced for one user, and read for that user."""
    path, user, recs = _run_dir(s, "recommendations"), _most_active(s, d), _recommend_rule(s, d)
    WR.replace_keyed(recs, path)
    WR.replace_keyed(WR.read_keyed(s, path).filter(F.col("UserID") == user).drop("timestamp"), path)
    return WR.cached_recommendations(s, path, user).drop("timestamp")


def _brand_rows(s, d):
    # One row per brand.  Few keys leave most shuffle partitions empty, which
    # keeps the adaptive planner from broadcasting them: hinted, or all rows of
    # a brand would be sorted in one task.
    brands = _brands(s, d).select(F.col("NewsID").alias("SubCategory"))
    rows = featured(s, d, with_position=True)
    return rows.join(F.broadcast(brands), "SubCategory", "left_semi").withColumn("NewsID", F.col("SubCategory"))


def _brands(s, d):
    """Every brand of the news table as an article (26 rows at most)."""
    brand = FX.news(s, d).filter("SubCategory is not null").select(F.col("SubCategory").alias("NewsID")).distinct()
    return brand.select("NewsID", F.col("NewsID").alias("Category"), F.col("NewsID").alias("Title"),
                        F.lit(1).alias("TitleWordCount"))


QUERIES: dict[str, Query] = {
    # ---- parse and features
    "parse_impressions": lambda s, d: interactions(s, d),
    "parse_strict": lambda s, d: interactions(s, d, strict=True),
    "news_clean": lambda s, d: news_clean(s, d),
    "article_stats": lambda s, d: FE.article_stats(interactions(s, d)),
    "user_stats": lambda s, d: FE.user_stats(interactions(s, d)),
    "category_affinity": lambda s, d: FE.category_affinity(
        interactions(s, d), news_clean(s, d)),
    "top_category_all": lambda s, d: FE.top_category(FE.category_affinity(
        interactions(s, d), news_clean(s, d)), ties="all"),
    "top_category_first": lambda s, d: FE.top_category(FE.category_affinity(
        interactions(s, d), news_clean(s, d)), ties="first"),
    "featured_dataset": lambda s, d: featured(s, d),
    "featured_dataset_first": lambda s, d: featured(s, d, ties="first"),
    "featured_projection": _ds(FE.featured_projection),
    "featured_dashboard": lambda s, d: FE.dashboard_featured(
        interactions(s, d, strict=True), FX.news(s, d)),
    "catalogue_semi_join": lambda s, d: catalogue_semi_join(interactions(s, d), FX.news(s, d)),
    "catalogue_duplicates": lambda s, d: FE.catalogue_duplicates(FX.news(s, d)),
    "category_copies": lambda s, d: FE.catalogue_duplicates(
        FX.news(s, d).withColumn("NewsID", F.col("Category"))),
    # ---- analytics
    "overall_ctr": lambda s, d: AN.overall_ctr(interactions(s, d)),
    "platform_stats": _one_pass(AN.platform_stats),
    "platform_stats_catalogue": lambda s, d: AN.platform_stats_catalogue(
        _once(s, d), news_clean(s, d)),
    "category_clicks": _one_pass(AN.category_clicks),
    "category_ctr": _one_pass(AN.category_ctr),
    "category_trend": _one_pass(AN.category_trend),
    "top_categories": _one_pass(AN.top_categories),
    "top_news": _ds(AN.top_news),
    "top_news_with_category": _one_pass(AN.top_news_with_category),
    "top_users": _one_pass(AN.top_users),
    "active_users": _one_pass(AN.active_users),
    "user_profile": _one_pass(AN.user_profile),
    "user_profile_mode": _one_pass(AN.user_profile_mode),
    "activity_distribution": _one_pass(AN.activity_distribution),
    "user_ctr_histogram": _one_pass(AN.user_ctr_histogram),
    "user_scatter": _one_pass(AN.user_scatter),
    "class_distribution": _one_pass(AN.class_distribution),
    "short_titles": lambda s, d: AN.display_titles(news_clean(s, d))
        .select("NewsID", "short_title", "card_title", "category_tag"),
    # ---- recommendation without a model, and with a fixed rule score
    "ranked_catalogue": _catalogue,
    "unseen_ranges": _unseen_ranges,
    "candidates": lambda s, d: _candidate_features(s, d).select("UserID", "pos", "NewsID", "exhausted"),
    "candidate_features": _candidate_features,
    "article_means": lambda s, d: RC.article_means(_once(s, d)),
    "latest_user_rows": lambda s, d: RC.latest_user_rows(_once(s, d)),
    "popular_articles": lambda s, d: RC.popular_articles(_once(s, d), news_clean(s, d), 10),
    "cold_start": lambda s, d: RC.cold_start(
        FX.requested_users(s, d), _once(s, d), news_clean(s, d), 10),
    "exhausted_users": lambda s, d: RC.exhausted_users(_once(s, d), news_clean(s, d)),
    "exhausted_brands": lambda s, d: RC.exhausted_users(_brand_rows(s, d), _brands(s, d)),
    "unseen_brands": lambda s, d: RC.unseen_ranges(_brand_rows(s, d), RC.ranked_catalogue(_brands(s, d))),
    "recommend_rule": _recommend_rule,
    "cached_recommendations": _cached_recommendations,
    "display_recommendations": lambda s, d: AN.display_titles(_recommend_rule(s, d)).select(
        "UserID", "NewsID", "short_title", "card_title", "category_tag", "progress"),
    "one_user_profile": lambda s, d: AN.user_profile(_once(s, d), _most_active(s, d)),
    "one_user_mode": lambda s, d: AN.user_profile_mode(_once(s, d), _most_active(s, d)),
    # ---- ML data steps and metrics
    "split_counts": lambda s, d: ML.split_counts(_pos(s, d)),
    "scaler_fit": lambda s, d: ML.scaler_frame(_train_side(s, d)),
    "model_metrics": _rule_metrics,
    "rule_metrics": _rules,
    "rule_metrics_long": lambda s, d: ML.metrics_long(_rules(s, d).select("model", "accuracy", "auc", "f1")),
    "rule_best": lambda s, d: ML.best_model(_rules(s, d)),
    # ---- click stream
    "event_values": lambda s, d: FX.event_values(s, d),
    "message_text": lambda s, d: ST.message_text(
        FX.event_values(s, d).select(F.col("value").cast("binary").alias("value"))),
    "parse_events": lambda s, d: ST.parse_events(FX.event_values(s, d)),
    "stream_events": lambda s, d: ST.stream_table_events(s, d, scratch_path(s, "streams")),
    # ---- sources and sinks
    "tsv_news": _tsv_news,
    "tsv_behaviors": _tsv_behaviors,
    "stored_interactions": lambda s, d: RD.read_table(s, f"{_serving(s, d)}/interactions"),
    "stored_news": _stored_news,
    "saved_featured": _saved_featured,
    "csv_interactions": _csv_interactions,
    "json_categories": _json_categories,
    "stored_model_results": _stored_model_results,
    "first_source": _first_source,
}

# ---- model training, recommendation with a model, clustering (rows-only check)
QUERIES.update(TR.QUERIES)
