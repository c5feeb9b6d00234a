"""Top-N recommendation for all users in one distributed job.

Semantics of the per-user recommender, applied to every user at once:

* candidates are all catalogue rows (catalogue order = ``NewsID``) whose
  article the user has not seen; a user who has seen the whole catalogue gets
  the whole catalogue again;
* features of a candidate: the mean stored ``article_ctr`` /
  ``popularity_score`` of the article (0.1 / 0.05 if it was never shown),
  the user fields of the user's latest row (latest = largest
  ``(Time, ImpID, ImpPos, preferred_category)``; missing ones are 0), whether
  the candidate's category equals the user's preferred category, and the
  candidate's own ``TitleWordCount``;
* scored by the model, the ``n`` most probable per user are returned (equal
  ones in catalogue order); users without any row get the most popular
  articles instead.

The ``n`` best of the whole catalogue are found exactly without a table of
pairs: see ``retrieval``.  What a user has not seen as a whole is given as
position ranges (``unseen_ranges``): at most one range more than articles seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from engage.functions import expressions as X
from engage.operators.ml import scoring_order
from engage.operators.ordering import with_global_position
from engage.operators.retrieval import (ARTICLE_FEATURES, BLOCK, OWN, USER_FEATURES, LinearOrder, gaps, shortlist,
                                        with_place)
from engage.schemas import DEFAULT_TITLE_WORDS, FEATURE_COLS, UNSEEN_ARTICLE_CTR, UNSEEN_POPULARITY

USER_FIELDS = ["user_ctr", "preferred_category", "activity_encoded",
               "title_len_encoded", "top_category_affinity"]


def ranked_catalogue(news_clean: DataFrame) -> DataFrame:
    """Catalogue rows with a 1-based ``pos`` in NewsID order (duplicate rows
    are separate positions, ordered by their other fields)."""
    cat = news_clean.select("NewsID", "Category", "Title", "TitleWordCount")
    order = [F.col(c).asc_nulls_first() for c in ("NewsID", "Category", "Title", "TitleWordCount")]
    return with_global_position(cat, order, "pos")


# Fixed value: exact decimal type for averaging the stored 4-place features.
MEAN_DECIMAL = "decimal(24,10)"


def article_means(ds: DataFrame) -> DataFrame:
    """Mean stored CTR and popularity per article over the rows.

    The stored values have 4 decimal places, so they are averaged as exact
    decimals: the result does not depend on how the rows are partitioned
    (a double sum does, in its last bits)."""
    def mean(c):
        return F.avg(F.col(c).cast(MEAN_DECIMAL)).cast("double")
    return ds.groupBy("NewsID").agg(mean("article_ctr").alias("mean_article_ctr"),
                                    mean("popularity_score").alias("mean_popularity"))


def latest_user_rows(ds: DataFrame) -> DataFrame:
    """The user fields of each user's latest row.  ``ds`` carries ``ImpID``
    and ``ImpPos`` (interactions parsed ``with_position``)."""
    key = F.struct(F.col("Time"), F.col("ImpID").try_cast("long"), F.col("ImpID"),
                   F.col("ImpPos"), F.col("preferred_category"))
    val = F.struct(*[F.col(c) for c in USER_FIELDS])
    return (ds.groupBy("UserID").agg(F.max_by(val, key).alias("u"))
              .select("UserID", *[F.col(f"u.{c}").alias(c) for c in USER_FIELDS]))


def catalogue_features(catalogue: DataFrame, ds: DataFrame, with_title: bool = True) -> DataFrame:
    """Ranked catalogue with the article statistics a candidate carries
    (mean stored CTR / popularity, or the defaults for unseen articles)."""
    title = ["Title"] if with_title else []
    return (catalogue.join(article_means(ds), "NewsID", "left")
                     .select("pos", "NewsID", "Category", *title, "TitleWordCount",
                             F.coalesce("mean_article_ctr", F.lit(UNSEEN_ARTICLE_CTR))
                              .alias("article_ctr"),
                             F.coalesce("mean_popularity", F.lit(UNSEEN_POPULARITY))
                              .alias("popularity_score")))


def seen_positions(ds: DataFrame, catalogue: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """``UserID, pos, Category`` of the catalogue rows each user has seen."""
    seen = ds.select("UserID", "NewsID").distinct()
    if users is not None:
        seen = seen.join(users.select("UserID").distinct(), "UserID", "left_semi")
    return seen.join(catalogue.select("NewsID", "pos", "Category"), "NewsID").drop("NewsID")


def unseen_ranges(ds: DataFrame, catalogue: DataFrame, users: DataFrame | None = None,
                  exhausted: str = "catalogue") -> DataFrame:
    """``UserID, exhausted, first_pos, last_pos, before``: the catalogue
    positions that each user has not seen, as ranges; ``before`` counts the
    unseen positions ahead of the range.

    ``users`` restricts the job to the given known users (default: every user
    of ``ds``).  ``exhausted="catalogue"`` gives a user who has seen everything
    the whole catalogue again (the API form); ``"empty"`` gives nothing (the
    dashboard form).
    """
    if exhausted not in ("catalogue", "empty"):
        raise ValueError("exhausted must be 'catalogue' or 'empty'")
    known = ds.select("UserID").distinct()
    if users is not None:
        known = known.join(users.select("UserID").distinct(), "UserID", "left_semi")
    total = catalogue.agg(F.max("pos")).scalar()
    marks = with_place(seen_positions(ds, catalogue, users).select("UserID", F.col("pos").alias("at")),
                       ["UserID"], [F.col("at")], "place")
    found = gaps(marks, ["UserID"], known.select("UserID", F.coalesce(total, F.lit(0)).cast("long").alias("n")))
    ranges = found.select("UserID", F.lit(False).alias("exhausted"), F.col("start").alias("first_pos"),
                          (F.col("start") + F.col("size") - 1).alias("last_pos"), "before")
    if exhausted == "empty":
        return ranges
    full = (marks.groupBy("UserID").agg(F.count(F.lit(1)).alias("n_seen")).filter(F.col("n_seen") >= total)
            .select("UserID", F.lit(True).alias("exhausted"), F.lit(1).cast("long").alias("first_pos"),
                    F.col("n_seen").alias("last_pos"), F.lit(0).cast("long").alias("before")))
    return ranges.unionByName(full)


def first_unseen(ds: DataFrame, catalogue: DataFrame, max_candidates: int, users: DataFrame | None = None,
                 exhausted: str = "catalogue") -> DataFrame:
    """``UserID, exhausted`` and catalogue columns of each user's first
    ``max_candidates`` unseen rows in catalogue order (the shortened candidate
    list of an interactive request).  Ranges meet the catalogue in blocks, so
    the generated rows are not shuffled."""
    ranges = unseen_ranges(ds, catalogue, users, exhausted).filter(F.col("before") < max_candidates)
    last = F.least("last_pos", F.col("first_pos") + max_candidates - F.col("before") - 1)
    block = lambda c: F.expr(f"({c} - 1) div {BLOCK}")
    rows = ranges.withColumn("last_pos", last).withColumn(
        "block", F.explode(F.sequence(block("first_pos"), block("last_pos"))))
    blocks = (catalogue.withColumn("block", block("pos")).groupBy("block")
              .agg(F.collect_list(F.struct(*catalogue.columns)).alias("entries")))
    wanted = F.filter("entries", lambda e: e["pos"].between(F.col("first_pos"), F.col("last_pos")))
    return rows.join(blocks, "block").select("UserID", "exhausted", F.explode(wanted).alias("e")).select(
        "UserID", "exhausted", "e.*")


def candidate_features(ds: DataFrame, catalogue: DataFrame, model, n: int = 10,
                       users: DataFrame | None = None) -> DataFrame:
    """The candidates that can be among the ``n`` best of each user, from the
    whole catalogue: the first ``n`` unseen articles of the preferred category
    and of all others, in the order of the model's score.  The 8 model
    features as double, and ``UserID``, ``NewsID``, ``pos``, ``Category``,
    ``exhausted``, ``_part`` and ``k`` (the probability, for tree models)."""
    def filled(c: str, default: float = 0.0):
        return F.coalesce(F.col(c).cast("double"), F.lit(default)).alias(c)
    articles = catalogue_features(catalogue, ds, with_title=False).select(
        "pos", "NewsID", "Category", "article_ctr", "popularity_score",
        filled("TitleWordCount", float(DEFAULT_TITLE_WORDS)))
    rows = latest_user_rows(ds)
    if users is not None:
        rows = rows.join(users.select("UserID").distinct(), "UserID", "left_semi")
    rows = rows.select("UserID", "preferred_category", *[filled(c) for c in USER_FEATURES])
    found = shortlist(rows, seen_positions(ds, catalogue, users), articles, scoring_order(model), n)
    match = (F.col("side") == OWN).cast("double").alias("category_match")
    return found.select("UserID", "NewsID", "pos", "Category", "exhausted", "_part", "k",
                        *[match if c == "category_match" else F.col(c) for c in FEATURE_COLS])


def popular_articles(ds: DataFrame, news_clean: DataFrame, k: int = 10) -> DataFrame:
    """Articles by click share (clicks / rows, no minimum support), top ``k``,
    with title and category (empty string when not in the catalogue)."""
    pop = (ds.groupBy("NewsID").agg(F.sum("Click").alias("c"), F.count("Click").alias("i"))
             .withColumn("score", X.ratio("c", "i", places=None))
             .orderBy(F.col("score").desc(), F.col("NewsID")).limit(k)
             .withColumn("rank", F.row_number().over(
                 Window.orderBy(F.col("score").desc(), F.col("NewsID")))))
    meta = news_clean.select("NewsID", "Title", "Category")
    return (pop.join(meta, "NewsID", "left")
               .select("NewsID", F.coalesce("Title", F.lit("")).alias("Title"),
                       F.coalesce("Category", F.lit("")).alias("Category"),
                       F.col("score").alias("click_probability"), "rank"))


def cold_start(requested: DataFrame, ds: DataFrame, news_clean: DataFrame,
               k: int = 10) -> DataFrame:
    """Requested users without any row get the ``k`` popular articles.

    The pairing is an equi-join on rank: each unknown user expands to ranks
    1..k and meets the ``k``-row popular list (a bounded broadcast)."""
    unknown = (requested.select("UserID").distinct()
               .join(ds.select("UserID"), "UserID", "left_anti"))
    ranks = unknown.select("UserID", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("rank"))
    pop = popular_articles(ds, news_clean, k)
    return (ranks.join(F.broadcast(pop), "rank")
                 .select("UserID", "NewsID", "Title", "Category", "click_probability", "rank"))


def exhausted_users(ds: DataFrame, news_clean: DataFrame) -> DataFrame:
    """Users who have seen every catalogue article (they get the whole
    catalogue back as candidates)."""
    n_ids = news_clean.select(F.countDistinct("NewsID")).scalar()
    seen = (ds.select("UserID", "NewsID").distinct()
              .join(news_clean.select("NewsID").distinct(), "NewsID", "left_semi"))
    return (seen.groupBy("UserID").agg(F.count("*").alias("seen_articles"))
                .filter(F.col("seen_articles") >= n_ids))


def top_n_per_user(scored: DataFrame, n: int = 10, prob: str = "click_probability") -> DataFrame:
    """The ``n`` most probable rows per user (ties: the larger article part,
    then catalogue order)."""
    w = Window.partitionBy("UserID").orderBy(F.col(prob).desc(), F.col("_part").desc(), F.col("pos"))
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def recommend_top_n(ds: DataFrame, news_clean: DataFrame, model, n: int = 10,
                    users: DataFrame | None = None, round_places: int | None = 4) -> DataFrame:
    """Recommendations from the whole catalogue for every known user (or the
    requested ``users``; unknown ones get the popular list).

    ``model`` is a fitted ``PipelineModel`` (logistic regression, random
    forest or boosted trees over the 8 feature columns) or a ``LinearOrder``
    (any score that grows with an article part).  A linear model is scored as
    a column expression; the probabilities of a tree model come with its cells.
    """
    if n < 1 or n > 50:
        raise ValueError("n must be in [1, 50]")
    order = scoring_order(model)
    catalogue = ranked_catalogue(news_clean)
    feats = candidate_features(ds, catalogue, order, n, users)
    scored = (order.score(feats) if isinstance(order, LinearOrder)
              else feats.withColumn("click_probability", F.col("k")))
    best = top_n_per_user(scored, n).select("UserID", "pos", "Category", "click_probability", "rank")
    # titles are joined to the n best rows per user only
    out = (best.join(catalogue.select("pos", "NewsID", "Title"), "pos")
               .select("UserID", "NewsID", "Title", "Category", "click_probability", "rank"))
    if users is not None:
        out = out.unionByName(cold_start(users, ds, news_clean, n))
    if round_places is not None:
        out = out.withColumn("click_probability", F.bround("click_probability", round_places))
    return out
