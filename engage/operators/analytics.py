"""Platform, category, article and user analytics over the featured rows.

Every query is one ``groupBy`` (partial aggregation before the shuffle)
followed, for the reports, by a top-k (``TakeOrderedAndProject``) or a sort
of the small aggregate.  Sorts always carry an id tie-break so the order is
total.  ``ds`` is the stored interaction table (featured rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from engage.functions import expressions as X


def _check_k(k: int, cap: int | None) -> int:
    if k < 1 or (cap is not None and k > cap):
        raise ValueError(f"k must be in [1, {cap}]")
    return k


def overall_ctr(inter: DataFrame) -> DataFrame:
    """Mean click flag over all parsed interactions."""
    return inter.agg(F.avg("Click").alias("overall_ctr"))


def platform_stats(ds: DataFrame) -> DataFrame:
    """Users, distinct articles seen, rows, clicks and CTR (half-even, 4).

    Users and articles are counted as the groups of one aggregation each: two
    distinct counts in one aggregation would expand every row threefold.
    """
    users = ds.groupBy("UserID").agg(F.count("*").alias("n"), F.sum("Click").alias("c"),
                                     F.count("Click").alias("flagged"))
    n_news = ds.groupBy("NewsID").agg(F.count("*").alias("n")).select(F.count("NewsID")).scalar()
    agg = users.agg(F.count("UserID").alias("total_users"), F.coalesce(F.sum("n"), F.lit(0)).alias("total_interactions"),
                    F.sum("c").alias("total_clicks"), F.sum("flagged").alias("flagged"))
    return agg.select("total_users", n_news.alias("total_news"), "total_interactions", "total_clicks",
                      F.bround(F.try_divide("total_clicks", "flagged"), 4).alias("overall_ctr"))


def platform_stats_catalogue(ds: DataFrame, news: DataFrame) -> DataFrame:
    """As ``platform_stats`` but ``total_news`` counts catalogue rows and the
    CTR divides by ``max(rows, 1)``.  The catalogue count is a scalar
    subquery, not a join; users are the groups of one aggregation."""
    n_news = news.select(F.count("*")).scalar()
    users = ds.groupBy("UserID").agg(F.count("*").alias("n"), F.sum("Click").alias("c"))
    agg = users.agg(
        F.count("UserID").alias("total_users"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_interactions"),
        F.sum("c").alias("total_clicks"))
    return agg.select(
        "total_users", n_news.alias("total_news"), "total_interactions",
        "total_clicks",
        F.bround(X.safe_ratio("total_clicks", "total_interactions"), 4).alias("overall_ctr"))


def category_clicks(ds: DataFrame) -> DataFrame:
    """Clicked rows per category (null category is a group), clicks desc."""
    return (ds.filter(F.col("Click") == 1).groupBy("Category")
              .agg(F.count("*").alias("clicks"))
              .orderBy(F.col("clicks").desc(), F.col("Category").asc_nulls_last()))


def category_ctr(ds: DataFrame, drop_null: bool = False) -> DataFrame:
    """Clicks, rows and CTR per category, CTR desc.  The collection form keeps
    the null category; ``drop_null`` gives the in-memory form."""
    src = ds.filter(F.col("Category").isNotNull()) if drop_null else ds
    return (src.groupBy("Category")
               .agg(F.sum("Click").alias("clicks"), F.count("*").alias("total"))
               .withColumn("CTR", X.ratio("clicks", "total", places=None))
               .orderBy(F.col("CTR").desc(), F.col("Category").asc_nulls_last()))


def category_trend(ds: DataFrame) -> DataFrame:
    """Dashboard category trend: clicks, impressions, CTR (null dropped)."""
    return (ds.filter(F.col("Category").isNotNull()).groupBy("Category")
              .agg(F.sum("Click").alias("clicks"), F.count("*").alias("impressions"))
              .withColumn("CTR", X.ratio("clicks", "impressions", places=None))
              .orderBy(F.col("CTR").desc(), F.col("Category")))


def top_categories(ds: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` categories with most clicks (dashboard bar chart)."""
    _check_k(k, None)
    return (category_ctr(ds, drop_null=True)
            .orderBy(F.col("clicks").desc(), F.col("Category")).limit(k))


def top_news(ds: DataFrame, k: int = 20) -> DataFrame:
    """Most clicked articles with their category and title, clicks desc.

    The counts are taken without the texts; category and title are fetched for
    the ``k`` articles only (the smallest, where rows differ)."""
    _check_k(k, 100)
    top = (ds.groupBy("NewsID").agg(F.sum("Click").alias("clicks"), F.count("*").alias("impressions"))
             .withColumn("CTR", X.ratio("clicks", "impressions", places=None))
             .orderBy(F.col("clicks").desc(), F.col("NewsID")).limit(k))
    texts = (ds.join(F.broadcast(top.select("NewsID")), "NewsID", "left_semi")     # k rows
               .groupBy("NewsID", "Category", "Title").agg(F.count("*").alias("n"))
               .groupBy("NewsID").agg(F.min("Category").alias("Category"), F.min("Title").alias("Title")))
    return (top.join(texts, "NewsID", "left")
            .select("NewsID", "clicks", "impressions", "Category", "Title", "CTR")
            .orderBy(F.col("clicks").desc(), F.col("NewsID")).limit(k))


def top_news_with_category(ds: DataFrame, k: int = 20) -> DataFrame:
    """Dashboard top articles, then a left join with the distinct
    (NewsID, Category) pairs of the rows."""
    _check_k(k, None)
    top = (ds.groupBy("NewsID")
             .agg(F.sum("Click").alias("clicks"), F.count("*").alias("impressions"))
             .withColumn("CTR", X.ratio("clicks", "impressions", places=None))
             .orderBy(F.col("clicks").desc(), F.col("NewsID")).limit(k))
    pairs = ds.select("NewsID", "Category").dropDuplicates()
    return top.join(pairs, "NewsID", "left")


def user_engagement(ds: DataFrame) -> DataFrame:
    """Clicks, impressions and CTR per user."""
    return (ds.groupBy("UserID")
              .agg(F.sum("Click").alias("clicks"), F.count("*").alias("impressions"))
              .withColumn("CTR", X.ratio("clicks", "impressions", places=None)))


def top_users(ds: DataFrame, k: int = 20) -> DataFrame:
    """Most active users by rows, with CTR."""
    _check_k(k, 100)
    return (user_engagement(ds)
            .orderBy(F.col("impressions").desc(), F.col("UserID")).limit(k))


def active_users(ds: DataFrame, k: int = 50, cap: int | None = 200) -> DataFrame:
    """User ids by number of rows, descending (the user list)."""
    _check_k(k, cap)
    return (ds.groupBy("UserID").agg(F.count("*").alias("n_interactions"))
              .orderBy(F.col("n_interactions").desc(), F.col("UserID")).limit(k))


def user_profile(ds: DataFrame, user: str | None = None) -> DataFrame:
    """Collection profile per user: rows, clicks, mean stored CTR and the
    stored preferred category, affinity and activity.

    Rows of one user carry one preferred category per tied top category;
    the smallest name is taken so the answer is deterministic.  ``ctr`` is
    the API's half-even rounded clicks / max(rows, 1).
    """
    src = ds.filter(F.col("UserID") == user) if user is not None else ds
    # numbers by (user, category) first; the name is compared over these few rows
    by_category = src.groupBy("UserID", "preferred_category").agg(
        F.count("*").alias("n"), F.sum("Click").alias("clicks"), F.sum("user_ctr").alias("ctr_sum"),
        F.count("user_ctr").alias("ctr_n"), F.max("top_category_affinity").alias("affinity"),
        F.max("activity_encoded").alias("activity"))
    return (by_category.groupBy("UserID")
            .agg(F.sum("n").alias("total_impressions"), F.sum("clicks").alias("total_clicks"),
                 F.bround(F.try_divide(F.sum("ctr_sum"), F.sum("ctr_n")), 4).alias("avg_user_ctr"),
                 F.min("preferred_category").alias("preferred_category"),
                 F.max("affinity").alias("top_category_affinity"),
                 F.max("activity").alias("activity_encoded"))
            .withColumn("ctr", F.bround(X.safe_ratio("total_clicks", "total_impressions"), 4)))


def user_profile_mode(ds: DataFrame, user: str | None = None) -> DataFrame:
    """In-memory profile: clicked rows, rows, CTR and the most frequent
    clicked category (smallest on ties, nulls skipped; null if none)."""
    src = ds.filter(F.col("UserID") == user) if user is not None else ds
    clicked = F.when(F.col("Click") == 1, F.col("Category"))
    by_category = src.groupBy("UserID", clicked.alias("clicked")).agg(
        F.count("*").alias("n"), F.count(F.when(F.col("Click") == 1, F.lit(1))).alias("clicks"))
    # most clicks, then the smallest name: over (user, category) rows only
    best = F.min(F.when(F.col("clicked").isNotNull(), F.struct((-F.col("n")).alias("n"), F.col("clicked").alias("name"))))
    return (by_category.groupBy("UserID")
            .agg(F.sum("clicks").alias("total_clicks"), F.sum("n").alias("total_impressions"),
                 best["name"].alias("preferred_category"))
            .withColumn("ctr", F.bround(X.ratio("total_clicks", "total_impressions", places=None), 4)))


def activity_distribution(ds: DataFrame) -> DataFrame:
    """Users per activity label over bins (0,5] (5,15] (15,30] (30,9999];
    labels with no user are listed with 0."""
    spark = ds.sparkSession
    per_user = ds.groupBy("UserID").agg(F.count("*").alias("n"))
    code = X.bounded_bucket("n", X.ACTIVITY_EDGES, X.ACTIVITY_MAX)
    counts = (per_user.select(code.alias("code")).filter(F.col("code").isNotNull())
                      .groupBy("code").agg(F.count("*").alias("users")))
    names = F.array(*[F.lit(x) for x in X.ACTIVITY_LABELS])
    labels = spark.range(len(X.ACTIVITY_LABELS)).select(
        F.col("id").cast("int").alias("code"), F.get(names, F.col("id").cast("int")).alias("activity"))
    return (F.broadcast(labels).join(counts, "code", "left")
            .select("activity", F.coalesce("users", F.lit(0)).alias("users"), "code")
            .orderBy("code").drop("code"))


def user_ctr_histogram(ds: DataFrame, bins: int = 30) -> DataFrame:
    """Users per equal-width CTR bin on [0, 1]; CTR 1.0 falls in the last bin."""
    b = F.least(F.floor(F.col("CTR") * bins) + 1, F.lit(bins)).cast("int")
    return (user_engagement(ds).select(b.alias("bin"))
            .groupBy("bin").agg(F.count("*").alias("users"))
            .withColumns({"lower": (F.col("bin") - 1) / F.lit(float(bins)),
                          "upper": F.col("bin") / F.lit(float(bins))})
            .select("bin", "lower", "upper", "users").orderBy("bin"))


def user_scatter(ds: DataFrame, k: int = 200) -> DataFrame:
    """The first ``k`` users by id with clicks, impressions and CTR."""
    return user_engagement(ds).orderBy("UserID").limit(k)


def class_distribution(ds: DataFrame) -> DataFrame:
    """Rows per click class and the class share (the CTR for class 1).
    The share divides by a scalar subquery of the row count."""
    total = ds.select(F.count("*")).scalar()
    return (ds.groupBy("Click").agg(F.count("*").alias("n"))
              .withColumn("share", F.col("n") / total)
              .orderBy("Click"))


def display_titles(recs: DataFrame) -> DataFrame:
    """Display fields of a recommendation list: 40-character title with an
    ellipsis, the 80-character card title, the upper-case category and, when
    there is a probability, the progress value clamped to at most 1."""
    cols = {
        "short_title": X.short_title("Title", 40),
        "card_title": F.substring(F.col("Title"), 1, 80),
        "category_tag": F.upper(F.col("Category")),
    }
    if "click_probability" in recs.columns:
        cols["progress"] = F.least(F.col("click_probability"), F.lit(1.0))
    return recs.withColumns(cols)

