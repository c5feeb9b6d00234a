"""Impression-log parsing: behaviour rows -> (UserID, NewsID, Click) rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engage.functions import expressions as X


def parse_impressions(beh: DataFrame, strict: bool = False,
                      with_position: bool = False) -> DataFrame:
    """Explode ``Impressions`` into one row per ``NewsID-click`` token.

    Default: any token whose second dash-separated part is an integer is kept
    (``N-4-0`` gives ``(N, 4)``).  ``strict=True`` keeps only tokens of
    exactly two parts.  Rows without impressions are skipped.  A narrow
    operator: filter, generate and project in one stage, no shuffle.

    ``with_position`` adds ``ImpID`` and ``ImpPos`` (0-based token position)
    so that "the user's latest row" has a total order.
    """
    gen = F.posexplode(F.split(F.col("Impressions"), " ")).alias("ImpPos", "imp")
    keep = ["UserID", "Time"] + (["ImpID"] if with_position else [])
    rows = (beh.filter(F.col("Impressions").isNotNull())
               .select(*keep, gen))
    if strict:
        rows = rows.filter(X.token_is_strict("imp"))
    rows = (rows.withColumns({"NewsID": X.token_news_id("imp"),
                              "Click": X.token_click("imp")})
                .filter(F.col("Click").isNotNull()))
    cols = ["UserID", "NewsID", "Click", "Time"]
    if with_position:
        cols += ["ImpID", "ImpPos"]
    return rows.select(*cols)


def format_impressions(inter: DataFrame) -> DataFrame:
    """Inverse of the parse for well-formed rows: one behaviour row per
    (ImpID, UserID, Time), tokens in position order."""
    tok = F.concat(F.col("NewsID"), F.lit("-"), F.col("Click").cast("string"))
    return (inter.groupBy("ImpID", "UserID", "Time")
            .agg(F.array_join(F.transform(
                F.array_sort(F.collect_list(F.struct("ImpPos", tok.alias("t")))),
                lambda x: x["t"]), " ").alias("Impressions"))
            .withColumn("History", F.lit(""))
            .select("ImpID", "UserID", "Time", "History", "Impressions"))


def catalogue_semi_join(inter: DataFrame, news: DataFrame) -> DataFrame:
    """Interactions whose article exists in the catalogue (left semi join)."""
    return inter.join(news.select("NewsID"), "NewsID", "left_semi")
