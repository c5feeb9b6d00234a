"""Click-log inputs derived from the star-schema test tables.

The test tables hold no click log, so the news catalogue, the behaviour log
and the click stream are derived from them with plain DataFrame operations
(the mapping is documented in FIXTURES.md §2).  Every derivation scales with
its input tables: no driver round trip, no fixed-size input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixture mapping: a line of every 40th part (remainder 1)
# also shows an article that is in no catalogue, a line of every 50th part also
# shows a supplier's page (which has no category), and a line of every 97th
# part also holds a token without click flag.  They add rows and cut none.
ORPHAN_MOD = 40
ORPHAN_REM = 1
PAGE_MOD = 50
MALFORMED_TOKEN_MOD = 97
CLICK_RETURNFLAG = "R"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def news_from_tables(part: DataFrame, documents: DataFrame, supplier: DataFrame) -> DataFrame:
    """News catalogue in the 8-column news layout: every part, with the first
    line of its document as title and all other lines as abstract, and every
    supplier's page, which has neither category nor texts."""
    null = F.lit(None).cast("string")
    texts = documents.select("doc_id", F.substring_index(F.col("text"), "\n", 1).alias("Title"),
                             F.expr(r"CASE WHEN instr(text, '\n') > 0 THEN substring(text, instr(text, '\n') + 1) END")
                              .alias("Abstract"))
    joined = part.join(texts, part.p_partkey == texts.doc_id, "left")
    articles = joined.select(
        F.concat(F.lit("N"), F.col("p_partkey").cast("string")).alias("NewsID"),
        F.col("p_type").alias("Category"), F.col("p_brand").alias("SubCategory"), "Title",
        "Abstract", null.alias("URL"), null.alias("TitleEnt"), null.alias("AbsEnt"))
    pages = supplier.select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("NewsID"),
        *[null.alias(c) for c in articles.columns[1:]])
    return articles.unionByName(pages)


def behaviors_from_tables(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Behaviour log in the 5-column layout: one row per order.

    Line items are first reduced to one impression string per order (the
    groups are one order's lines, so they stay small); the result is already
    hash-partitioned on the order key, so the join with ``orders`` only
    shuffles ``orders``.
    """
    def when(mod: int, rem: int, *parts: Column) -> Column:
        return F.when(F.pmod(F.col("l_partkey"), F.lit(mod)) == rem, F.concat(*parts))

    part, supp = F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")
    flag = F.when(F.col("l_returnflag") == CLICK_RETURNFLAG, F.lit("-1")).otherwise(F.lit("-0"))
    tok = F.concat_ws(
        " ", F.concat(F.lit("N"), part, flag),
        when(ORPHAN_MOD, ORPHAN_REM, F.lit("X"), supp, flag),
        when(PAGE_MOD, 0, F.lit("S"), supp, flag),
        when(MALFORMED_TOKEN_MOD, 0, F.lit("N"), part))
    per_order = (lineitem
                 .select("l_orderkey",
                         F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag",
                                  tok.alias("tok")).alias("t"))
                 .groupBy("l_orderkey")
                 .agg(F.array_join(F.sort_array(F.collect_list("t"))["tok"], " ").alias("Impressions")))
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    j = o.join(per_order, o.o_orderkey == per_order.l_orderkey, "left")
    return j.select(
        F.col("o_orderkey").cast("string").alias("ImpID"),
        F.concat(F.lit("U"), F.col("o_custkey").cast("string")).alias("UserID"),
        F.col("o_orderdate").cast("string").alias("Time"),
        F.lit("").alias("History"),
        F.col("Impressions"))


def event_values_from_tables(events: DataFrame, part: DataFrame) -> DataFrame:
    """Click-stream messages: one JSON ``value`` per event, as a producer sends."""
    k = F.get_json_object(F.col("props"), "$.k")
    ev = events.select("event_id", "user_id", "event_type", k.alias("k"))
    cat = part.select(F.col("p_partkey").cast("string").alias("k"),
                      F.col("p_type").alias("Category"))
    j = ev.join(cat, "k", "left")
    body = F.struct(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("UserID"),
        F.concat(F.lit("N"), F.col("k")).alias("NewsID"),
        F.col("Category"),
        F.when(F.col("event_type") == "click", F.lit(1)).otherwise(F.lit(0)).alias("Click"))
    return j.select(F.col("event_id"), F.to_json(body).alias("value"))


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    return news_from_tables(*(table(spark, sf_dir, t) for t in ("part", "documents", "supplier")))


def behaviors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return behaviors_from_tables(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"))


def event_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_values_from_tables(table(spark, sf_dir, "events"), table(spark, sf_dir, "part"))


def requested_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customer ids as requested users, and a visitor for every supplier,
    whom no log knows (cold start)."""
    customers = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("U"), F.col("c_custkey").cast("string")).alias("UserID"))
    return customers.unionByName(table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("V"), F.col("s_suppkey").cast("string")).alias("UserID")))
