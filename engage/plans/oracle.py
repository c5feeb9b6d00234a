"""DuckDB SQL twins of the registered queries.

The driver pre-registers the raw test tables as views; each statement
re-derives the click log from them with the same mapping the Spark side uses
(FIXTURES.md §2) and then states the query.  The SQL is written from the
query semantics, independently of the DataFrame code, so that it is a real
second opinion.
"""

from __future__ import annotations

# ---------------------------------------------------------------- fixtures
NEWS = """
news AS (
  SELECT 'N' || CAST(p.p_partkey AS VARCHAR) AS NewsID, p.p_type AS Category,
         p.p_brand AS SubCategory,
         split_part(d.text, chr(10), 1) AS Title,
         CASE WHEN strpos(d.text, chr(10)) > 0 THEN substr(d.text, strpos(d.text, chr(10)) + 1) END AS Abstract
  FROM part p LEFT JOIN documents d ON d.doc_id = p.p_partkey
  UNION ALL
  SELECT 'S' || CAST(s_suppkey AS VARCHAR), NULL, NULL, NULL, NULL FROM supplier
)"""

BEHAVIORS = """
li_imp AS (
  SELECT l_orderkey,
         string_agg('N' || CAST(l_partkey AS VARCHAR) || flag
                    || CASE WHEN l_partkey % 40 = 1 THEN ' X' || CAST(l_suppkey AS VARCHAR) || flag ELSE '' END
                    || CASE WHEN l_partkey % 50 = 0 THEN ' S' || CAST(l_suppkey AS VARCHAR) || flag ELSE '' END
                    || CASE WHEN l_partkey % 97 = 0 THEN ' N' || CAST(l_partkey AS VARCHAR) ELSE '' END,
                    ' ' ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag) AS Impressions
  FROM (SELECT *, CASE WHEN l_returnflag = 'R' THEN '-1' ELSE '-0' END AS flag FROM lineitem)
  GROUP BY l_orderkey
),
behaviors AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS ImpID,
         'U' || CAST(o.o_custkey AS VARCHAR) AS UserID,
         CAST(o.o_orderdate AS VARCHAR) AS Time,
         '' AS History,
         li.Impressions
  FROM orders o LEFT JOIN li_imp li ON li.l_orderkey = o.o_orderkey
)"""

TOKENS = """
tokens AS (
  SELECT UserID, Time, ImpID,
         CAST(t.pos - 1 AS INTEGER) AS ImpPos, t.imp
  FROM behaviors,
       unnest(string_split(Impressions, ' ')) WITH ORDINALITY AS t(imp, pos)
  WHERE Impressions IS NOT NULL
)"""


def _inter(strict: bool = False, name: str = "inter") -> str:
    click = "TRY_CAST(NULLIF(split_part(imp, '-', 2), '') AS INTEGER)"
    strict_sql = " AND len(string_split(imp, '-')) = 2" if strict else ""
    return f"""
{name} AS (
  SELECT UserID, split_part(imp, '-', 1) AS NewsID, {click} AS Click, Time,
         ImpID, ImpPos
  FROM tokens
  WHERE {click} IS NOT NULL{strict_sql}
)"""


NEWS_CLEAN = """
news_clean AS (
  SELECT NewsID,
         coalesce(Category, 'unknown') AS Category,
         coalesce(SubCategory, 'unknown') AS SubCategory,
         coalesce(Title, '') AS Title,
         CAST(CASE WHEN Title IS NULL THEN -1 ELSE len(string_split(Title, ' ')) END
              AS INTEGER) AS TitleWordCount
  FROM news
)"""

ART = """
art AS (
  SELECT NewsID, total_impressions, total_clicks, article_ctr,
         round(ln(1 + total_clicks) * article_ctr, 4) AS popularity_score
  FROM (SELECT NewsID, count(Click) AS total_impressions,
               CAST(sum(Click) AS BIGINT) AS total_clicks,
               round(CAST(sum(Click) AS DOUBLE) / count(Click), 4) AS article_ctr
        FROM inter GROUP BY NewsID)
)"""

USR = """
usr AS (
  SELECT UserID, user_total_impressions, user_total_clicks,
         round(CAST(user_total_clicks AS DOUBLE) / user_total_impressions, 4) AS user_ctr,
         CASE WHEN user_total_impressions <= 5 THEN 0
              WHEN user_total_impressions <= 15 THEN 1
              WHEN user_total_impressions <= 30 THEN 2 ELSE 3 END AS activity_encoded
  FROM (SELECT UserID, count(Click) AS user_total_impressions,
               CAST(sum(Click) AS BIGINT) AS user_total_clicks
        FROM inter GROUP BY UserID)
)"""

AFF = """
aff AS (
  SELECT UserID, Category, cat_click_count, total_cat_clicks,
         round(CAST(cat_click_count AS DOUBLE) / total_cat_clicks, 4) AS category_affinity
  FROM (SELECT UserID, Category, cat_click_count,
               CAST(sum(cat_click_count) OVER (PARTITION BY UserID) AS BIGINT) AS total_cat_clicks
        FROM (SELECT i.UserID, nc.Category, count(*) AS cat_click_count
              FROM inter i LEFT JOIN news_clean nc ON nc.NewsID = i.NewsID
              WHERE i.Click = 1
              GROUP BY i.UserID, nc.Category))
)"""


def _top(ties: str = "all", name: str = "topcat") -> str:
    if ties == "all":
        order = "rank() OVER (PARTITION BY UserID ORDER BY category_affinity DESC)"
    else:
        order = ("row_number() OVER (PARTITION BY UserID ORDER BY category_affinity DESC, "
                 "Category ASC NULLS LAST)")
    return f"""
{name} AS (
  SELECT UserID, Category AS preferred_category,
         category_affinity AS top_category_affinity
  FROM (SELECT *, {order} AS rk FROM aff) WHERE rk = 1
)"""


def _featured(top: str = "topcat", name: str = "ds", extra: str = "") -> str:
    return f"""
{name} AS (
  SELECT i.UserID, i.NewsID, i.Click, i.Time, nc.Category, nc.SubCategory, nc.Title,
         coalesce(nc.TitleWordCount, 8) AS TitleWordCount,
         a.total_impressions, a.total_clicks,
         coalesce(a.article_ctr, 0.0) AS article_ctr,
         coalesce(a.popularity_score, 0.0) AS popularity_score,
         u.user_total_impressions, u.user_total_clicks,
         coalesce(u.user_ctr, 0.0) AS user_ctr,
         coalesce(u.activity_encoded, 1) AS activity_encoded,
         t.preferred_category,
         coalesce(t.top_category_affinity, 0.0) AS top_category_affinity,
         coalesce(CAST(nc.Category = t.preferred_category AS INTEGER), 0) AS category_match,
         CASE WHEN nc.TitleWordCount <= 6 THEN 0 WHEN nc.TitleWordCount <= 10 THEN 1
              WHEN nc.TitleWordCount <= 15 THEN 2 ELSE 3 END AS title_len_encoded{extra}
  FROM inter i
  LEFT JOIN news_clean nc ON nc.NewsID = i.NewsID
  LEFT JOIN art a ON a.NewsID = i.NewsID
  LEFT JOIN usr u ON u.UserID = i.UserID
  LEFT JOIN {top} t ON t.UserID = i.UserID
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


BASE = (NEWS, BEHAVIORS, TOKENS, _inter())
FEATURED = (*BASE, NEWS_CLEAN, ART, USR, AFF, _top("all"), _featured())
FEATURED_FIRST = (*BASE, NEWS_CLEAN, ART, USR, AFF, _top("first"), _featured())
FEATURED_POS = (*BASE, NEWS_CLEAN, ART, USR, AFF, _top("all"),
                _featured(extra=", i.ImpID, i.ImpPos"))

INTER_COLS = "UserID, NewsID, Click, Time"
DS_COLS = ("UserID, NewsID, Click, Time, Category, SubCategory, Title, TitleWordCount, "
           "total_impressions, total_clicks, article_ctr, popularity_score, "
           "user_total_impressions, user_total_clicks, user_ctr, activity_encoded, "
           "preferred_category, top_category_affinity, category_match, title_len_encoded")
STORED = ("UserID, NewsID, Click, Category, Title, article_ctr, popularity_score, user_ctr, "
          "category_match, activity_encoded, title_len_encoded, top_category_affinity, "
          "TitleWordCount, preferred_category")


def _q(ctes, body: str) -> str:
    return with_ctes(*ctes) + body


USER_ENGAGEMENT = """
ue AS (
  SELECT UserID, CAST(sum(Click) AS BIGINT) AS clicks, count(*) AS impressions,
         CAST(sum(Click) AS DOUBLE) / count(*) AS CTR
  FROM ds GROUP BY UserID
)"""

SQL: dict[str, str] = {
    # ---- parse and features
    "parse_impressions": _q(BASE, f"SELECT {INTER_COLS} FROM inter"),
    "parse_strict": _q((NEWS, BEHAVIORS, TOKENS, _inter(strict=True)),
                       f"SELECT {INTER_COLS} FROM inter"),
    "news_clean": _q((NEWS, NEWS_CLEAN), "SELECT * FROM news_clean"),
    "article_stats": _q(BASE + (ART,), "SELECT * FROM art"),
    "user_stats": _q(BASE + (USR,), "SELECT * FROM usr"),
    "category_affinity": _q(BASE + (NEWS_CLEAN, AFF), "SELECT * FROM aff"),
    "top_category_all": _q(BASE + (NEWS_CLEAN, AFF, _top("all")), "SELECT * FROM topcat"),
    "top_category_first": _q(BASE + (NEWS_CLEAN, AFF, _top("first")), "SELECT * FROM topcat"),
    "featured_dataset": _q(FEATURED, f"SELECT {DS_COLS} FROM ds"),
    "featured_dataset_first": _q(FEATURED_FIRST, f"SELECT {DS_COLS} FROM ds"),
    "featured_projection": _q(FEATURED, f"SELECT {STORED} FROM ds"),
    "catalogue_semi_join": _q(BASE, f"SELECT {INTER_COLS} FROM inter "
                                    "WHERE NewsID IN (SELECT NewsID FROM news)"),
    # ---- analytics
    "overall_ctr": _q(BASE, "SELECT avg(Click) AS overall_ctr FROM inter"),
    "platform_stats": _q(FEATURED, """
SELECT count(DISTINCT UserID) AS total_users, count(DISTINCT NewsID) AS total_news,
       count(*) AS total_interactions, CAST(sum(Click) AS BIGINT) AS total_clicks,
       round_even(avg(Click), 4) AS overall_ctr
FROM ds"""),
    "platform_stats_catalogue": _q(FEATURED, """
SELECT count(DISTINCT UserID) AS total_users, (SELECT count(*) FROM news) AS total_news,
       count(*) AS total_interactions, CAST(sum(Click) AS BIGINT) AS total_clicks,
       round_even(CAST(sum(Click) AS DOUBLE) / greatest(count(*), 1), 4) AS overall_ctr
FROM ds"""),
    "category_clicks": _q(FEATURED, """
SELECT Category, count(*) AS clicks FROM ds WHERE Click = 1 GROUP BY Category
ORDER BY clicks DESC, Category NULLS LAST"""),
    "category_ctr": _q(FEATURED, """
SELECT Category, CAST(sum(Click) AS BIGINT) AS clicks, count(*) AS total,
       CAST(sum(Click) AS DOUBLE) / count(*) AS CTR
FROM ds GROUP BY Category ORDER BY CTR DESC, Category NULLS LAST"""),
    "category_trend": _q(FEATURED, """
SELECT Category, CAST(sum(Click) AS BIGINT) AS clicks, count(*) AS impressions,
       CAST(sum(Click) AS DOUBLE) / count(*) AS CTR
FROM ds WHERE Category IS NOT NULL GROUP BY Category ORDER BY CTR DESC, Category"""),
    "top_categories": _q(FEATURED, """
SELECT Category, CAST(sum(Click) AS BIGINT) AS clicks, count(*) AS total,
       CAST(sum(Click) AS DOUBLE) / count(*) AS CTR
FROM ds WHERE Category IS NOT NULL GROUP BY Category
ORDER BY clicks DESC, Category LIMIT 10"""),
    "top_news": _q(FEATURED, """
SELECT NewsID, CAST(sum(Click) AS BIGINT) AS clicks, count(*) AS impressions,
       min(Category) AS Category, min(Title) AS Title,
       CAST(sum(Click) AS DOUBLE) / count(*) AS CTR
FROM ds GROUP BY NewsID ORDER BY clicks DESC, NewsID LIMIT 20"""),
    "top_news_with_category": _q(FEATURED, """
SELECT t.NewsID, t.clicks, t.impressions, t.CTR, p.Category
FROM (SELECT NewsID, CAST(sum(Click) AS BIGINT) AS clicks, count(*) AS impressions,
             CAST(sum(Click) AS DOUBLE) / count(*) AS CTR
      FROM ds GROUP BY NewsID ORDER BY clicks DESC, NewsID LIMIT 20) t
LEFT JOIN (SELECT DISTINCT NewsID, Category FROM ds) p ON p.NewsID = t.NewsID"""),
    "top_users": _q(FEATURED + (USER_ENGAGEMENT,), """
SELECT * FROM ue ORDER BY impressions DESC, UserID LIMIT 20"""),
    "active_users": _q(FEATURED, """
SELECT UserID, count(*) AS n_interactions FROM ds GROUP BY UserID
ORDER BY n_interactions DESC, UserID LIMIT 50"""),
    "user_profile": _q(FEATURED, """
SELECT UserID, count(*) AS total_impressions, CAST(sum(Click) AS BIGINT) AS total_clicks,
       round_even(avg(user_ctr), 4) AS avg_user_ctr,
       min(preferred_category) AS preferred_category,
       max(top_category_affinity) AS top_category_affinity,
       max(activity_encoded) AS activity_encoded,
       round_even(CAST(sum(Click) AS DOUBLE) / greatest(count(*), 1), 4) AS ctr
FROM ds GROUP BY UserID"""),
    "user_profile_mode": _q(FEATURED, """
SELECT u.UserID, u.total_clicks, u.total_impressions, m.Category AS preferred_category,
       round_even(CAST(u.total_clicks AS DOUBLE) / u.total_impressions, 4) AS ctr
FROM (SELECT UserID, count(*) FILTER (WHERE Click = 1) AS total_clicks,
             count(*) AS total_impressions FROM ds GROUP BY UserID) u
LEFT JOIN (SELECT UserID, Category FROM (
             SELECT UserID, Category, row_number() OVER (
                      PARTITION BY UserID ORDER BY count(*) DESC, Category) AS rk
             FROM ds WHERE Click = 1 AND Category IS NOT NULL
             GROUP BY UserID, Category) WHERE rk = 1) m ON m.UserID = u.UserID"""),
    "activity_distribution": _q(FEATURED, """
SELECT l.activity, coalesce(c.users, 0) AS users
FROM (VALUES (0, 'Low'), (1, 'Medium'), (2, 'High'), (3, 'Very High')) l(code, activity)
LEFT JOIN (SELECT code, count(*) AS users FROM (
             SELECT CASE WHEN n > 0 AND n <= 5 THEN 0 WHEN n > 5 AND n <= 15 THEN 1
                         WHEN n > 15 AND n <= 30 THEN 2 WHEN n > 30 AND n <= 9999 THEN 3
                    END AS code
             FROM (SELECT UserID, count(*) AS n FROM ds GROUP BY UserID))
           WHERE code IS NOT NULL GROUP BY code) c ON c.code = l.code
ORDER BY l.code"""),
    "user_ctr_histogram": _q(FEATURED + (USER_ENGAGEMENT,), """
SELECT bin, (bin - 1) / 30.0 AS lower, bin / 30.0 AS upper, count(*) AS users
FROM (SELECT CAST(least(floor(CTR * 30) + 1, 30) AS INTEGER) AS bin FROM ue)
GROUP BY bin ORDER BY bin"""),
    "user_scatter": _q(FEATURED + (USER_ENGAGEMENT,), """
SELECT * FROM ue ORDER BY UserID LIMIT 200"""),
    "class_distribution": _q(FEATURED, """
SELECT Click, count(*) AS n, count(*) / (SELECT count(*) FROM ds) AS share
FROM ds GROUP BY Click ORDER BY Click"""),
}


# ---------------------------------------------------------------- recommender
CAT = """
cat AS (
  SELECT NewsID, Category, Title, TitleWordCount,
         row_number() OVER (ORDER BY NewsID NULLS FIRST, Category NULLS FIRST,
                                     Title NULLS FIRST, TitleWordCount NULLS FIRST) AS pos
  FROM news_clean
)"""

CANDS = """
users AS (SELECT DISTINCT UserID FROM ds),
seen AS (SELECT DISTINCT UserID, NewsID FROM ds),
unseen AS (
  SELECT u.UserID, c.pos, c.NewsID FROM users u CROSS JOIN cat c
  WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.UserID = u.UserID AND s.NewsID = c.NewsID)
),
cands AS (
  SELECT UserID, pos, NewsID, false AS exhausted FROM unseen
  UNION ALL
  SELECT u.UserID, c.pos, c.NewsID, true AS exhausted
  FROM users u CROSS JOIN cat c
  WHERE u.UserID NOT IN (SELECT UserID FROM unseen)
)"""

LATEST = """
latest AS (
  SELECT UserID, user_ctr, preferred_category, activity_encoded, title_len_encoded,
         top_category_affinity
  FROM (SELECT *, row_number() OVER (
          PARTITION BY UserID ORDER BY Time DESC, TRY_CAST(ImpID AS BIGINT) DESC, ImpID DESC,
                                       ImpPos DESC, preferred_category DESC NULLS LAST) AS r
        FROM ds)
  WHERE r = 1
)"""

AMEANS = """
am AS (
  SELECT NewsID,
         CAST(avg(CAST(article_ctr AS DECIMAL(24,10))) AS DOUBLE) AS mean_article_ctr,
         CAST(avg(CAST(popularity_score AS DECIMAL(24,10))) AS DOUBLE) AS mean_popularity
  FROM ds GROUP BY NewsID
)"""

# every unseen pair with its features, and the first 10 of either match
CAND_FEATURES = """
cf AS (
  SELECT c.UserID, c.NewsID, c.pos, c.exhausted, k.Category, k.Title,
         CAST(coalesce(am.mean_article_ctr, 0.1) AS DOUBLE) AS article_ctr,
         CAST(coalesce(am.mean_popularity, 0.05) AS DOUBLE) AS popularity_score,
         CAST(coalesce(l.user_ctr, 0) AS DOUBLE) AS user_ctr,
         CAST(CAST(coalesce(k.Category = l.preferred_category, false) AS INTEGER) AS DOUBLE)
           AS category_match,
         CAST(coalesce(l.activity_encoded, 0) AS DOUBLE) AS activity_encoded,
         CAST(coalesce(l.title_len_encoded, 0) AS DOUBLE) AS title_len_encoded,
         CAST(coalesce(l.top_category_affinity, 0) AS DOUBLE) AS top_category_affinity,
         CAST(coalesce(k.TitleWordCount, 8) AS DOUBLE) AS TitleWordCount
  FROM cands c
  JOIN cat k ON k.pos = c.pos
  LEFT JOIN am ON am.NewsID = k.NewsID
  LEFT JOIN latest l ON l.UserID = c.UserID
),
shortlist AS (
  SELECT * EXCLUDE (r, Title) FROM (
    SELECT *, row_number() OVER (PARTITION BY UserID, category_match ORDER BY article_ctr DESC, pos) AS r FROM cf)
  WHERE r <= 10
)"""

POP = """
pop AS (
  SELECT p.NewsID, coalesce(n.Title, '') AS Title, coalesce(n.Category, '') AS Category,
         p.score AS click_probability, CAST(p.rank AS INTEGER) AS rank
  FROM (SELECT NewsID, score, row_number() OVER (ORDER BY score DESC, NewsID) AS rank
        FROM (SELECT NewsID, CAST(sum(Click) AS DOUBLE) / count(Click) AS score
              FROM ds GROUP BY NewsID)
        ORDER BY score DESC, NewsID LIMIT 10) p
  LEFT JOIN news_clean n ON n.NewsID = p.NewsID
)"""

# test side of a class: its round(n / 5) rows with the smallest keys
SPLIT = """
keyed AS (
  SELECT *, md5(concat_ws('|', '42', UserID, NewsID, CAST(Click AS VARCHAR), Time,
                          ImpID, CAST(ImpPos AS VARCHAR), preferred_category)) AS k
  FROM ds
),
cuts AS (
  SELECT Click, max(k) AS cut FROM (
    SELECT Click, k, row_number() OVER (PARTITION BY Click ORDER BY k) AS r,
           count(*) OVER (PARTITION BY Click) AS n FROM keyed)
  WHERE r <= (2 * n + 5) // 10 GROUP BY Click
),
sided AS (
  SELECT keyed.*, coalesce(k <= cut, false) AS is_test
  FROM keyed LEFT JOIN cuts ON keyed.Click IS NOT DISTINCT FROM cuts.Click
)"""

FEATS = ["article_ctr", "popularity_score", "user_ctr", "category_match", "activity_encoded",
         "title_len_encoded", "top_category_affinity", "TitleWordCount"]

TRAIN = f"""
train AS (
  SELECT {", ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0) AS {c}" for c in FEATS)}, Click
  FROM sided WHERE NOT is_test
)"""

TEST = f"""
test AS (
  SELECT {", ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0) AS {c}" for c in FEATS)}, Click
  FROM sided WHERE is_test
)"""

RULE_METRICS = """
sc AS (
  SELECT Click, p, CASE WHEN p > 0.4 THEN 1 ELSE 0 END AS pred
  FROM (SELECT Click, (article_ctr + user_ctr + top_category_affinity) / 3.0 AS p FROM test)
),
conf AS (
  SELECT count(*) FILTER (WHERE Click = 1 AND pred = 1) AS tp,
         count(*) FILTER (WHERE Click = 0 AND pred = 1) AS fp,
         count(*) FILTER (WHERE Click = 1 AND pred = 0) AS fn,
         count(*) FILTER (WHERE Click = 0 AND pred = 0) AS tn
  FROM sc
),
g AS (
  SELECT p, count(*) FILTER (WHERE Click = 1) AS pos, count(*) FILTER (WHERE Click = 0) AS neg
  FROM sc GROUP BY p
),
auc AS (
  SELECT sum(pos * (coalesce(nb, 0) + 0.5 * neg)) / (sum(pos) * sum(neg)) AS auc
  FROM (SELECT *, sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                  AS nb FROM g)
)"""

SQL.update({
    "ranked_catalogue": _q((NEWS, NEWS_CLEAN, CAT), "SELECT * FROM cat"),
    "unseen_ranges": _q(FEATURED_POS + (CAT, CANDS), """
SELECT UserID, exhausted, min(pos) AS first_pos, max(pos) AS last_pos, min(r) - 1 AS before
FROM (SELECT *, row_number() OVER (PARTITION BY UserID ORDER BY pos) AS r FROM cands)
GROUP BY UserID, exhausted, pos - r"""),
    "candidates": _q(FEATURED_POS + (CAT, CANDS, LATEST, AMEANS, CAND_FEATURES),
                     "SELECT UserID, pos, NewsID, exhausted FROM shortlist"),
    "candidate_features": _q(FEATURED_POS + (CAT, CANDS, LATEST, AMEANS, CAND_FEATURES),
                             "SELECT * FROM shortlist"),
    "article_means": _q(FEATURED + (AMEANS,), "SELECT * FROM am"),
    "latest_user_rows": _q(FEATURED_POS + (LATEST,), "SELECT * FROM latest"),
    "popular_articles": _q(FEATURED + (POP,), "SELECT * FROM pop"),
    "cold_start": _q(FEATURED + (POP,), """
SELECT u.UserID, p.NewsID, p.Title, p.Category, p.click_probability, p.rank
FROM (SELECT DISTINCT 'U' || CAST(c_custkey AS VARCHAR) AS UserID FROM customer
      UNION ALL SELECT DISTINCT 'V' || CAST(s_suppkey AS VARCHAR) FROM supplier) u
CROSS JOIN pop p
WHERE u.UserID NOT IN (SELECT UserID FROM ds)"""),
    "exhausted_users": _q(FEATURED, """
SELECT UserID, count(*) AS seen_articles
FROM (SELECT DISTINCT UserID, NewsID FROM ds
      WHERE NewsID IN (SELECT NewsID FROM news_clean))
GROUP BY UserID
HAVING count(*) >= (SELECT count(DISTINCT NewsID) FROM news_clean)"""),
    "short_titles": _q((NEWS, NEWS_CLEAN), """
SELECT NewsID, substring(Title, 1, 40) || '...' AS short_title,
       substring(Title, 1, 80) AS card_title, upper(Category) AS category_tag
FROM news_clean"""),
    "split_counts": _q(FEATURED_POS + (SPLIT,), """
SELECT CASE WHEN is_test THEN 'test' ELSE 'train' END AS side, Click, count(*) AS n
FROM sided GROUP BY ALL"""),
    # SMOTE adds exactly n_majority - n_minority minority rows to the train side
    "smote_balance": _q(FEATURED_POS + (SPLIT, TRAIN), """
SELECT CAST(Click AS INTEGER) AS Click, max(count(*)) OVER () AS n FROM train GROUP BY Click"""),
    "scaler_fit": _q(FEATURED_POS + (SPLIT, TRAIN), " UNION ALL ".join(
        f"SELECT '{c}' AS feature, avg({c}) AS mean, stddev_pop({c}) AS std FROM train"
        for c in FEATS)),
    "model_metrics": _q(FEATURED_POS + (SPLIT, TEST, RULE_METRICS), """
SELECT round(CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn), 4) AS accuracy,
       round((SELECT auc FROM auc), 4) AS auc,
       round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0.0 END, 4)
         AS f1,
       round(CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END, 4)
         AS precision,
       round(CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0.0 END, 4)
         AS recall
FROM conf"""),
})


# ---------------------------------------------------------------- click stream
EVENTS = """
ev AS (
  SELECT e.event_id, 'U' || CAST(e.user_id AS VARCHAR) AS UserID,
         'N' || json_extract_string(e.props, '$.k') AS NewsID,
         p.p_type AS Category,
         CASE WHEN e.event_type = 'click' THEN 1 ELSE 0 END AS Click
  FROM events e
  LEFT JOIN part p ON CAST(p.p_partkey AS VARCHAR) = json_extract_string(e.props, '$.k')
)"""

_EV_JSON = ("SELECT event_id, CAST(to_json(struct_pack(UserID := UserID, NewsID := NewsID, "
            "Category := Category, Click := Click)) AS VARCHAR) AS value FROM ev")
SQL.update({
    "event_values": _q((EVENTS,), _EV_JSON),
    "message_text": _q((EVENTS,), f"SELECT value FROM ({_EV_JSON})"),
    "parse_events": _q((EVENTS,), "SELECT UserID, NewsID, Category, Click FROM ev"),
    "stream_events": _q((EVENTS,), "SELECT UserID, NewsID, Category, Click FROM ev"),
})


SQL.update({
    "tsv_news": _q((NEWS,), """
SELECT NewsID, Category, SubCategory, Title, Abstract,
       CAST(NULL AS VARCHAR) AS URL, CAST(NULL AS VARCHAR) AS TitleEnt,
       CAST(NULL AS VARCHAR) AS AbsEnt
FROM news"""),
    "tsv_behaviors": SQL["parse_impressions"],
    "stored_interactions": SQL["featured_projection"],
    "stored_news": SQL["news_clean"],
})


# ---------------------------------------------------------------- dashboard features
DASH = """
dcat AS (
  SELECT NewsID, coalesce(Category, '') AS Category, coalesce(SubCategory, '') AS SubCategory,
         coalesce(Title, '') AS Title,
         CAST(len(list_filter(regexp_split_to_array(trim(coalesce(Title, '')), '\\s+'),
                              lambda w: w <> '')) AS INTEGER) AS TitleWordCount
  FROM news
),
dinter AS (SELECT * FROM inter WHERE NewsID IN (SELECT NewsID FROM dcat)),
dpop AS (
  SELECT NewsID, article_ctr, round_even(ln(1 + c) * article_ctr, 4) AS popularity_score
  FROM (SELECT NewsID, CAST(sum(Click) AS BIGINT) AS c,
               round_even(CAST(sum(Click) AS DOUBLE) / count(Click), 4) AS article_ctr
        FROM dinter GROUP BY NewsID)
),
dusr AS (
  SELECT UserID, round_even(CAST(c AS DOUBLE) / n, 4) AS user_ctr,
         CASE WHEN n > 0 AND n <= 5 THEN 0 WHEN n > 5 AND n <= 15 THEN 1
              WHEN n > 15 AND n <= 30 THEN 2 WHEN n > 30 AND n <= 9999 THEN 3 END
           AS activity_encoded
  FROM (SELECT UserID, count(Click) AS n, CAST(sum(Click) AS BIGINT) AS c
        FROM dinter GROUP BY UserID)
),
dmerged AS (
  SELECT i.UserID, i.NewsID, i.Click, c.Category
  FROM dinter i LEFT JOIN (SELECT DISTINCT NewsID, Category FROM dcat) c ON c.NewsID = i.NewsID
),
daff AS (
  SELECT UserID, Category,
         round_even(CAST(cnt AS DOUBLE) / sum(cnt) OVER (PARTITION BY UserID), 4)
           AS category_affinity
  FROM (SELECT UserID, Category, count(*) AS cnt FROM dmerged
        WHERE Click = 1 AND Category IS NOT NULL GROUP BY UserID, Category)
),
dtop AS (
  SELECT UserID, Category AS preferred_category, category_affinity AS top_category_affinity
  FROM (SELECT *, row_number() OVER (PARTITION BY UserID ORDER BY category_affinity DESC,
                                     Category ASC NULLS LAST) AS rk FROM daff)
  WHERE rk = 1
),
dds AS (
  SELECT m.UserID, m.NewsID, m.Click, m.Category,
         coalesce(p.article_ctr, 0.0) AS article_ctr,
         coalesce(p.popularity_score, 0.0) AS popularity_score,
         coalesce(u.user_ctr, 0.0) AS user_ctr,
         coalesce(u.activity_encoded, 1) AS activity_encoded,
         t.preferred_category,
         coalesce(t.top_category_affinity, 0.0) AS top_category_affinity,
         coalesce(w.TitleWordCount, 8) AS TitleWordCount,
         coalesce(CAST(m.Category = t.preferred_category AS INTEGER), 0) AS category_match,
         coalesce(CASE WHEN w.TitleWordCount > 0 AND w.TitleWordCount <= 6 THEN 0
                       WHEN w.TitleWordCount > 6 AND w.TitleWordCount <= 10 THEN 1
                       WHEN w.TitleWordCount > 10 AND w.TitleWordCount <= 15 THEN 2
                       WHEN w.TitleWordCount > 15 AND w.TitleWordCount <= 999 THEN 3 END, 1)
           AS title_len_encoded
  FROM dmerged m
  LEFT JOIN dpop p ON p.NewsID = m.NewsID
  LEFT JOIN dusr u ON u.UserID = m.UserID
  LEFT JOIN dtop t ON t.UserID = m.UserID
  LEFT JOIN (SELECT DISTINCT NewsID, TitleWordCount FROM dcat) w ON w.NewsID = m.NewsID
)"""

SQL["featured_dashboard"] = _q((NEWS, BEHAVIORS, TOKENS, _inter(strict=True), DASH),
                               "SELECT * FROM dds")
SQL["catalogue_duplicates"] = _q((NEWS,), """
SELECT NewsID, count(*) AS copies FROM news GROUP BY NewsID HAVING count(*) > 1""")


RECOMMENDED = FEATURED_POS + (CAT, CANDS, LATEST, AMEANS, CAND_FEATURES, """
recs AS (
  SELECT UserID, NewsID, Title, Category, round_even(p, 4) AS click_probability, CAST(rank AS INTEGER) AS rank
  FROM (SELECT *, row_number() OVER (PARTITION BY UserID ORDER BY p DESC, pos) AS rank
        FROM (SELECT *, (article_ctr + user_ctr + top_category_affinity) / 3.0 AS p FROM cf))
  WHERE rank <= 10
)""")
MOST_ACTIVE = "(SELECT UserID FROM ds GROUP BY UserID ORDER BY count(*) DESC, UserID LIMIT 1)"
SQL["recommend_rule"] = _q(RECOMMENDED, "SELECT * FROM recs")
SQL["cached_recommendations"] = _q(RECOMMENDED, f"SELECT * FROM recs WHERE UserID = {MOST_ACTIVE}")
SQL["display_recommendations"] = _q(RECOMMENDED, """
SELECT UserID, NewsID, substring(Title, 1, 40) || '...' AS short_title, substring(Title, 1, 80) AS card_title,
       upper(Category) AS category_tag, least(click_probability, 1.0) AS progress FROM recs""")
for _one, _all in (("one_user_profile", "user_profile"), ("one_user_mode", "user_profile_mode")):
    _body = SQL[_all].removeprefix(_q(FEATURED, ""))
    SQL[_one] = _q(FEATURED, f"SELECT * FROM ({_body}) WHERE UserID = {MOST_ACTIVE}")
SQL["category_copies"] = _q((NEWS,), """
SELECT Category AS NewsID, count(*) AS copies FROM news GROUP BY Category HAVING count(*) > 1""")
BRANDS = ("""
brands AS (SELECT DISTINCT SubCategory AS NewsID FROM news WHERE SubCategory IS NOT NULL)""", """
brand_seen AS (SELECT DISTINCT UserID, SubCategory AS NewsID FROM ds WHERE SubCategory IN (SELECT NewsID FROM brands))""")
SQL["exhausted_brands"] = _q(FEATURED + BRANDS, """
SELECT UserID, count(*) AS seen_articles FROM brand_seen GROUP BY UserID
HAVING count(*) >= (SELECT count(*) FROM brands)""")
SQL["unseen_brands"] = _q(FEATURED + BRANDS, """
SELECT UserID, exhausted, min(pos) AS first_pos, max(pos) AS last_pos, min(r) - 1 AS before
FROM (SELECT *, row_number() OVER (PARTITION BY UserID ORDER BY pos) AS r FROM (
        SELECT u.UserID, b.pos, x.UserID IS NOT NULL AS exhausted
        FROM (SELECT DISTINCT UserID FROM brand_seen) u
        CROSS JOIN (SELECT NewsID, row_number() OVER (ORDER BY NewsID) AS pos FROM brands) b
        LEFT JOIN (SELECT UserID FROM brand_seen GROUP BY UserID
                   HAVING count(*) = (SELECT count(*) FROM brands)) x ON x.UserID = u.UserID
        WHERE x.UserID IS NOT NULL OR NOT EXISTS (
          SELECT 1 FROM brand_seen s WHERE s.UserID = u.UserID AND s.NewsID = b.NewsID)))
GROUP BY UserID, exhausted, pos - r""")


# ---------------------------------------------------------------- metrics of fixed rules, properties of models
RULE_SCORES = [("Mean Rule", "(article_ctr + user_ctr + top_category_affinity) / 3.0"), ("Article Rule", "article_ctr"),
               ("User Rule", "user_ctr")]
RULES = (SPLIT, TEST, "\nrs AS (" + " UNION ALL ".join(
    f"SELECT '{name}' AS model, {i} AS position, Click, {p} AS p FROM test" for i, (name, p) in enumerate(RULE_SCORES))
    + ")", """
rg AS (
  SELECT model, p, count(*) FILTER (WHERE Click = 1) AS pos, count(*) FILTER (WHERE Click = 0) AS neg
  FROM rs GROUP BY model, p
),
ra AS (
  SELECT model, sum(pos * (coalesce(nb, 0) + 0.5 * neg)) / (sum(pos) * sum(neg)) AS auc
  FROM (SELECT *, sum(neg) OVER (PARTITION BY model ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS nb
        FROM rg) GROUP BY model
),
rc AS (
  SELECT model, position, count(*) FILTER (WHERE Click = 1 AND p > 0.4) AS tp, count(*) FILTER (WHERE Click = 0 AND p > 0.4) AS fp,
         count(*) FILTER (WHERE Click = 1 AND NOT p > 0.4) AS fn, count(*) FILTER (WHERE Click = 0 AND NOT p > 0.4) AS tn
  FROM rs GROUP BY model, position
),
rules AS (
  SELECT rc.model, rc.position, round(CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn), 4) AS accuracy,
         round(auc, 4) AS auc,
         round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0.0 END, 4) AS f1,
         round(CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END, 4) AS precision,
         round(CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0.0 END, 4) AS recall
  FROM rc JOIN ra ON ra.model = rc.model
)""")
SQL.update({
    "rule_metrics": _q(FEATURED_POS + RULES, "SELECT * FROM rules"),
    "stored_model_results": _q(FEATURED_POS + RULES, "SELECT * FROM rules"),
    "rule_best": _q(FEATURED_POS + RULES, "SELECT * FROM rules ORDER BY auc DESC, position LIMIT 1"),
    "rule_metrics_long": _q(FEATURED_POS + RULES, """
SELECT model, metric, value, value = max(value) OVER (PARTITION BY metric) AS is_best FROM (
  SELECT model, 'accuracy' AS metric, accuracy AS value FROM rules UNION ALL SELECT model, 'auc', auc FROM rules
  UNION ALL SELECT model, 'f1', f1 FROM rules)"""),
    "saved_featured": SQL["featured_dataset"],
    # CSV does not tell an empty text from a missing one
    "csv_interactions": _q(FEATURED, "SELECT * REPLACE (nullif(Title, '') AS Title) FROM ("
                           + SQL["featured_projection"].removeprefix(_q(FEATURED, "")) + ")"),
    "json_categories": SQL["category_ctr"],
    "first_source": SQL["news_clean"],
    "model_properties": """
SELECT model, position, true AS beats_chance, true AS low_in_range, true AS high_in_range, true AS best_has_top_auc
FROM (VALUES ('Logistic Regression', 0), ('Random Forest', 1), ('Gradient Boosting', 2)) m(model, position)""",
    "importance_properties": "SELECT 8::BIGINT AS n, 8::BIGINT AS n_features, 1.0::DOUBLE AS total, true AS none_negative",
    "recommend_properties": _q(FEATURED, """
SELECT count(DISTINCT UserID) AS users, 10 * count(DISTINCT UserID) AS n, 0::BIGINT AS n_seen, 0::BIGINT AS n_unknown, 0::BIGINT AS n_rising,
       10 AS last_rank FROM ds"""),
    "cluster_properties": _q(FEATURED, """
SELECT count(*) AS n, 3::BIGINT AS n_clusters, 3::BIGINT AS n_segments, true AS sizes_add_up FROM ds"""),
})
