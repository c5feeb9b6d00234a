"""Fixed schemas and column lists of the click-log data model."""

from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

# Layouts of the news catalogue, the behaviour log and the
# click-stream event, and the feature / storage column lists.
NEWS_SCHEMA = StructType([
    StructField("NewsID", StringType(), True),
    StructField("Category", StringType(), True),
    StructField("SubCategory", StringType(), True),
    StructField("Title", StringType(), True),
    StructField("Abstract", StringType(), True),
    StructField("URL", StringType(), True),
    StructField("TitleEnt", StringType(), True),
    StructField("AbsEnt", StringType(), True),
])

BEH_SCHEMA = StructType([
    StructField("ImpID", StringType(), True),
    StructField("UserID", StringType(), True),
    StructField("Time", StringType(), True),
    StructField("History", StringType(), True),
    StructField("Impressions", StringType(), True),
])

EVENT_SCHEMA = StructType([
    StructField("UserID", StringType(), True),
    StructField("NewsID", StringType(), True),
    StructField("Category", StringType(), True),
    StructField("Click", IntegerType(), True),
])

FEATURE_COLS = [
    "article_ctr", "popularity_score", "user_ctr", "category_match",
    "activity_encoded", "title_len_encoded", "top_category_affinity",
    "TitleWordCount",
]
TARGET = "Click"
ROW_KEY = "_k"                  # row key of split and training rows

STORED_COLS = [
    "UserID", "NewsID", "Click", "Category", "Title", "article_ctr",
    "popularity_score", "user_ctr", "category_match", "activity_encoded",
    "title_len_encoded", "top_category_affinity", "TitleWordCount",
    "preferred_category",
]

STORED_SCHEMA = StructType([
    StructField(c, StringType() if c in ("UserID", "NewsID", "Category", "Title", "preferred_category")
                else IntegerType() if c in ("Click", "category_match", "activity_encoded", "title_len_encoded",
                                            "TitleWordCount") else DoubleType(), True)
    for c in STORED_COLS])

# Null fills of the featured dataset (batch variant).
FEATURE_FILL = {
    "article_ctr": 0.0, "popularity_score": 0.0, "user_ctr": 0.0,
    "top_category_affinity": 0.0, "activity_encoded": 1,
    "title_len_encoded": 1, "TitleWordCount": 8, "category_match": 0,
}

# Defaults for a candidate article that has no interaction statistics, and
# for the title length of a catalogue row without one.
UNSEEN_ARTICLE_CTR = 0.1
UNSEEN_POPULARITY = 0.05
DEFAULT_TITLE_WORDS = 8

# Codes of a tab-separated field for an empty text and for
# characters; the backslash comes first.
EMPTY = "\\e"
ESCAPES = [("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")]
