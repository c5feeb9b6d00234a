"""Small tables with the cases every corpus operator has to stand."""

from pyspark.sql import DataFrame, SparkSession

SF_SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, v long"
BASE = ("the quick brown fox jumps over the lazy dog near a quiet river bank while seven grey herons "
        "watch from the far shore and nobody says a single word about it today")


def rows() -> list[tuple]:
    other = " ".join(f"w{i * i % 97}x{i}" for i in range(400))
    texts = [
        (1, BASE), (2, BASE), (3, BASE.replace("quiet", "calm")), (4, None), (5, ""), (6, " \n\t "),
        (7, "one"), (8, "one two"), (9, other), (10, other + " tail"), (None, BASE), (None, "lone words here"),
        (12, "Ünïcode “quotes” \U0001F600 ẞ ǅ\x1c\x85 x　y"), (12, "Ünïcode “quotes” \U0001F600 ẞ ǅ\x1c\x85 x　y"),
        (13, "a b c d e f g h " * 4000), (14, "x" * 30000), (15, "line one is here now\nline one is here now\n\nend"),
        (16, "mail me: joe.b@ex.co.uk or +1 (017) 555-7713, 4111 1111 1111 1111 at 10.0.0.255 ok"),
        (17, "<|endoftext|> </s>[INST] \\ <\\| <|x|>"), (18, "# $ % & * | < > " * 30),
    ]
    return [(i, t, "en", None if i == 7 else f"s{(i or 0) % 3}", len(t or ""), "n", 5) for i, t in texts]


def documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def no_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def small(spark: SparkSession, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{SF_SMALL}/{name}.parquet")
