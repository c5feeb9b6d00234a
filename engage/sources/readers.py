"""Batch sources: tab-separated logs, Parquet tables, CSV, fallback chains.

All readers take an explicit schema (no inference pass over the data) and
return lazy DataFrames: filters and projections applied later reach the
scan (Parquet predicate pushdown, CSV column pruning).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from engage.schemas import BEH_SCHEMA, EMPTY, ESCAPES, NEWS_SCHEMA


def read_tsv(spark: SparkSession, paths, schema: StructType, limit: int | None = None,
             quote: str = '"', escaped: bool = False) -> DataFrame:
    """Tab-separated, no header, fixed schema.  The default quote character
    is kept (a field that begins with ``"`` may then span tabs); pass
    ``quote=""`` to read quotes literally.  ``escaped`` reads what
    ``write_tsv(..., escaped=True)`` wrote."""
    r = (spark.read.schema(schema).option("sep", "\t").option("header", "false")
              .option("quote", quote if quote else "\u0000"))
    df = (r.option("escape", '"') if escaped else r).csv(paths)
    if escaped:
        def plain(part):
            for char, code in ESCAPES[1:]:
                part = F.replace(part, F.lit(code), F.lit(char))
            return part
        def whole(name):
            text = F.array_join(F.transform(F.split(name, r"\\\\"), plain), "\\")
            return F.when(F.col(name) == EMPTY, "").otherwise(text).alias(name)
        # a double backslash is cut out first, so that no code starts inside one
        df = df.select(*[whole(f.name) if isinstance(f.dataType, StringType) else f.name for f in schema.fields])
    return df.limit(limit) if limit is not None else df


def read_news(spark: SparkSession, paths, limit: int | None = None, quote: str = '"',
              escaped: bool = False) -> DataFrame:
    """News catalogue: NewsID, Category, SubCategory, Title, Abstract, URL,
    TitleEnt, AbsEnt (all nullable strings)."""
    return read_tsv(spark, paths, NEWS_SCHEMA, limit, quote, escaped)


def read_behaviors(spark: SparkSession, paths, limit: int | None = None,
                   quote: str = '"') -> DataFrame:
    """Behaviour log: ImpID, UserID, Time, History, Impressions."""
    return read_tsv(spark, paths, BEH_SCHEMA, limit, quote)


def read_table(spark: SparkSession, path: str, limit: int | None = None,
               columns: Iterable[str] | None = None) -> DataFrame:
    """A stored Parquet table (interactions, news, recommendations ...)."""
    df = spark.read.parquet(path)
    if columns is not None:
        df = df.select(*columns)
    return df.limit(limit) if limit is not None else df


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header line and an explicit schema (an empty field is null:
    CSV does not tell an empty text from a missing one)."""
    return spark.read.schema(schema).option("header", "true").option("escape", '"').csv(path)


def read_model_results(spark: SparkSession, path: str) -> DataFrame:
    """Stored model metrics without the write time."""
    return spark.read.parquet(path).drop("timestamp")


def first_available(readers: Iterable[Callable[[], DataFrame]]) -> DataFrame:
    """The first reader whose source exists (sources are alternatives, not a
    union).  Raises when none does; there is no simulated fallback."""
    errors = []
    for r in readers:
        try:
            df = r()
            df.schema  # resolves the source: missing paths fail here
            return df
        except AnalysisException as e:
            errors.append(str(e).splitlines()[0])
    raise FileNotFoundError("no source available: " + "; ".join(errors))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on its file system (local, HDFS, object store)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))
