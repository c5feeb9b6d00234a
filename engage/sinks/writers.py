"""Batch sinks: Parquet tables laid out for lookups, keyed replace of
per-user rows, model results, CSV, JSON records.

Every write is a distributed Spark write; only manifests, bucket numbers and
the bounded key sample of a z-order come to the driver.  Replaces write new
version folders and switch by a manifest, so a plan never reads and overwrites
the same files and a crash leaves the old rows in place.
"""

from __future__ import annotations

import json
import uuid

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructType

from engage.schemas import EMPTY, ESCAPES
from engage.session import scratch_path, staged

BUCKET, VERSION = "bucket", "version"
MANIFESTS = "_manifests"
SAMPLE = 100_000                # rows sampled for the bounds of a z-order
ROW_GROUP_BYTES = 8 << 20       # small row groups: what a lookup reads at least
FILE_ROWS = 500_000             # rows that one task of a z-order sorts


def bucket_of(key, buckets: int):
    """Stable bucket of a key column (or literal): pmod(xxhash64(key), n)."""
    k = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.xxhash64(k), F.lit(buckets)).cast("int")


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                sort_by: list[str] | None = None, buckets: int | None = None) -> None:
    """Write Parquet.  With ``sort_by`` the rows are clustered on those
    columns (hash-partitioned into ``buckets`` files, sorted inside), so the
    Parquet min/max statistics let a lookup by the first column skip row
    groups: the columnar stand-in for a secondary index."""
    out = df
    if sort_by:
        n = buckets or max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
        out = df.repartition(n, sort_by[0]).sortWithinPartitions(*sort_by)
    out.write.mode(mode).parquet(path)


def _bounds(df: DataFrame, key: str, cuts: int, n: int) -> list:
    """At most ``cuts`` keys that cut the ``n`` rows into about equal parts, from
    a sample of about ``SAMPLE`` rows (they shape the files, not the results)."""
    drawn = df.select(key).filter(F.col(key).isNotNull())
    if n > SAMPLE:
        drawn = drawn.sample(SAMPLE / n, 7)
    keys = sorted(r[0] for r in drawn.limit(2 * SAMPLE).collect())
    return sorted({keys[len(keys) * (i + 1) // (cuts + 1)] for i in range(cuts)}) if keys else []


def _part(key: str, bounds: list):
    """Number of bounds at or below the key."""
    return sum(((F.col(key) >= b).cast("int") for b in bounds), F.lit(0))


def write_zordered(df: DataFrame, path: str, keys: list[str], bits: int = 4, files: int | None = None,
                   mode: str = "overwrite") -> None:
    """Write Parquet so that a lookup by *any* of ``keys`` can skip files and
    row groups: each key's range is cut into ``2 ** bits`` parts, the parts'
    bits are interleaved, and rows are ranged and sorted by that number.  A row
    group then spans few parts of every key, and its min/max statistics tell a
    reader so.  Inside a part rows are sorted by the last key first, so that what
    belongs to it (titles) stands together and takes its place once.  No task
    sorts more than about ``FILE_ROWS`` rows, unless ``files`` is given."""
    spark = df.sparkSession
    src = staged(df, "zorder")                          # read by the samples and the write
    rows = src.count()
    places = {k: F.coalesce(_part(k, _bounds(src, k, (1 << bits) - 1, rows)), F.lit(0)) for k in keys}
    z = F.lit(0).cast("long")
    for bit in reversed(range(bits)):
        for place in places.values():
            z = F.shiftleft(z, 1).bitwiseOR(F.shiftright(place, bit).bitwiseAND(F.lit(1)))
    n = files or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // FILE_ROWS), 1)
    order = ["_z", *reversed(keys)]
    (src.withColumn("_z", z).repartitionByRange(n, *order).sortWithinPartitions(*order).drop("_z")
     .write.mode(mode).option("parquet.block.size", ROW_GROUP_BYTES).parquet(path))


def save_featured(dataset: DataFrame, news_clean: DataFrame, out_path: str) -> None:
    """Featured rows and cleaned catalogue, overwritten (local or HDFS path)."""
    base = out_path.rstrip("/")
    dataset.write.mode("overwrite").parquet(f"{base}/featured_dataset")
    news_clean.write.mode("overwrite").parquet(f"{base}/news_clean")


def save_interactions(projection: DataFrame, news_clean: DataFrame, base: str,
                      buckets: int | None = None) -> None:
    """The serving tables: interactions laid out for lookups by UserID and by
    NewsID (z-order), and the catalogue by NewsID."""
    write_zordered(projection, f"{base.rstrip('/')}/interactions", ["UserID", "NewsID"], files=buckets)
    write_table(news_clean, f"{base.rstrip('/')}/news", sort_by=["NewsID"], buckets=buckets)


def _manifests(spark: SparkSession, path: str) -> list[str]:
    """Manifest files of a keyed table, oldest first (empty: no table)."""
    fs, p = _fs(spark, f"{path.rstrip('/')}/{MANIFESTS}")
    if not fs.exists(p):
        return []
    return sorted(str(f.getPath()) for f in fs.listStatus(p) if f.getPath().getName().endswith(".json"))


def read_manifest(spark: SparkSession, path: str) -> dict | None:
    """State of a keyed table: ``number``, ``buckets`` (their count), ``live``
    (bucket -> version of its rows) and ``schema``; None where there is none."""
    files = _manifests(spark, path)
    if not files:
        return None
    state = json.loads(spark.read.text(files[-1], wholetext=True).first()[0])
    return {**state, "live": {int(b): v for b, v in state["live"].items()}}


def commit_manifest(spark: SparkSession, path: str, state: dict) -> None:
    """Make ``state`` the table: one rename, which fails if another writer has
    taken the number."""
    name = f"{path.rstrip('/')}/{MANIFESTS}/{state['number']:012d}"
    fs, tmp = _fs(spark, f"{name}.{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp)
    out.write(bytearray(json.dumps(state).encode()))
    out.close()
    if not fs.rename(tmp, _fs(spark, f"{name}.json")[1]):
        fs.delete(tmp, False)
        raise RuntimeError(f"{path}: another writer has replaced the table")


def read_keyed(spark: SparkSession, path: str, buckets: list[int] | None = None) -> DataFrame:
    """The rows of a keyed table (or of some buckets), as its newest manifest
    names them."""
    state = read_manifest(spark, path)
    if state is None:
        raise FileNotFoundError(f"no keyed table at {path}")
    base = path.rstrip("/")
    live = {b: v for b, v in state["live"].items() if buckets is None or b in buckets}
    folders = [f"{base}/{BUCKET}={b}/{VERSION}={v}" for b, v in sorted(live.items())]
    schema = StructType.fromJson(state["schema"])
    if not folders:
        return spark.createDataFrame([], schema)
    return (spark.read.schema(schema).option("basePath", base).parquet(*folders)
            .select(*[f.name for f in schema.fields]))


def replace_keyed(new: DataFrame, path: str, key: str = "UserID", buckets: int = 64,
                  stamp: bool = True, keys: DataFrame | None = None) -> None:
    """Replace all rows of the keys in ``keys`` (those of ``new`` by default)
    by the rows of ``new``; a key in ``keys`` without new rows is emptied.

    A key's rows stand in bucket ``pmod(xxhash64(key), buckets)``.  A replace
    writes the touched buckets anew, as folders of a new version, and then
    switches to them by one manifest file; until that file is in place readers
    (and a later run, should this one die) see the old rows whole.  Folders
    that neither the present nor the last manifest names are removed by the
    next replace, so a reader of the last state is not disturbed.  Nothing to
    replace is not an error.
    """
    spark = new.sparkSession
    base = path.rstrip("/")
    state = read_manifest(spark, path)
    if state is not None and state["buckets"] != buckets:
        raise ValueError(f"{path} has {state['buckets']} buckets, not {buckets}")
    rows = new.withColumn("timestamp", F.current_timestamp()) if stamp else new
    stages = [scratch_path(spark, f"stage-{uuid.uuid4().hex}") for _ in range(2)]
    try:
        rows.write.parquet(stages[0])
        rows = spark.read.schema(rows.schema).parquet(stages[0])
        names = (keys.select(key) if keys is not None else rows.select(key)).distinct()
        # one row per bucket at most
        touched = {r[0] for r in names.select(bucket_of(key, buckets)).distinct().collect()}
        merged = rows
        if state is not None:
            old = read_keyed(spark, path, sorted(touched))
            merged = old.join(names, key, "left_anti").unionByName(rows, allowMissingColumns=True)
        version = uuid.uuid4().hex
        merged = merged.withColumns({BUCKET: bucket_of(key, buckets), VERSION: F.lit(version)})
        merged.write.parquet(stages[1])
        merged = spark.read.schema(merged.schema).parquet(stages[1])
        filled = {r[0] for r in merged.select(BUCKET).distinct().collect()}
        merged.repartition(buckets, BUCKET).write.mode("append").partitionBy(BUCKET, VERSION).parquet(base)
        live = {b: v for b, v in (state["live"] if state else {}).items() if b not in touched}
        schema = merged.drop(BUCKET, VERSION).schema
        commit_manifest(spark, path, {
            "number": state["number"] + 1 if state else 0, "buckets": buckets,
            "live": {**live, **{b: version for b in sorted(filled)}}, "schema": schema.jsonValue()})
        vacuum_keyed(spark, path, state)
    finally:
        for s in stages:
            remove(spark, s)


def vacuum_keyed(spark: SparkSession, path: str, last: dict | None = None) -> None:
    """Remove version folders that neither the present manifest nor ``last``
    names, and older manifests."""
    state = read_manifest(spark, path)
    if state is None:
        return
    base = path.rstrip("/")
    kept = {(b, v) for s in (state, last) if s for b, v in s["live"].items()}
    fs, p = _fs(spark, base)
    for folder in fs.listStatus(p):
        name = folder.getPath().getName()
        if name.startswith(f"{BUCKET}="):
            for version in fs.listStatus(folder.getPath()):
                of = version.getPath().getName().removeprefix(f"{VERSION}=")
                if (int(name.removeprefix(f"{BUCKET}=")), of) not in kept:
                    fs.delete(version.getPath(), True)
    for old in _manifests(spark, path)[:-2]:
        remove(spark, old)


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this module wrote."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def cached_recommendations(spark: SparkSession, path: str, user: str) -> DataFrame:
    """A user's stored recommendations, most probable first; reads the folder
    of the user's bucket only."""
    state = read_manifest(spark, path)
    if state is None:
        raise FileNotFoundError(f"no keyed table at {path}")
    at = spark.range(1).select(bucket_of(F.lit(user), state["buckets"])).first()[0]
    return (read_keyed(spark, path, [at]).filter(F.col("UserID") == user)
              .orderBy(F.col("click_probability").desc(), F.col("NewsID")))


def write_model_results(metrics: DataFrame, path: str) -> None:
    """Replace the stored model results, stamping the write time."""
    metrics.withColumn("timestamp", F.current_timestamp()).write.mode("overwrite").parquet(path)


def flat_columns(df: DataFrame) -> DataFrame:
    """Drop columns a CSV file cannot hold (vectors, arrays, maps, structs)."""
    bad = (VectorUDT, ArrayType, MapType, StructType)
    return df.select(*[f.name for f in df.schema.fields if not isinstance(f.dataType, bad)])


def write_csv(df: DataFrame, path: str, compression: str | None = None) -> None:
    """CSV with a header, after dropping non-flat columns; quotes are doubled
    and outer blanks kept, so that texts come back as they are.  With
    ``compression`` (such as ``"gzip"``) each part file is packed, as ``read_csv``
    takes it."""
    w = flat_columns(df).write.option("compression", compression) if compression else flat_columns(df).write
    (w.mode("overwrite").option("header", "true").option("escape", '"')
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path))


def write_tsv(df: DataFrame, path: str, escaped: bool = False) -> None:
    """Tab-separated, no header (the log layout read by ``read_tsv``).  With
    ``escaped`` line feeds, carriage returns, tabs and backslashes in texts are
    written as ``\\n``, ``\\r``, ``\\t`` and ``\\\\`` and an empty text as ``\\e``, so that each row stays one
    line and whole texts come back (``read_tsv(..., escaped=True)``)."""
    if escaped:
        for f in df.schema.fields:
            if isinstance(f.dataType, StringType):
                c = F.col(f.name)
                for plain, code in ESCAPES:
                    c = F.replace(c, F.lit(plain), F.lit(code))
                c = F.when(F.col(f.name) == "", EMPTY).otherwise(c)
                df = df.withColumn(f.name, c)
    w = df.write.option("escape", '"') if escaped else df.write
    (w.mode("overwrite").option("sep", "\t").option("header", "false")
       .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
       .csv(path))


def to_json_rows(df: DataFrame, name: str = "value") -> DataFrame:
    """Each row as one JSON record string."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias(name))


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)

