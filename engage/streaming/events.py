"""Click-stream ingestion with Structured Streaming.

The stream is stateless: each message's ``value`` is cast to a string and
parsed with ``from_json`` against the fixed event schema.  ``parse_events``
is the same function for batch and streaming DataFrames, so the batch twin
is the test of the streaming plan.  Malformed JSON is kept as an all-null
row (PERMISSIVE); a wrongly typed field nulls only that field.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from engage.schemas import EVENT_SCHEMA

BATCH = "batch"
VALUE_SCHEMA = StructType([StructField("value", StringType(), True)])


def read_event_stream(spark: SparkSession, fmt: str = "kafka",
                      options: dict | None = None, path: str | None = None,
                      schema: StructType | None = None) -> DataFrame:
    """Streaming source of messages with a ``value`` column.

    ``fmt="kafka"`` needs the Kafka connector on the classpath (a deploy-time
    package) and options such as ``kafka.bootstrap.servers``, ``subscribe``
    and ``startingOffsets`` (default ``latest``).  File formats (``json``,
    ``parquet``, ``text``) read a folder of messages and need ``schema``
    (default: one string ``value``).
    """
    opts = dict(options or {})
    r = spark.readStream.format(fmt)
    if fmt == "kafka":
        opts.setdefault("startingOffsets", "latest")
    else:
        r = r.schema(schema or VALUE_SCHEMA)
    r = r.options(**opts)
    return r.load(path) if path is not None else r.load()


def message_text(df: DataFrame) -> DataFrame:
    """The plain consumer: every message's value as UTF-8 text."""
    return df.select(F.col("value").cast("string").alias("value"))


def parse_events(df: DataFrame, drop_malformed: bool = False) -> DataFrame:
    """``value`` -> (UserID, NewsID, Category, Click)."""
    parsed = (df.select(F.from_json(F.col("value").cast("string"), EVENT_SCHEMA).alias("data"))
                .select("data.*"))
    if drop_malformed:
        any_field = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in parsed.columns])
        parsed = parsed.filter(any_field)
    return parsed


def events_to_json(df: DataFrame, name: str = "value") -> DataFrame:
    """Inverse of ``parse_events``: each row packed into one JSON value."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias(name))


def write_stream(df: DataFrame, fmt: str, checkpoint: str, path: str | None = None,
                 trigger: dict | None = None, output_mode: str = "append",
                 query_name: str | None = None, options: dict | None = None) -> StreamingQuery:
    """Start an append-mode streaming query with a checkpoint (so a restarted
    query resumes where it stopped).  ``trigger`` e.g. ``{"availableNow":
    True}`` or ``{"processingTime": "5 seconds"}``."""
    w = (df.writeStream.format(fmt).outputMode(output_mode)
           .option("checkpointLocation", checkpoint).options(**(options or {})))
    if query_name:
        w = w.queryName(query_name)
    if trigger:
        w = w.trigger(**trigger)
    return w.start(path) if path is not None else w.start()


def _write_batch(batch: DataFrame, batch_id: int, path: str) -> None:
    batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


def append_once(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                query_name: str | None = None) -> StreamingQuery:
    """Append every micro-batch exactly once: a batch is one folder, keyed by
    its id, and a batch that is run again after a crash (its rows are fixed by
    the checkpoint's offset log) overwrites its own folder.  Read it with
    ``read_batches``.  For output formats without a transactional file sink
    the same key makes any keyed write idempotent."""
    base = path.rstrip("/")
    w = (df.writeStream.foreachBatch(lambda batch, batch_id: _write_batch(batch, batch_id, base))
           .option("checkpointLocation", checkpoint))
    if query_name:
        w = w.queryName(query_name)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def read_batches(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The rows of all whole batches (those with Spark's success mark) that
    ``append_once`` has written; ``schema`` is that of the rows (default:
    parsed events)."""
    base = path.rstrip("/")
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{BATCH}=*/_SUCCESS")
    marks = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p) or []
    schema = schema or EVENT_SCHEMA
    folders = sorted(str(m.getPath().getParent()) for m in marks)
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def stream_table_events(spark: SparkSession, sf_dir: str, out_dir: str) -> DataFrame:
    """End-to-end stream over the ``events`` table: a file-source stream of
    event rows is turned into JSON messages (stream-static join with the
    part table for the category), parsed back, and appended once to ``out_dir``
    with ``availableNow`` (every file present is processed, then the query
    stops).  Returns the batch read of the sink."""
    from engage.sources import fixtures as FX

    base = sf_dir.rstrip("/")
    schema = spark.read.parquet(f"{base}/events.parquet").schema
    src = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
                .parquet(base))
    msgs = FX.event_values_from_tables(src, FX.table(spark, base, "part"))
    run = f"{out_dir.rstrip('/')}/{uuid.uuid4().hex}"
    q = append_once(parse_events(msgs), f"{run}/data", f"{run}/_checkpoint", trigger={"availableNow": True})
    q.awaitTermination()
    return read_batches(spark, f"{run}/data")
