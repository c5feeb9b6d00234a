"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from engage.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def new_path(spark: SparkSession, what: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir`` (shared on a cluster)."""
    return scratch_path(spark, f"llm/{what}-{uuid.uuid4().hex}")


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Queries made and run inside leave no shuffle files behind (else these
    stay until the driver's garbage collection finds them unused)."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def staged(df: DataFrame, what: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder (below ``folder``, if given) and
    read it back.

    Cuts the lineage at a point that survives a lost executor, and keeps an
    expensive Python pass from running once for each consumer.  Its shuffle
    files go when it is written.
    """
    spark = df.sparkSession
    path = f"{folder}/{what}-{uuid.uuid4().hex}" if folder else new_path(spark, what)
    with shuffles_deleted(spark):
        df.select("*").write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, folder: str) -> None:
    """Delete an operator's own folder of staged tables, all of whose readers
    have been written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def id_and_bytes(docs: DataFrame, *extra: str) -> DataFrame:
    """``doc_id``, the text as UTF-8 bytes (null: empty) and further columns."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                       *[F.col(c) for c in extra])


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table],
                schema: str) -> DataFrame:
    """``mapInArrow`` of a function on one batch (rows stay where they are)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                yield from out.to_batches() if isinstance(out, pa.Table) else [out]
    return df.mapInArrow(run, schema)
