"""SparkSession construction and shared-storage helpers.

ANSI mode stays on (the Spark 4 default); every operator that relied on
null-on-error semantics uses ``try_cast`` / ``get`` explicitly.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that hold on a cluster as well as in local mode.  Shuffle
# parallelism is left to the cluster; AQE sizes and coalesces partitions and
# splits skewed join partitions at run time.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "engage", extra: dict | None = None) -> SparkSession:
    """Session for tests and the local bench (``local[cores]``)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "16g")
         .config("spark.ui.showConsoleProgress", "false"))
    for k, v in {**CLUSTER_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is used as is; a
    cluster without it is an error, as a machine-local folder would be lost
    with its machine.  A scratch folder is made for a local master only.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        path = tempfile.mkdtemp(prefix="engage-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-path of the shared checkpoint folder for staged tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name) if "://" not in base else f"{base.rstrip('/')}/{name}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared checkpoint folder and read back:
    a short lineage that survives a lost executor, and a size Spark knows."""
    path = scratch_path(df.sparkSession, f"staged/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
