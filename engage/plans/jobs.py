"""End-to-end jobs: what a user launches instead of the original scripts.

    python -m engage.plans.jobs features  --news N.tsv --behaviors B.tsv --out OUT
    python -m engage.plans.jobs train     --data OUT --models MODELS
    python -m engage.plans.jobs recommend --data OUT --models MODELS --recs RECS [--top-n 10]
    python -m engage.plans.jobs cluster   --data OUT --out CLUSTERS [--level row|article]
    python -m engage.plans.jobs stream    --source kafka --option kafka.bootstrap.servers=H:P \\
                                          --option subscribe=news-topic --sink console \\
                                          --checkpoint CKPT

Each job is one Spark application: scan -> transform -> write, one action
per output.  Row counts are observed during the writes.  ``--news`` and
``--behaviors`` take several candidate paths; the first that exists is read.
"""

from __future__ import annotations

import argparse
import json

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from engage.operators import cluster as CL
from engage.operators import features as FE
from engage.operators import ml as ML
from engage.operators import recommend as RC
from engage.operators.interactions import parse_impressions
from engage.schemas import STORED_COLS, STORED_SCHEMA
from engage.sinks import writers as WR
from engage.sources import readers as RD
from engage.streaming import events as ST


def _alternatives(paths) -> list:
    """Candidate sources in order: each element of ``paths`` is one source (a
    path or a list of paths read together); the first that exists is used."""
    return [paths] if isinstance(paths, str) else list(paths)


def stored_dataset(spark: SparkSession, data: str) -> DataFrame:
    """The rows to train and cluster on: the featured dataset, else the stored
    interactions, else their CSV export."""
    base = data.rstrip("/")
    return RD.first_available([
        lambda: RD.read_table(spark, f"{base}/featured_dataset"),
        lambda: RD.read_table(spark, f"{base}/serving/interactions"),
        lambda: RD.read_csv(spark, f"{base}/interactions_csv", STORED_SCHEMA)])


def split_keys(ds: DataFrame) -> list[str] | None:
    """The columns that identify a row of a stored dataset: the usual ones, or
    all 14 of the stored layout, which has neither impression nor time."""
    return None if all(c in ds.columns for c in ML.KEY_COLS) else STORED_COLS


def feature_job(spark: SparkSession, news_paths, behavior_paths, out: str,
                ties: str = "all", limit: int | None = None) -> dict:
    """TSV logs -> interactions -> featured rows + catalogue (Parquet), and
    the serving tables (projection clustered by user, catalogue by id)."""
    news = RD.first_available([lambda p=p: RD.read_news(spark, p, limit) for p in _alternatives(news_paths)])
    beh = RD.first_available([lambda p=p: RD.read_behaviors(spark, p, limit) for p in _alternatives(behavior_paths)])
    # both counts are observed while the rows pass, without jobs of their own
    parsed, featured = Observation(), Observation()
    n = F.count(F.lit(1)).alias("n")
    inter = parse_impressions(beh, with_position=True).observe(parsed, n).persist(StorageLevel.MEMORY_AND_DISK)
    ds = FE.featured_dataset(inter, news, ties=ties).persist(StorageLevel.MEMORY_AND_DISK)
    nc = FE.news_clean(news)
    base = out.rstrip("/")
    WR.save_featured(ds.observe(featured, n), nc, base)
    WR.save_interactions(ds.select(*STORED_COLS), nc, f"{base}/serving")
    rows = featured.get["n"]
    stats = {"featured_rows": rows, "stored_rows": rows, "interactions": parsed.get["n"]}
    ds.unpersist()
    inter.unpersist()
    return stats


def train_job(spark: SparkSession, data: str, models: str, profile: str = "batch",
              balance: str | None = "smote") -> DataFrame:
    """Train the three models, save the best one, store and return metrics."""
    ds = stored_dataset(spark, data)
    train, test, stats = ML.prepare(ds, balance, key_cols=split_keys(ds))
    fitted = ML.train_models(train, stats, profile)
    metrics = ML.evaluate(fitted, test)
    name = ML.best_model(metrics).first()["model"]
    ML.save_model(fitted[name], ML.model_path(models))
    WR.write_model_results(metrics, f"{models.rstrip('/')}/model_results")
    return metrics


def recommend_job(spark: SparkSession, data: str, models: str, recs: str, n: int = 10,
                  users: DataFrame | None = None) -> None:
    """Top-N for every user (or the given users), stored by keyed replace."""
    base = data.rstrip("/")
    ds = RD.read_table(spark, f"{base}/featured_dataset")
    nc = RD.read_table(spark, f"{base}/news_clean")
    model, _ = ML.load_or_train(ML.model_path(models), ds)
    out = RC.recommend_top_n(ds, nc, model, n, users=users)
    WR.replace_keyed(out, recs)


def cluster_job(spark: SparkSession, data: str, out: str, level: str = "row") -> None:
    ds = stored_dataset(spark, data)
    clustered, _ = CL.cluster(ds, level=level)
    WR.write_csv(clustered, out)


def stream_job(spark: SparkSession, source: str, options: dict, sink: str,
               checkpoint: str, path: str | None = None, source_path: str | None = None,
               trigger: dict | None = None, parse: bool = True):
    """Message stream -> parsed click events (or, ``parse=False``, the plain
    message text) -> sink.  ``sink="once"`` appends Parquet batches exactly
    once, also over restarts; other sinks are Spark's own in append mode."""
    df = ST.read_event_stream(spark, source, options, path=source_path)
    rows = ST.parse_events(df) if parse else ST.message_text(df)
    if sink == "once":
        return ST.append_once(rows, path, checkpoint, trigger)
    return ST.write_stream(rows, sink, checkpoint, path=path, trigger=trigger)


def main(argv=None) -> None:
    from engage.session import CLUSTER_CONF

    ap = argparse.ArgumentParser(prog="engage")
    sub = ap.add_subparsers(dest="job", required=True)
    f = sub.add_parser("features")
    f.add_argument("--news", required=True, nargs="+")
    f.add_argument("--behaviors", required=True, nargs="+")
    f.add_argument("--out", required=True)
    f.add_argument("--ties", default="all", choices=["all", "first"])
    t = sub.add_parser("train")
    t.add_argument("--data", required=True)
    t.add_argument("--models", required=True)
    t.add_argument("--profile", default="batch", choices=["batch", "dashboard"])
    t.add_argument("--balance", default="smote", choices=["weight", "smote", "none"])
    r = sub.add_parser("recommend")
    r.add_argument("--data", required=True)
    r.add_argument("--models", required=True)
    r.add_argument("--recs", required=True)
    r.add_argument("--top-n", type=int, default=10)
    r.add_argument("--users", help="text file with one requested user id a line")
    c = sub.add_parser("cluster")
    c.add_argument("--data", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--level", default="row", choices=["row", "article"])
    s = sub.add_parser("stream")
    s.add_argument("--source", default="kafka")
    s.add_argument("--source-path")
    s.add_argument("--option", action="append", default=[])
    s.add_argument("--sink", default="console")
    s.add_argument("--path")
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--raw", action="store_true", help="keep the message text as it is")
    for job in (f, t, r, c, s):
        job.add_argument("--checkpoint-dir", help="folder that all executors share (spark.checkpoint.dir)")
    a = ap.parse_args(argv)

    b = SparkSession.builder.appName(f"engage-{a.job}")
    for k, v in CLUSTER_CONF.items():
        b = b.config(k, v)
    if a.checkpoint_dir:
        b = b.config("spark.checkpoint.dir", a.checkpoint_dir)
    spark = b.getOrCreate()
    if a.job == "features":
        print(json.dumps(feature_job(spark, a.news, a.behaviors, a.out, a.ties)))
    elif a.job == "train":
        train_job(spark, a.data, a.models, a.profile,
                  None if a.balance == "none" else a.balance).show(truncate=False)
    elif a.job == "recommend":
        users = spark.read.text(a.users).select(F.col("value").alias("UserID")) if a.users else None
        recommend_job(spark, a.data, a.models, a.recs, a.top_n, users)
    elif a.job == "cluster":
        cluster_job(spark, a.data, a.out, a.level)
    elif a.job == "stream":
        opts = dict(o.split("=", 1) for o in a.option)
        stream_job(spark, a.source, opts, a.sink, a.checkpoint, a.path,
                   a.source_path, parse=not a.raw).awaitTermination()


if __name__ == "__main__":
    main()
