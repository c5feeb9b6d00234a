"""Click-prediction models with Spark MLlib.

* split: stratified 80/20, each class at the quantile of its own row hashes,
  so the shares are exact and a row never changes side when the partitioning
  changes;
* scaler: centre and divide by the *population* standard deviation (std 0
  divides by 1), fitted on the training side only, expressed as a
  ``SQLTransformer`` so it is saved with the model;
* models: logistic regression (L2, ``regParam = 1/(C n)``), random forest
  and gradient-boosted trees (grown on binned rows, ``engage.operators.trees``)
  with the batch or dashboard settings;
* metrics of class 1 at the 0.5 cut and an exact AUC (ties count 1/2),
  computed from grouped scores with a distributed prefix sum.

Class balance: ``balance="smote"`` (the default) adds synthetic minority rows
(``engage.operators.oversample``); ``balance="weight"`` gives each class half
of the total weight (``weightCol``); ``None`` trains on the raw rows.
"""

from __future__ import annotations

import functools
import operator
import os

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from engage.operators.ordering import with_prefix_sums
from engage.operators.retrieval import ARTICLE_FEATURES, LinearOrder, TreeOrder
from engage.schemas import FEATURE_COLS, ROW_KEY, TARGET
from engage.sources.readers import exists

# Model settings of the batch trainer and of the dashboard
# trainer, the split and the seeds.
SPLIT_SEED = 42
PROFILES = {
    "batch": {
        "Logistic Regression": {"maxIter": 500, "C": 1.0},
        "Random Forest": {"numTrees": 150, "maxDepth": 10},
        "Gradient Boosting": {"maxIter": 150, "maxDepth": 4, "stepSize": 0.1},
    },
    "dashboard": {
        "Logistic Regression": {"maxIter": 500, "C": 1.0},
        "Random Forest": {"numTrees": 100, "maxDepth": 30},
        "Gradient Boosting": {"maxIter": 100, "maxDepth": 3, "stepSize": 0.1},
    },
}
# MLlib's own tree learners, where ``build_pipeline`` fits them: keep each row's
# node id cached between levels instead of re-walking the trees, and give the
# per-level split statistics 1 GB.  ``train_models`` grows trees by
# ``engage.operators.trees`` with the same parameters.
TREE_TUNING = {"cacheNodeIds": True, "maxMemoryInMB": 1024, "checkpointInterval": 10}
# Training partitions hold so many rows on average.  Never fewer than MIN_PARTS nor more than the shuffles'.
PART_ROWS = 250_000
MIN_PARTS = 8
MODEL_ORDER = ["Logistic Regression", "Random Forest", "Gradient Boosting"]


def assemble_rows(ds: DataFrame, keep: list[str] = ()) -> DataFrame:
    """The 8 feature columns as double (null -> 0), the int label and
    the ``keep`` columns."""
    return ds.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
                       for c in FEATURE_COLS],
                     F.col(TARGET).cast("int").alias(TARGET), *keep)


# Columns that identify a row of the featured dataset.
KEY_COLS = ["UserID", "NewsID", "Click", "Time", "ImpID", "ImpPos", "preferred_category"]
DIGITS = 4                      # hex digits of the key settled in a pass: 65,536 buckets a class
FEW = 10_000                    # keys of the buckets in question that come to the driver at most


def row_key(key_cols: list[str] = KEY_COLS, seed: int = SPLIT_SEED):
    """md5 of the row's identifying columns (and the seed), hex string: spread
    evenly, the same in every SQL engine and however the rows are cut."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key_cols]))


def split_cuts(keyed: DataFrame, tenths: int = 2) -> dict:
    """Per class the key of its last test row: the key at place ``round(n *
    tenths / 10)`` in key order (None for a class without a test row).

    The place is found digit group by digit group: each pass counts the keys
    of the one bucket per class that holds the place by their next ``DIGITS``
    digits, so no pass sorts rows; two rows come to the driver, and when the
    buckets that hold the places have ``FEW`` keys at most, these keys.
    """
    wanted = {r[TARGET]: (r["n"] * tenths + 5) // 10
              for r in keyed.groupBy(TARGET).agg(F.count(F.lit(1)).alias("n")).collect()}
    found = {c: ("", q) for c, q in wanted.items() if q}            # key prefix, place among its keys
    for upto in range(DIGITS, 32 + 1, DIGITS):
        inside = [F.col(TARGET).eqNullSafe(F.lit(c)) & F.col(ROW_KEY).startswith(p) for c, (p, _) in found.items()]
        if not inside:
            break
        counts = (keyed.filter(functools.reduce(operator.or_, inside))
                  .groupBy(TARGET, F.substring(ROW_KEY, 1, upto).alias("prefix")).agg(F.count(F.lit(1)).alias("n")))
        # at most 65,536 buckets a class
        to = F.sum("n").over(Window.partitionBy(TARGET).orderBy("prefix"))
        place = functools.reduce(lambda e, c: F.when(F.col(TARGET).eqNullSafe(F.lit(c)), found[c][1]).otherwise(e),
                                 found, F.lit(0))
        at = counts.withColumn("to", to).filter((F.col("to") >= place) & (F.col("to") - F.col("n") < place)).collect()
        found = {r[TARGET]: (r["prefix"], found[r[TARGET]][1] - (r["to"] - r["n"])) for r in at}
        if sum(r["n"] for r in at) <= FEW:
            last = functools.reduce(operator.or_, [F.col(TARGET).eqNullSafe(F.lit(c)) & F.col(ROW_KEY).startswith(p)
                                                   for c, (p, _) in found.items()])
            keys = {c: [] for c in found}
            for r in keyed.filter(last).select(TARGET, ROW_KEY).collect():
                keys[r[TARGET]].append(r[ROW_KEY])
            found = {c: (sorted(keys[c])[place - 1], 0) for c, (_, place) in found.items()}
            break
    return {c: found[c][0] if c in found else None for c in wanted}


def _keyed(ds: DataFrame, seed: int, key_cols: list[str] | None) -> DataFrame:
    cols = KEY_COLS if key_cols is None else key_cols
    missing = [c for c in cols if c not in ds.columns]
    if missing:
        raise ValueError(f"no columns {missing}: name the columns that identify a row in key_cols")
    return ds.withColumn(ROW_KEY, row_key(cols, seed))


def _is_test(cuts: dict):
    sides = [F.col(TARGET).eqNullSafe(F.lit(c)) & (F.col(ROW_KEY) <= cut) for c, cut in cuts.items() if cut]
    return functools.reduce(operator.or_, sides, F.lit(False))


def stratified_split(ds: DataFrame, seed: int = SPLIT_SEED,
                     key_cols: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(train, test) rows of ``ds`` plus the row key ``_k``: of every class the
    fifth of its rows with the smallest keys is the test side (to the row, as
    long as keys differ).  ``key_cols`` identify a row (default ``KEY_COLS``,
    which must all be there)."""
    t = _keyed(ds, seed, key_cols)
    test = _is_test(split_cuts(t))
    return t.filter(~test), t.filter(test)


def fit_scaler(train: DataFrame, cols: list[str] = FEATURE_COLS) -> dict[str, tuple[float, float]]:
    """Mean and population std per column (one aggregate; 2 x 8 numbers)."""
    row = train.agg(*[F.avg(c).alias(f"m_{c}") for c in cols],
                    *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
    out = {}
    for c in cols:
        m, s = row[f"m_{c}"] or 0.0, row[f"s_{c}"] or 0.0
        out[c] = (float(m), float(s) if s else 1.0)
    return out


def scaler_stage(stats: dict[str, tuple[float, float]]) -> SQLTransformer:
    exprs = ", ".join(f"(`{c}` - ({m!r})) / ({s!r}) AS `{c}__s`" for c, (m, s) in stats.items())
    return SQLTransformer(statement=f"SELECT *, {exprs} FROM __THIS__")


def scale(df: DataFrame, stats: dict[str, tuple[float, float]]) -> DataFrame:
    """The scaled feature columns (same names) for inspection and tests."""
    return df.select(*[((F.col(c) - m) / s).alias(c) for c, (m, s) in stats.items()],
                     *[c for c in df.columns if c not in stats])


def class_weights(train: DataFrame) -> DataFrame:
    """``weight`` column: each class carries half of the total weight (the
    class counts are two numbers, so the weights are literals)."""
    n = {r[TARGET]: r["n"] for r in train.groupBy(TARGET).agg(F.count("*").alias("n")).collect()}
    weight = functools.reduce(lambda e, c: F.when(F.col(TARGET).eqNullSafe(F.lit(c)), sum(n.values()) / (2.0 * n[c]))
                              .otherwise(e), n, F.lit(0.0))
    return train.withColumn("weight", weight)


def _estimator(name: str, params: dict, n_train: int, weighted: bool):
    kw = {"featuresCol": "features", "labelCol": TARGET}
    if weighted:
        kw["weightCol"] = "weight"
    if name == "Logistic Regression":
        return LogisticRegression(maxIter=params["maxIter"],
                                  regParam=1.0 / (params["C"] * max(n_train, 1)),
                                  elasticNetParam=0.0, standardization=False, **kw)
    if name == "Random Forest":
        return RandomForestClassifier(numTrees=params["numTrees"], maxDepth=params["maxDepth"],
                                      seed=SPLIT_SEED, **TREE_TUNING, **kw)
    if name == "Gradient Boosting":
        return GBTClassifier(maxIter=params["maxIter"], maxDepth=params["maxDepth"],
                             stepSize=params["stepSize"], seed=SPLIT_SEED, **TREE_TUNING, **kw)
    raise ValueError(name)


def build_pipeline(stats, estimator) -> Pipeline:
    assembler = VectorAssembler(inputCols=[f"{c}__s" for c in FEATURE_COLS],
                                outputCol="features", handleInvalid="error")
    return Pipeline(stages=[scaler_stage(stats), assembler, estimator])


def prepare(ds: DataFrame, balance: str | None = "smote", seed: int = SPLIT_SEED,
            key_cols: list[str] | None = None):
    """Split, fit the scaler on train and balance the training side.

    Returns (train, test, stats); ``train`` may carry ``weight``."""
    train, test = stratified_split(ds, seed, key_cols)
    train, test = assemble_rows(train, [ROW_KEY]), assemble_rows(test, [ROW_KEY])
    stats = fit_scaler(train)
    if balance == "weight":
        train = class_weights(train)
    elif balance == "smote":
        from engage.operators.oversample import smote
        train = smote(train, stats, seed=seed)
    elif balance is not None:
        raise ValueError("balance must be 'weight', 'smote' or None")
    return train, test, stats


def stable_layout(df: DataFrame, n: int | None = None) -> DataFrame:
    """Same rows in the same partitions and order on every run.

    Shuffle reads arrive in no fixed order, and the tree learners draw their
    bootstrap samples per partition, so training input is hash-partitioned
    and sorted inside each partition: a fixed seed then gives a fixed model,
    also after a task is recomputed.  The hash is on the row key ``_k`` when
    present (unique per row, so many identical feature rows still spread
    over all partitions), else on all columns."""
    n = n or max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    cols = [F.col(ROW_KEY)] if ROW_KEY in df.columns else [F.col(c) for c in df.columns]
    spread = F.xxhash64(*cols)
    return df.repartition(n, spread).sortWithinPartitions(spread, *cols)


def without_summary(model: PipelineModel, spark: SparkSession) -> PipelineModel:
    """The model without its training summary.  A fresh logistic regression or
    MLlib forest keeps a summary that holds the session, and a session that has
    ever observed a DataFrame cannot be serialised into a scoring task."""
    for stage in model.stages:
        if getattr(stage, "hasSummary", False):
            stage._java_obj.setSummary(spark._jvm.scala.Option.apply(None))
    return model


def train_models(train: DataFrame, stats, profile: str = "batch",
                 names: list[str] | None = None, parallelism: int = 1) -> dict[str, PipelineModel]:
    """Fit the selected models (default: all three) on ``train``.

    The fits are independent; with ``parallelism > 1`` they are submitted
    from separate threads (as MLlib's tuning utilities do) so a cluster can
    interleave their jobs; the default is sequential.  Each fit's result does
    not depend on the others (fixed seeds, fixed input layout)."""
    from concurrent.futures import ThreadPoolExecutor

    from engage.operators.trees import Binned

    weighted = "weight" in train.columns
    todo = list(names or MODEL_ORDER)
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    laid, rows = None, None
    try:
        n = train.count()
        shuffled = max(int(train.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
        laid = stable_layout(train, min(shuffled, max(MIN_PARTS, -(-n // PART_ROWS)))).persist(StorageLevel.MEMORY_AND_DISK)
        laid.count()
        train.unpersist()
        if set(todo) - {"Logistic Regression"}:
            rows = Binned(scaler_stage(stats).transform(laid), [f"{c}__s" for c in FEATURE_COLS], TARGET,
                          "weight" if weighted else None, SPLIT_SEED)

        def fit(name):
            est = _estimator(name, PROFILES[profile][name], n, weighted)
            if name == "Logistic Regression":
                return name, without_summary(build_pipeline(stats, est).fit(laid), train.sparkSession)
            return name, PipelineModel([*build_pipeline(stats, est).getStages()[:-1], rows.fit(est)])

        with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(todo)))) as pool:
            out = dict(pool.map(fit, todo))
    finally:
        for held in (train, laid):
            if held is not None:
                held.unpersist()
        if rows is not None:
            rows.release()
    return {name: out[name] for name in todo}


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Rows with ``p`` = P(click) and ``pred`` = 1 if ``p`` > 0.5."""
    model = without_summary(model, df.sparkSession)
    s = model.transform(df).withColumn("p", vector_to_array("probability").getItem(1))
    return s.withColumn("pred", (F.col("p") > 0.5).cast("int"))


def linear_order(model: PipelineModel) -> LinearOrder | None:
    """A fitted binary logistic regression as column expressions, or None for
    any other model.

    For a pipeline ending in ``[VectorAssembler, LogisticRegressionModel]``
    the earlier stages (the scaler projection) are applied as they are and
    ``p = 1 / (1 + exp(-(w . x + b)))`` is written over the assembler's input
    columns: the model's own formula with its 8 coefficients, evaluated inside
    whole-stage codegen instead of building a vector and a probability vector
    per row.  The article features are summed first, so the probability never
    falls as their part of the sum grows."""
    from pyspark.ml.classification import LogisticRegressionModel

    stages = list(getattr(model, "stages", []) or [])
    if len(stages) < 2:
        return None
    lr, asm = stages[-1], stages[-2]
    if not (isinstance(lr, LogisticRegressionModel) and isinstance(asm, VectorAssembler)
            and lr.numClasses == 2):
        return None
    weights = dict(zip(asm.getInputCols(), map(float, lr.coefficients.toArray().tolist()), strict=True))
    of_article = [f"{c}__s" for c in ARTICLE_FEATURES]
    part = sum((F.col(c) * F.lit(weights[c]) for c in of_article), F.lit(0.0))
    margin = sum((F.col(c) * F.lit(w) for c, w in weights.items() if c not in of_article), part)
    margin = margin + F.lit(float(lr.intercept))
    head = PipelineModel(stages[:-2])

    def add_part(df: DataFrame) -> DataFrame:
        rest = {c: F.lit(0.0) for c in FEATURE_COLS if c not in ARTICLE_FEATURES}
        return head.transform(df.withColumns(rest)).withColumn("_part", part).select(*df.columns, "_part")

    def score(df: DataFrame) -> DataFrame:
        return (head.transform(df).withColumn("click_probability", 1.0 / (1.0 + F.exp(-margin)))
                .drop(*asm.getInputCols()))
    return LinearOrder(add_part, score)


def linear_probability(model: PipelineModel):
    """The scoring function of ``linear_order``, or None."""
    order = linear_order(model)
    return order and order.score


def scoring_order(model: PipelineModel | LinearOrder | TreeOrder) -> LinearOrder | TreeOrder:
    """How a model orders articles: as it is given, a logistic regression by
    its linear form, a forest or boosted trees by their cells."""
    if isinstance(model, LinearOrder | TreeOrder):
        return model
    linear = linear_order(model)
    if linear is not None:
        return linear
    if hasattr(model.stages[-1], "trees"):
        return TreeOrder(without_summary(model, SparkSession.getActiveSession()))
    raise ValueError("the model is neither linear nor made of trees; give a LinearOrder")


def model_metrics(scored: DataFrame, label: str = TARGET, p: str = "p",
                  pred: str = "pred") -> DataFrame:
    """accuracy, auc, f1, precision, recall of class 1 (rounded to 4).

    One pass over the scored rows: they are grouped by score, counting
    positives / negatives and the predicted-positive ones.  Everything else
    runs on that grouped table: a distributed prefix sum of negatives gives
    the exact AUC (ties count 1/2) and the confusion counts are its sums.
    """
    y, yh = F.col(label), F.col(pred)
    g = (scored.groupBy(F.col(p).alias("score"))
               .agg(F.count(F.when(y == 1, 1)).alias("pos"),
                    F.count(F.when(y == 0, 1)).alias("neg"),
                    F.count(F.when((y == 1) & (yh == 1), 1)).alias("tp"),
                    F.count(F.when((y == 0) & (yh == 1), 1)).alias("fp")))
    g = with_prefix_sums(g, "score", ["neg"])
    tot = g.agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"),
                (F.sum("pos") - F.sum("tp")).alias("fn"),
                (F.sum("neg") - F.sum("fp")).alias("tn"),
                (F.sum(F.col("pos") * (F.col("neg_before") + 0.5 * F.col("neg")))
                 / (F.sum("pos") * F.sum("neg"))).alias("auc_raw"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    prec = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0))
    rec = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0))
    f1 = F.when(2 * tp + fp + fn > 0, 2 * tp / (2 * tp + fp + fn)).otherwise(F.lit(0.0))
    acc = (tp + tn) / (tp + tn + fp + fn)
    return tot.select(F.round(acc, 4).alias("accuracy"), F.round("auc_raw", 4).alias("auc"),
                      F.round(f1, 4).alias("f1"), F.round(prec, 4).alias("precision"),
                      F.round(rec, 4).alias("recall"))


def rule_score(ds: DataFrame) -> DataFrame:
    """A fixed, model-free click score for checking the metric code: the mean
    of the article's rate, the user's rate and the user's category affinity,
    a click from 0.4 on."""
    return ds.withColumn("p", RULES["Mean Rule"]()).withColumn("pred", (F.col("p") > 0.4).cast("int"))


# Fixed, model-free scores by name: the metric and selection code can be
# checked on them against any SQL engine.
RULES = {
    "Mean Rule": lambda: (F.col("article_ctr") + F.col("user_ctr") + F.col("top_category_affinity")) / 3.0,
    "Article Rule": lambda: F.col("article_ctr"),
    "User Rule": lambda: F.col("user_ctr"),
}


def rule_metrics(test: DataFrame) -> DataFrame:
    """One metrics row per rule, in the layout of ``evaluate``."""
    out = None
    for i, (name, p) in enumerate(RULES.items()):
        scored = test.withColumn("p", p()).withColumn("pred", (F.col("p") > 0.4).cast("int"))
        row = model_metrics(scored).select(F.lit(name).alias("model"), F.lit(i).alias("position"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def rule_order() -> LinearOrder:
    """The rule score as a recommender's scorer."""
    return LinearOrder(lambda df: df.withColumn("_part", F.col("article_ctr")),
                       lambda df: rule_score(df).withColumn("click_probability", F.col("p")))


def evaluate(models: dict[str, PipelineModel], test: DataFrame) -> DataFrame:
    """One metrics row per model, with its position in training order."""
    spark = test.sparkSession
    rows = []
    for i, name in enumerate(MODEL_ORDER):
        if name in models:
            m = model_metrics(score(models[name], test)).first()
            rows.append((name, i, *[float(m[c]) for c in
                                    ("accuracy", "auc", "f1", "precision", "recall")]))
    return spark.createDataFrame(
        rows, "model string, position int, accuracy double, auc double, f1 double, "
              "precision double, recall double")


def best_model(metrics: DataFrame) -> DataFrame:
    """Highest AUC; on equal AUC the earlier model wins."""
    return metrics.orderBy(F.col("auc").desc(), F.col("position")).limit(1)


def metrics_long(metrics: DataFrame) -> DataFrame:
    """Wide -> long (model, metric, value) with ``is_best`` per metric."""
    long = metrics.unpivot(["model"], ["accuracy", "auc", "f1"], "metric", "value")
    best = F.max("value").over(Window.partitionBy("metric"))
    return long.withColumn("is_best", F.col("value") == best)


def feature_importance(model: PipelineModel) -> DataFrame:
    """(feature, importance) of a tree model, importance descending."""
    tree = model.stages[-1]
    imp = tree.featureImportances.toArray().tolist()
    spark = SparkSession.getActiveSession()
    df = spark.createDataFrame(list(zip(FEATURE_COLS, [float(v) for v in imp])),
                               "feature string, importance double")
    return df.orderBy(F.col("importance").desc(), F.col("feature"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_or_train(path: str, ds: DataFrame, profile: str = "batch",
                  balance: str | None = "smote",
                  names: list[str] | None = None) -> tuple[PipelineModel, DataFrame | None]:
    """Load the saved best model, or train, evaluate, save and return it.

    Returns (model, metrics) where metrics is None when loaded.  Only a path
    that does not exist counts as "no model": a broken folder raises, and is
    not overwritten."""
    if exists(ds.sparkSession, path):
        return load_model(path), None
    train, test, stats = prepare(ds, balance)
    models = train_models(train, stats, profile, names)
    metrics = evaluate(models, test)
    name = best_model(metrics).first()["model"]
    save_model(models[name], path)
    return models[name], metrics


def model_path(base: str, name: str = "click_predictor") -> str:
    return os.path.join(base, name) if "://" not in base else f"{base.rstrip('/')}/{name}"


def scaler_frame(train: DataFrame, cols: list[str] = FEATURE_COLS) -> DataFrame:
    """(feature, mean, std) of the scaler fit as a DataFrame (one aggregate,
    then a stack of the single row)."""
    agg = train.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                    *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c}', m{i}, s{i}" for i, c in enumerate(cols))
    return agg.selectExpr(f"stack({len(cols)}, {pairs}) AS (feature, mean, std)")


def split_counts(ds: DataFrame, seed: int = SPLIT_SEED) -> DataFrame:
    """Rows per (side, Click): the split's class balance."""
    keyed = _keyed(ds, seed, None).select(TARGET, ROW_KEY)
    side = F.when(_is_test(split_cuts(keyed)), F.lit("test")).otherwise(F.lit("train"))
    return keyed.groupBy(side.alias("side"), F.col(TARGET)).agg(F.count("*").alias("n"))
