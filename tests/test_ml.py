import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from engage.operators import ml as ML
from engage.operators.oversample import smote
from engage.plans.catalog import featured


def test_split_disjoint_covering_stratified(spark):
    ds = featured(spark, SF_SMALL, with_position=True)
    train, test = ML.stratified_split(ds)
    assert train.count() + test.count() == ds.count()
    assert train.join(test, ML.KEY_COLS, "inner").count() == 0
    sides = [{r.Click: r["count"] for r in part.groupBy("Click").count().collect()} for part in (train, test)]
    for c in sides[0]:
        n = sides[0][c] + sides[1][c]
        assert sides[1][c] == (2 * n + 5) // 10
    with pytest.raises(ValueError, match="ImpID"):
        ML.stratified_split(ds.drop("ImpID"))


def test_split_cuts_are_the_order_statistic_of_each_class(spark):
    rng = random.Random(4)
    rows = [(c, "%032x" % rng.getrandbits(128)) for c, n in ((0, 700), (1, 133), (2, 2), (None, 40)) for _ in range(n)]
    rows += [(3, "ab" * 12 + "%08x" % i) for i in range(300)] + [(4, "f" * 32)] * 7   # shared digits, equal keys
    df = spark.createDataFrame(rows, f"Click int, {ML.ROW_KEY} string").repartition(5)
    for tenths in (2, 5, 10, 0):
        want = {}
        for c in {c for c, _ in rows}:
            keys = sorted(k for x, k in rows if x == c)
            q = (len(keys) * tenths + 5) // 10
            want[c] = keys[q - 1] if q else None
        assert ML.split_cuts(df, tenths) == want


def test_scaler_is_population_std(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4)], "x double")
    (m, s), = ML.fit_scaler(df, ["x"]).values()
    assert m == 2.5 and abs(s - np.std([1, 2, 3, 4])) < 1e-12
    const = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    assert ML.fit_scaler(const, ["x"])["x"] == (5.0, 1.0)
    z = ML.scale(df, ML.fit_scaler(df, ["x"])).agg(F.avg("x"), F.stddev_pop("x")).first()
    assert abs(z[0]) < 1e-12 and abs(z[1] - 1) < 1e-12


def test_metrics_match_direct_computation(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 400)
    p = np.round(rng.random(400) * 0.5 + y * 0.3, 2)       # many ties
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "Click int, p double")
    df = df.withColumn("pred", (F.col("p") > 0.5).cast("int"))
    got = ML.model_metrics(df).first()
    pos, neg = p[y == 1], p[y == 0]
    auc = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) \
        / (len(pos) * len(neg))
    pred = (p > 0.5).astype(int)
    tp = int(((pred == 1) & (y == 1)).sum()); fp = int(((pred == 1) & (y == 0)).sum())
    fn = int(((pred == 0) & (y == 1)).sum())
    assert got.auc == round(auc, 4)
    assert got.accuracy == round(float((pred == y).mean()), 4)
    assert got.precision == round(tp / (tp + fp), 4) and got.recall == round(tp / (tp + fn), 4)
    assert got.f1 == round(2 * tp / (2 * tp + fp + fn), 4)


def test_models_learn_and_are_deterministic(spark, tmp_path):
    ds = featured(spark, SF_SMALL, with_position=True)
    train, test, stats = ML.prepare(ds, "weight")
    models = ML.train_models(train, stats, names=["Logistic Regression", "Random Forest"])
    metrics = ML.evaluate(models, test)
    assert {r.model for r in metrics.collect()} == {"Logistic Regression", "Random Forest"}
    assert all(r.auc > 0.5 for r in metrics.collect())
    again = ML.train_models(train, stats, names=["Random Forest"])["Random Forest"]
    s1 = sorted(r.p for r in ML.score(models["Random Forest"], test).select("p").collect())
    s2 = sorted(r.p for r in ML.score(again, test).select("p").collect())
    assert s1 == s2
    path = str(tmp_path / "model")
    ML.save_model(models["Logistic Regression"], path)
    loaded = ML.load_model(path)
    assert (sorted(r.p for r in ML.score(loaded, test).select("p").collect())
            == sorted(r.p for r in ML.score(models["Logistic Regression"], test)
                      .select("p").collect()))
    best = ML.best_model(metrics).first()
    assert best.auc == max(r.auc for r in metrics.collect())
    imp = ML.feature_importance(models["Random Forest"]).collect()
    assert len(imp) == 8 and abs(sum(r.importance for r in imp) - 1) < 1e-6


def test_smote_balanced_and_bounded(spark):
    ds = featured(spark, SF_SMALL, with_position=True)
    train, _ = ML.stratified_split(ds)
    rows = ML.assemble_rows(train)
    stats = ML.fit_scaler(rows)
    out = smote(rows, stats, block_size=64)
    counts = {r.Click: r["count"] for r in out.groupBy("Click").count().collect()}
    assert counts[0] == counts[1]
    mins = rows.filter("Click = 1")
    for c in ML.FEATURE_COLS:
        lo, hi = mins.agg(F.min(c), F.max(c)).first()
        lo2, hi2 = out.filter("Click = 1").agg(F.min(c), F.max(c)).first()
        assert lo <= lo2 and hi2 <= hi
    assert (out.subtract(rows).count() > 0)


def test_linear_probability_equals_model_transform(spark):
    from pyspark.ml.functions import vector_to_array
    ds = featured(spark, SF_SMALL, with_position=True)
    train, test, stats = ML.prepare(ds)
    model = ML.train_models(train, stats, names=["Logistic Regression"])["Logistic Regression"]
    fast = ML.linear_probability(model)
    assert fast is not None
    a = fast(test).select(ML.ROW_KEY, "click_probability")
    b = model.transform(test).select(ML.ROW_KEY, vector_to_array("probability")[1].alias("p"))
    worst = a.join(b, ML.ROW_KEY).agg(F.max(F.abs(F.col("click_probability") - F.col("p")))).first()[0]
    assert worst < 1e-12
    assert a.count() == test.count()
    rf = ML.train_models(train, stats, names=["Random Forest"])["Random Forest"]
    assert ML.linear_probability(rf) is None


def test_smote_rows_lie_between_exact_neighbours(spark):
    """Every synthetic row lies between its point and one of the 5 nearest
    other minority rows (brute force over all of them, copies included)."""
    from engage.operators import oversample as OS
    rng = np.random.default_rng(6)
    x = np.concatenate([np.round(rng.normal(size=(150, 8)), 1), np.zeros((9, 8)), np.ones((3, 8))])
    data = [tuple(map(float, r)) + (1, f"b{i}") for i, r in enumerate(x)]
    data += [tuple(map(float, r)) + (0, f"a{i}") for i, r in enumerate(rng.normal(size=(900, 8)))]
    rows = spark.createDataFrame(data, ", ".join(f"{c} double" for c in ML.FEATURE_COLS) + f", Click int, {ML.ROW_KEY} string")
    stats = ML.fit_scaler(rows)
    out = OS.smote(rows, stats, block_size=16).filter(F.col(ML.ROW_KEY).startswith("smote-")).collect()
    assert len(out) == 900 - len(x)
    mean, sd = (np.array([stats[c][i] for c in ML.FEATURE_COLS]) for i in (0, 1))
    z = (x - mean) / sd
    points = {r.id: np.array([r[c] for c in ML.FEATURE_COLS]) for r in OS.minority_points(rows, stats, 1).collect()}
    made = {}
    for r in out:
        p, v = points[int(r[ML.ROW_KEY].split("-")[1])], np.array([r[c] for c in ML.FEATURE_COLS])
        i = next(i for i in range(len(x)) if (x[i] == p).all())
        d = np.sqrt(((z - z[i]) ** 2).sum(1))
        d[i] = np.inf
        near = x[d <= np.sort(d)[4] + 1e-12]
        ok = False
        for q in near:
            step = q - p
            u = [(v - p)[j] / step[j] for j in range(8) if step[j] != 0]
            ok |= (np.abs((v - p)[step == 0]) < 1e-12).all() and (not u or max(u) - min(u) < 1e-6 and -1e-9 <= min(u) <= 1)
        assert ok
        made[tuple(p)] = made.get(tuple(p), 0) + 1
    # each row makes its share, whole draws apart
    for i, p in enumerate(map(tuple, x)):
        share = (900 - len(x)) * (x == x[i]).all(1).sum() / len(x)
        assert abs(made.get(p, 0) - share) <= 1


def test_smote_tiny_minority_spreads_and_repeats(spark, monkeypatch):
    """3 minority rows against 4,000 majority rows: exactly the gap is made,
    the synthetic rows come from several tasks (chunks are shuffled apart,
    not built in one group), and a second run gives the same rows."""
    from engage.operators import oversample as OS
    monkeypatch.setattr(OS, "CHUNK_ROWS", 100)
    cols = ML.FEATURE_COLS
    data = [tuple(float((i * 7 + j) % 11) for j in range(len(cols))) + (0, f"a{i}")
            for i in range(4000)]
    data += [tuple(float(i + j) for j in range(len(cols))) + (1, f"b{i}") for i in range(3)]
    rows = spark.createDataFrame(data, ", ".join(f"{c} double" for c in cols)
                                 + ", Click int, _k string")
    stats = ML.fit_scaler(rows)
    out = OS.smote(rows, stats, block_size=64)
    synth = out.filter(F.col("_k").startswith("smote-"))
    assert synth.count() == 4000 - 3
    assert synth.groupBy(F.spark_partition_id()).count().count() > 1
    lo = [min(float(i + j) for i in range(3)) for j in range(len(cols))]
    hi = [max(float(i + j) for i in range(3)) for j in range(len(cols))]
    got = synth.agg(*[F.min(c) for c in cols], *[F.max(c) for c in cols]).first()
    assert all(lo[j] <= got[j] and got[len(cols) + j] <= hi[j] for j in range(len(cols)))
    again = OS.smote(rows, stats, block_size=64).filter(F.col("_k").startswith("smote-"))
    assert synth.exceptAll(again).count() == 0 and again.exceptAll(synth).count() == 0


def test_a_fresh_model_scores_in_a_session_that_has_observed(spark):
    """The minimal case of a failure: after any observation a just fitted
    logistic regression could not be sent to a task."""
    from pyspark.sql import Observation
    seen = Observation()
    spark.range(5).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 5}
    ds = featured(spark, SF_SMALL, with_position=True)
    train, test, stats = ML.prepare(ds, None)
    model = ML.train_models(train, stats, names=["Logistic Regression"])["Logistic Regression"]
    assert not model.stages[-1].hasSummary
    assert ML.model_metrics(ML.score(model, test)).first().auc > 0.5


def test_training_partitions_follow_the_rows(spark, monkeypatch):
    rows = spark.range(400).select(*[(F.col("id") % (i + 2)).cast("double").alias(c) for i, c in enumerate(ML.FEATURE_COLS)],
                                   (F.col("id") % 2).cast("int").alias(ML.TARGET))
    used = []
    fit = ML.Pipeline.fit
    monkeypatch.setattr(ML.Pipeline, "fit", lambda self, df: used.append(df.rdd.getNumPartitions()) or fit(self, df))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        for rows_each, want in ((250_000, 8), (20, 20), (1, 40)):
            monkeypatch.setattr(ML, "PART_ROWS", rows_each)
            ML.train_models(rows, ML.fit_scaler(rows), names=["Logistic Regression"])
            assert used.pop() == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_few_keys_settle_the_cut_at_once(spark, monkeypatch):
    data = spark.range(3000).select((F.col("id") % 3 == 0).cast("int").alias(ML.TARGET), F.md5(F.col("id").cast("string")).alias("_k"))
    want = {c: sorted(r["_k"] for r in data.collect() if r[ML.TARGET] == c)[n - 1] for c, n in ((1, 200), (0, 400))}
    assert ML.split_cuts(data) == want
    monkeypatch.setattr(ML, "FEW", 0)
    assert ML.split_cuts(data) == want


def test_clusters_are_fitted_once_and_counted_by_cluster(spark, monkeypatch):
    from engage.operators import cluster as CL
    from engage.plans import training as TR
    rows = [(float(i % 10) / 10, float(i % 7), float(i % 5) / 5, f"U{i % 9}", f"N{i % 13}") for i in range(300)]
    ds = spark.createDataFrame(rows, "article_ctr double, popularity_score double, user_ctr double, UserID string, NewsID string")
    fits, fit = [], CL.KMeans.fit
    monkeypatch.setattr(TR, "featured_rows", lambda s, d: ds)
    monkeypatch.setattr(CL.KMeans, "fit", lambda self, df: fits.append(1) or fit(self, df))
    monkeypatch.setattr(TR, "_FITTED", {})
    out = TR.cluster_properties(spark, "made-up")
    assert [tuple(r) for r in out.collect()] == [(300, 3, 3, True)] and len(fits) == 1
    want = CL.cluster(ds)[0].select("UserID", "NewsID", *CL.CLUSTER_COLS, "prediction", "segment")
    got = TR.cluster_rows(spark, "made-up")
    assert got.exceptAll(want).count() == 0 and got.count() == 300
