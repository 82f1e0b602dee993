import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.operators import boosting, classify
from shelfwise.plans import catalogue
from shelfwise.staging import stage


@pytest.fixture(scope="module")
def split(spark, folder):
    rows = catalogue.matrix(spark, folder).select("product_id", "features", "label")
    return stage(classify.stratified_split(rows))


def test_split_is_exact_per_label(split):
    for r in split.groupBy("label").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect():
        assert r.t == round(0.2 * r.n)


def test_folds_are_even(split):
    rows = classify.assign_folds(split.drop("is_test")).groupBy("label", "fold").count().collect()
    for label in (0, 1):
        sizes = [r["count"] for r in rows if r.label == label]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_metrics(spark):
    rows = [(1, 1.0)] * 3 + [(1, 0.0)] * 1 + [(0, 1.0)] * 2 + [(0, 0.0)] * 4
    row = classify.evaluate(spark.createDataFrame(rows, "label int, prediction double")).first()
    assert (row.accuracy, row.precision, row.recall, row.f1) == (0.7, 0.6, 0.75, 0.6667)
    none = classify.evaluate(spark.createDataFrame([(0, 0.0)], "label int, prediction double")).first()
    assert (none.precision, none.recall, none.f1) == (0.0, 0.0, 0.0)


def test_forest_and_boosting(spark, split):
    for kind, params in (("random_forest", {"trees": 10}), ("boosted_trees", {"rounds": 3, "depth": 3})):
        model, metrics = classify.train_and_evaluate(split, kind, **params)
        row = metrics.first()
        assert 0 <= row.f1 <= 1 and row.tp + row.fp + row.fn + row.tn == split.where("is_test").count()
        names = [f"f{i}" for i in range(model.numFeatures)]
        assert classify.importances(model, names, spark).count() == len(names)
        diag = classify.diagnostics(model, split.where(~F.col("is_test")), split.where("is_test"), names).first()
        assert 0 <= diag.train_f1 <= 1


def test_cross_validation(split):
    train = split.where(~F.col("is_test")).drop("is_test")
    scores = classify.cross_validate(train, classify.random_forest(trees=5), classify.balanced_weights, folds=3)
    row = classify.cv_summary(scores).first()
    assert 0 <= row.cv_f1_mean <= 1 and row.cv_f1_std >= 0


def test_boosting_in_a_task_equals_sparks(spark, split, monkeypatch):
    """One job a fit, where Spark needs two stages for every level of every round, and the same trees."""
    rows = stage(classify.positive_weights(split.where(~F.col("is_test"))).coalesce(1))
    estimator = classify.boosted_trees(rounds=6, depth=4)
    own = classify.fitted(estimator, rows)
    want = estimator.fit(rows)
    digits = re.compile(r"-?\d+\.\d+(?:E-?\d+)?")
    a, b = (m.toDebugString.split("\n", 1)[1] for m in (own, want))
    assert digits.sub("#", a) == digits.sub("#", b)
    assert np.allclose([float(v) for v in digits.findall(a)], [float(v) for v in digits.findall(b)], rtol=1e-9, atol=1e-12)
    assert np.allclose(own.featureImportances.toArray(), want.featureImportances.toArray())
    assert own.getMaxDepth() == 4 and own.getWeightCol() == "weight" and own.treeWeights == want.treeWeights
    # Too many cells for a task, or a setting that is not handled: Spark's trees.
    monkeypatch.setattr(boosting, "CELLS", 10)
    assert not boosting.handles(estimator, rows, rows.count())
    monkeypatch.undo()
    assert boosting.handles(estimator, rows, 1) and not boosting.handles(estimator.copy().setSubsamplingRate(0.5), rows, 1)


def test_folds_of_boosted_trees_need_few_jobs(spark, split):
    train = split.where(~F.col("is_test")).drop("is_test")
    spark.sparkContext.setJobGroup("folds", "folds")
    try:
        classify.cross_validate(train, classify.boosted_trees(rounds=40, depth=5), classify.positive_weights, folds=2)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("folds"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < jobs < 100  # before: a job for every level of every round


def test_thresholds():
    assert boosting.thresholds(np.array([3.0, 1.0, 1.0]), np.ones(3), 32).tolist() == [2.0]
    assert boosting.thresholds(np.arange(8.0), np.ones(8), 4).tolist() == [1.5, 3.5, 5.5]
    assert len(boosting.thresholds(np.full(5, 2.0), np.ones(5), 4)) == 0
