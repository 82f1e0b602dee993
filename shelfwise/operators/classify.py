"""Supervised step: split, tree ensembles, metrics and diagnostics.

Frames carry ``product_id``, a ``features`` vector and a 0/1 ``label``.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions import hashing
from shelfwise.operators import boosting
from shelfwise.operators.dedup import shared_rows
from shelfwise.operators.stats import ordered_position
from shelfwise.staging import stage

FOLDS = 5


def _shuffled_position(df: DataFrame, label: str, seed: int) -> DataFrame:
    """Position of each row in a hash-shuffled order of its label.

    The leading digest digits cut a label into 4096 even slices, as a label
    holds a large share of all rows.
    """
    digest = hashing.salted_md5(F.col("product_id"), str(seed))
    lead = F.conv(F.substring(digest, 1, 3), 16, 10).cast("int")
    return ordered_position(df, [label], lead, [digest, F.col("product_id")])


def _label_sizes(df: DataFrame, label: str) -> dict:
    return {r[label]: r["count"] for r in df.groupBy(label).count().collect()}


def stratified_split(df: DataFrame, label: str = "label", test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """``is_test`` marks the same share of every label, to the row."""
    quota = F
    for value, n in _label_sizes(df, label).items():
        quota = quota.when(F.col(label).eqNullSafe(F.lit(value)), round(test_share * n))
    placed = _shuffled_position(df, label, seed)
    return placed.withColumn("is_test", F.col("pos") <= quota.otherwise(0)).drop("pos")


def assign_folds(df: DataFrame, label: str = "label", folds: int = FOLDS, seed: int = 42) -> DataFrame:
    """Stratified ``fold`` 0 .. folds-1."""
    placed = _shuffled_position(df, label, seed)
    return placed.withColumn("fold", (F.col("pos") % folds).cast("int")).drop("pos")


def balanced_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """``weight`` that gives every class the same total."""
    sizes = _label_sizes(df, label)
    total, weight = sum(sizes.values()), F
    for value, n in sizes.items():
        weight = weight.when(F.col(label) == value, total / (len(sizes) * n))
    return df.withColumn("weight", weight.otherwise(1.0))


def positive_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """``weight`` negatives / positives on the positive class, 1 elsewhere."""
    sizes = _label_sizes(df, label)
    pos = sizes.get(1, 0)
    ratio = (sum(sizes.values()) - pos) / pos if pos else 1.0
    return df.withColumn("weight", F.when(F.col(label) == 1, ratio).otherwise(1.0))


def random_forest(trees: int = 200, depth: int = 8, min_leaf: int = 5, seed: int = 42) -> RandomForestClassifier:
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, minInstancesPerNode=min_leaf,
                                  weightCol="weight", seed=seed)


def boosted_trees(rounds: int = 300, depth: int = 6, rate: float = 0.05, seed: int = 42) -> GBTClassifier:
    return GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=rate, weightCol="weight", seed=seed)


ESTIMATORS = {"random_forest": random_forest, "boosted_trees": boosted_trees}
WEIGHTING = {"random_forest": balanced_weights, "boosted_trees": positive_weights}


def confusion(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: true/false positives and negatives."""
    actual, said = F.col(label) == 1, F.col(prediction) == 1
    return predictions.agg(
        F.count_if(actual & said).alias("tp"), F.count_if(~actual & said).alias("fp"),
        F.count_if(actual & ~said).alias("fn"), F.count_if(~actual & ~said).alias("tn"),
    )


def evaluate(predictions: DataFrame, model: str = "model", label: str = "label",
             prediction: str = "prediction") -> DataFrame:
    """Accuracy and positive-class precision, recall and F1; 0 on an empty base."""
    def ratio(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b).otherwise(0.0)

    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return confusion(predictions, label, prediction).select(
        F.lit(model).alias("model"),
        F.round(ratio(tp + tn, tp + fp + fn + tn), 4).alias("accuracy"),
        F.round(ratio(tp, tp + fp), 4).alias("precision"),
        F.round(ratio(tp, tp + fn), 4).alias("recall"),
        F.round(ratio(2 * tp, 2 * tp + fp + fn), 4).alias("f1"),
        "tn", "fp", "fn", "tp",
    )


def at_once(spark: SparkSession, jobs: list[Callable]) -> list:
    """Results of independent driver calls, whose Spark jobs run at the same time."""
    with ThreadPoolExecutor(max(1, len(jobs))) as pool:
        return list(pool.map(lambda job: inheritable_thread_target(spark)(job)(), jobs))


def fitted(estimator, rows: DataFrame):
    """The estimator's model; boosted trees of rows that a task can hold are grown in one task."""
    return boosting.fit(estimator, rows) if boosting.handles(estimator, rows, rows.count()) else estimator.fit(rows)


def cross_validate(train: DataFrame, estimator, weighting, folds: int = FOLDS) -> DataFrame:
    """F1 per fold; see ``cv_summary`` for mean and spread. The folds are fitted at the same time."""
    folded = stage(assign_folds(train, folds=folds), "folds")

    def score(fold: int) -> tuple[int, float]:
        model = fitted(estimator, weighting(folded.where(F.col("fold") != fold)))
        held_out = model.transform(folded.where(F.col("fold") == fold))
        return fold, evaluate(held_out).first()["f1"]

    scores = at_once(train.sparkSession, [partial(score, fold) for fold in range(folds)])
    return train.sparkSession.createDataFrame(scores, "fold int, f1 double")


def cross_validate_kind(train: DataFrame, kind: str, **params) -> DataFrame:
    """One row: mean and spread of F1 over the folds of one kind of trees."""
    return cv_summary(cross_validate(train, ESTIMATORS[kind](**params), WEIGHTING[kind])).withColumn("model", F.lit(kind))


def cv_summary(folds: DataFrame) -> DataFrame:
    return folds.agg(F.round(F.avg("f1"), 4).alias("cv_f1_mean"), F.round(F.stddev_pop("f1"), 4).alias("cv_f1_std"))


def importances(model, names: list[str], spark) -> DataFrame:
    """Feature importances, one row per feature."""
    rows = [(n, float(v)) for n, v in zip(names, model.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def row_overlap(train: DataFrame, test: DataFrame, columns: list[str]) -> DataFrame:
    """Number of distinct feature rows that occur in both sets."""
    return shared_rows(train, test, columns).agg(F.count("*").alias("shared_rows"))


def diagnostics(model, train: DataFrame, test: DataFrame, names: list[str]) -> DataFrame:
    """Train and test F1, leakage suspicion and a dominant feature, if any."""
    train_f1 = evaluate(model.transform(train)).first()["f1"]
    test_f1 = evaluate(model.transform(test)).first()["f1"]
    top, share = max(zip(names, model.featureImportances.toArray()), key=lambda x: x[1])
    shared = row_overlap(train, test, ["features"]).first()["shared_rows"]
    row = (train_f1, test_f1, test_f1 > 0.98 or test_f1 - train_f1 > 0.1,
           top if share > 0.8 else None, shared)
    return train.sparkSession.createDataFrame(
        [row], "train_f1 double, test_f1 double, leakage_suspected boolean, dominant_feature string, "
               "shared_rows bigint")


def train_and_evaluate(split: DataFrame, kind: str = "random_forest", **params):
    """Fitted model and its one-row test metrics."""
    model = fitted(ESTIMATORS[kind](**params), WEIGHTING[kind](split.where(~F.col("is_test"))))
    return model, evaluate(model.transform(split.where("is_test")), kind)
