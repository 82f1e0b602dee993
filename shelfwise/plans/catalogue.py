"""Stage tables of a catalogue: products, cleaned, scored, model matrix.

Each table is computed once per application and folder and then read from the
shared folder by whatever builds on it, the way a dashboard reads the outputs
of the scoring run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators import clean, cluster, lloyd, scoring
from shelfwise.sources import catalog
from shelfwise.staging import stage

_tables: dict[tuple[str, str, str], DataFrame] = {}


def _once(spark: SparkSession, folder: str, name: str, build) -> DataFrame:
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _tables:
        _tables[key] = stage(build(), name)
    return _tables[key]


def products(spark: SparkSession, folder: str) -> DataFrame:
    return _once(spark, folder, "products", lambda: catalog.products(spark, folder))


def cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return _once(spark, folder, "cleaned", lambda: clean.clean(products(spark, folder)))


def scored(spark: SparkSession, folder: str) -> DataFrame:
    return _once(spark, folder, "scored", lambda: scoring.compute_scores(cleaned(spark, folder)))


def featured(spark: SparkSession, folder: str) -> DataFrame:
    """Scored catalogue with the engineered and encoded feature columns."""
    return _once(spark, folder, "featured",
                 lambda: clean.encode_labels(clean.engineer(scored(spark, folder))))


def matrix(spark: SparkSession, folder: str) -> DataFrame:
    """Featured catalogue with the scaled ``features`` vector and the ``label``."""
    def build() -> DataFrame:
        rows, _ = clean.feature_matrix(featured(spark, folder))
        return rows.withColumn("label", F.col("is_top_product").cast("int"))
    return _once(spark, folder, "matrix", build)


_fits: dict[tuple[str, str], dict[int, lloyd.Fit]] = {}


def sweep(spark: SparkSession, folder: str) -> DataFrame:
    """Inertia and silhouette for every k, with all restarts."""
    def build() -> DataFrame:
        rows, fits = cluster.sweep_fits(matrix(spark, folder).select("product_id", "features"))
        _fits[spark.sparkContext.applicationId, folder] = fits
        return rows
    return _once(spark, folder, "sweep", build)


def best_fit(spark: SparkSession, folder: str) -> lloyd.Fit:
    """The sweep's fit for its best k."""
    k = best_k(spark, folder)
    return _fits[spark.sparkContext.applicationId, folder][k]


def best_k(spark: SparkSession, folder: str) -> int:
    return sweep(spark, folder).where("best").first()["k"]


def clustered(spark: SparkSession, folder: str) -> DataFrame:
    """Model matrix with KMeans ``cluster`` for the best k, and its name."""
    def build() -> DataFrame:
        rows = matrix(spark, folder)
        labelled = best_fit(spark, folder).transform(rows)
        return cluster.label_products(stage(labelled, "kmeans"))
    return _once(spark, folder, "clustered", build)
