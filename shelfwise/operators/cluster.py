"""KMeans, silhouettes, cluster names and PCA over a ``features`` vector."""

from __future__ import annotations

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators import lloyd
from shelfwise.operators.stats import exact_quantiles, known, scalars

SEED = 42
# Cluster names.
PREMIUM, PROMO, TOP_RATED = "Premium", "Discount / Promo", "Top rated"
NICHE, MAINSTREAM, ANOMALY = "Niche / peu connu", "Mainstream", "Anomalie (DBSCAN)"


def silhouette(labelled: DataFrame, label: str = "cluster", keep_noise: bool = True) -> float:
    """Mean silhouette (squared Euclidean, linear time); 0 for fewer than two clusters."""
    rows = labelled if keep_noise else labelled.where(F.col(label) != -1)
    clusters = rows.agg(F.count_distinct(label).alias("n")).first()["n"]
    if clusters < 2:
        return 0.0
    codes = rows.withColumn("_label", F.col(label).cast("int"))
    return ClusteringEvaluator(predictionCol="_label").evaluate(codes)


def best_kmeans(df: DataFrame, k: int, n_init: int = 10, seed: int = SEED) -> lloyd.Fit:
    """The fit of least cost out of ``n_init`` starts, which take their steps together."""
    points = lloyd.points_of(df)
    return lloyd.best_of(lloyd.fit_all(points, lloyd.starts(points, [(k, i) for i in range(n_init)], seed)))[k]


def sweep_limit(rows: int, cap: int = 10, per_cluster: int = 5) -> int:
    return min(cap, rows // per_cluster)


def k_sweep(df: DataFrame, k_max: int | None = None, k_min: int = 2, n_init: int = 10, seed: int = SEED) -> DataFrame:
    """Inertia and silhouette per k; ``best`` marks the highest silhouette.

    All models of all k take their steps together; the best of every k are
    then judged together.
    """
    return sweep_fits(df, k_max, k_min, n_init, seed)[0]


def sweep_fits(
    df: DataFrame, k_max: int | None = None, k_min: int = 2, n_init: int = 10, seed: int = SEED,
) -> tuple[DataFrame, dict[int, lloyd.Fit]]:
    """The rows of ``k_sweep`` and the fit of every k, which is the one of ``best_kmeans``."""
    points = lloyd.points_of(df)
    limit = sweep_limit(points.count()) if k_max is None else k_max
    models = [(k, i) for k in range(k_min, limit + 1) for i in range(n_init)]
    best = lloyd.best_of(lloyd.fit_all(points, lloyd.starts(points, models, seed))) if models else {}
    scores = lloyd.squared_silhouettes(points, best)
    rows = [(k, round(fit.cost, 2), round(scores[k], 4)) for k, fit in sorted(best.items())]
    top = max(rows, key=lambda r: r[2])[0] if rows else None
    return df.sparkSession.createDataFrame(
        [(*r, r[0] == top) for r in rows], "k int, inertia double, silhouette double, best boolean"), best


def name_clusters(df: DataFrame) -> DataFrame:
    """Profile and business name of every ``cluster``; noise (-1) is left out."""
    p75 = known(scalars(exact_quantiles(df, {"p75": ("price", 0.75)}))["p75"])
    profile = df.where(F.col("cluster") != -1).groupBy("cluster").agg(
        F.avg("price").alias("avg_price"), F.avg("rating").alias("avg_rating"),
        F.avg("review_count").alias("avg_reviews"), F.avg("discount_pct").alias("avg_discount"),
        F.count("title").alias("count"),
    )
    name = (
        F.when(F.col("avg_price") > p75, PREMIUM)
        .when(F.col("avg_discount") > 20, PROMO)
        .when((F.col("avg_rating") >= 4.2) & (F.col("avg_reviews") >= 200), TOP_RATED)
        .when(F.col("avg_reviews") < 50, NICHE)
        .otherwise(MAINSTREAM)
    )
    return profile.withColumn("cluster_label", name)


def label_products(df: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """``cluster_label`` per product; noise gets the anomaly name."""
    names = (name_clusters(df) if names is None else names).select("cluster", "cluster_label")
    joined = df.join(names, "cluster", "left")
    return joined.withColumn(
        "cluster_label", F.when(F.col("cluster") == -1, ANOMALY).otherwise(F.col("cluster_label")))


def pca(df: DataFrame, k: int = 2):
    """Fitted (centring, projection) models."""
    centre = StandardScaler(withMean=True, withStd=False, inputCol="features", outputCol="_centred").fit(df)
    return centre, PCA(k=k, inputCol="_centred", outputCol="_pcs").fit(centre.transform(df))


def project(df: DataFrame, models) -> DataFrame:
    """``pc1``, ``pc2``, ...; each axis points where its largest loading is positive."""
    centre, axes = models
    loadings = axes.pc.toArray()
    signs = [1.0 if abs(c.max()) >= abs(c.min()) else -1.0 for c in loadings.T]
    values = vector_to_array("_pcs")
    return axes.transform(centre.transform(df)).withColumns({
        f"pc{i + 1}": values[i] * F.lit(s) for i, s in enumerate(signs)
    }).drop("_centred", "_pcs")


def explained_variance(models, spark) -> DataFrame:
    rows = [(i + 1, float(v)) for i, v in enumerate(models[1].explainedVariance)]
    return spark.createDataFrame(rows, "component int, ratio double")
