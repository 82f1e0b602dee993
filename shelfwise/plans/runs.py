"""Whole runs: ingest, analysis and text enrichment with their written outputs."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import cached_property, partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import labels
from shelfwise.operators import (
    bi, classify, clean, cluster, dedup, density, enrich, hierarchy, lloyd, normalize, rules, scoring, silhouette,
)
from shelfwise.sources import bucketed, catalog, sinks
from shelfwise.staging import stage


def ingest(
    payloads: dict[str, DataFrame], folder: str, run_ts: str, label: str,
    history: DataFrame | str | None = None, order: Column | None = None, buckets: int = bucketed.BUCKETS,
) -> dict[str, DataFrame]:
    """Landed payloads to one de-duplicated snapshot, its files and the history.

    ``order`` ranks copies of a product inside the run (first wins). ``history``
    is the folder of a bucketed history, of which the run rewrites its own
    buckets, or rows that are written anew together with the run.
    """
    merged = normalize.stamp(normalize.normalize(payloads), run_ts)
    place = F.struct("platform", "url", "product_id") if order is None else order
    numbered = merged.withColumn("seq", place)
    unique = stage(dedup.keep_first(numbered).drop("seq"), "run")
    snapshot = normalize.contract_order(normalize.derive(catalog.require_rows(unique, "payloads")))
    sinks.write_snapshot_csv(snapshot, folder, label)
    sinks.write_jsonl(snapshot, f"{folder}/jsonl/{label}")
    ordered = snapshot.withColumn("seq", F.col("product_id"))
    if isinstance(history, str):
        bucketed.merge(ordered, history, buckets=buckets)
        kept = bucketed.read(ordered.sparkSession, history, ordered.schema).drop("seq")
        return {"snapshot": snapshot, "history": kept, "summary": bi.run_summary(kept)}
    past = None if history is None else history.withColumn("seq", F.col("product_id"))
    kept = sinks.append_history(past, ordered, f"{folder}/history/{label}").drop("seq")
    return {"snapshot": snapshot, "history": kept, "summary": bi.run_summary(kept)}


class Clustering:
    """KMeans, Ward and DBSCAN of a staged matrix; each part is computed once, when it is first asked for."""

    def __init__(self, matrix: DataFrame, k: int | Callable[[], int], n_init: int = 10, fit: Callable[[], lloyd.Fit] | None = None):
        self.matrix, self._k, self.n_init, self._fit = matrix, k, n_init, fit

    @cached_property
    def k(self) -> int:
        return self._k() if callable(self._k) else self._k

    @cached_property
    def kmeans(self) -> DataFrame:
        fit = self._fit() if self._fit else cluster.best_kmeans(self.matrix, self.k, self.n_init)
        return stage(fit.transform(self.matrix), "kmeans")

    @cached_property
    def _ward(self) -> DataFrame | None:
        found = hierarchy.point_labels(self.matrix, self.k)
        return None if found is None else stage(found, "ward")

    @cached_property
    def _dbscan(self) -> DataFrame | None:
        return density.point_labels(self.matrix)

    def ward(self, rows: DataFrame | None = None) -> DataFrame:
        """Rows of the matrix with ``hc_label``."""
        return hierarchy.labelled(self.matrix if rows is None else rows, self._ward)

    def dbscan(self, rows: DataFrame | None = None) -> DataFrame:
        """Rows of the matrix with ``dbscan_label``."""
        return density.labelled(self.matrix if rows is None else rows, self._dbscan)

    @cached_property
    def labelled(self) -> DataFrame:
        return stage(self.dbscan(self.ward(self.kmeans)), "dbscan")

    @cached_property
    def _noise(self) -> tuple[int, int]:
        """DBSCAN's clusters and its noise rows."""
        sizes = self.dbscan().agg(
            F.count_distinct(F.when(F.col("dbscan_label") != density.NOISE, F.col("dbscan_label"))).alias("clusters"),
            F.count_if(F.col("dbscan_label") == density.NOISE).alias("noise")).first()
        return sizes["clusters"], sizes["noise"]

    @cached_property
    def _kmeans_silhouette(self) -> float:
        return round(cluster.silhouette(self.kmeans, "cluster"), 4)

    def headline(self) -> DataFrame:
        """The columns of ``metrics`` that a run's report shows, without the other clusterings and silhouettes."""
        return self.matrix.sparkSession.createDataFrame(
            [(self.k, self._kmeans_silhouette, self._noise[1])], "k int, kmeans_silhouette double, dbscan_outliers long")

    @cached_property
    def metrics(self) -> DataFrame:
        """One row; ``.._silhouette`` is over squared distances, ``.._euclidean`` over distances."""
        labelled, (clusters, noise) = self.labelled, self._noise
        db_score = cluster.silhouette(labelled, "dbscan_label", keep_noise=False) if clusters >= 2 else 0.0
        own = labelled.select("features", F.col("cluster").alias("kmeans"), F.col("hc_label").alias("ward"),
                              F.when(F.col("dbscan_label") != density.NOISE, F.col("dbscan_label")).alias("dbscan"))
        exact = silhouette.euclidean_silhouettes(own, ["kmeans", "ward", "dbscan"])
        shares = [float(v) for v in cluster.pca(self.matrix)[1].explainedVariance]
        return self.matrix.sparkSession.createDataFrame(
            [(self.k, self._kmeans_silhouette, round(cluster.silhouette(labelled, "hc_label"), 4),
              clusters, noise, round(db_score, 4), *[round(exact[c], 4) for c in ("kmeans", "ward", "dbscan")], shares)],
            "k int, kmeans_silhouette double, ward_silhouette double, dbscan_clusters long, dbscan_outliers long, "
            "dbscan_silhouette double, kmeans_euclidean double, ward_euclidean double, dbscan_euclidean double, "
            "pca_explained array<double>")


def cluster_all(matrix: DataFrame, k: int, n_init: int = 10) -> tuple[DataFrame, DataFrame]:
    """Rows with all three cluster labels and names, and one row of metrics."""
    found = Clustering(matrix, k, n_init)
    return cluster.label_products(found.labelled), found.metrics


class Analysis:
    """A catalogue cleaned, scored, classified, clustered and mined; each part is computed once, when it is first asked for.

    The label is attached before the split, by key.
    """

    def __init__(self, products: DataFrame, forest: dict | None = None, boosting: dict | None = None,
                 k_max: int | None = None, n_init: int = 10):
        self.products, self.k_max, self.n_init = products, k_max, n_init
        self.kinds = {"random_forest": forest or {}, "boosted_trees": boosting or {}}

    @cached_property
    def cleaned(self) -> DataFrame:
        return stage(clean.clean(stage(self.products, "products")), "cleaned")

    @cached_property
    def scored(self) -> DataFrame:
        return stage(scoring.compute_scores(self.cleaned), "scored")

    @cached_property
    def _matrix(self) -> tuple[DataFrame, list[str]]:
        matrix, names = clean.feature_matrix(stage(clean.encode_labels(clean.engineer(self.scored)), "featured"))
        return stage(matrix.withColumn("label", F.col("is_top_product")), "matrix"), names

    @property
    def matrix(self) -> DataFrame:
        return self._matrix[0]

    @property
    def names(self) -> list[str]:
        return self._matrix[1]

    @cached_property
    def split(self) -> DataFrame:
        return stage(classify.stratified_split(self.matrix.select("product_id", "features", "label")), "split")

    def fitted(self, kind: str) -> tuple:
        """(model, one row of test metrics)."""
        return classify.train_and_evaluate(self.split, kind, **self.kinds[kind])

    def validated(self, kind: str) -> DataFrame:
        """One row: mean and spread of F1 over the folds of the training rows."""
        train = self.split.where(~F.col("is_test")).drop("is_test")
        return stage(classify.cross_validate_kind(train, kind, **self.kinds[kind]), "validated")

    @cached_property
    def _sweep(self) -> tuple[DataFrame, dict[int, lloyd.Fit]]:
        return cluster.sweep_fits(self.matrix, self.k_max, n_init=self.n_init)

    @cached_property
    def clustering(self) -> Clustering:
        sweep, fits = self._sweep
        best_k = sweep.where("best").first()["k"]
        return Clustering(self.matrix, best_k, self.n_init, lambda: fits[best_k])

    @cached_property
    def mined(self) -> DataFrame:
        """Rules between itemsets of all basket families."""
        banded = self.scored.withColumn("price_band", labels.price_band(F.col("price")))
        if "related_products" not in banded.columns:
            banded = banded.withColumn("related_products", F.lit(None).cast("string"))
        return stage(rules.mine_itemset_rules(banded), "rules")

    def write(self, folder: str, generated_at: str, k: int = 50, cross_validation: bool = True) -> dict[str, DataFrame]:
        """Everything, written out. What does not build on each other is computed at the same time."""
        scored, matrix, names, split = self.scored, self.matrix, self.names, self.split
        train, test = split.where(~F.col("is_test")), split.where("is_test")
        jobs = [partial(self.fitted, kind) for kind in self.kinds] + [lambda: self.clustering.metrics, lambda: self.mined]
        if cross_validation:
            jobs += [partial(self.validated, kind) for kind in self.kinds]
        (rf, rf_metrics), (gbt, gbt_metrics), cluster_metrics, mined, *validated = classify.at_once(scored.sparkSession, jobs)
        metrics = rf_metrics.unionByName(gbt_metrics)
        clustered = cluster.label_products(self.clustering.labelled)
        projected = cluster.project(clustered, cluster.pca(matrix)).select(
            "pc1", "pc2", "cluster", "cluster_label", "product_id", "title", "price", "score")
        outputs = {
            "df_clean": self.cleaned, "products_scored": scored, "top_k_products": scoring.select_top_k(scored, k),
            "shop_leaderboard": scoring.shop_leaderboard(scored), "supervised_metrics": metrics,
            "rf_feature_importance": classify.importances(rf, names, scored.sparkSession),
            "gbt_feature_importance": classify.importances(gbt, names, scored.sparkSession),
            "diagnostics": classify.diagnostics(rf, train, test, names),
            "elbow_curve": self._sweep[0], "clustering_metrics": cluster_metrics,
            "products_clustered": clustered.drop("features"), "cluster_profiles": cluster.name_clusters(clustered),
            "pca_2d": projected, "association_rules": mined, "top_rules": rules.top_rules(mined, 20, 0.0),
        }
        if validated:
            outputs["cross_validation"] = validated[0].unionByName(validated[1])
        outputs["summary"] = run_report(scored, k, names, metrics, cluster_metrics, mined)
        sinks.write_bundle(outputs, folder, generated_at)
        rf.write().overwrite().save(f"{folder}/models/random_forest")
        gbt.write().overwrite().save(f"{folder}/models/boosted_trees")
        return outputs


def analyse(
    products: DataFrame, folder: str, generated_at: str, k: int = 50, forest: dict | None = None,
    boosting: dict | None = None, k_max: int | None = None, n_init: int = 10, cross_validation: bool = True,
) -> dict[str, DataFrame]:
    """Clean, score, classify, cluster and mine a catalogue; write every output."""
    return Analysis(products, forest, boosting, k_max, n_init).write(folder, generated_at, k, cross_validation)


def run_report(
    scored: DataFrame, k: int, features: Iterable[str], metrics: DataFrame, cluster_metrics: DataFrame,
    mined: DataFrame,
) -> DataFrame:
    """One row: catalogue size, model quality, cluster metrics, rules."""
    quality = {r["model"]: r for r in metrics.collect()}
    grouped = cluster_metrics.first()
    found = bi.rule_kpis(mined).first()
    return scored.agg(
        F.count("*").alias("total_products"), F.lit(k).alias("top_k"),
        F.lit(len(list(features))).alias("features_used"),
        *[F.lit(float(row[m])).alias(f"{name}_{m}") for name, row in quality.items() for m in ("f1", "accuracy")],
        F.lit(grouped["k"]).alias("clusters"), F.lit(grouped["kmeans_silhouette"]).alias("kmeans_silhouette"),
        F.lit(grouped["dbscan_outliers"]).alias("dbscan_outliers"),
        F.lit(found["rules"]).alias("total_rules"), F.lit(float(found["max_lift"] or 0)).alias("top_lift"),
    )


def enrich_catalogue(
    scored: DataFrame, folder: str, day: str, clustered: DataFrame | None = None, mined: DataFrame | None = None,
    max_summaries: int = 50, completion: enrich.Completion | None = None,
) -> DataFrame:
    """Product summaries as JSON lines, three reports, and a one-row summary."""
    order = [F.desc("score"), F.asc("product_id")]
    described = scored if "description" in scored.columns else scored.withColumn("description", F.lit(""))
    if "currency" not in described.columns:
        described = described.withColumn("currency", F.lit("USD"))
    summarised = enrich.batch_summarize(described, order, max_summaries, completion)
    sinks.write_jsonl(summarised, f"{folder}/enriched_products")
    top = scoring.select_top_k(scored, 20)
    reports = {
        "trend_report": (f"Catalogue trends, {day}", enrich.trend_context(scored)),
        "client_profile": ("Who buys the top products", enrich.persona_context(top)),
        "marketing_strategy": ("What to promote next",
                               enrich.strategy_context(scored if clustered is None else clustered, mined)),
    }
    texts = {}
    for name, (title, prompt) in reports.items():
        done = stage(enrich.complete(prompt, completion), name)
        sinks.write_report(done, title, f"{folder}/{name}")
        texts[name] = done.first()["completion"][:200] + "..."
    written = scored.sparkSession.read.json(f"{folder}/enriched_products")
    return written.agg(
        F.count_if(F.col("summary") != "").alias("summaries_count"),
        *[F.lit(text).alias(name) for name, text in texts.items()])
