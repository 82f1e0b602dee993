import numpy as np
from pyspark.sql import functions as F

from shelfwise.operators import cluster, density, hierarchy, rules, silhouette
from shelfwise.plans import catalogue, derived, runs


def test_ingest(spark, folder, tmp_path):
    payloads = {"shopify": derived.shopify_pages(spark, folder), "woocommerce": derived.woo_pages(spark, folder)}
    out = runs.ingest(payloads, str(tmp_path), "2024-01-01T00:00:00", "a")
    n = catalogue.products(spark, folder).count()
    copies = out["snapshot"].groupBy("title", "price", "platform").count().where("count > 1").count()
    assert copies == 0 and n <= out["snapshot"].count() <= 2 * n
    again = runs.ingest(payloads, str(tmp_path), "2024-01-02T00:00:00", "b", history=out["history"])
    assert again["history"].count() == 2 * out["history"].count()
    same = runs.ingest(payloads, str(tmp_path), "2024-01-02T00:00:00", "c", history=again["history"])
    assert same["history"].count() == again["history"].count()
    for i, day in enumerate(("2024-01-01", "2024-01-02", "2024-01-02")):
        kept = runs.ingest(payloads, str(tmp_path), f"{day}T00:00:00", f"d{i}", history=str(tmp_path / "kept"), buckets=8)["history"]
    columns = sorted(kept.columns)
    assert sorted(columns) == sorted(same["history"].columns)
    assert kept.select(columns).exceptAll(same["history"].select(columns)).count() == 0 and kept.count() == same["history"].count()


def test_analysis_run(spark, folder, tmp_path):
    out = runs.analyse(catalogue.products(spark, folder), str(tmp_path), "now", k=10, forest={"trees": 5},
                       boosting={"rounds": 2, "depth": 2}, k_max=3, n_init=1, cross_validation=False)
    manifest = {r.dataset: r.rows for r in spark.read.json(str(tmp_path / "manifest")).collect()}
    assert manifest["top_k_products"] == 10 and manifest["summary"] == 1
    assert manifest["products_clustered"] == manifest["products_scored"] == manifest["pca_2d"]
    summary = spark.read.parquet(str(tmp_path / "summary")).first()
    assert summary.total_products == manifest["products_scored"] and summary.features_used == 12
    assert set(out) <= set(manifest) and (tmp_path / "models/random_forest").exists()


def test_enrichment_run(spark, folder, tmp_path):
    scored = catalogue.scored(spark, folder)
    row = runs.enrich_catalogue(scored, str(tmp_path), "2024-01-01", max_summaries=7).first()
    assert row.summaries_count == 7 and row.trend_report.startswith("Trend note")
    text = "".join(p.read_text() for p in (tmp_path / "client_profile").glob("part-*"))
    assert text.startswith("# Who buys the top products\n\n")


def test_failing_completions_become_blank(spark):
    from shelfwise.operators import enrich

    def picky(prompts):
        if (prompts == "bad").any():
            raise ValueError("no")
        return prompts + "!"

    df = spark.createDataFrame([(1, "good"), (2, "bad")], "id int, prompt string").coalesce(1)
    assert {r.id: r.completion for r in enrich.complete(df, picky).collect()} == {1: "good!", 2: ""}
    assert enrich.complete(df).where(F.col("completion") == "").count() == 0


def _never(*args, **kwargs):
    raise AssertionError("not needed here")


def test_rules_need_no_model(spark, folder, monkeypatch):
    """The rules of a run come from the scored products alone; before, the query ran the whole analysis."""
    from shelfwise.operators import classify, cluster
    from shelfwise.plans.queries import QUERIES

    for module, name in ((classify, "train_and_evaluate"), (classify, "cross_validate_kind"), (cluster, "sweep_fits")):
        monkeypatch.setattr(module, name, _never)
    rows = catalogue.scored(spark, folder).select("product_id")
    found = QUERIES["analysis_rules"](spark, folder)
    assert found.columns == rules.RULE_COLUMNS and found.count() > 0 and rows.count() > 0


def test_labels_of_one_clustering_need_no_other(spark, folder, monkeypatch):
    """DBSCAN needs no k, and Ward no DBSCAN; before, each query computed all clusterings and silhouettes."""
    rows = catalogue.matrix(spark, folder).select("product_id", "features")
    monkeypatch.setattr(silhouette, "euclidean_silhouettes", _never)
    only = runs.Clustering(rows, _never)
    assert only.dbscan().select("product_id", "dbscan_label").count() == rows.count()
    monkeypatch.setattr(density, "point_labels", _never)
    ward = runs.Clustering(rows, lambda: 3).ward()
    assert ward.select("hc_label").distinct().count() == 3 and ward.count() == rows.count()


def test_report_needs_neither_ward_nor_silhouettes_of_pairs(spark, folder, monkeypatch):
    rows = catalogue.matrix(spark, folder).select("product_id", "features")
    monkeypatch.setattr(silhouette, "euclidean_silhouettes", _never)
    monkeypatch.setattr(hierarchy, "point_labels", _never)
    found = runs.Clustering(rows, 3, n_init=2).headline().first()
    assert found.k == 3 and -1 <= found.kmeans_silhouette <= 1 and 0 <= found.dbscan_outliers <= rows.count()


def test_best_k_is_not_fitted_again(spark, folder, monkeypatch):
    """The sweep's own fit labels the rows; it is the one that a second fit gave."""
    rows = catalogue.matrix(spark, folder).select("product_id", "features")
    sweep, fits = cluster.sweep_fits(rows, 3, n_init=2)
    again = cluster.best_kmeans(rows, 3, 2)
    assert np.allclose(again.centres, fits[3].centres) and sorted(fits) == [2, 3] and sweep.count() == 2
    monkeypatch.setattr(cluster, "best_kmeans", _never)
    found = runs.Clustering(rows, 3, 2, lambda: fits[3]).kmeans
    assert found.select("cluster").distinct().count() == 3
