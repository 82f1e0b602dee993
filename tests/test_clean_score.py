import pytest
from pyspark.sql import functions as F

from shelfwise.operators import bi, clean, dedup, scoring, stats
from shelfwise.plans import catalogue


def test_product_ids(spark):
    df = spark.createDataFrame([("7.1E+12",), ("1234567890123456789",), ("x",), (None,), ("12.9",)], "product_id string")
    assert [r.product_id for r in clean.repair_product_id(df).collect()] == [
        "7100000000000", "1234567890123456789", "Unknown", "Unknown", "12"]


def test_numeric_imputation(spark):
    df = spark.createDataFrame(
        [(1.0, 4.0, 5, 120.0, 10.0, 2), (3.0, None, None, -4.0, None, None), (float("inf"), 2.0, -3, None, 20.0, 1)],
        "price double, rating double, review_count int, discount_pct double, stock_quantity double, variant_count int")
    rows = clean.impute_numeric(df).collect()
    assert [r.price for r in rows] == [1.0, 3.0, 2.0] and [r.rating for r in rows] == [4.0, 3.0, 2.0]
    assert [r.review_count for r in rows] == [5, 0, 0] and [r.discount_pct for r in rows] == [100.0, 0.0, 0.0]
    assert [r.stock_quantity for r in rows] == [10.0, 15.0, 20.0] and [r.variant_count for r in rows] == [2, 1, 1]


def test_all_missing_ratings_fall_back(spark):
    df = spark.createDataFrame([(1.0, None, 1, 0.0, None, 1)],
                               "price double, rating double, review_count int, discount_pct double, "
                               "stock_quantity double, variant_count int")
    row = clean.impute_numeric(df).first()
    assert row.rating == 3.5 and row.stock_quantity == 0.0


def test_flat_ratings_gate(spark):
    flat = spark.createDataFrame([(3.0,)] * 10 + [(None,)] * 5 + [(4.0,)], "rating double")
    mixed = spark.createDataFrame([(3.0,)] * 5 + [(4.0,)] * 5, "rating double")
    assert clean.ratings_are_flat(flat) and not clean.ratings_are_flat(mixed)


def test_clean_invariants(spark, folder):
    rows = catalogue.cleaned(spark, folder)
    row = rows.agg(F.count("*").alias("n"), F.min("price").alias("p"), F.min("rating").alias("r"),
                   F.count_if(F.col("category").isNull()).alias("c")).first()
    assert row.n > 0 and row.p > 0 and row.r >= 1 and row.c == 0


def test_scaled_features_stay_in_unit_range(spark, folder):
    from pyspark.ml.functions import vector_to_array

    x = vector_to_array("features")
    row = catalogue.matrix(spark, folder).agg(
        F.min(F.array_min(x)).alias("lo"), F.max(F.array_max(x)).alias("hi")).first()
    assert row.lo >= 0 and row.hi <= 1 + 1e-9


def test_constant_feature_scales_to_zero(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 3.0)], "a double, b double")
    assert [tuple(r) for r in clean.scale_features(df, ["a", "b"]).collect()] == [(0.0, 0.0), (0.0, 1.0)]


def test_scores(spark, folder):
    scored = catalogue.scored(spark, folder)
    row = scored.agg(F.min("score").alias("lo"), F.max("score").alias("hi"), F.sum("is_top_product").alias("top")).first()
    assert 0 <= row.lo and row.hi <= 1 and row.top > 0
    top = [r.score for r in scoring.select_top_k(scored, 20).orderBy("rank").collect()]
    assert len(top) == 20 and top == sorted(top, reverse=True)


def test_ranks_share_the_minimum(spark):
    df = spark.createDataFrame([(1, 0.5), (2, 0.9), (3, 0.5), (4, 0.1), (5, None)], "product_id int, score double")
    ranks = {r.product_id: (r.score_rank, r.is_top_product) for r in scoring.rank_and_label(df).collect()}
    assert ranks == {2: (1, 1), 1: (2, 0), 3: (2, 0), 4: (4, 0), 5: (None, None)}


def test_fallback_is_chosen_without_telemetry(spark, folder):
    bare = catalogue.cleaned(spark, folder).withColumns({"review_count": F.lit(0), "rating": F.lit(3.5)})
    row = scoring.compute_scores(bare).agg(F.max("score").alias("hi"), F.min("score").alias("lo")).first()
    assert row.hi == 1.0 and row.lo >= 0


def test_quantiles_interpolate(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "a"), (4.0, "b"), (10.0, None), (None, "b")], "x double, k string")
    row = stats.exact_quantiles(df, {"p": ("x", 0.8), "m": ("x", 0.5)}).first()
    assert row.p == pytest.approx(6.4) and row.m == 3.0


def test_ordered_position_over_slices(spark):
    import random

    rng = random.Random(1)
    rows = [("hot" if rng.random() < 0.7 else "cold", rng.randrange(10_000), i) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, x long, i long")
    got = stats.ordered_position(df, ["k"], stats.even_slices(df, "x", 16), [F.col("x"), F.col("i")])
    for k in ("hot", "cold"):
        want = [i for _, _, i in sorted((r for r in rows if r[0] == k), key=lambda r: (r[1], r[2]))]
        assert [r.i for r in got.where(F.col("k") == k).orderBy("pos").collect()] == want


def test_filters_fall_back(spark, folder):
    scored = catalogue.scored(spark, folder)
    assert clean.filter_or_all(scored, category="nope").count() == scored.count()
    assert clean.filter_or_all(scored, platform="shopify").count() < scored.count()
    assert clean.filter_catalog(scored, category="nope").count() == 0


def test_dedup(spark):
    df = spark.createDataFrame([(1, "A", 10.0, "shopify"), (2, "A", 10.0, "shopify"), (3, "B", 20.0, "woocommerce"),
                                (4, None, None, "x"), (5, None, None, "x")],
                               "seq long, title string, price double, platform string")
    assert sorted(r.seq for r in dedup.keep_first(df).collect()) == [1, 3, 4]
    assert sorted(r.seq for r in dedup.keep_last(df, dedup.RUN_KEYS).collect()) == [2, 3, 5]


def test_box_outliers(spark):
    df = spark.createDataFrame([("a", float(x)) for x in [*range(1, 12), 100]] + [("b", 1.0)], "category string, price double")
    box = {r.category: r for r in bi.box_stats(df).collect()}
    assert box["a"].outliers == 1 and box["a"].whisker_high == 11.0 and box["b"].outliers == 0
    assert [r.price for r in bi.box_outliers(df).collect()] == [100.0]


def test_quadrants_cover_all(spark, folder):
    scored = catalogue.scored(spark, folder)
    counts = {r.quadrant: r["count"] for r in bi.quadrant_counts(scored).collect()}
    assert sum(counts.values()) == scored.count() and set(counts) <= set(bi.QUADRANTS.values())
