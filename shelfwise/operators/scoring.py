"""Composite score, ranks, labels, Top-K and the shop leaderboard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions import hashing
from shelfwise.operators.stats import (
    SLICES, even_slices, exact_quantiles, known, min_max, min_max_scaled, scalars,
)

# Weights of the composite score.
WEIGHTS = {
    "rating": 0.35, "reviews": 0.25, "price_comp": 0.15,
    "discount": 0.10, "availability": 0.10, "stock": 0.05,
}
# Brands that earn the fallback bonus.
BONUS_BRANDS = ["glossier", "banish", "drunk elephant", "chanel", "dior", "fenty"]


def _inputs(df: DataFrame) -> DataFrame:
    """Score inputs as extra columns ``_rating`` .. ``_stock``."""
    available = F.lower(F.col("availability").cast("string"))
    return df.withColumns({
        "_rating": F.coalesce(F.col("rating").cast("double"), F.lit(0.0)),
        "_reviews": F.log1p(F.coalesce("review_count", F.lit(0))),
        "_price": F.greatest(F.col("price"), F.lit(0.0)),
        "_discount": F.coalesce(F.col("discount_pct").cast("double"), F.lit(0.0)),
        "_stock": F.col("stock_quantity").cast("double"),
        "_available": F.when(available.isin("false", "0"), 0).otherwise(1),
    })


def telemetry_flag(df: DataFrame) -> DataFrame:
    """One row: does any product carry real reviews, and any a real rating?"""
    return df.agg(
        (F.coalesce(F.max((F.col("review_count") > 2).cast("int")), F.lit(0)).cast("boolean")
         & F.coalesce(F.max((~F.col("rating").eqNullSafe(F.lit(3.5))).cast("int")), F.lit(0)).cast("boolean"))
        .alias("has_telemetry")
    )


def fallback_points(df: DataFrame, noise: bool = True) -> DataFrame:
    """Points from discount, brand, price and category, before rescaling."""
    price = scalars(min_max(df, ["price"]))
    brand = F.lower(F.coalesce("brand", F.lit(""))).rlike("|".join(BONUS_BRANDS))
    points = (
        F.coalesce(F.col("discount_pct").cast("double"), F.lit(0.0)) * 0.4
        + F.when(brand, 30).otherwise(0)
        + (1 - min_max_scaled(F.col("price"), price["price_min"], price["price_max"])) * 20
        + F.when(F.col("category") == "Skincare", 10).otherwise(0)
    )
    if noise:
        points = points + hashing.hash_unit(F.col("product_id"), "score") * 5
    return df.withColumn("_points", points)


def fallback_score(df: DataFrame, noise: bool = True) -> DataFrame:
    """Score on 0..1 for catalogues without ratings and reviews."""
    pointed = fallback_points(df, noise)
    best = scalars(pointed.agg(F.max("_points").alias("best")))["best"]
    points = F.col("_points")
    hundred = points / F.lit(best) * 100 if best is not None and best > 0 else points
    return pointed.withColumn("score", F.round(hundred, 2) / 100.0).drop("_points")


def weighted_score(df: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Weighted sum of min-max scaled inputs, 4 decimals; low prices score high."""
    w = weights or WEIGHTS
    prepared = _inputs(df)
    b = scalars(min_max(prepared, ["_rating", "_reviews", "_price", "_discount", "_stock"]))

    def norm(name: str) -> Column:
        return min_max_scaled(F.col(name), b[f"{name}_min"], b[f"{name}_max"])

    total = (
        F.lit(w["rating"]) * norm("_rating")
        + F.lit(w["reviews"]) * norm("_reviews")
        + F.lit(w["price_comp"]) * (1 - norm("_price"))
        + F.lit(w["discount"]) * norm("_discount")
        + F.lit(w["availability"]) * F.col("_available")
        + F.lit(w["stock"]) * norm("_stock")
    )
    return prepared.withColumn("score", F.round(total, 4)).select(*df.columns, "score")


def rank_and_label(df: DataFrame, top_share: float = 0.2) -> DataFrame:
    """``score_rank`` (ties share the best rank) and the top-share label.

    Equal scores merge into a histogram; ranks are counted in slices of it and
    looked up by score, so there is no global window over rows or scores.
    """
    histogram = df.where(F.col("score").isNotNull()).groupBy("score").agg(F.count("*").alias("_n"))
    threshold = known(scalars(exact_quantiles(df, {"t": ("score", 1 - top_share)}))["t"])
    slot = even_slices(histogram, "score", SLICES)
    sliced = histogram.withColumn("_s", slot)
    higher_slices = Window.orderBy(F.desc("_s")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sliced.groupBy("_s").agg(F.sum("_n").alias("_size")).select(  # one row a slice
        "_s", F.coalesce(F.sum("_size").over(higher_slices), F.lit(0)).alias("_offset"))
    higher = Window.partitionBy("_s").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    ranks = sliced.withColumn("_inside", F.coalesce(F.sum("_n").over(higher), F.lit(0))).join(offsets, "_s").select(
        F.col("score").alias("_score"), (F.col("_offset") + F.col("_inside") + 1).cast("int").alias("score_rank"),
        (F.col("score") >= threshold).cast("int").alias("is_top_product"),
    )
    keep = [c for c in df.columns if c not in ("score_rank", "is_top_product")]
    return df.join(ranks, df["score"] == ranks["_score"], "left").select(
        *[df[c] for c in keep], "score_rank", "is_top_product"
    )


def compute_scores(
    df: DataFrame, weights: dict[str, float] | None = None, mode: str = "auto"
) -> DataFrame:
    """Scored catalogue. ``mode``: "auto" asks the data which score applies."""
    if mode == "auto":
        mode = "weighted" if telemetry_flag(df).first()["has_telemetry"] else "fallback"
    scored = weighted_score(df, weights) if mode == "weighted" else fallback_score(df)
    return rank_and_label(scored)


def best_first(key: str = "score") -> list[Column]:
    return [F.desc_nulls_last(key), F.asc("product_id")]


def top_n(df: DataFrame, n: int, key: str = "score") -> DataFrame:
    """First ``n`` products by any key, numbered from 1 (a distributed top-k, no full sort)."""
    cut = df.orderBy(*best_first(key)).limit(n)
    return cut.withColumn("rank", F.row_number().over(Window.orderBy(*best_first(key))))


def select_top_k(df: DataFrame, k: int = 50) -> DataFrame:
    return top_n(df, k, "score")


def _best_of(df: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Best-scored row per group as ``best``.

    The best score per group is a hash aggregation; only the rows that reach
    it meet the tie-break, which needs a sort.
    """
    rows = df.where(F.col("score").isNotNull())
    peak = rows.groupBy(*keys).agg(F.max("score").alias("_peak"))
    tied = rows.join(peak, keys).where(F.col("score") == F.col("_peak"))
    return tied.groupBy(*keys).agg(F.min_by(F.struct(*fields), F.col("product_id")).alias("best"))


def best_per_category(df: DataFrame, n: int | None = 6) -> DataFrame:
    """Best product of each category; the first ``n`` categories by name."""
    named = df.where(F.col("category").isNotNull())
    if n is not None:
        first = named.select("category").distinct().orderBy("category").limit(n)
        named = named.join(F.broadcast(first), "category", "left_semi")  # n rows
    best = _best_of(named, ["category"], ["product_id", "title", "price", "score"])
    return best.select("category", "best.*").orderBy("category")


def shop_stats(df: DataFrame) -> DataFrame:
    """Average score and rating and product count of every shop."""
    return (
        df.where(F.col("shop_name").isNotNull() & F.col("shop_country").isNotNull())
        .groupBy("shop_name", "shop_country")
        .agg(F.avg("score").alias("avg_score"), F.count("title").alias("product_count"),
             F.avg("rating").alias("avg_rating"))
    )


def shop_leaderboard(df: DataFrame, n: int = 10, decimals: int = 6) -> DataFrame:
    """Best shops by average score (rounded, so that ties break by name).

    The best product is looked up for the ``n`` winning shops only.
    """
    keys = ["shop_name", "shop_country"]
    stats = shop_stats(df).withColumns({
        "avg_score": F.round("avg_score", decimals), "avg_rating": F.round("avg_rating", decimals),
    })
    winners = stats.orderBy(F.desc("avg_score"), *keys).limit(n)
    theirs = df.join(F.broadcast(winners.select(*keys)), keys, "left_semi")
    best = _best_of(theirs, keys, ["title"]).select(*keys, F.col("best.title").alias("top_product"))
    return winners.join(F.broadcast(best), keys, "left").orderBy(F.desc("avg_score"), *keys)
