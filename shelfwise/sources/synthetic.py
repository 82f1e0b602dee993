"""Generated demo catalogue, used when a run has no output yet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions import hashing
from shelfwise.operators.scoring import rank_and_label

CATEGORIES = ["Audio", "Garden", "Kitchen", "Outdoor", "Stationery", "Lighting", "Pets"]
SHOPS = ["Northwind Corner", "Green Barn", "Lantern Street", "Quill and Co", "Harbour Goods"]
COUNTRIES = ["USA", "IT", "FR", "DE", "SE"]
PLATFORMS = ["shopify", "woocommerce"]
DISCOUNTS = [0.0, 0.0, 0.0, 10.0, 20.0, 30.0, 50.0]
# Segment names.
SEGMENTS = ["Premium", "Top rated", "Discount / Promo", "Niche / peu connu", "Mainstream"]


def _unit(salt: str, seed: int) -> Column:
    return hashing.hash_unit(F.col("id"), f"{salt}{seed}")


def _choice(values: list, salt: str, seed: int) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (hashing.hash_pick(F.col("id"), len(values), f"{salt}{seed}") + 1).cast("int"))


def synthetic_products(spark: SparkSession, n: int = 300, seed: int = 42) -> DataFrame:
    """``n`` products: lognormal price, uniform rating, value-list columns, score, rank and top-share label.

    Every draw is a hash of the id, so the values do not depend on partitions.
    """
    bell = F.sqrt(-2 * F.log(_unit("a", seed) * 0.999999 + 0.000001)) * F.cos(2 * F.pi() * _unit("b", seed))
    price = F.least(F.lit(500.0), F.greatest(F.lit(2.0), F.exp(3.5 + 0.8 * bell)))
    base = spark.range(1, n + 1).select(
        F.col("id").cast("string").alias("product_id"),
        F.concat(F.lit("Product "), F.col("id").cast("string")).alias("title"),
        _choice(CATEGORIES, "category", seed).alias("category"),
        _choice(PLATFORMS, "platform", seed).alias("platform"),
        F.round(price, 2).alias("price"),
        _choice(DISCOUNTS, "discount", seed).alias("discount_pct"),
        F.round(2.5 + 2.5 * _unit("rating", seed), 1).alias("rating"),
        F.floor(_unit("reviews", seed) * 3000).alias("review_count"),
        (_unit("available", seed) < 0.85).alias("availability"),
        F.floor(_unit("stock", seed) * 200).alias("stock_quantity"),
        _choice(SHOPS, "shop", seed).alias("shop_name"),
        _choice(COUNTRIES, "country", seed).alias("shop_country"),
        _choice(SEGMENTS, "segment", seed).alias("cluster_label"),
        F.floor(1 + 5 * _unit("variants", seed)).cast("int").alias("variant_count"),
    )
    score = (
        0.35 * (F.col("rating") - 2.5) / 2.5
        + 0.25 * F.log1p("review_count") / F.log1p(F.lit(3000))
        + 0.15 * (1 - (F.col("price") - 2) / 498)
        + 0.10 * F.col("discount_pct") / 50
        + 0.10
        + 0.05 * F.col("stock_quantity") / 200
    )
    discounted = F.col("discount_pct") > 0
    return rank_and_label(base.select(
        "*",
        F.when(discounted, F.round(F.col("price") * (1 - F.col("discount_pct") / 100), 2)).alias("price_promo"),
        F.when(discounted, F.col("price")).alias("price_old"),
        F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), score)), 4).alias("score"),
    ))
