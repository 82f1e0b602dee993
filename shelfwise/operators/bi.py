"""Aggregates behind the dashboard pages, reports and run summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.clean import filter_catalog
from shelfwise.operators.scoring import shop_stats, top_n
from shelfwise.operators.stats import cell, exact_quantiles, grouped_quantiles, known, scalars, value_counts

MARKET_MEASURES = ["price", "rating", "review_count", "score"]
ANOMALY_LABEL = "Anomalie (DBSCAN)"


def _share(condition: Column) -> Column:
    """Share of rows for which the condition holds; null counts as no."""
    return F.avg(F.coalesce(condition, F.lit(False)).cast("int"))


def _whole_percent(condition: Column) -> Column:
    return F.floor(_share(condition) * 100).cast("bigint")


def market_stats(df: DataFrame, group_by: str = "category") -> DataFrame:
    """Mean measures and row count per key; an unknown key falls back to category."""
    key = group_by if group_by in df.columns else "category"
    means = [F.round(F.avg(c), 3).alias(c) for c in MARKET_MEASURES if c in df.columns]
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*means, F.count("*").alias("count"))


def cluster_profile(df: DataFrame, decimals: int = 3) -> DataFrame:
    measures = ["price", "rating", "review_count", "discount_pct", "score"]
    means = [F.round(F.avg(c), decimals).alias(c) for c in measures if c in df.columns]
    return df.where(F.col("cluster_label").isNotNull()).groupBy("cluster_label").agg(
        *means, F.count("*").alias("count")
    )


def overview_kpis(df: DataFrame) -> DataFrame:
    median = scalars(exact_quantiles(df, {"price": ("price", 0.5)}))["price"]
    return df.agg(
        F.count("*").alias("total_products"),
        F.round(F.avg("score"), 4).alias("avg_score"),
        known(median).alias("median_price"),
        F.round(F.avg("rating"), 4).alias("avg_rating"),
        _whole_percent(F.col("is_top_product") == 1).alias("top_pct"),
        _whole_percent(F.col("discount_pct") > 0).alias("on_sale_pct"),
    )


def top_k_kpis(eligible: DataFrame, shown: DataFrame) -> DataFrame:
    """KPIs over the shown rows next to the size of the eligible set."""
    n = eligible.count()
    return shown.agg(
        F.lit(n).cast("bigint").alias("eligible_products"),
        F.max("score").alias("top_score"),
        F.round(F.avg("price"), 4).alias("avg_price"),
        F.round(F.avg("rating"), 4).alias("avg_rating"),
        _whole_percent(F.col("discount_pct") > 0).alias("on_sale_pct"),
    )


def cluster_kpis(df: DataFrame) -> DataFrame:
    sizes = value_counts(df, "cluster_label")
    return sizes.agg(
        F.count("*").alias("clusters"),
        F.max("count").alias("largest"),
        F.min_by("cluster_label", F.struct(-F.col("count"), F.col("cluster_label"))).alias("largest_name"),
        F.min("count").alias("smallest"),
        F.sum("count").alias("total"),
        F.coalesce(F.sum(F.when(F.col("cluster_label") == ANOMALY_LABEL, F.col("count"))), F.lit(0))
        .alias("anomalies"),
    )


def pricing_kpis(df: DataFrame) -> DataFrame:
    discounted = F.col("discount_pct") > 0
    return df.agg(
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.round(F.avg("price"), 4).alias("mean_price"),
        F.count_if(discounted).alias("on_sale"),
        F.round(F.avg(F.when(discounted, F.col("discount_pct"))), 4).alias("avg_discount"),
        F.max("discount_pct").alias("max_discount"),
    )


def rule_kpis(rules: DataFrame) -> DataFrame:
    return rules.agg(
        F.count("*").alias("rules"), F.max("lift").alias("max_lift"),
        F.max("confidence").alias("max_confidence"), F.max("support").alias("max_support"),
    )


def shop_kpis(df: DataFrame) -> DataFrame:
    shops = shop_stats(df)
    countries = df.agg(F.count_distinct("shop_country").alias("n")).first()["n"]
    return shops.agg(
        F.count("*").alias("shops"),
        F.round(F.max("avg_score"), 6).alias("best_score"),
        F.round(F.avg("avg_score"), 6).alias("avg_shop_score"),
        F.max("product_count").alias("largest_shop"),
        F.lit(countries).cast("bigint").alias("countries"),
    )


def distribution(df: DataFrame, key: str) -> DataFrame:
    return value_counts(df, key, share=True)


def most_frequent(df: DataFrame, key: str, n: int) -> DataFrame:
    return value_counts(df, key).orderBy(F.desc("count"), key).limit(n)


def histogram(
    df: DataFrame, column: str, bins: int, low: float, high: float, by: str | None = None
) -> DataFrame:
    """Rows per equal-width bin (the last bin is closed), optionally per series."""
    width = (high - low) / bins
    x = F.col(column)
    slot = F.least(F.lit(bins - 1), F.floor((x - low) / F.lit(width))).cast("int")
    keys = [by] if by else []
    return (
        df.where(x.between(low, high))
        .groupBy(*keys, slot.alias("bin"))
        .agg(F.count("*").alias("count"))
    )


def score_histogram(df: DataFrame) -> DataFrame:
    return histogram(df, "score", 40, 0.0, 1.0, by="platform")


def discount_histogram(df: DataFrame) -> DataFrame:
    return histogram(df.where(F.col("discount_pct") > 0), "discount_pct", 20, 0.0, 100.0)


def box_stats(df: DataFrame, key: str = "category", column: str = "price") -> DataFrame:
    """Quartiles, 1.5 IQR whiskers and outlier counts per group.

    Works on the (group, value) histogram throughout, so a group that holds
    most rows is merged map-side before anything is shuffled.
    """
    rows = df.where(F.col(key).isNotNull() & F.col(column).isNotNull())
    cells = rows.groupBy(key, column).agg(F.count("*").alias("_n"))
    quartiles = grouped_quantiles(rows, [key], column, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    iqr = F.col("q3") - F.col("q1")
    inside = F.col(column).between(F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr)
    return cells.join(quartiles, key).groupBy(key, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col(column))).alias("whisker_low"),
        F.max(F.when(inside, F.col(column))).alias("whisker_high"),
        F.sum("_n").alias("count"),
        F.coalesce(F.sum(F.when(~inside, F.col("_n"))), F.lit(0)).alias("outliers"),
    )


def box_outliers(df: DataFrame, key: str = "category", column: str = "price") -> DataFrame:
    """The rows outside the whiskers of their group."""
    box = box_stats(df, key, column).select(key, "whisker_low", "whisker_high")
    joined = df.where(F.col(column).isNotNull()).join(box, key)
    return joined.where(~F.col(column).between(F.col("whisker_low"), F.col("whisker_high"))).drop(
        "whisker_low", "whisker_high"
    )


def price_by_platform(df: DataFrame) -> DataFrame:
    rows = df.where(F.col("platform").isNotNull())
    means = rows.groupBy("platform").agg(
        F.count("price").alias("count"), F.round(F.avg("price"), 2).alias("mean"),
        F.min("price").alias("min"), F.max("price").alias("max"),
    )
    medians = grouped_quantiles(rows, ["platform"], "price", {"median": 0.5})
    return means.join(medians, "platform", "left").select(
        "platform", "count", "mean", F.round("median", 2).alias("median"),
        F.round("min", 2).alias("min"), F.round("max", 2).alias("max"),
    )


def price_by_category(df: DataFrame, n: int = 10) -> DataFrame:
    rows = df.where(F.col("category").isNotNull())
    means = rows.groupBy("category").agg(
        F.count("price").alias("count"), F.round(F.avg("price"), 2).alias("mean")
    )
    medians = grouped_quantiles(rows, ["category"], "price", {"median": 0.5})
    return (
        means.join(medians, "category", "left")
        .select("category", "count", "mean", F.round("median", 2).alias("median"))
        .orderBy(F.desc("mean"), "category").limit(n)
    )


def discounted_share(df: DataFrame) -> DataFrame:
    return df.agg(F.round(_share(F.col("discount_pct") > 0) * 100, 1).alias("pct_discounted"))


def alerts(df: DataFrame, stock_below: int = 5, discount_above: int = 40) -> DataFrame:
    return df.agg(
        F.count_if(F.col("stock_quantity") < stock_below).alias("low_stock"),
        F.count_if(F.col("discount_pct") > discount_above).alias("high_discount"),
    )


def country_scores(df: DataFrame) -> DataFrame:
    return df.where(F.col("shop_country").isNotNull()).groupBy("shop_country").agg(
        F.round(F.avg("score"), 6).alias("avg_score")
    )


def run_summary(df: DataFrame) -> DataFrame:
    """One row on a catalogue snapshot: size, price range, ratings."""
    return df.agg(
        F.count("*").alias("rows"),
        F.lit(len(df.columns)).cast("bigint").alias("columns"),
        F.min("price").alias("price_min"), F.round(F.avg("price"), 2).alias("price_mean"),
        F.max("price").alias("price_max"), F.round(F.avg("rating"), 2).alias("rating_mean"),
        F.count("rating").alias("rated"),
    )



def trend_stats(df: DataFrame) -> DataFrame:
    """One row of market figures, with the platform counts as a map."""
    platforms = value_counts(df, "platform").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("platform", "count")))).alias("platforms")
    )
    figures = df.agg(
        F.count("*").alias("total_products"),
        F.round(F.avg("score"), 3).alias("avg_score"),
        F.round(F.avg("price"), 2).alias("avg_price"),
        F.round(F.avg("rating"), 2).alias("avg_rating"),
        F.round(_share(F.col("discount_pct") > 0) * 100, 1).alias("pct_on_sale"),
    )
    return figures.select("*", cell(platforms).alias("platforms"))


def persona_stats(top: DataFrame, n_categories: int = 3) -> DataFrame:
    """Dominant categories and price and rating range of a Top-K table."""
    leading = most_frequent(top, "category", n_categories).agg(
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct(-F.col("count"), F.col("category")))),
                        lambda x: x["category"]), ", ").alias("top_categories")
    )
    figures = top.agg(
        F.round(F.min("price"), 2).alias("price_min"), F.round(F.max("price"), 2).alias("price_max"),
        F.round(F.avg("rating"), 1).alias("avg_rating"),
    )
    return figures.select("*", cell(leading).alias("top_categories"))


def qa_stats(df: DataFrame) -> DataFrame:
    median = scalars(exact_quantiles(df, {"price": ("price", 0.5)}))["price"]
    return df.agg(
        F.count("*").alias("total_products"),
        F.round(F.avg("score"), 3).alias("avg_score"),
        F.round(known(median), 2).alias("median_price"),
        F.round(F.avg("rating"), 1).alias("avg_rating"),
    )


def insights(df: DataFrame) -> DataFrame:
    """Quartile signals and the leading category."""
    q = scalars(exact_quantiles(df, {
        "p25": ("price", 0.25), "p50": ("price", 0.5), "r75": ("rating", 0.75)}))
    return most_frequent(df, "category", 1).select(
        F.col("category").alias("top_category"), F.col("count").alias("top_category_count"),
        known(q["p25"]).alias("price_p25"), known(q["p50"]).alias("price_median"),
        known(q["r75"]).alias("rating_p75"),
    )


def domain(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values, for filter widgets."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def domain_stats(df: DataFrame) -> DataFrame:
    return df.agg(
        F.min("price").alias("price_min"), F.max("price").alias("price_max"),
        F.count("*").alias("products"),
        F.count_distinct("shop_name").alias("shops"),
        F.count_distinct("category").alias("categories"),
    )


def shop_totals(report: DataFrame) -> DataFrame:
    """Product total per shop from its report rows."""
    return report.groupBy("base_url").agg(F.coalesce(F.sum("total"), F.lit(0)).alias("shop_product_count"))


QUADRANTS = {  # Fixed values: names by (high price, high score).
    (True, True): "Premium Value", (True, False): "Overpriced",
    (False, True): "Hidden Gems", (False, False): "Weak Products",
}


def quadrants(df: DataFrame) -> DataFrame:
    """Each product's place against the median price and the median score."""
    median = scalars(exact_quantiles(df, {"price": ("price", 0.5), "score": ("score", 0.5)}))
    high_price = F.col("price") >= known(median["price"])
    high_score = F.col("score") >= known(median["score"])
    name = (
        F.when(high_price & high_score, QUADRANTS[True, True])
        .when(high_price, QUADRANTS[True, False])
        .when(high_score, QUADRANTS[False, True])
        .otherwise(QUADRANTS[False, False])
    )
    return df.where(F.col("price").isNotNull() & F.col("score").isNotNull()).withColumn("quadrant", name)


def quadrant_counts(df: DataFrame) -> DataFrame:
    return quadrants(df).groupBy("quadrant").agg(
        F.count("*").alias("count"), F.round(F.avg("price"), 4).alias("avg_price"),
        F.round(F.avg("score"), 4).alias("avg_score"),
    )


def top_scatter(df: DataFrame, n: int = 20, key: str = "score") -> DataFrame:
    """Price and rating points of the Top-N against their medians."""
    shown = top_n(df, n, key)
    median = scalars(exact_quantiles(shown, {"price": ("price", 0.5), "rating": ("rating", 0.5)}))
    return shown.select(
        "product_id", "title", "platform", "category", "price", "rating", "review_count", "score",
        known(median["price"]).alias("median_price"), known(median["rating"]).alias("median_rating"),
    )


def filtered_top(df: DataFrame, n: int, key: str = "score", **filters) -> DataFrame:
    return top_n(filter_catalog(df, **filters), n, key)
