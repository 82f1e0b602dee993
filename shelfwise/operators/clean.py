"""Catalogue cleaning, imputation and feature columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import hashing, labels, parse
from shelfwise.operators.stats import exact_quantiles, known, min_max, numbered, scalars

CATEGORICAL = ["category", "platform", "shop_country"]

# Brands that raise a generated rating.
PRESTIGE_BRANDS = ["glossier", "banish", "drunk elephant", "chanel", "dior"]

# Countries by shop, and the pool for all other shops.
SHOP_COUNTRIES = {
    "www": "USA", "beautyologie": "CA", "us": "USA", "kosas": "USA", "banish": "USA",
    "henuaofficial": "FR",
}
COUNTRY_POOL = ["USA", "UK", "FR", "DE", "CA", "AU", "ES", "IT"]


def repair_product_id(df: DataFrame) -> DataFrame:
    """Ids in scientific notation become whole numbers; others ``Unknown``."""
    number = F.col("product_id").cast("string").try_cast("decimal(38,4)")
    whole = F.when(number < 0, F.ceil(number)).otherwise(F.floor(number))
    return df.withColumn("product_id", F.coalesce(whole.cast("string"), F.lit("Unknown")))


def impute_category(df: DataFrame) -> DataFrame:
    """Missing categories (and subcategories) inferred from title keywords."""
    title = F.col("title")
    no_category = F.col("category").isNull() | F.col("category").isin("Unknown", "NaN")
    no_subcategory = F.col("subcategory").isNull() | (F.col("subcategory") == "Unknown")
    return df.withColumns({
        "category": F.when(no_category, labels.keyword_category(title)).otherwise(F.col("category")),
        "subcategory": F.when(no_category | no_subcategory, labels.keyword_subcategory(title))
        .otherwise(F.col("subcategory")),
    })


def ratings_are_flat(df: DataFrame, default_rating: float = 3.0, share: float = 0.9) -> bool:
    """True when nearly all ratings (nulls included) equal the default rating."""
    same = (F.coalesce(F.col("rating").cast("double"), F.lit(default_rating)) == default_rating)
    return (scalars(df.agg(F.avg(same.cast("int")).alias("share")))["share"] or 0.0) > share


def synthesize_ratings(df: DataFrame) -> DataFrame:
    """Plausible ratings and review counts from price tier and brand.

    The draw is a hash of the product id, so reruns give the same values.
    """
    price, key = F.col("price"), F.col("product_id")
    boosted = F.lower(F.coalesce("brand", F.lit(""))).rlike("|".join(PRESTIGE_BRANDS))
    factor = F.when(boosted, 2).otherwise(1)
    base = (
        F.when(price > 100, 4.2).when(price > 30, 4.0).otherwise(3.8)
        + F.when(boosted, 0.3).otherwise(0.0)
    )
    low = F.when(price > 100, 50).when(price > 30, 10).otherwise(0) * factor
    high = F.when(price > 100, 500).when(price > 30, 200).otherwise(50) * factor
    drawn = base + (hashing.hash_unit(key, "rating") * 0.8 - 0.5)
    return df.withColumns({
        "rating": F.round(F.least(F.lit(5.0), F.greatest(F.lit(1.0), drawn)), 1),
        "review_count": low + F.pmod(hashing.hash_int(key, "reviews"), (high - low + 1).cast("bigint")),
    })


def impute_numeric(df: DataFrame) -> DataFrame:
    """Medians for rating, stock and price; fixed values and clips for the rest."""
    df = df.withColumns({c: parse.finite(F.col(c)) for c in ["price", "rating", "stock_quantity"]})
    median = scalars(exact_quantiles(df, {
        "rating": ("rating", 0.5), "stock": ("stock_quantity", 0.5), "price": ("price", 0.5),
    }))
    discount = F.coalesce(F.col("discount_pct").cast("double"), F.lit(0.0))
    return df.withColumns({
        "rating": F.coalesce(F.col("rating"), known(median["rating"]), F.lit(3.5)),
        "review_count": F.greatest(F.lit(0), F.coalesce("review_count", F.lit(0))).cast("bigint"),
        "discount_pct": F.least(F.lit(100.0), F.greatest(F.lit(0.0), discount)),
        "stock_quantity": F.coalesce(F.col("stock_quantity"), known(median["stock"]), F.lit(0.0)),
        "price": F.coalesce(F.col("price"), known(median["price"])),
        "variant_count": F.coalesce("variant_count", F.lit(1)),
    })


def availability_flag(value: Column) -> Column:
    """0 for a false boolean, the number zero or the text "False"; anything else counts as available."""
    no = F.typeof(value) != "string"
    text = value.cast("string")
    return F.when((no & F.lower(text).isin("false", "0", "0.0")) | (text == "False"), 0).otherwise(1)


def fill_categoricals(df: DataFrame, columns: list[str] = CATEGORICAL) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.trim(F.coalesce(c, F.lit("Unknown"))) for c in present})


def keep_valid(df: DataFrame) -> DataFrame:
    return df.where(F.col("title").isNotNull() & (F.col("price") > 0))


def dropped_rows(df: DataFrame) -> DataFrame:
    """Row counts around ``keep_valid``."""
    valid = F.col("title").isNotNull() & (F.col("price") > 0)
    return df.agg(
        F.count("*").alias("rows_before"),
        F.count_if(valid).alias("rows_after"),
        (F.count("*") - F.count_if(valid)).alias("rows_dropped"),
    )


def impute(df: DataFrame) -> DataFrame:
    """All cleaning steps up to the row filter."""
    df = impute_category(repair_product_id(df))
    if ratings_are_flat(df):
        df = synthesize_ratings(df)
    df = impute_numeric(df)
    return fill_categoricals(df.withColumn("availability", availability_flag(F.col("availability"))))


def clean(df: DataFrame) -> DataFrame:
    return keep_valid(impute(df))


def enrich_countries(df: DataFrame) -> DataFrame:
    """Country per shop where it is unknown: by map, else by hash of the shop name."""
    known = F.create_map(*[F.lit(x) for pair in SHOP_COUNTRIES.items() for x in pair])
    pool = F.array(*map(F.lit, COUNTRY_POOL))
    drawn = F.get(pool, hashing.hash_pick(F.col("shop_name"), len(COUNTRY_POOL)).cast("int"))
    looked_up = F.coalesce(F.try_element_at(known, F.col("shop_name")), drawn)
    unknown = F.col("shop_country").isNull() | (F.col("shop_country") == "Unknown")
    by_shop = F.when(F.col("shop_country") == "Unknown", looked_up)
    return df.withColumn(
        "shop_country",
        F.when(unknown, F.coalesce(F.when(by_shop != "Unknown", by_shop), F.lit("USA")))
        .otherwise(F.col("shop_country")),
    )


def relabel_platform(df: DataFrame, tenths: int = 3) -> DataFrame:
    """A fixed share of products (by hash of the id) is tagged woocommerce."""
    hit = hashing.hash_pick(F.coalesce(F.col("product_id").cast("string"), F.lit("nan")), 10) < tenths
    return df.withColumn("platform", F.when(hit, "woocommerce").otherwise(F.col("platform")))


def ensure_column(df: DataFrame, name: str = "is_top_product", default=0) -> DataFrame:
    return df if name in df.columns else df.withColumn(name, F.lit(default))


def engineer(df: DataFrame) -> DataFrame:
    """Log price, popularity and the two price tiers around the median price."""
    median = known(scalars(exact_quantiles(df, {"price": ("price", 0.5)}))["price"])
    reviews = F.coalesce("review_count", F.lit(0))
    return df.withColumns({
        "review_count": reviews,
        "log_price": F.log1p("price"),
        "popularity_score": F.coalesce("rating", F.lit(0.0)) * F.log1p(reviews),
        "is_budget": (F.col("price") <= median * 0.5).cast("int"),
        "is_premium": (F.col("price") >= median * 2.0).cast("int"),
    })


def label_codes(df: DataFrame, column: str) -> DataFrame:
    """Code table of a column: distinct texts numbered from 0 in sorted order."""
    distinct = df.select(F.col(column).cast("string").alias(column)).distinct()
    return numbered(distinct.where(F.col(column).isNotNull()), column, "_code").select(
        column, F.col("_code").cast("int").alias(f"{column}_enc"))


def encode_labels(df: DataFrame, columns: list[str] = CATEGORICAL) -> DataFrame:
    """``<column>_enc`` for every categorical; code tables hold distinct values only."""
    present = [c for c in columns if c in df.columns]
    return reduce(lambda out, c: out.join(label_codes(df, c), c, "left"), present, df).select(
        *df.columns, *[f"{c}_enc" for c in present]
    )


# Feature order of the model matrix. Scaled review counts are
# optional, as ``log_review_count`` is only used when the frame carries it.
FEATURES = [
    "log_price", "log_review_count", "rating", "discount_pct", "stock_quantity",
    "variant_count", "availability", "is_budget", "is_premium", "popularity_score",
]


def feature_columns(df: DataFrame) -> list[str]:
    wanted = FEATURES + [f"{c}_enc" for c in CATEGORICAL]
    return [c for c in wanted if c in df.columns]


def feature_bounds(df: DataFrame, columns: list[str]) -> DataFrame:
    """The fitted scaler: one row of minima and maxima, reusable for inference."""
    filled = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns])
    return min_max(filled, columns)


def _scaled_column(name: str, bounds: dict) -> Column:
    value = F.coalesce(F.col(name).cast("double"), F.lit(0.0))
    low, high = bounds[f"{name}_min"], bounds[f"{name}_max"]
    return (value - F.lit(low)) / F.lit(high - low if high > low else 1.0)


def scale_features(df: DataFrame, columns: list[str], bounds: DataFrame | None = None) -> DataFrame:
    """Every feature min-max scaled in place of its raw column, constants to 0."""
    fitted = scalars(feature_bounds(df, columns) if bounds is None else bounds)
    return df.withColumns({c: _scaled_column(c, fitted) for c in columns})


def feature_matrix(df: DataFrame, bounds: DataFrame | None = None) -> tuple[DataFrame, list[str]]:
    """Frame with a ``features`` vector of the scaled columns, and their names."""
    from pyspark.ml.feature import VectorAssembler

    columns = feature_columns(df)
    fitted = scalars(feature_bounds(df, columns) if bounds is None else bounds)
    scaled = {f"_scaled_{c}": _scaled_column(c, fitted) for c in columns}
    assembler = VectorAssembler(inputCols=list(scaled), outputCol="features")
    return assembler.transform(df.withColumns(scaled)).drop(*scaled), columns


def _catalog_filter(
    price_min: float | None = None,
    price_max: float | None = None,
    category: str | None = None,
    platform: str | None = None,
) -> Column:
    """Conjunction of the given filters; blank and "All" mean no filter."""
    keep = F.lit(True)
    if price_min is not None and price_max is not None:
        keep = keep & F.col("price").between(float(price_min), float(price_max))
    for column, wanted in (("category", category), ("platform", platform)):
        if wanted and wanted.strip() and wanted.lower() != "all":
            keep = keep & (F.col(column) == wanted)
    return keep


def filter_catalog(df: DataFrame, **filters) -> DataFrame:
    return df.where(_catalog_filter(**filters))


def filter_or_all(df: DataFrame, **filters) -> DataFrame:
    """Filtered catalogue, or the whole one when nothing matches."""
    keep = F.coalesce(_catalog_filter(**filters), F.lit(False))
    return df if df.where(keep).isEmpty() else df.where(keep)


def by_category(df: DataFrame, category: str | None, columns: list[str]) -> DataFrame:
    """Case-insensitive category filter with a column subset."""
    if category:
        df = df.where(F.lower("category") == category.lower())
    return df.select(*[c for c in columns if c in df.columns])
