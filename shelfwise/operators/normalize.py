"""Platform payloads to the product schema, and snapshot columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise import schema
from shelfwise.functions import labels, parse
from shelfwise.sources import html

# Option names that carry colours and sizes.
COLOR_WORDS = ["color", "colour", "couleur"]
SIZE_WORDS = ["size", "taille"]
DESCRIPTION_CHARS, TAG_CHARS, REVIEW_CHARS = 600, 200, 150


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def to_product(df: DataFrame, **given: Column) -> DataFrame:
    """Canonical projection: given expressions, defaults for the rest, declared types."""
    columns = []
    for field in schema.PRODUCT.fields:
        default = schema.PRODUCT_DEFAULTS.get(field.name)
        value = given.get(field.name, F.lit(None)).cast(field.dataType)
        if default is not None:
            value = F.coalesce(value, F.lit(default).cast(field.dataType))
        columns.append(value.alias(field.name))
    return df.select(*columns)


def titled(df: DataFrame) -> DataFrame:
    """Products whose title is not blank."""
    return df.where(F.length(F.trim("title")) > 0)


# --- landed payload pages ------------------------------------------------

def shopify_items(pages: DataFrame) -> DataFrame:
    """Items of ``products.json`` pages ``(base_url, page, body)``."""
    body = F.from_json("body", schema.SHOPIFY_BODY)
    return pages.select("base_url", F.explode(body["products"]).alias("i")).select("base_url", "i.*")


def woo_items(pages: DataFrame) -> DataFrame:
    """Items of REST product pages ``(base_url, page, body)``."""
    return pages.select("base_url", F.explode(F.from_json("body", schema.WOO_BODY)).alias("i")).select(
        "base_url", "i.*"
    )


# --- shopify -------------------------------------------------------------

def shopify_tags(tags: Column) -> Column:
    """A JSON list or a comma text as one ", "-joined text."""
    listed = F.from_json(tags, T.ArrayType(T.StringType()))
    parts = F.transform(F.split(F.coalesce(tags, F.lit("")), ","), lambda t: F.trim(t))
    is_list = F.coalesce(F.startswith(F.trim(tags), F.lit("[")), F.lit(False))
    joined = F.when(is_list, F.array_join(listed, ", ")).otherwise(F.array_join(parts, ", "))
    return F.substring(joined, 1, TAG_CHARS)


def shopify_products(items: DataFrame, shop_country: str = "") -> DataFrame:
    variants = F.coalesce("variants", F.array())
    first = F.get("variants", F.lit(0))
    listed = parse.money(first["price"])
    compare = F.nullif(parse.money(first["compare_at_price"]), F.lit(0.0))
    reduced = F.coalesce(listed < compare, F.lit(False))
    counts = F.transform(variants, lambda v: F.greatest(F.lit(0), parse.integer(v["inventory_quantity"])))
    stock = F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, b: a + b)
    kind = F.split(_text(F.col("product_type")), "/", 2)
    base = _text(F.col("base_url"))
    return to_product(
        items,
        product_id=_text(F.col("id")),
        title=F.trim(_text(F.col("title"))),
        description=F.substring(parse.strip_html(F.col("body_html")), 1, DESCRIPTION_CHARS),
        category=F.trim(F.get(kind, F.lit(0))),
        subcategory=F.trim(F.coalesce(F.get(kind, F.lit(1)), F.lit(""))),
        brand=F.col("vendor"), vendor=F.col("vendor"),
        image_url=F.get("images", F.lit(0))["src"],
        tags=shopify_tags(F.col("tags")),
        url=F.concat(base, F.lit("/products/"), _text(F.col("handle"))),
        platform=F.lit("shopify"),
        price=F.when(reduced & (listed != 0), compare).otherwise(listed),
        price_promo=F.when(reduced, listed),
        price_old=compare,
        discount_pct=parse.percent_off(F.coalesce(compare, listed), listed),
        availability=F.exists(variants, lambda v: F.coalesce(v["available"], F.lit(False))),
        stock_quantity=F.nullif(stock, F.lit(0).cast("bigint")),
        variant_count=F.when(F.col("variants").isNotNull(), F.size("variants")),
        colors=parse.option_values(F.col("options"), "values", COLOR_WORDS),
        sizes=parse.option_values(F.col("options"), "values", SIZE_WORDS),
        shop_name=parse.first_host_label(base),
        shop_country=F.lit(shop_country),
        published_at=F.col("published_at"),
    )


def shopify_cards(cards: DataFrame, shop_country: str = "") -> DataFrame:
    """Theme cards ``(base_url, title, price, url, image_url)``."""
    return to_product(
        cards,
        title=F.trim(_text(F.col("title"))), price=parse.money(F.col("price")),
        url=F.col("url"), image_url=F.col("image_url"), platform=F.lit("shopify"),
        shop_name=parse.first_host_label(_text(F.col("base_url"))), shop_country=F.lit(shop_country),
    )


# --- woocommerce ---------------------------------------------------------

def woo_products(items: DataFrame, shop_name: str = "", shop_country: str = "") -> DataFrame:
    regular = parse.money(F.coalesce(
        parse.blank_to_null(F.col("regular_price")), parse.blank_to_null(F.col("price"))))
    sale = F.nullif(parse.money(F.col("sale_price")), F.lit(0.0))
    promo = F.when(sale < regular, sale)
    quantity = F.col("stock_quantity")
    base = _text(F.col("base_url"))
    names = F.filter(F.transform("tags", lambda t: t["name"]), lambda n: F.coalesce(n, F.lit("")) != "")
    description = F.coalesce(parse.blank_to_null(F.col("description")), F.col("short_description"))
    present = set(items.columns)
    return to_product(
        items,
        product_id=_text(F.col("id")),
        title=F.trim(_text(F.col("name"))),
        description=F.substring(parse.strip_html(description), 1, DESCRIPTION_CHARS),
        category=F.get("categories", F.lit(0))["name"],
        subcategory=F.get("categories", F.lit(1))["name"],
        brand=F.col("sku"),
        image_url=F.get("images", F.lit(0))["src"],
        tags=F.substring(F.array_join(names, ", "), 1, TAG_CHARS),
        url=F.col("permalink"), platform=F.lit("woocommerce"),
        price=regular, price_promo=promo,
        price_old=F.when(promo.isNotNull(), regular),
        discount_pct=parse.percent_off(regular, promo),
        rating=F.nullif(parse.money(F.col("average_rating")), F.lit(0.0)),
        review_count=parse.integer(F.col("rating_count")),
        availability=F.coalesce(F.col("stock_status"), F.lit("instock")) == "instock",
        stock_quantity=F.when(~quantity.isin("", "0"), parse.integer(quantity)),
        variant_count=F.greatest(F.lit(1), F.size(F.coalesce("variations", F.array().cast("array<bigint>")))),
        colors=parse.option_values(F.col("attributes"), "options", COLOR_WORDS),
        sizes=parse.option_values(F.col("attributes"), "options", SIZE_WORDS),
        shop_name=F.lit(shop_name) if shop_name else parse.full_host(base),
        shop_country=F.lit(shop_country),
        shop_product_count=F.col("shop_product_count") if "shop_product_count" in present else F.lit(None),
        published_at=F.col("date_created"),
        customer_reviews=F.col("customer_reviews") if "customer_reviews" in present else F.lit(""),
    )


def review_digest(reviews: DataFrame, per_product: int = 3) -> DataFrame:
    """First reviews of a product ``(base_url, id, pos, review)`` as one text.

    The positions are ranked with a row limit, which Spark applies before the
    shuffle too, so a much reviewed product sends few rows.
    """
    first = Window.partitionBy("base_url", "id").orderBy("pos")
    kept = (
        reviews.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= per_product)
        .where(F.coalesce("review", F.lit("")) != "")
    )
    piece = F.substring(parse.strip_html(F.col("review")), 1, REVIEW_CHARS)
    ordered = F.sort_array(F.collect_list(F.struct("_n", piece.alias("text"))))
    return kept.groupBy("base_url", "id").agg(
        F.array_join(F.transform(ordered, lambda r: r["text"]), " | ").alias("customer_reviews")
    )


def attach_reviews(items: DataFrame, reviews: DataFrame, per_product: int = 3) -> DataFrame:
    return items.join(review_digest(reviews, per_product), ["base_url", "id"], "left")


def attach_shop_totals(items: DataFrame, totals: DataFrame) -> DataFrame:
    """``shop_product_count`` from one row per shop."""
    return items.join(totals.select("base_url", "shop_product_count"), "base_url", "left")


# --- generic -------------------------------------------------------------

def generic_products(items: DataFrame) -> DataFrame:
    """Raw items with any of the generic fields; missing ones take defaults."""
    has = set(items.columns)
    optional = ["currency", "url", "availability", "rating", "description", "category", "image_url"]
    return to_product(
        items,
        title=F.trim(_text(F.col("title"))), price=parse.money(F.col("price")),
        platform=F.lit("generic"), **{c: F.col(c) for c in optional if c in has},
    )


def woo_cards(cards: DataFrame, shop_country: str = "") -> DataFrame:
    """Listing cards ``(base_url, title, price, url, image_url)`` of a WooCommerce theme."""
    return to_product(
        cards,
        title=F.trim(_text(F.col("title"))), price=parse.money(F.col("price")),
        url=F.col("url"), image_url=F.col("image_url"), platform=F.lit("woocommerce"),
        shop_name=parse.full_host(_text(F.col("base_url"))), shop_country=F.lit(shop_country),
    )


# --- snapshot columns ----------------------------------------------------

def with_discount(df: DataFrame) -> DataFrame:
    """A missing discount is filled from the old price."""
    old, price = F.col("price_old"), F.col("price")
    filled = F.when(old > 0, F.round((old - price) / old * 100, 1))
    return df.withColumn("discount_pct", F.coalesce("discount_pct", filled))


def stamp(df: DataFrame, run_ts: str) -> DataFrame:
    return df.withColumn("scraped_at", F.lit(run_ts))


def derive(df: DataFrame) -> DataFrame:
    """Score placeholder, price band and the three flags."""
    return df.withColumns({
        "score": F.lit(0.0),
        "price_band": labels.price_band(F.col("price")),
        "is_on_sale": labels.on_sale(F.col("price_promo"), F.col("price")),
        "is_popular": labels.popular(F.col("rating"), F.col("review_count")),
        "is_low_stock": labels.low_stock(F.col("stock_quantity")),
    })


def contract_order(df: DataFrame, order: list[str] = schema.SNAPSHOT_COLUMNS) -> DataFrame:
    """Contract columns first and in order, extras after them."""
    known = [c for c in order if c in df.columns]
    return df.select(*known, *[c for c in df.columns if c not in known])


NORMALIZERS = {
    "shopify": lambda pages: titled(shopify_products(shopify_items(pages))),
    "woocommerce": lambda pages: titled(woo_products(woo_items(pages))),
    "generic": lambda items: titled(generic_products(items)),
    # Landed HTML pages (page_id, url, html) of each theme.
    "shopify_pages": lambda pages: titled(shopify_cards(html.extract_items(pages, "shopify"))),
    "woocommerce_pages": lambda pages: titled(woo_cards(html.extract_items(pages, "woocommerce"))),
    "generic_pages": lambda pages: titled(generic_products(html.extract_items(pages, "generic"))),
}


def normalize(payloads: dict[str, DataFrame]) -> DataFrame:
    """Union of the normalised payloads of every platform given."""
    frames = [with_discount(NORMALIZERS[p](df)) for p, df in payloads.items()]
    return reduce(lambda a, b: a.unionByName(b), frames)
