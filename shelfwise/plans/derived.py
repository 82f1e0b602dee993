"""Inputs that Spark derives from the driver tables for the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions import parse
from shelfwise.operators.enrich import fixed
from shelfwise.plans import catalogue
from shelfwise.sources.catalog import table

PAGE_ITEMS = 250


def _key():
    return F.col("product_id").cast("bigint")


def shop_pages(spark: SparkSession, folder: str, item, body_of) -> DataFrame:
    """Landed payload pages: at most 250 products of one shop each."""
    shops = table(spark, folder, "supplier").count()
    rows = catalogue.products(spark, folder).withColumn("key", _key())
    page = F.floor(F.col("key") / (PAGE_ITEMS * shops)) + 1
    base = F.concat(F.lit("https://shop"), F.pmod("key", F.lit(shops)).cast("string"), F.lit(".example.com"))
    listed = rows.select(base.alias("base_url"), page.alias("page"), F.col("key"), item.alias("item"))
    return listed.groupBy("base_url", "page").agg(body_of(F.transform(
        F.sort_array(F.collect_list(F.struct("key", "item"))), lambda x: x["item"])).alias("body"))


def _price_text():
    return fixed(F.col("price"), 2)


def shopify_pages(spark: SparkSession, folder: str) -> DataFrame:
    key = _key()
    variant = F.struct(
        _price_text().alias("price"),
        F.when(F.col("discount_pct") > 0, fixed(F.col("price") + 5, 2)).alias("compare_at_price"),
        F.col("availability").alias("available"),
        F.col("stock_quantity").cast("string").alias("inventory_quantity"))
    other = F.struct(
        _price_text().alias("price"), F.lit(None).cast("string").alias("compare_at_price"),
        F.lit(False).alias("available"), F.lit("-3").alias("inventory_quantity"))
    item = F.struct(
        key.alias("id"), F.concat(F.lit(" "), "title", F.lit(" ")).alias("title"),
        F.concat(F.lit("item-"), "product_id").alias("handle"), F.col("brand").alias("vendor"),
        F.concat(F.coalesce("category", F.lit("")), F.lit(" / "), "subcategory").alias("product_type"),
        F.concat(F.lit("<p>Fine <b>"), "title", F.lit("</b> &amp; more</p>")).alias("body_html"),
        F.lit("2024-01-01T00:00:00Z").alias("published_at"),
        F.when(key % 2 == 0, F.lit('["new", "sale"]')).otherwise(F.lit("old, blue")).alias("tags"),
        F.array(variant, other).alias("variants"),
        F.array(F.struct(F.lit("Colour").alias("name"), F.array(F.lit("Red"), F.lit("Blue")).alias("values")),
                F.struct(F.lit("Size").alias("name"), F.array(F.lit("M")).alias("values"))).alias("options"),
        F.array(F.struct(F.concat(F.lit("https://img/"), "product_id").alias("src"))).alias("images"))
    return shop_pages(spark, folder, item, lambda items: F.to_json(F.struct(items.alias("products"))))


def woo_pages(spark: SparkSession, folder: str) -> DataFrame:
    key = _key()
    item = F.struct(
        key.alias("id"), F.col("title").alias("name"), F.col("brand").alias("sku"),
        F.concat(F.lit("https://w/"), "product_id").alias("permalink"), _price_text().alias("price"),
        F.when(key % 5 != 0, fixed(F.col("price") + 1, 2)).otherwise(F.lit("")).alias("regular_price"),
        F.when(F.col("discount_pct") > 0, _price_text()).otherwise(F.lit("")).alias("sale_price"),
        F.when(F.col("availability"), "instock").otherwise("outofstock").alias("stock_status"),
        F.col("stock_quantity").cast("string").alias("stock_quantity"),
        F.coalesce(F.col("rating").cast("string"), F.lit("0")).alias("average_rating"),
        F.col("review_count").cast("string").alias("rating_count"),
        F.array(F.struct(F.coalesce("category", F.lit("Misc")).alias("name")),
                F.struct(F.col("subcategory").alias("name"))).alias("categories"),
        F.array(F.struct(F.lit("hot").alias("name")), F.struct(F.lit("").alias("name")),
                F.struct(F.col("subcategory").alias("name"))).alias("tags"),
        F.array(F.struct(F.lit("Taille").alias("name"), F.array(F.lit("S"), F.lit("L")).alias("options")))
        .alias("attributes"),
        F.when(key % 4 == 0, F.array().cast("array<bigint>"))
        .otherwise(F.sequence(F.lit(1), F.col("variant_count").cast("bigint"))).alias("variations"),
        F.array(F.struct(F.concat(F.lit("https://img/"), "product_id").alias("src"))).alias("images"),
        F.when(key % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("<i>Long</i> "), "title")).alias("description"),
        F.concat(F.lit("<i>Short</i> "), "title").alias("short_description"),
        F.lit("2024-02-02T00:00:00").alias("date_created"))
    return shop_pages(spark, folder, item, F.to_json)


def listing_pages(spark: SparkSession, folder: str, theme: str) -> DataFrame:
    """Listing pages in the markup of a theme: (page_id, url, html)."""
    title, pid = F.col("title"), F.col("product_id")
    price = F.concat(F.lit("$"), _price_text())
    card = {
        "generic": F.concat(
            F.lit('<div class="product-item x"><img src="/i/'), pid, F.lit('.png"><h2 class="a"><a href="/p/'), pid,
            F.lit('">'), title, F.lit('</a></h2><span class="price">'), price, F.lit("</span></div>")),
        "shopify": F.concat(
            F.lit('<div class="grid__item"><h3>'), title, F.lit('</h3><a href="/about">x</a><a href="/products/'), pid,
            F.lit('">go</a><b class="the-price">'), price, F.lit("</b></div>")),
        "woocommerce": F.concat(
            F.lit('<li class="product"><a href="https://w/'), pid,
            F.lit('"><h2 class="woocommerce-loop-product__title">'), title,
            F.lit('</h2></a><span class="price"><span class="woocommerce-Price-amount">'), price,
            F.lit("</span></span>")),
    }[theme]
    pages = shop_pages(spark, folder, card, lambda items: F.array_join(items, "\n"))
    html = F.concat(F.lit("<!DOCTYPE html><html><body><!-- <li class='product'> --><ul>"), "body",
                    F.lit("</ul><a rel='next' href='?page=2'>more</a></body></html>"))
    return pages.select(
        F.col("page").cast("bigint").alias("page_id"),
        F.concat("base_url", F.lit("/collections/all")).alias("url"), html.alias("html"))


def item_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Single product pages with schema.org markup."""
    html = F.concat(
        F.lit('<html><body><h1 itemprop="name">'), "title", F.lit('</h1><meta itemprop="price" content="'),
        _price_text(), F.lit('"><div itemprop="description">Good <b>'), "subcategory",
        F.lit('</b></div><img itemprop="image" src="/i/'), "product_id", F.lit('.png"></body></html>'))
    return catalogue.products(spark, folder).select(
        _key().alias("page_id"), F.concat(F.lit("https://s.example.com/p/"), "product_id").alias("url"),
        html.alias("html"))


def money_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Line item prices written in seven locale styles, with junk."""
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    whole, part = F.floor(cents / 100).cast("bigint"), F.lpad(F.pmod(cents, F.lit(100)).cast("string"), 2, "0")
    grouped = F.concat(F.floor(whole / 1000).cast("string"), F.lit("#"),
                       F.lpad(F.pmod(whole, F.lit(1000)).cast("string"), 3, "0"))
    style = F.pmod(F.col("l_orderkey") + F.col("l_linenumber"), F.lit(8))
    text = (
        F.when(style == 0, F.concat(F.lit("$"), whole.cast("string"), F.lit("."), part))
        .when(style == 1, F.concat(F.replace(grouped, F.lit("#"), F.lit(",")), F.lit("."), part))
        .when(style == 2, F.concat(F.lit("€"), whole.cast("string"), F.lit(","), part))
        .when(style == 3, F.concat(F.replace(grouped, F.lit("#"), F.lit(".")), F.lit(","), part))
        .when(style == 4, F.replace(grouped, F.lit("#"), F.lit(",")))
        .when(style == 5, F.concat(F.lit("-"), whole.cast("string"), F.lit(",5")))
        .when(style == 6, F.concat(whole.cast("string"), F.lit(",2.3.4")))
        .otherwise(F.lit("sold out"))
    )
    return rows.select("l_orderkey", "l_linenumber", text.alias("price_text"))


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """Products and, after them, a copy of every fifth one; ``seq`` in that order."""
    rows = catalogue.products(spark, folder).select(
        _key().alias("seq"), "product_id", "title", "price", "platform", "rating")
    again = rows.where(F.col("seq") % 5 == 0).withColumns(
        {"seq": F.col("seq") + 10_000_000_000, "rating": F.lit(1.5)})
    return rows.unionByName(again)


def calls(spark: SparkSession, folder: str) -> DataFrame:
    """Events as tool calls."""
    events = table(spark, folder, "events")
    return events.select(
        F.col("event_id").alias("seq"), parse.try_epoch_micros(F.col("ts")).alias("ts"),
        F.col("event_type").alias("server"),
        F.concat(F.lit("user_"), F.pmod("user_id", F.lit(5)).cast("string")).alias("tool"),
        F.col("value").alias("latency_ms"))


CALL_PERMISSIONS = {  # by event type
    "click": ["user_0", "user_1", "user_2"], "error": ["user_0"],
    "view": ["user_0", "user_1", "user_2", "user_3"], "purchase": ["user_1", "user_4"],
}
HOUR = 3_600_000_000


def order_items(spark: SparkSession, folder: str, item: str) -> DataFrame:
    """(basket_id, item) rows: one basket per order."""
    from shelfwise.operators.rules import baskets_from_rows

    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    part = table(spark, folder, "part").select("p_partkey", item)
    return baskets_from_rows(lines.join(part, lines["l_partkey"] == part["p_partkey"]), "l_orderkey", item)


def questions(spark: SparkSession, folder: str) -> DataFrame:
    """User turns; every seventh one gets a word that routes it."""
    words = F.array(*map(F.lit, ["rapport", "profil", "marketing", "panier", "meilleur", "top", "hello"]))
    said = table(spark, folder, "conversations").where(F.col("role") == "user")
    tail = F.when(F.col("conv_id") % 7 != 6, F.concat(
        F.lit(" "), F.element_at(words, (F.pmod("conv_id", F.lit(7)) + 1).cast("int")))).otherwise(F.lit(""))
    return said.select("conv_id", "turn", F.concat("text", tail).alias("question"))


def described(spark: SparkSession, folder: str) -> DataFrame:
    """Scored products with a document as description, where there is one."""
    docs = table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("product_id"), F.col("text").alias("description"))
    return catalogue.scored(spark, folder).join(docs, "product_id", "left")


def related(spark: SparkSession, folder: str) -> DataFrame:
    """Products with the titles of their brand-mates in the same subcategory and price step."""
    rows = catalogue.products(spark, folder).withColumn("key", _key())
    mate = rows.select((F.col("key") - 1).alias("key"), F.col("title").alias("mate"))
    other = rows.select((F.col("key") - 7).alias("key"), F.col("title").alias("other"))
    texts = F.concat_ws(", ", "mate", F.when(F.col("key") % 3 != 0, F.col("other")))
    joined = rows.join(mate, "key", "left").join(other, "key", "left")
    return joined.withColumn("related_products", F.when(F.col("key") % 2 == 0, texts)).drop("mate", "other", "key")
