"""Declared schemas and column contracts."""

from __future__ import annotations

from pyspark.sql import types as T


def _fields(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in pairs])


_S, _D, _I, _L, _B = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType(), T.BooleanType()

# Column order of a catalogue snapshot.
SNAPSHOT_COLUMNS = [
    "product_id", "title", "category", "subcategory", "brand",
    "price", "price_promo", "price_old", "discount_pct", "currency",
    "rating", "review_count", "category_rank",
    "availability", "stock_quantity", "delivery_days",
    "variant_count", "colors", "sizes",
    "shop_name", "shop_country", "shop_product_count",
    "related_products",
    "published_at", "scraped_at",
    "tags", "description", "customer_reviews",
    "url", "image_url", "platform",
]

# CSV cell texts that mean "missing".
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

PRODUCT = _fields(
    ("product_id", _S), ("title", _S), ("description", _S), ("category", _S),
    ("subcategory", _S), ("brand", _S), ("image_url", _S), ("tags", _S),
    ("url", _S), ("platform", _S),
    ("price", _D), ("price_promo", _D), ("price_old", _D), ("discount_pct", _D), ("currency", _S),
    ("rating", _D), ("review_count", _L), ("category_rank", _I),
    ("availability", _B), ("stock_quantity", _L), ("delivery_days", _I),
    ("variant_count", _I), ("colors", _S), ("sizes", _S),
    ("shop_name", _S), ("shop_country", _S), ("shop_product_count", _L), ("vendor", _S),
    ("related_products", _S), ("published_at", _S), ("scraped_at", _S), ("customer_reviews", _S),
)

# Value a field takes when a source does not provide it (absent here: null).
PRODUCT_DEFAULTS = {
    "product_id": "", "title": "", "description": "", "category": "", "subcategory": "",
    "brand": "", "image_url": "", "tags": "", "url": "", "platform": "",
    "price": 0.0, "currency": "USD", "review_count": 0, "availability": True,
    "variant_count": 1, "colors": "", "sizes": "", "shop_name": "", "shop_country": "",
    "vendor": "", "related_products": "", "published_at": "", "scraped_at": "",
    "customer_reviews": "",
}

SHOPIFY_ITEM = _fields(
    ("id", _L), ("title", _S), ("handle", _S), ("vendor", _S), ("product_type", _S),
    ("body_html", _S), ("published_at", _S), ("tags", _S),
    ("variants", T.ArrayType(_fields(
        ("price", _S), ("compare_at_price", _S), ("available", _B), ("inventory_quantity", _S)))),
    ("options", T.ArrayType(_fields(("name", _S), ("values", T.ArrayType(_S))))),
    ("images", T.ArrayType(_fields(("src", _S)))),
)
SHOPIFY_BODY = _fields(("products", T.ArrayType(SHOPIFY_ITEM)))

_NAMED = T.ArrayType(_fields(("name", _S)))
WOO_ITEM = _fields(
    ("id", _L), ("name", _S), ("sku", _S), ("permalink", _S), ("price", _S),
    ("regular_price", _S), ("sale_price", _S), ("stock_status", _S), ("stock_quantity", _S),
    ("average_rating", _S), ("rating_count", _S), ("categories", _NAMED), ("tags", _NAMED),
    ("attributes", T.ArrayType(_fields(("name", _S), ("options", T.ArrayType(_S))))),
    ("variations", T.ArrayType(_L)), ("images", T.ArrayType(_fields(("src", _S)))),
    ("description", _S), ("short_description", _S), ("date_created", _S),
)
WOO_BODY = T.ArrayType(WOO_ITEM)

AUDIT = _fields(
    ("ts", _S), ("server", _S), ("tool", _S), ("allowed", _B), ("reason", _S),
    ("latency_ms", _D), ("result_size", _L),
)
