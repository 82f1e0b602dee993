"""Rule columns: price bands, flags, keyword categories, routes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Right-closed upper bounds of the price bands and their names.
PRICE_BANDS = [(10.0, "<$10"), (30.0, "$10-30"), (100.0, "$30-100"), (300.0, "$100-300")]
TOP_PRICE_BAND = ">$300"


def price_band(price: Column) -> Column:
    """Band name; null for a null price and for prices up to 0."""
    band = F.when(price <= 0, None)
    for upper, name in PRICE_BANDS:
        band = band.when(price <= upper, name)
    return band.when(price.isNotNull(), TOP_PRICE_BAND)


def price_band_ordinal(price: Column) -> Column:
    """0-based position of the band, for sorting."""
    rank = F.when(price <= 0, None)
    for i, (upper, _) in enumerate(PRICE_BANDS):
        rank = rank.when(price <= upper, i)
    return rank.when(price.isNotNull(), len(PRICE_BANDS)).cast("int")


def on_sale(price_promo: Column, price: Column) -> Column:
    return F.coalesce(price_promo < price, F.lit(False))


def popular(rating: Column, reviews: Column) -> Column:
    return F.coalesce((F.coalesce(rating, F.lit(0.0)) >= 4.0) & (reviews >= 100), F.lit(False))


def low_stock(stock: Column) -> Column:
    return F.coalesce(stock < 10, F.lit(False))


# Keyword groups for category inference, in order of precedence.
CATEGORY_KEYWORDS = [
    ("Skincare", ["serum", "cream", "lotion", "cleanser", "moisturizer", "toner", "oil", "mask", "peel"]),
    ("Makeup", ["lipstick", "palette", "foundation", "concealer", "mascara", "liner", "blush", "gloss"]),
    ("Haircare", ["shampoo", "conditioner", "hair", "scalp"]),
    ("Kits & Sets", ["kit", "set", "bundle", "collection"]),
]
# Keyword groups for the subcategory inside a category.
SUBCATEGORY_KEYWORDS = {
    "Skincare": [("Serums", ["serum"]), ("Masks", ["mask"]), ("Moisturizers", ["cream", "moisturizer"])],
    "Makeup": [("Lips", ["lipstick", "gloss"]), ("Eyes", ["palette"])],
}
OTHER_CATEGORY, GENERAL_SUBCATEGORY = "Other", "General"


def _first_match(text: Column, groups, default: str) -> Column:
    # A null title reads as the text "nan" and so falls to the default.
    text = F.lower(F.coalesce(text, F.lit("")))
    name = F
    for label, words in groups:
        name = name.when(text.rlike("|".join(words)), label)
    return name.otherwise(default)


def keyword_category(title: Column) -> Column:
    return _first_match(title, CATEGORY_KEYWORDS, OTHER_CATEGORY)


def keyword_subcategory(title: Column) -> Column:
    category = keyword_category(title)
    sub = F
    for name, groups in SUBCATEGORY_KEYWORDS.items():
        sub = sub.when(category == name, _first_match(title, groups, GENERAL_SUBCATEGORY))
    return sub.otherwise(GENERAL_SUBCATEGORY)


# Markers that reveal the shop platform.
SHOPIFY_URL_MARKERS = ["myshopify.com"]
SHOPIFY_BODY_MARKERS = ["Shopify.theme", "shopify-section"]
WOO_BODY_MARKERS = ["woocommerce"]
WOO_API_STATUS = [200, 401]


def _any_contains(text: Column, markers: list[str]) -> Column:
    found = F.lit(False)
    for marker in markers:
        found = found | F.coalesce(F.contains(text, F.lit(marker)), F.lit(False))
    return found


def platform_of_page(
    url: Column,
    body: Column,
    api_status: Column | None = None,
    shopify_url: list[str] = SHOPIFY_URL_MARKERS,
    shopify_body: list[str] = SHOPIFY_BODY_MARKERS,
    woo_body: list[str] = WOO_BODY_MARKERS,
) -> Column:
    """Route of a page: shopify before woocommerce before generic."""
    is_shopify = _any_contains(url, shopify_url) | _any_contains(body, shopify_body)
    is_woo = _any_contains(F.lower(body), woo_body)
    if api_status is not None:
        is_woo = is_woo | F.coalesce(api_status.isin(WOO_API_STATUS), F.lit(False))
    return F.when(is_shopify, "shopify").when(is_woo, "woocommerce").otherwise("generic")
