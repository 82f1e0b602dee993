import json

from shelfwise import schema
from shelfwise.operators import normalize


def shopify(spark, *items, base="https://demo.myshopify.com"):
    pages = spark.createDataFrame([(base, 1, json.dumps({"products": list(items)}))], "base_url string, page int, body string")
    return normalize.shopify_products(normalize.shopify_items(pages))


def woo(spark, *items):
    pages = spark.createDataFrame([("https://w.com", 1, json.dumps(list(items)))], "base_url string, page int, body string")
    return normalize.woo_products(normalize.woo_items(pages))


# A listing with three variants: the first sets the prices, stock is that of the first, any one makes it available.
LANTERN = {
    "title": "Storm lantern", "handle": "storm-lantern-2", "vendor": "Fjordlys", "product_type": "Lighting / Camping",
    "body_html": "<div>Burns <b>twelve</b> hours &mdash; rain or not.</div>", "tags": ["tin", "wick"],
    "images": [{"src": "https://img.test/l1.png"}, {"src": "https://img.test/l2.png"}],
    "options": [{"name": "Couleur", "values": ["Moss", "Rust"]}, {"name": "Size", "values": ["20 cm", "30 cm"]}],
    "variants": [{"price": "63.75", "compare_at_price": "85.00", "available": False, "inventory_quantity": 11},
                 {"price": "71", "available": True, "inventory_quantity": -3},
                 {"price": "80.5", "available": False}],
}


def test_shopify_listing_with_variants(spark):
    row = shopify(spark, LANTERN, base="https://fjord.shop.test").first()
    assert (row.title, row.vendor, row.platform, row.currency, row.shop_name) == (
        "Storm lantern", "Fjordlys", "shopify", "USD", "fjord")
    assert (row.price, row.price_promo, row.price_old, row.discount_pct) == (85.0, 63.75, 85.0, 25.0)
    assert (row.availability, row.stock_quantity, row.variant_count) == (True, 11, 3)
    assert (row.category, row.subcategory, row.tags) == ("Lighting", "Camping", "tin, wick")
    assert (row.colors, row.sizes) == ("Moss, Rust", "20 cm, 30 cm")
    assert row.url == "https://fjord.shop.test/products/storm-lantern-2" and row.image_url == "https://img.test/l1.png"
    assert row.description == "Burns twelve hours — rain or not."


def test_shopify_listing_without_reduction(spark):
    plain = LANTERN | {"variants": [{"price": "18.40", "available": False}]}
    row = shopify(spark, plain).first()
    assert (row.price, row.price_promo, row.stock_quantity, row.variant_count, row.availability) == (18.4, None, None, 1, False)


def test_untitled_listings_go_at_the_filter(spark):
    mixed = shopify(spark, LANTERN, {"title": "", "handle": "x"}, {"title": "  ", "handle": "y"}, LANTERN | {"title": "Spare wick"})
    assert mixed.count() == 4
    assert {r.title for r in normalize.titled(mixed).collect()} >= {"Storm lantern", "Spare wick"}
    assert normalize.titled(mixed).where("title = ''").count() == 0


def test_payload_pages_of_several_shops(spark):
    def body(shop, numbers):
        return json.dumps({"products": [{"title": f"{shop} {n}", "handle": f"h{n}", "variants": []} for n in numbers]})

    pages = spark.createDataFrame(
        [("https://one.test", 1, body("one", range(7))), ("https://one.test", 2, body("one", [7])),
         ("https://two.test", 1, body("two", range(3))), ("https://two.test", 2, body("two", []))],
        "base_url string, page int, body string")
    items = normalize.shopify_items(pages)
    assert {r["base_url"]: r["count"] for r in items.groupBy("base_url").count().collect()} == {
        "https://one.test": 8, "https://two.test": 3}
    row = normalize.shopify_products(items).where("title = 'two 2'").first()
    assert row.variant_count == 0 and row.url == "https://two.test/products/h2"


KETTLE = {"name": "Copper kettle", "sku": "CK-7", "price": "58.20", "regular_price": "77.60", "sale_price": "58.20",
          "stock_status": "onbackorder", "stock_quantity": 2, "average_rating": "3.75", "rating_count": 140,
          "categories": [{"name": "Hob"}, {"name": "Gifts"}], "variations": [31, 32],
          "images": [{"src": "https://img.test/k.png"}], "description": "<ul><li>Whistles</li><li>1.5&nbsp;l</li></ul>",
          "permalink": "https://w.com/shop/copper-kettle"}


def test_woo_listing_on_sale(spark):
    row = woo(spark, KETTLE).first()
    assert (row.title, row.platform, row.shop_name, row.brand) == ("Copper kettle", "woocommerce", "w.com", "CK-7")
    assert (row.price_promo, row.price_old, row.discount_pct) == (58.2, 77.6, 25.0)
    assert (row.rating, row.review_count, row.stock_quantity, row.variant_count) == (3.75, 140, 2, 2)
    assert (row.category, row.description, row.url) == ("Hob", "Whistles 1.5 l", "https://w.com/shop/copper-kettle")


def test_woo_listing_sold_out_and_bare(spark):
    gone = woo(spark, KETTLE | {"stock_status": "outofstock", "sale_price": "", "variations": []}).first()
    assert (gone.availability, gone.price_old, gone.price_promo, gone.variant_count) == (False, None, None, 1)
    bare = woo(spark, {"name": "Lid", "price": "4", "stock_status": "instock"}).first()
    assert (bare.title, bare.price, bare.availability) == ("Lid", 4.0, True)


def test_generic_items(spark):
    raw = spark.createDataFrame([(" Peg rail ", "1.234,50 €", "https://g.test/peg"), (None, "3", "https://g.test/none"),
                                 ("Hook", None, "https://g.test/hook")], "title string, price string, url string")
    rows = {r.title: r for r in normalize.NORMALIZERS["generic"](raw).collect()}
    assert set(rows) == {"Peg rail", "Hook"} and rows["Peg rail"].platform == "generic"
    assert rows["Hook"].url == "https://g.test/hook"


def test_reviews(spark):
    reviews = spark.createDataFrame(
        [("b", 1, 1, "<p>Good</p>"), ("b", 1, 2, ""), ("b", 1, 3, "x" * 200), ("b", 1, 4, "late")],
        "base_url string, id long, pos int, review string")
    assert normalize.review_digest(reviews).first().customer_reviews == "Good | " + "x" * 150


def test_snapshot_columns(spark):
    rows = normalize.contract_order(normalize.derive(normalize.stamp(shopify(spark, LANTERN), "ts")))
    known = [c for c in rows.columns if c in schema.SNAPSHOT_COLUMNS]
    assert rows.columns[:len(known)] == schema.SNAPSHOT_COLUMNS
    assert rows.first().is_on_sale is True and rows.first().price_band is not None


def test_missing_discount_is_filled(spark):
    df = spark.createDataFrame([(50.0, 40.0, None), (None, 40.0, None), (50.0, 40.0, 5.0)],
                               "price_old double, price double, discount_pct double")
    assert [r.discount_pct for r in normalize.with_discount(df).collect()] == [20.0, None, 5.0]
