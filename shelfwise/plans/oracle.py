"""SQL twins of the registered queries, for a DuckDB check on the same tables."""

from __future__ import annotations

from shelfwise.schema import NA_TOKENS

NA_LIST = ", ".join(f"'{t}'" for t in NA_TOKENS)

PRODUCTS = """
sold AS (
  SELECT l_partkey, count(*) AS n,
         sum(CASE l_returnflag WHEN 'N' THEN 50 WHEN 'A' THEN 35 ELSE 20 END)::BIGINT AS stars,
         sum(round(l_discount * 100)::BIGINT)::BIGINT AS cents_off,
         count(DISTINCT l_linenumber)::INTEGER AS variant_count
  FROM lineitem GROUP BY 1),
products AS (
  SELECT p_partkey::VARCHAR AS product_id, p_partkey AS key, p_name AS title, p_brand AS brand,
         CASE WHEN p_partkey % 11 <> 0 THEN p_type END AS category,
         split_part(p_name, ' ', 2) AS subcategory,
         round(p_retailprice - 900, 2) AS price,
         CASE WHEN p_partkey % 13 <> 0 THEN round(stars / 10.0::DOUBLE / n, 1) END AS rating,
         n * (1 + p_partkey % 10) AS review_count,
         CASE WHEN p_partkey % 3 = 0 THEN 0.0::DOUBLE ELSE round(8.0::DOUBLE * cents_off / n, 1) END AS discount_pct,
         CASE WHEN p_partkey % 7 <> 0 THEN p_size END AS stock_quantity,
         p_partkey % 10 <> 0 AS availability,
         variant_count, s_name AS shop_name, n_name AS shop_country,
         CASE p_partkey % 3 WHEN 0 THEN 'shopify' WHEN 1 THEN 'woocommerce' ELSE 'generic' END AS platform
  FROM part LEFT JOIN sold ON p_partkey = l_partkey
  LEFT JOIN supplier ON s_suppkey = p_partkey % (SELECT count(*) FROM supplier)
  LEFT JOIN nation ON s_nationkey = n_nationkey)"""


def category_of(title: str) -> str:
    return f"""CASE WHEN regexp_matches(lower({title}), 'serum|cream|lotion|cleanser|moisturizer|toner|oil|mask|peel') THEN 'Skincare'
      WHEN regexp_matches(lower({title}), 'lipstick|palette|foundation|concealer|mascara|liner|blush|gloss') THEN 'Makeup'
      WHEN regexp_matches(lower({title}), 'shampoo|conditioner|hair|scalp') THEN 'Haircare'
      WHEN regexp_matches(lower({title}), 'kit|set|bundle|collection') THEN 'Kits & Sets' ELSE 'Other' END"""


def subcategory_of(title: str) -> str:
    return f"""CASE ({category_of(title)})
      WHEN 'Skincare' THEN CASE WHEN regexp_matches(lower({title}), 'serum') THEN 'Serums'
        WHEN regexp_matches(lower({title}), 'mask') THEN 'Masks'
        WHEN regexp_matches(lower({title}), 'cream|moisturizer') THEN 'Moisturizers' ELSE 'General' END
      WHEN 'Makeup' THEN CASE WHEN regexp_matches(lower({title}), 'lipstick|gloss') THEN 'Lips'
        WHEN regexp_matches(lower({title}), 'palette') THEN 'Eyes' ELSE 'General' END
      ELSE 'General' END"""


CLEAN = PRODUCTS + f""",
medians AS (SELECT median(rating) AS rating, median(stock_quantity) AS stock, median(price) AS price FROM products),
imputed AS (
  SELECT p.product_id, key, title, brand,
         trim(coalesce(category, {category_of('title')})) AS category,
         CASE WHEN category IS NULL THEN {subcategory_of('title')} ELSE subcategory END AS subcategory,
         coalesce(p.price, m.price) AS price,
         coalesce(p.rating, m.rating, 3.5) AS rating,
         greatest(0, coalesce(review_count, 0))::BIGINT AS review_count,
         least(100.0, greatest(0.0, coalesce(discount_pct, 0.0)))::DOUBLE AS discount_pct,
         coalesce(stock_quantity::DOUBLE, m.stock, 0.0) AS stock_quantity,
         CASE WHEN availability THEN 1 ELSE 0 END AS availability,
         coalesce(variant_count, 1) AS variant_count,
         shop_name, trim(coalesce(shop_country, 'Unknown')) AS shop_country, platform
  FROM products p, medians m),
clean AS (SELECT * FROM imputed WHERE title IS NOT NULL AND price > 0)"""

SCORE = """
bounds AS (SELECT min(rating) AS r0, max(rating) AS r1, min(ln(1 + review_count)) AS v0, max(ln(1 + review_count)) AS v1,
  min(price) AS p0, max(price) AS p1, min(discount_pct) AS d0, max(discount_pct) AS d1,
  min(stock_quantity) AS s0, max(stock_quantity) AS s1 FROM clean),
raw_score AS (SELECT clean.*, round({0}::DOUBLE * ((rating - r0) / (r1 - r0))
  + {1}::DOUBLE * ((ln(1 + review_count) - v0) / (v1 - v0))
  + {2}::DOUBLE * (1 - (price - p0) / (p1 - p0))
  + {3}::DOUBLE * ((discount_pct - d0) / (d1 - d0))
  + {4}::DOUBLE * availability
  + {5}::DOUBLE * ((stock_quantity - s0) / (s1 - s0)), 4) AS score FROM clean, bounds),
scored AS (SELECT *, (rank() OVER (ORDER BY score DESC))::INTEGER AS score_rank,
  CASE WHEN score >= (SELECT quantile_cont(score, 0.8) FROM raw_score) THEN 1 ELSE 0 END AS is_top_product
  FROM raw_score)"""

SCORED = CLEAN + "," + SCORE.format(0.35, 0.25, 0.15, 0.10, 0.10, 0.05)
PRODUCT_LIST = ("product_id, title, brand, category, subcategory, price, rating, review_count, discount_pct, "
                "stock_quantity, availability, variant_count, shop_name, shop_country, platform")
BEST = "score DESC, product_id"


def products(sql: str) -> str:
    return f"WITH {PRODUCTS}\n{sql}"


def clean(sql: str) -> str:
    return f"WITH {CLEAN}\n{sql}"


def scored(sql: str) -> str:
    return f"WITH {SCORED}\n{sql}"


def counted(key: str) -> str:
    return f"(SELECT {key}, count(*) AS count FROM scored WHERE {key} IS NOT NULL GROUP BY 1)"


def fixed(x: str, digits: int) -> str:
    return f"round(({x})::DECIMAL(24,6), {digits})::VARCHAR"


def md5_int(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 8))::BIGINT"


def stripped(html: str) -> str:
    text = f"coalesce({html}, '')"
    for pattern in (r"<!--.*?-->", r"<script\b.*?</script>", r"<style\b.*?</style>", r"<[a-zA-Z/!?][^>]*>"):
        text = f"regexp_replace({text}, '{pattern}', ' ', 'gis')"
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"),
                         ("&apos;", "''"), ("&copy;", "©"), ("&middot;", "·"), ("&euro;", "€"), ("&amp;", "&")):
        text = f"replace({text}, '{entity}', '{char}')"
    return f"trim(regexp_replace({text}, '\\s+', ' ', 'g'))"


ORACLE: dict[str, str] = {
    "products_view": products(f"SELECT {PRODUCT_LIST} FROM products"),
    "csv_snapshot": products(f"SELECT {PRODUCT_LIST} FROM products"),
    "csv_quoted_lines": f"""SELECT doc_id::VARCHAR AS product_id, CASE WHEN text NOT IN ({NA_LIST}) THEN text END AS description,
        lang AS category FROM documents""",
    "jsonl_snapshot": products("SELECT product_id, title, category, price, rating FROM products"),
    "optional_top_k": scored(
        f"SELECT row_number() OVER (ORDER BY {BEST})::INTEGER AS rank, product_id, score FROM scored "
        f"ORDER BY {BEST} LIMIT 50"),
    "non_empty_guard": "SELECT count(*) AS rows FROM part",
    "export_manifest": clean("""SELECT dataset, rows, '2024-01-01T00:00:00' AS generated_at FROM (
      SELECT 'products_scored' AS dataset, count(*) AS rows FROM clean
      UNION ALL SELECT 'top_k_products', least(50, count(*)) FROM clean
      UNION ALL SELECT 'shop_leaderboard', least(10, count(DISTINCT shop_name)) FROM clean)"""),
}

# --- normalisation --------------------------------------------------------

MONEY_TEXTS = """
parts AS (SELECT l_orderkey, l_linenumber, (l_orderkey + l_linenumber) % 8 AS style,
  round(l_extendedprice * 100)::BIGINT // 100 AS whole,
  lpad((round(l_extendedprice * 100)::BIGINT % 100)::VARCHAR, 2, '0') AS part FROM lineitem),
pieces AS (SELECT *, (whole // 1000)::VARCHAR AS hi, lpad((whole % 1000)::VARCHAR, 3, '0') AS lo FROM parts),
texts AS (SELECT l_orderkey, l_linenumber, CASE style
  WHEN 0 THEN '$' || whole || '.' || part WHEN 1 THEN hi || ',' || lo || '.' || part
  WHEN 2 THEN '€' || whole || ',' || part WHEN 3 THEN hi || '.' || lo || ',' || part
  WHEN 4 THEN hi || ',' || lo WHEN 5 THEN '-' || whole || ',5' WHEN 6 THEN whole || ',2.3.4'
  ELSE 'sold out' END AS price_text FROM pieces)"""


def money(text: str) -> str:
    c = f"regexp_replace({text}, '[^0-9.,]', '', 'g')"
    return f"""coalesce(TRY_CAST(CASE
      WHEN contains({c}, '.') AND contains({c}, ',') AND instr(reverse({c}), '.') < instr(reverse({c}), ',') THEN replace({c}, ',', '')
      WHEN contains({c}, '.') AND contains({c}, ',') THEN replace(replace({c}, '.', ''), ',', '.')
      WHEN regexp_full_match({c}, '[0-9]*,[0-9][0-9]') THEN replace({c}, ',', '.')
      ELSE replace({c}, ',', '') END AS DOUBLE), 0.0)"""


BASE_URL = "coalesce(nullif(regexp_extract(url, '^(https?://[^/]+)', 1), ''), url)"
HOST = f"regexp_replace({BASE_URL}, 'https?://', '')"
NEXT_LINK = (r"""<a\b[^>]*\brel=["'']next["'']|<a\b[^>]*\bclass=["''](?:[^"'']*\s)?next(?:\s[^"'']*)?["'']"""
             r"""|\bclass=["''](?:[^"'']*\s)?pagination__next(?:\s[^"'']*)?["'']|\baria-label=["'']Next page["'']""")
SHOPS = "(SELECT count(*) FROM supplier)"
LISTED = f"(SELECT DISTINCT key % {SHOPS} AS shop, key // (250 * {SHOPS}) AS page FROM products)"
PRICE = fixed("price", 2)


def listed_cards(columns: str, where: str = "true") -> str:
    return products(f"SELECT {columns} FROM products, (SELECT count(*) AS shops FROM supplier) WHERE {where}")


CARD_BASE = "'https://shop' || (key % shops) || '.example.com'"

ORACLE |= {
    "parse_money": f"WITH {MONEY_TEXTS} SELECT *, {money('price_text')} AS amount FROM texts",
    "parse_int": f"""WITH {MONEY_TEXTS} SELECT l_orderkey, l_linenumber,
      CASE WHEN regexp_full_match(replace(price_text, ',', ''), '[+-]?[0-9]+')
           THEN replace(price_text, ',', '')::BIGINT ELSE 0 END AS count FROM texts""",
    "percent_off": """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_extendedprice > c AND c > 0
      THEN round((l_extendedprice - c) / l_extendedprice * 100, 1) END AS discount
      FROM (SELECT *, round(l_extendedprice * (1 - l_discount), 2) AS c FROM lineitem)""",
    "strip_html": f"SELECT page_id, {stripped('html')} AS text FROM pages",
    "page_urls": f"""SELECT page_id, {BASE_URL} AS base_url, split_part({HOST}, '.', 1) AS shop,
      split_part({HOST}, '/', 1) AS host, url AS page1,
      url || CASE WHEN contains(url, '?') THEN '&page=2' ELSE '?page=2' END AS page2 FROM pages""",
    "platform_detect": """SELECT page_id, CASE WHEN contains(url, 'blog.') OR contains(html, 'utm_source') THEN 'shopify'
      WHEN contains(lower(html), '<table') OR page_id % 7 + 196 IN (200, 401) THEN 'woocommerce'
      ELSE 'generic' END AS platform FROM pages""",
    "next_page_links": products(f"""SELECT has_next, count(*) AS pages FROM (
      SELECT regexp_matches(html, '(?is){NEXT_LINK}') AS has_next FROM pages
      UNION ALL SELECT true FROM {LISTED}) GROUP BY 1"""),
    "page_products": products("""SELECT platform, 'USD' AS currency, count(*) AS products, round(sum(price), 2) AS total,
      count(*) AS listings, count(*) AS available
      FROM (SELECT price FROM products), (VALUES ('shopify'), ('woocommerce'), ('generic')) AS t(platform) GROUP BY 1"""),
    "shopify_normalize": listed_cards(f"""product_id, trim(title) AS title,
      'Fine ' || title || ' & more' AS description, coalesce(category, '') AS category, subcategory, brand,
      'https://img/' || product_id AS image_url, CASE WHEN key % 2 = 0 THEN 'new, sale' ELSE 'old, blue' END AS tags,
      {CARD_BASE} || '/products/item-' || product_id AS url, 'shopify' AS platform,
      CASE WHEN discount_pct > 0 AND price <> 0 THEN round(price + 5, 2) ELSE price END AS price,
      CASE WHEN discount_pct > 0 THEN price END AS price_promo,
      CASE WHEN discount_pct > 0 THEN round(price + 5, 2) END AS price_old,
      CASE WHEN discount_pct > 0 AND price > 0
           THEN round((round(price + 5, 2) - price) / round(price + 5, 2) * 100, 1) END AS discount_pct,
      NULL::DOUBLE AS rating, 0::BIGINT AS review_count, availability,
      nullif(coalesce(stock_quantity, 0), 0)::BIGINT AS stock_quantity, 2::INTEGER AS variant_count,
      'Red, Blue' AS colors, 'M' AS sizes, 'shop' || (key % shops) AS shop_name,
      '2024-01-01T00:00:00Z' AS published_at"""),
    "woo_normalize": listed_cards(f"""product_id, title,
      CASE WHEN key % 3 = 0 THEN 'Short ' || title ELSE 'Long ' || title END AS description,
      coalesce(category, 'Misc') AS category, subcategory, brand, 'https://img/' || product_id AS image_url,
      'hot, ' || subcategory AS tags, 'https://w/' || product_id AS url, 'woocommerce' AS platform,
      CASE WHEN key % 5 <> 0 THEN round(price + 1, 2) ELSE price END AS price,
      CASE WHEN discount_pct > 0 AND key % 5 <> 0 AND price <> 0 THEN price END AS price_promo,
      CASE WHEN discount_pct > 0 AND key % 5 <> 0 AND price <> 0 THEN round(price + 1, 2) END AS price_old,
      CASE WHEN discount_pct > 0 AND key % 5 <> 0 AND price <> 0
           THEN round((round(price + 1, 2) - price) / round(price + 1, 2) * 100, 1) END AS discount_pct,
      rating, review_count, availability, nullif(stock_quantity, 0)::BIGINT AS stock_quantity,
      CASE WHEN key % 4 = 0 THEN 1 ELSE greatest(1, variant_count) END::INTEGER AS variant_count,
      '' AS colors, 'S, L' AS sizes, 'shop' || (key % shops) || '.example.com' AS shop_name,
      '2024-02-02T00:00:00' AS published_at"""),
    "platform_union": products("""SELECT platform, 'USD' AS currency, count(*) AS products,
      round(sum(p), 2) AS total, count(d) AS discounted FROM (
      SELECT 'shopify' AS platform, CASE WHEN discount_pct > 0 AND price <> 0 THEN round(price + 5, 2) ELSE price END AS p,
        CASE WHEN discount_pct > 0 THEN 1 END AS d FROM products
      UNION ALL SELECT 'woocommerce', CASE WHEN key % 5 <> 0 THEN round(price + 1, 2) ELSE price END,
        CASE WHEN discount_pct > 0 AND key % 5 <> 0 AND price <> 0 THEN 1 END FROM products) GROUP BY 1"""),
    "woo_reviews": f"""WITH ranked AS (SELECT doc_id % 211 AS id, doc_id, CASE WHEN doc_id % 5 <> 0 THEN text END AS review,
        row_number() OVER (PARTITION BY doc_id % 211 ORDER BY doc_id) AS n FROM documents),
      digest AS (SELECT id, string_agg(substr({stripped('review')}, 1, 150), ' | ' ORDER BY n) AS customer_reviews
        FROM ranked WHERE n <= 3 AND coalesce(review, '') <> '' GROUP BY 1)
      SELECT p_partkey AS id, customer_reviews FROM part LEFT JOIN digest ON id = p_partkey""",
    "shop_totals": """SELECT s_suppkey, total AS shop_product_count FROM supplier LEFT JOIN
      (SELECT l_suppkey, count(*) AS total FROM lineitem GROUP BY 1) ON l_suppkey = s_suppkey""",
    "generic_normalize": products("""SELECT title, price, 'https://g/' || product_id AS url,
      coalesce(category, '') AS category, rating, 'USD' AS currency, 'generic' AS platform, true AS availability,
      1::INTEGER AS variant_count FROM products WHERE key % 9 <> 0"""),
    "generic_cards": listed_cards(
        f"{CARD_BASE} AS base_url, title, price, {CARD_BASE} || '/p/' || product_id AS url, "
        "'/i/' || product_id || '.png' AS image_url, true AS has_next",
        f"(key % {SHOPS}, key // (250 * {SHOPS})) IN (SELECT (key % {SHOPS}, key // (250 * {SHOPS})) FROM products "
        "GROUP BY 1 HAVING count(*) >= 2)"),
    "shopify_cards": listed_cards(
        f"title, price, {CARD_BASE} || '/products/' || product_id AS url, 'shop' || (key % shops) AS shop_name, "
        "'shopify' AS platform"),
    "woo_cards": listed_cards(
        f"{CARD_BASE} AS base_url, title, price, 'https://w/' || product_id AS url, '' AS image_url, false AS has_next"),
    "single_product_pages": products("""SELECT key AS page_id, 'single' AS kind, title, price,
      'https://s.example.com/p/' || product_id AS url, 'Good' || subcategory AS description,
      '/i/' || product_id || '.png' AS image_url FROM products"""),
    "cards_in_raw_pages": "SELECT count(*) AS items FROM pages WHERE regexp_matches(html, 'itemprop|product')",
    "snapshot_columns": products("""SELECT product_id,
      CASE WHEN key % 2 = 0 THEN discount_pct
           WHEN discount_pct > 0 THEN round((round(price + 5, 2) - price) / round(price + 5, 2) * 100, 1) END AS discount_pct,
      '2024-01-01T00:00:00+00:00' AS scraped_at, 0.0::DOUBLE AS score,
      CASE WHEN price <= 0 THEN NULL WHEN price <= 10 THEN '<$10' WHEN price <= 30 THEN '$10-30'
           WHEN price <= 100 THEN '$30-100' WHEN price <= 300 THEN '$100-300' WHEN price > 300 THEN '>$300' END AS price_band,
      key % 4 = 0 AND price IS NOT NULL AS is_on_sale,
      coalesce(coalesce(rating, 0) >= 4 AND review_count >= 100, false) AS is_popular,
      coalesce(stock_quantity < 10, false) AS is_low_stock,
      CASE WHEN price <= 0 THEN NULL WHEN price <= 10 THEN 0 WHEN price <= 30 THEN 1 WHEN price <= 100 THEN 2
           WHEN price <= 300 THEN 3 WHEN price > 300 THEN 4 END::INTEGER AS band_no FROM products"""),
}

# --- cleaning and features ------------------------------------------------

FEATURED = SCORED + """,
half AS (SELECT median(price) AS m FROM scored),
featured AS (SELECT scored.*, ln(1 + price) AS log_price, rating * ln(1 + review_count) AS popularity_score,
  CASE WHEN price <= m * 0.5 THEN 1 ELSE 0 END AS is_budget, CASE WHEN price >= m * 2 THEN 1 ELSE 0 END AS is_premium,
  (dense_rank() OVER (ORDER BY category) - 1)::INTEGER AS category_enc,
  (dense_rank() OVER (ORDER BY platform) - 1)::INTEGER AS platform_enc,
  (dense_rank() OVER (ORDER BY shop_country) - 1)::INTEGER AS shop_country_enc FROM scored, half)"""
FEATURE_NAMES = ["log_price", "rating", "discount_pct", "stock_quantity", "variant_count", "availability", "is_budget",
                 "is_premium", "popularity_score", "category_enc", "platform_enc", "shop_country_enc"]


def scaled(c: str, source: str = "featured") -> str:
    lo, hi = f"(SELECT min({c}) FROM {source})", f"(SELECT max({c}) FROM {source})"
    return f"({c} - {lo}) / (CASE WHEN {hi} > {lo} THEN ({hi} - {lo})::DOUBLE ELSE 1.0::DOUBLE END)"


ORACLE |= {
    "clean_catalog": clean(f"SELECT {PRODUCT_LIST} FROM clean"),
    "dropped_rows": clean("""SELECT count(*) AS rows_before, count(*) FILTER (title IS NOT NULL AND price > 0) AS rows_after,
      count(*) - count(*) FILTER (title IS NOT NULL AND price > 0) AS rows_dropped FROM imputed"""),
    "infer_category": f"SELECT doc_id, {category_of('text')} AS category, {subcategory_of('text')} AS subcategory FROM documents",
    "impute_category": products(f"""SELECT category, subcategory, count(*) AS products FROM (
      SELECT coalesce(category, {category_of('title')}) AS category,
             CASE WHEN category IS NULL THEN {subcategory_of('title')} ELSE subcategory END AS subcategory FROM products)
      GROUP BY ALL"""),
    "repair_ids": """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN (o_orderkey * 1000)::VARCHAR
      WHEN 1 THEN o_orderkey::VARCHAR WHEN 2 THEN 'Unknown' ELSE '900719925474099' || o_orderkey END AS product_id FROM orders""",
    "synthetic_ratings": products(f"""SELECT product_id,
      round(least(5.0, greatest(1.0, base + ({md5_int("'rating|' || product_id")} % 1000000 / 1000000.0::DOUBLE * 0.8 - 0.5))), 1) AS rating,
      low + {md5_int("'reviews|' || product_id")} % (high - low + 1) AS review_count
      FROM (SELECT product_id, CASE WHEN p > 100 THEN 4.2 WHEN p > 30 THEN 4.0 ELSE 3.8 END::DOUBLE AS base,
        CASE WHEN p > 100 THEN 50 WHEN p > 30 THEN 10 ELSE 0 END AS low,
        CASE WHEN p > 100 THEN 500 WHEN p > 30 THEN 200 ELSE 50 END AS high
        FROM (SELECT product_id, price * 2 AS p FROM products))"""),
    "availability_flags": """SELECT availability, count(*) AS rows FROM (SELECT
      CASE WHEN event_id % 6 = 1 THEN 0 ELSE 1 END::INTEGER AS availability FROM events) GROUP BY 1""",
    "features": f"""WITH {FEATURED} SELECT product_id, round(log_price, 9) AS log_price,
      round(popularity_score, 9) AS popularity_score, is_budget, is_premium, category_enc, platform_enc, shop_country_enc
      FROM featured""",
    "label_codes": scored("""SELECT category, (dense_rank() OVER (ORDER BY category) - 1)::INTEGER AS category_enc
      FROM (SELECT DISTINCT category FROM scored)"""),
    "minmax_features": f"WITH {FEATURED} SELECT product_id, "
                       + ", ".join(f"round({scaled(c)}, 6) AS {c}" for c in FEATURE_NAMES) + " FROM featured",
    "fitted_scaler_reuse": f"WITH {FEATURED}, fit AS (SELECT * FROM featured WHERE platform = 'shopify') SELECT product_id, "
                           + ", ".join(f"round({scaled(c, 'fit')}, 6) AS {c}"
                                       for c in ("rating", "discount_pct", "stock_quantity")) + " FROM featured",
    "feature_matrix": f"WITH {FEATURED} SELECT product_id, {len(FEATURE_NAMES)}::INTEGER AS width, round("
                      + " + ".join(scaled(c) for c in FEATURE_NAMES)
                      + ", 6) AS row_sum, is_top_product AS label FROM featured",
    "enrich_countries": products(f"""SELECT product_id, shop_name, CASE WHEN key % 2 = 0 THEN
      list_extract(['USA', 'UK', 'FR', 'DE', 'CA', 'AU', 'ES', 'IT'], 1 + {md5_int('shop_name')} % 8)
      ELSE shop_country END AS shop_country FROM products"""),
    "relabel_platform": products(f"""SELECT platform, count(*) AS products FROM (SELECT
      CASE WHEN {md5_int('product_id')} % 10 < 3 THEN 'woocommerce' ELSE platform END AS platform FROM products) GROUP BY 1"""),
    "filter_catalog": scored("""SELECT product_id, category, price, platform FROM scored
      WHERE price BETWEEN 10 AND 60 AND category = 'PROMO'"""),
    "filter_fallback": scored("SELECT count(*) AS products FROM scored"),
    "category_subset": scored(f"""SELECT rank, product_id, category, score FROM (SELECT *,
      row_number() OVER (ORDER BY {BEST})::INTEGER AS rank FROM scored) WHERE rank <= 200 AND lower(category) = 'economy'"""),
    "ensure_target": clean("SELECT 0::INTEGER AS is_top_product, count(*) AS products FROM clean"),
}

# --- scoring --------------------------------------------------------------

ORACLE |= {
    "scored_products": scored("SELECT product_id, score, score_rank, is_top_product FROM scored"),
    "topk_products": scored(f"""SELECT row_number() OVER (ORDER BY {BEST})::INTEGER AS rank, product_id, title, category,
      price, rating, review_count, score, score_rank FROM scored ORDER BY {BEST} LIMIT 50"""),
    "custom_weights": f"WITH {CLEAN}," + SCORE.format(0.5, 0.1, 0.2, 0.1, 0.05, 0.05) + f"""
      SELECT row_number() OVER (ORDER BY {BEST})::INTEGER AS rank, product_id, score FROM scored ORDER BY {BEST} LIMIT 20""",
    "score_label_counts": scored("""SELECT is_top_product, count(*) AS products, min(score) AS min_score,
      max(score) AS max_score FROM scored GROUP BY 1"""),
    "telemetry_gate": clean("SELECT bool_or(review_count > 2) AND bool_or(rating <> 3.5) AS has_telemetry FROM clean"),
    "fallback_score": clean(f"""SELECT product_id, round(points / (max(points) OVER ()) * 100, 2) / 100.0::DOUBLE AS score FROM (
      SELECT product_id, discount_pct * 0.4::DOUBLE + CASE WHEN regexp_matches(lower(brand),
        'glossier|banish|drunk elephant|chanel|dior|fenty') THEN 30 ELSE 0 END
        + (1 - (price - (SELECT min(price) FROM clean)) / (SELECT max(price) - min(price) FROM clean)) * 20
        + CASE WHEN category = 'Skincare' THEN 10 ELSE 0 END
        + {md5_int("'score|' || product_id")} % 1000000 / 1000000.0::DOUBLE * 5 AS points FROM clean)"""),
    "best_per_category": scored(f"""SELECT category, product_id, title, price, score FROM scored
      QUALIFY row_number() OVER (PARTITION BY category ORDER BY {BEST}) = 1 ORDER BY category LIMIT 6"""),
    "shop_leaderboard": scored(f"""SELECT shop_name, shop_country, round(avg(score), 6) AS avg_score,
      count(title) AS product_count, round(avg(rating), 6) AS avg_rating, first(title ORDER BY {BEST}) AS top_product
      FROM scored GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10"""),
    "shop_table": scored("""SELECT shop_name, shop_country, round(avg(score), 6) AS avg_score,
      count(title) AS product_count, round(avg(rating), 6) AS avg_rating FROM scored GROUP BY 1, 2"""),
}
for _key in ("rating", "price", "review_count"):
    ORACLE[f"top_by_{_key}"] = scored(f"""SELECT row_number() OVER (ORDER BY {_key} DESC, product_id)::INTEGER AS rank,
      product_id, {_key} FROM scored ORDER BY {_key} DESC, product_id LIMIT 20""")

# --- dashboard aggregates -------------------------------------------------


def market(key: str) -> str:
    return scored(f"""SELECT {key}, round(avg(price), 3) AS price, round(avg(rating), 3) AS rating,
      round(avg(review_count), 3) AS review_count, round(avg(score), 3) AS score, count(*) AS count FROM scored GROUP BY 1""")


def shares(key: str) -> str:
    return scored(f"""SELECT {key}, count, round(count / sum(count) OVER (), 4) AS share FROM {counted(key)}""")


SEGMENTS = SCORED + """,
segments AS (SELECT *, CASE WHEN price <= 1 THEN -1 ELSE floor(price / 20) END::INTEGER AS cluster FROM scored),
profiles AS (SELECT cluster, avg(price) AS avg_price, avg(rating) AS avg_rating, avg(review_count) AS avg_reviews,
  avg(discount_pct) AS avg_discount, count(title) AS count FROM segments WHERE cluster <> -1 GROUP BY 1),
names AS (SELECT *, CASE WHEN avg_price > (SELECT quantile_cont(price, 0.75) FROM scored) THEN 'Premium'
  WHEN avg_discount > 20 THEN 'Discount / Promo' WHEN avg_rating >= 4.2 AND avg_reviews >= 200 THEN 'Top rated'
  WHEN avg_reviews < 50 THEN 'Niche / peu connu' ELSE 'Mainstream' END AS cluster_label FROM profiles),
labelled AS (SELECT segments.*, CASE WHEN segments.cluster = -1 THEN 'Anomalie (DBSCAN)' ELSE names.cluster_label END AS cluster_label
  FROM segments LEFT JOIN names USING (cluster))"""
TOP5 = f"""(SELECT string_agg('  ' || rank || '. ' || title || ' — score=' || {fixed('score', 3)} || ', prix='
  || {fixed('price', 2)} || '$, rating=' || rating, chr(10) ORDER BY rank) FROM (SELECT *,
  row_number() OVER (ORDER BY {BEST}) AS rank FROM scored) WHERE rank <= 5)"""

ORACLE |= {
    "market_stats_category": market("category"),
    "market_stats_platform": market("platform"),
    "market_stats_unknown_key": market("category"),
    "kpi_overview": scored("""SELECT count(*) AS total_products, round(avg(score), 4) AS avg_score,
      median(price) AS median_price, round(avg(rating), 4) AS avg_rating,
      floor(avg(is_top_product) * 100)::BIGINT AS top_pct,
      floor(avg(CASE WHEN discount_pct > 0 THEN 1 ELSE 0 END) * 100)::BIGINT AS on_sale_pct FROM scored"""),
    "kpi_pricing": scored("""SELECT min(price) AS min_price, max(price) AS max_price, round(avg(price), 4) AS mean_price,
      count(*) FILTER (discount_pct > 0) AS on_sale,
      round(avg(discount_pct) FILTER (discount_pct > 0), 4) AS avg_discount, max(discount_pct) AS max_discount FROM scored"""),
    "kpi_shops": scored("""SELECT count(*) AS shops, round(max(a), 6) AS best_score, round(avg(a), 6) AS avg_shop_score,
      max(n) AS largest_shop, (SELECT count(DISTINCT shop_country) FROM scored) AS countries
      FROM (SELECT avg(score) AS a, count(title) AS n FROM scored GROUP BY shop_name, shop_country)"""),
    "distribution_category": shares("category"),
    "distribution_platform": shares("platform"),
    "distribution_country": shares("shop_country"),
    "score_histogram": scored("""SELECT platform, least(39, floor(score / (1.0::DOUBLE / 40)))::INTEGER AS bin, count(*) AS count
      FROM scored WHERE score BETWEEN 0 AND 1 GROUP BY 1, 2"""),
    "discount_histogram": scored("""SELECT least(19, floor(discount_pct / 5.0::DOUBLE))::INTEGER AS bin, count(*) AS count
      FROM scored WHERE discount_pct > 0 AND discount_pct <= 100 GROUP BY 1"""),
    "price_boxplot": scored("""SELECT s.category, q1, q.median, q3,
      min(price) FILTER (price BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
      max(price) FILTER (price BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
      count(*) AS count, count(*) FILTER (NOT price BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
      FROM scored s JOIN (SELECT category, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.5) AS median,
        quantile_cont(price, 0.75) AS q3 FROM scored GROUP BY 1) q ON s.category = q.category GROUP BY 1, 2, 3, 4"""),
    "review_boxplot_outliers": scored("""SELECT product_id, s.category, review_count FROM scored s JOIN (
      SELECT category, quantile_cont(review_count, 0.25) AS q1, quantile_cont(review_count, 0.75) AS q3
      FROM scored GROUP BY 1) q ON s.category = q.category
      WHERE NOT review_count BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)"""),
    "price_by_platform": scored("""SELECT platform, count(price) AS count, round(avg(price), 2) AS mean,
      round(median(price), 2) AS median, round(min(price), 2) AS min, round(max(price), 2) AS max FROM scored GROUP BY 1"""),
    "price_by_category": scored("""SELECT category, count(price) AS count, round(avg(price), 2) AS mean,
      round(median(price), 2) AS median FROM scored GROUP BY 1 ORDER BY 3 DESC, 1 LIMIT 10"""),
    "discounted_share": scored("""SELECT round(avg(CASE WHEN discount_pct > 0 THEN 1 ELSE 0 END) * 100, 1) AS pct_discounted
      FROM scored"""),
    "alerts": scored("""SELECT count(*) FILTER (stock_quantity < 5) AS low_stock,
      count(*) FILTER (discount_pct > 40) AS high_discount FROM scored"""),
    "country_scores": scored("SELECT shop_country, round(avg(score), 6) AS avg_score FROM scored GROUP BY 1"),
    "run_summary": scored("""SELECT count(*) AS rows, 19::BIGINT AS columns, min(price) AS price_min,
      round(avg(price), 2) AS price_mean, max(price) AS price_max, round(avg(rating), 2) AS rating_mean,
      count(rating) AS rated FROM scored"""),
    "top_categories": scored(f"SELECT category, count FROM {counted('category')} ORDER BY 2 DESC, 1 LIMIT 5"),
    "top_brands": scored(f"SELECT brand, count FROM {counted('brand')} ORDER BY 2 DESC, 1 LIMIT 10"),
    "qa_stats": scored("""SELECT count(*) AS total_products, round(avg(score), 3) AS avg_score,
      round(median(price), 2) AS median_price, round(avg(rating), 1) AS avg_rating FROM scored"""),
    "insights": scored(f"""SELECT category AS top_category, count AS top_category_count,
      (SELECT quantile_cont(price, 0.25) FROM scored) AS price_p25, (SELECT median(price) FROM scored) AS price_median,
      (SELECT quantile_cont(rating, 0.75) FROM scored) AS rating_p75
      FROM {counted('category')} ORDER BY 2 DESC, 1 LIMIT 1"""),
    "domain_category": scored("SELECT DISTINCT category FROM scored WHERE category IS NOT NULL"),
    "domain_stats": scored("""SELECT min(price) AS price_min, max(price) AS price_max, count(*) AS products,
      count(DISTINCT shop_name) AS shops, count(DISTINCT category) AS categories FROM scored"""),
    "quadrant_counts": scored("""SELECT quadrant, count(*) AS count, round(avg(price), 4) AS avg_price,
      round(avg(score), 4) AS avg_score FROM (SELECT price, score, CASE
        WHEN price >= (SELECT median(price) FROM scored) AND score >= (SELECT median(score) FROM scored) THEN 'Premium Value'
        WHEN price >= (SELECT median(price) FROM scored) THEN 'Overpriced'
        WHEN score >= (SELECT median(score) FROM scored) THEN 'Hidden Gems' ELSE 'Weak Products' END AS quadrant FROM scored)
      GROUP BY 1"""),
    "top_scatter": scored(f"""SELECT product_id, title, platform, category, price, rating, review_count, score,
      median(price) OVER () AS median_price, median(rating) OVER () AS median_rating
      FROM (SELECT * FROM scored ORDER BY {BEST} LIMIT 20)"""),
    "kpi_topk": scored(f"""SELECT (SELECT count(*) FROM scored WHERE platform = 'shopify') AS eligible_products,
      max(score) AS top_score, round(avg(price), 4) AS avg_price, round(avg(rating), 4) AS avg_rating,
      floor(avg(CASE WHEN discount_pct > 0 THEN 1 ELSE 0 END) * 100)::BIGINT AS on_sale_pct
      FROM (SELECT * FROM scored WHERE platform = 'shopify' ORDER BY {BEST} LIMIT 20)"""),
    "trend_stats": scored("""SELECT s.*, platform, products FROM (SELECT count(*) AS total_products,
      round(avg(score), 3) AS avg_score, round(avg(price), 2) AS avg_price, round(avg(rating), 2) AS avg_rating,
      round(avg(CASE WHEN discount_pct > 0 THEN 1 ELSE 0 END) * 100, 1) AS pct_on_sale FROM scored) s,
      (SELECT platform, count(*) AS products FROM scored GROUP BY 1) p"""),
    "persona_stats": scored(f""", top AS (SELECT * FROM scored ORDER BY {BEST} LIMIT 20)
      SELECT round(min(price), 2) AS price_min, round(max(price), 2) AS price_max, round(avg(rating), 1) AS avg_rating,
      (SELECT string_agg(category, ', ' ORDER BY n DESC, category) FROM (SELECT category, count(*) AS n FROM top
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3)) AS top_categories FROM top"""),
    "cluster_names": f"""WITH {SEGMENTS} SELECT cluster, round(avg_price, 6) AS avg_price, count, cluster_label FROM names""",
    "cluster_lookup": f"WITH {SEGMENTS} SELECT cluster, cluster_label, count(*) AS products FROM labelled GROUP BY 1, 2",
    "cluster_profile": f"""WITH {SEGMENTS} SELECT cluster_label, round(avg(price), 3) AS price, round(avg(rating), 3) AS rating,
      round(avg(review_count), 3) AS review_count, round(avg(discount_pct), 3) AS discount_pct,
      round(avg(score), 3) AS score, count(*) AS count FROM labelled GROUP BY 1""",
    "kpi_clusters": f"""WITH {SEGMENTS}, sizes AS (SELECT cluster_label, count(*) AS n FROM labelled GROUP BY 1)
      SELECT count(*) AS clusters, max(n) AS largest, first(cluster_label ORDER BY n DESC, cluster_label) AS largest_name,
      min(n) AS smallest, sum(n)::BIGINT AS total,
      coalesce(sum(n) FILTER (cluster_label = 'Anomalie (DBSCAN)'), 0)::BIGINT AS anomalies FROM sizes""",
}

# --- de-duplication and sets ----------------------------------------------

RUNS = PRODUCTS + """,
runs AS (SELECT key AS seq, product_id, title, price, platform, rating FROM products
  UNION ALL SELECT key + 10000000000, product_id, title, price, platform, 1.5 FROM products WHERE key % 5 = 0)"""
SPLIT = SCORED + """,
placed AS (SELECT product_id, is_top_product AS label, row_number() OVER (PARTITION BY is_top_product
  ORDER BY md5('42|' || product_id), product_id) AS pos FROM scored),
split AS (SELECT product_id, label, pos, pos <= (SELECT round_even(0.2 * count(*), 0) FROM placed p
  WHERE p.label = placed.label) AS is_test FROM placed)"""

ORACLE |= {
    "dedup_first": f"""WITH {RUNS} SELECT title, price, platform, product_id, rating FROM runs
      QUALIFY row_number() OVER (PARTITION BY title, price, platform ORDER BY seq) = 1""",
    "history_keep_last": f"""WITH {RUNS} SELECT title, price, platform, product_id, rating FROM runs
      QUALIFY row_number() OVER (PARTITION BY title, price, platform ORDER BY seq DESC) = 1""",
    "union_in_order": products("""SELECT 0::INTEGER AS frame, key AS seq, product_id, platform FROM products
      WHERE platform = 'woocommerce'
      UNION ALL SELECT 1, key, product_id, NULL FROM products WHERE platform = 'shopify'
      UNION ALL SELECT 2, key, product_id, platform FROM products WHERE platform = 'generic'"""),
    "distinct_titles": scored("SELECT DISTINCT brand, subcategory, title FROM scored"),
    "row_overlap": scored("""SELECT count(*) AS shared_rows FROM (
      SELECT title, category, floor(price / 5) FROM scored WHERE key % 2 = 0
      INTERSECT SELECT title, category, floor(price / 5) FROM scored WHERE key % 2 = 1)"""),
    "stratified_split": f"WITH {SPLIT} SELECT product_id, label, is_test FROM split",
    "stratified_folds": f"WITH {SPLIT} SELECT product_id, (pos % 5)::INTEGER AS fold FROM split",
    "class_weights": scored("""SELECT label, round(t / (2.0::DOUBLE * n), 6) AS balanced,
      round(CASE label WHEN 1 THEN (t - n) / n::DOUBLE ELSE 1.0 END, 6) AS positive FROM (
      SELECT is_top_product AS label, count(*) AS n, sum(count(*)) OVER () AS t FROM scored GROUP BY 1)"""),
    "confusion_metrics": scored("""SELECT 'rule' AS model, round((tp + tn) / (tp + fp + fn + tn), 4) AS accuracy,
      CASE WHEN tp + fp > 0 THEN round(tp / (tp + fp), 4) ELSE 0 END AS precision,
      CASE WHEN tp + fn > 0 THEN round(tp / (tp + fn), 4) ELSE 0 END AS recall,
      CASE WHEN 2 * tp + fp + fn > 0 THEN round(2 * tp / (2 * tp + fp + fn), 4) ELSE 0 END AS f1, tn, fp, fn, tp
      FROM (SELECT count(*) FILTER (a AND g) AS tp, count(*) FILTER (NOT a AND g) AS fp, count(*) FILTER (a AND NOT g) AS fn,
        count(*) FILTER (NOT a AND NOT g) AS tn FROM (SELECT is_top_product = 1 AS a, rating >= 3.9 AS g FROM scored))"""),
    "labels_by_key": f"WITH {SPLIT} SELECT is_test, label AS is_top_product, count(*) AS products FROM split GROUP BY 1, 2",
}

# --- association rules ----------------------------------------------------

RELATED = PRODUCTS + """,
related AS (SELECT p.*, m.title AS mate, CASE WHEN p.key % 3 <> 0 THEN o.title END AS other FROM products p
  LEFT JOIN products m ON m.key = p.key + 1 LEFT JOIN products o ON o.key = p.key + 7),
related_items AS (SELECT DISTINCT 'r|' || product_id AS basket_id, unnest([title, mate, other]) AS item FROM related
  WHERE key % 2 = 0 AND (mate IS NOT NULL OR other IS NOT NULL))"""


def chunk_items(source: str) -> str:
    return f"""
chunk_titles AS (SELECT brand, subcategory, title, min(key) AS first_id FROM {source}
  WHERE brand IS NOT NULL AND subcategory IS NOT NULL AND title IS NOT NULL GROUP BY 1, 2, 3),
chunk_places AS (SELECT *, (row_number() OVER (PARTITION BY brand, subcategory ORDER BY first_id, title) - 1) // 5 AS chunk
  FROM chunk_titles),
chunk_items AS (SELECT 'c|' || brand || '|' || subcategory || '|' || chunk AS basket_id, title AS item FROM chunk_places
  QUALIFY count(*) OVER (PARTITION BY brand, subcategory, chunk) >= 2)"""


BAND = """CASE WHEN price <= 0 THEN NULL WHEN price <= 10 THEN '<$10' WHEN price <= 30 THEN '$10-30'
  WHEN price <= 100 THEN '$30-100' WHEN price <= 300 THEN '$100-300' ELSE '>$300' END"""


def band_items(source: str) -> str:
    group = "category || '|' || band || '|' || draw"
    return f"""
band_titles AS (SELECT DISTINCT category, {BAND} AS band, title FROM {source}
  WHERE category IS NOT NULL AND {BAND} IS NOT NULL AND title IS NOT NULL),
band_draws AS (SELECT *, count(*) OVER (PARTITION BY category, band, draw) AS n, row_number() OVER (
  PARTITION BY category, band, draw ORDER BY md5('band|' || draw || '|' || title), title) AS place
  FROM band_titles, (SELECT unnest(range(1, 11)) AS draw)),
band_items AS (SELECT 'b|' || {group} AS basket_id, title AS item FROM band_draws
  WHERE n >= 2 AND draw <= least(10, n // 2) AND place <= 2 + {md5_int("'band-size|' || " + group)} % 3)"""


def as_sets(items: str) -> str:
    return f"SELECT basket_id, string_agg(item, '|' ORDER BY item) AS items FROM {items} GROUP BY 1"


def order_items(item: str) -> str:
    return (f"items AS (SELECT DISTINCT l_orderkey AS basket_id, {item} AS item FROM lineitem "
            "JOIN part ON l_partkey = p_partkey)")


def pair_rules(min_support: float, min_confidence: float, tail: str = "SELECT * FROM rules") -> str:
    return f"""
total AS (SELECT count(DISTINCT basket_id) AS n FROM items),
single AS (SELECT item, count(*) AS c FROM items GROUP BY 1 HAVING count(*) / (SELECT n FROM total) >= {min_support}),
pairs AS (SELECT a.item AS a, b.item AS b, count(*) AS c FROM items a JOIN items b
  ON a.basket_id = b.basket_id AND a.item <> b.item GROUP BY 1, 2
  HAVING count(*) / (SELECT n FROM total) >= {min_support}),
measured AS (SELECT a AS antecedents, b AS consequents, p.c / n::DOUBLE AS support,
  (p.c / n::DOUBLE) / (x.c / n::DOUBLE) AS confidence,
  ((p.c / n::DOUBLE) / (x.c / n::DOUBLE)) / (y.c / n::DOUBLE) AS lift
  FROM pairs p JOIN single x ON x.item = a JOIN single y ON y.item = b, total),
rules AS (SELECT antecedents, consequents, round(support, 4) AS support, round(confidence, 4) AS confidence,
  round(lift, 4) AS lift FROM measured WHERE confidence >= {min_confidence})
{tail}"""




def _itemsets(widest: int) -> str:
    """Counts of all item combinations up to the widest basket."""
    def of(k: int) -> str:
        joins = "".join(f" JOIN items i{j} ON i{j}.basket_id = i0.basket_id AND i{j - 1}.item < i{j}.item" for j in range(1, k))
        return f"SELECT [{', '.join(f'i{j}.item' for j in range(k))}] AS s, count(*) AS freq FROM items i0{joins} GROUP BY 1"
    return " UNION ALL ".join(of(k) for k in range(1, widest + 1))


def itemset_rules(min_support: float, min_lift: float) -> str:
    """Rules between the sides of all frequent ``sets``."""
    return f"""
      frequent AS MATERIALIZED (SELECT s, freq FROM sets, total WHERE freq >= ceil({min_support} * n)),
      masks AS (SELECT s, freq, unnest(generate_series(1, (1 << len(s)) - 2)) AS mask FROM frequent WHERE len(s) > 1),
      parted AS MATERIALIZED (SELECT freq AS n_all, list_filter(s, lambda x, i: (mask >> (i - 1)) & 1 = 1) AS ant,
        list_filter(s, lambda x, i: (mask >> (i - 1)) & 1 = 0) AS con FROM masks),
      sided AS (SELECT n_all, ant, a.freq AS n_ant, con, c.freq AS n_con
        FROM parted JOIN frequent a ON a.s = ant JOIN frequent c ON c.s = con),
      set_rules AS (SELECT array_to_string(ant, ', ') AS antecedents, array_to_string(con, ', ') AS consequents,
        round(n_all / n, 4) AS support, round(n_all / n_ant, 4) AS confidence,
        round((n_all / n_ant) / (n_con / n), 4) AS lift FROM sided, total WHERE (n_all / n_ant) / (n_con / n) >= {min_lift})"""


# Chunks hold five titles at most, drawn baskets four; the catalogue has no related products.
ANALYSIS_RULES = f"""{SCORED}, {chunk_items('scored')}, {band_items('scored')},
items AS (SELECT * FROM chunk_items UNION ALL SELECT * FROM band_items), sets AS MATERIALIZED ({_itemsets(5)}),
total AS (SELECT count(DISTINCT basket_id) AS n FROM items), {itemset_rules(0.01, 1.0)}"""

TYPES = "ECONOMY, LARGE, MEDIUM, PROMO, SMALL, STANDARD"
# Six product types, so no basket is wider.
ITEMSETS = order_items("p_type") + f""",
sets AS ({_itemsets(6)}),
total AS (SELECT count(DISTINCT basket_id) AS n FROM items)"""

ORACLE |= {
    "baskets_related": f"WITH {RELATED} {as_sets('related_items')} HAVING count(*) >= 1",
    "baskets_brand_chunks": f"WITH {SCORED}, {chunk_items('scored')} {as_sets('chunk_items')}",
    "baskets_category_bands": f"WITH {SCORED}, {band_items('scored')} {as_sets('band_items')}",
    "pair_counts": f"""WITH {order_items('p_type')}, frequent AS (SELECT item FROM items GROUP BY 1
      HAVING count(*) / (SELECT count(DISTINCT basket_id) FROM items) >= 0.05)
      SELECT a.item AS a, b.item AS b, count(*) AS n_pair FROM items a JOIN items b
      ON a.basket_id = b.basket_id AND a.item < b.item
      WHERE a.item IN (SELECT item FROM frequent) AND b.item IN (SELECT item FROM frequent) GROUP BY 1, 2""",
    "pair_rules_types": f"WITH {order_items('p_type')}, {pair_rules(0.05, 0.3)}",
    "pair_rules_names": f"WITH {order_items('p_name')}, {pair_rules(0.004, 0.01)}",
    "top_rules": f"WITH {order_items('p_name')}, " + pair_rules(
        0.004, 0.01, "SELECT * FROM rules WHERE lift >= 1 ORDER BY lift DESC, antecedents, consequents LIMIT 10"),
    "kpi_rules": f"WITH {order_items('p_name')}, " + pair_rules(
        0.004, 0.01, "SELECT count(*) AS rules, max(lift) AS max_lift, max(confidence) AS max_confidence, "
                     "max(support) AS max_support FROM rules"),
    "fpgrowth_itemsets": f"""WITH {ITEMSETS} SELECT array_to_string(s, '|') AS items, freq FROM sets, total
      WHERE freq >= 0.05 * n""",
    "fpgrowth_rules": f"WITH {ITEMSETS.replace('sets AS (', 'sets AS MATERIALIZED (')}, {itemset_rules(0.05, 0.9)} "
                      "SELECT * FROM set_rules",
    "analysis_rules": f"WITH {ANALYSIS_RULES} SELECT * FROM set_rules",
    # The catalogue's rows, fixed sizes, and the rules.
    "analyse": f"""WITH {ANALYSIS_RULES}, sizes AS (SELECT (SELECT count(*) FROM scored) AS n,
      (SELECT count(*) FROM set_rules) AS found, (SELECT count(*) FROM (SELECT DISTINCT shop_name, shop_country FROM scored)) AS shops)
      SELECT unnest(['df_clean', 'products_scored', 'products_clustered', 'pca_2d', 'top_k_products', 'shop_leaderboard',
        'association_rules', 'top_rules', 'supervised_metrics', 'cross_validation', 'diagnostics', 'clustering_metrics',
        'summary']) AS dataset,
        unnest([n, n, n, n, least(n, 50), least(shops, 10), found, least(found, 20), 2, 2, 1, 1, 1]) AS rows FROM sizes""",
    "one_hot_baskets": f"""WITH {order_items('p_type')} SELECT {TYPES}, count(*) AS baskets FROM (
      SELECT {', '.join(f"bool_or(item = '{t}') AS {t}" for t in TYPES.split(', '))}
      FROM items GROUP BY basket_id) GROUP BY {TYPES}""",
    "catalogue_rules": f"""WITH {RELATED}, {chunk_items('products')}, {band_items('products')},
      items AS (SELECT * FROM related_items WHERE item IS NOT NULL UNION ALL SELECT * FROM chunk_items
        UNION ALL SELECT * FROM band_items), {pair_rules(0.001, 0.1)}""",
}

# --- text enrichment ------------------------------------------------------

SUMMARY_PROMPT = """'Summarize this product in 2-3 sentences.' || chr(10) || 'Title: ' || title || chr(10) || 'Category: ' || category
  || chr(10) || 'Price: ' || price || ' USD' || chr(10) || 'Rating: ' || rating || '/5 (' || review_count || ' reviews)'
  || chr(10) || 'Description: ' || substr(coalesce(text, ''), 1, 400)"""
QUESTIONS = """asked AS (SELECT conv_id, turn, text || CASE WHEN conv_id % 7 <> 6 THEN ' ' || list_extract(
  ['rapport', 'profil', 'marketing', 'panier', 'meilleur', 'top', 'hello'], conv_id % 7 + 1) ELSE '' END AS question
  FROM conversations WHERE role = 'user')"""
REPLIES = {
    "summary": "Short summary: buyers rate this product well and its price holds up against similar offers.",
    "trend": "Trend note: compare the category scores and discount shares above with the previous run before acting.",
    "profile": "Buyer profile: people who compare prices, read reviews and buy online in the categories listed.",
    "strategy": "Strategy note: promote well rated products first, pair items that sell together, and show reviews next to "
                "prices.",
    "answer": "The figures above answer this question as far as the catalogue goes.",
}
CATEGORY_LINES = f"""(SELECT string_agg(category || ': ' || count, chr(10) ORDER BY count DESC, category)
  FROM (SELECT * FROM {counted('category')} ORDER BY count DESC, category LIMIT 5))"""

ORACLE |= {
    "summary_prompts": scored(f"SELECT product_id, {SUMMARY_PROMPT} AS prompt FROM scored LEFT JOIN documents ON doc_id = key"),
    "batch_summaries": scored(f"""SELECT product_id, CASE WHEN row_number() OVER (ORDER BY key) <= 50
      THEN '{REPLIES["summary"]}' ELSE '' END AS summary FROM scored"""),
    "stock_completions": f"""WITH {QUESTIONS} SELECT conv_id, turn, CASE
      WHEN regexp_matches(lower(question), 'summar') THEN '{REPLIES["summary"]}'
      WHEN regexp_matches(lower(question), 'trend|rapport') THEN '{REPLIES["trend"]}'
      WHEN regexp_matches(lower(question), 'profil|client') THEN '{REPLIES["profile"]}'
      WHEN regexp_matches(lower(question), 'stratégie|marketing') THEN '{REPLIES["strategy"]}'
      WHEN contains(lower(question), 'chatbot') OR contains(question, '?') THEN '{REPLIES["answer"]}'
      ELSE '[Mock LLM] Processed: ' || substr(question, 1, 80) || '...' END AS completion FROM asked""",
    "custom_completions": f"WITH {QUESTIONS} SELECT conv_id, turn, length(question)::VARCHAR AS completion FROM asked",
    "question_routing": f"""WITH {QUESTIONS} SELECT conv_id, turn, CASE
      WHEN regexp_matches(lower(question), 'tendance|rapport|trend|semaine|marché') THEN 'generate_trend_report'
      WHEN regexp_matches(lower(question), 'profil|client|persona|cible') THEN 'build_client_profile'
      WHEN regexp_matches(lower(question), 'stratégie|marketing|recommand|action') THEN 'recommend_strategy'
      WHEN regexp_matches(lower(question), 'règle|association|lift|panier') THEN 'get_association_rules'
      WHEN regexp_matches(lower(question), 'top|meilleur|classement|produit') THEN 'get_top_products'
      ELSE 'answer_question' END AS tool FROM asked""",
    "question_prompts": f"""WITH {SCORED}, {QUESTIONS} SELECT conv_id, turn, 'Products: ' || n || chr(10) || 'Average score: '
      || {fixed('s', 3)} || chr(10) || 'Median price: ' || {fixed('m', 2)} || '$' || chr(10) || 'Average rating: '
      || {fixed('r', 1)} || '/5' || chr(10) || 'Top 5:' || chr(10) || {TOP5} || chr(10) || 'Question: ' || question AS prompt
      FROM asked, (SELECT count(*) AS n, round(avg(score), 3) AS s, round(median(price), 2) AS m, round(avg(rating), 1) AS r FROM scored)""",
    "trend_context": scored(f"""SELECT *, 'Weekly market trend report.' || chr(10) || 'Products: ' || n || chr(10) || 'Average score: '
      || s || chr(10) || 'Average price: ' || p || chr(10) || 'Average rating: ' || r || chr(10) || 'On sale: ' || d || '%' || chr(10)
      || 'Platforms: ' || f || chr(10) || 'Top products:' || chr(10) || top5 || chr(10) || 'Top categories:' || chr(10) || categories AS prompt
      FROM (SELECT {TOP5} AS top5, {CATEGORY_LINES} AS categories),
      (SELECT count(*) AS n, round(avg(score), 3) AS s, round(avg(price), 2) AS p, round(avg(rating), 2) AS r,
        round(avg(CASE WHEN discount_pct > 0 THEN 1 ELSE 0 END) * 100, 1) AS d FROM scored),
      (SELECT string_agg(platform || '=' || count, ', ' ORDER BY platform) AS f FROM {counted('platform')})
      """).replace("SELECT *, 'Weekly", "SELECT top5, categories, 'Weekly"),
    "persona_context": scored(f""", top AS (SELECT *, row_number() OVER (ORDER BY {BEST}) AS rank FROM scored
        QUALIFY rank <= 20)
      SELECT *, 'Target customer profile (profil client) for these products:' || chr(10) || products || chr(10) || 'Categories: '
      || top_categories || chr(10) || 'Prices: ' || p0 || '$ – ' || p1 || '$' || chr(10) || 'Average rating: ' || r || '/5' AS prompt
      FROM (SELECT (SELECT string_agg('  - ' || title || ' (' || category || ', ' || {fixed('price', 0)} || '$, ★' || rating || ')',
        chr(10) ORDER BY rank) FROM top WHERE rank <= 15) AS products,
      (SELECT string_agg(category, ', ' ORDER BY n DESC, category) FROM (SELECT category, count(*) AS n FROM top
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3)) AS top_categories),
      (SELECT round(min(price), 2) AS p0, round(max(price), 2) AS p1, round(avg(rating), 1) AS r FROM top)""").replace(
        "SELECT *, 'Target", "SELECT products, top_categories, 'Target"),
    "strategy_context": f"""WITH {SEGMENTS}, {order_items('p_type')}, """ + pair_rules(0.05, 0.3, f"""
      SELECT segments, rules, top_by_category, 'Marketing strategy (stratégie).' || chr(10) || 'Segments:' || chr(10) || segments
      || chr(10) || 'Rules:' || chr(10) || rules || chr(10) || 'Best product per category:' || chr(10) || top_by_category AS prompt
      FROM (SELECT (SELECT string_agg(cluster_label || ': ' || n || ' products, price ' || {fixed('p', 2)} || ', score '
          || {fixed('s', 2)}, chr(10) ORDER BY cluster_label) FROM (SELECT cluster_label, count(title) AS n, avg(price) AS p,
          avg(score) AS s FROM labelled GROUP BY 1)) AS segments,
        (SELECT string_agg('  {{' || antecedents || '}} → {{' || consequents || '}} (lift=' || {fixed('lift', 2)} || ', conf='
          || {fixed('confidence', 2)} || ')', chr(10) ORDER BY lift DESC, antecedents, consequents)
          FROM (SELECT * FROM rules ORDER BY lift DESC, antecedents, consequents LIMIT 5)) AS rules,
        (SELECT string_agg(category || ': ' || title || ' (' || {fixed('price', 2)} || '$, score ' || {fixed('score', 4)} || ')',
          chr(10) ORDER BY category) FROM (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY category
          ORDER BY {BEST}) = 1 ORDER BY category LIMIT 6)) AS top_by_category)"""),
    "pricing_context": scored("""SELECT platforms, categories, 'Pricing analysis.' || chr(10) || 'By platform:' || chr(10) || platforms
      || chr(10) || 'By category:' || chr(10) || categories || chr(10) || 'Discounted: ' || d || '%' AS prompt FROM (
      SELECT (SELECT string_agg(platform || ' ' || n || ' ' || a || ' ' || m || ' ' || lo || ' ' || hi, chr(10) ORDER BY platform)
        FROM (SELECT platform, count(*) AS n, round(avg(price), 2) AS a, round(median(price), 2) AS m, round(min(price), 2) AS lo,
          round(max(price), 2) AS hi FROM scored GROUP BY 1)) AS platforms,
      (SELECT string_agg(category || ' ' || n || ' ' || a || ' ' || m, chr(10) ORDER BY a DESC, category)
        FROM (SELECT category, count(*) AS n, round(avg(price), 2) AS a, round(median(price), 2) AS m FROM scored GROUP BY 1
          ORDER BY a DESC, category LIMIT 10)) AS categories,
      (SELECT round(avg(CASE WHEN discount_pct > 0 THEN 1 ELSE 0 END) * 100, 1) FROM scored) AS d)"""),
}

# --- call log -------------------------------------------------------------

CALLS = """calls AS (SELECT event_id AS seq, epoch_us(ts) AS ts, event_type AS server, 'user_' || (user_id % 5) AS tool,
  value AS latency_ms FROM events)"""
PERMITTED = """((server = 'click' AND tool IN ('user_0', 'user_1', 'user_2')) OR (server = 'error' AND tool = 'user_0')
  OR (server = 'view' AND tool IN ('user_0', 'user_1', 'user_2', 'user_3')) OR (server = 'purchase' AND tool IN ('user_1', 'user_4')))"""


def load(span: int) -> str:
    return f"""WITH {CALLS} SELECT seq, server, count(*) OVER (PARTITION BY server ORDER BY ts
      RANGE BETWEEN {span - 1} PRECEDING AND CURRENT ROW) AS load FROM calls"""


def admission(calls: str, limit: str, span: int = 3_600_000_000) -> str:
    """Sequential replay: per server a fold over its calls in (ts, seq) order."""
    return f"""
steps AS (SELECT server, list({{'w': [ts], 'ok': [seq]}} ORDER BY ts, seq) AS calls FROM {calls} GROUP BY 1),
folded AS (SELECT server, list_reduce(calls, lambda acc, x: CASE
    WHEN len(list_filter(acc.w, lambda t: t > x.w[1] - {span})) >= {limit}
    THEN {{'w': list_filter(acc.w, lambda t: t > x.w[1] - {span}), 'ok': acc.ok}}
    ELSE {{'w': list_append(list_filter(acc.w, lambda t: t > x.w[1] - {span}), x.w[1]), 'ok': list_append(acc.ok, x.ok[1])}}
  END) AS state FROM steps),
ok AS (SELECT unnest(state.ok) AS seq FROM folded)"""


OUTCOMES = f"""{CALLS}, permitted AS (SELECT * FROM calls WHERE {PERMITTED}),
{admission('permitted', "CASE server WHEN 'click' THEN 2 ELSE 3 END")},
outcomes AS (SELECT calls.*, ok.seq IS NOT NULL AS allowed, CASE
  WHEN tool NOT IN ('user_0', 'user_1', 'user_2', 'user_3', 'user_4') THEN 'Unknown tool'
  WHEN NOT {PERMITTED} THEN 'Tool ''' || tool || ''' not permitted for server ''' || server || ''''
  WHEN ok.seq IS NULL THEN 'Rate limit exceeded: ' || CASE server WHEN 'click' THEN 2 ELSE 3 END || ' calls/min for ''' || server || ''''
  ELSE 'OK' END AS reason FROM calls LEFT JOIN ok ON calls.seq = ok.seq)"""
RECENT = "(SELECT * FROM outcomes ORDER BY ts DESC, seq DESC LIMIT 1000)"

ORACLE |= {
    "call_load_60s": load(60_000_000),
    "call_load_1h": load(3_600_000_000),
    "rate_limit_admission": f"""WITH {CALLS}, {admission('calls', "CASE server WHEN 'click' THEN 3 ELSE 4 END")}
      SELECT calls.seq, server, ok.seq IS NOT NULL AS admitted FROM calls LEFT JOIN ok ON calls.seq = ok.seq""",
    "permission_checks": f"WITH {CALLS} SELECT seq, server, tool, {PERMITTED} AS permitted FROM calls",
    "denied_calls": f"WITH {CALLS} SELECT server, tool, count(*) AS calls FROM calls WHERE NOT {PERMITTED} GROUP BY 1, 2",
    "call_outcomes": f"WITH {OUTCOMES} SELECT seq, allowed, reason FROM outcomes",
    "audit_stats": f"""WITH {OUTCOMES} SELECT count(*) AS total_calls, count(*) FILTER (NOT allowed) AS blocked_calls,
      round(count(*) FILTER (NOT allowed) / count(*), 3) AS block_rate, round(avg(latency_ms), 1) AS avg_latency_ms FROM {RECENT}""",
    "audit_by_server": f"WITH {OUTCOMES} SELECT server, count(*) AS calls FROM {RECENT} GROUP BY 1",
    "audit_recent": f"WITH {CALLS} SELECT seq, ts, server, tool FROM calls ORDER BY ts DESC, seq DESC LIMIT 50",
    "audit_log_files": f"WITH {CALLS} SELECT server, count(*) AS calls, max(seq) AS last_seq FROM calls GROUP BY 1",
    "minute_stats": f"""WITH {CALLS} SELECT ts // 60000000 * 60000000 AS window_start, server, count(*) AS calls,
      count(*) FILTER (seq % 3 = 0) AS blocked, round(avg(latency_ms), 3) AS avg_latency_ms FROM calls GROUP BY 1, 2""",
}

ORACLE["stream_admission"] = ORACLE["rate_limit_admission"]
ORACLE["stream_admission_ordered"] = ORACLE["rate_limit_admission"]
ORACLE["stream_history"] = ORACLE["history_keep_last"]
# A stream in append mode gives the windows that the watermark has closed.
ORACLE["stream_minute_stats"] = ORACLE["minute_stats"]

ORACLE |= {
    "ingest_snapshot": products(f"""SELECT platform, price_band, is_on_sale, count(*) AS products FROM (
      SELECT DISTINCT ON (title, price, platform) platform, {BAND} AS price_band, promo IS NOT NULL AND promo < price AS is_on_sale FROM (
        SELECT 'shopify' AS platform, title, key, CASE WHEN discount_pct > 0 AND price <> 0 THEN round(price + 5, 2) ELSE price END AS price,
          CASE WHEN discount_pct > 0 THEN price END AS promo,
          'https://shop' || (key % {SHOPS}) || '.example.com/products/item-' || product_id AS url FROM products
        UNION ALL SELECT 'woocommerce', title, key, CASE WHEN key % 5 <> 0 THEN round(price + 1, 2) ELSE price END,
          CASE WHEN discount_pct > 0 AND key % 5 <> 0 AND price <> 0 THEN price END, 'https://w/' || product_id FROM products)
      ORDER BY title, price, platform, url) GROUP BY 1, 2, 3"""),
    "enrichment_summary": clean(f"""SELECT least(50, count(*)) AS summaries_count,
      substr('{REPLIES["trend"]}', 1, 200) || '...' AS trend_report,
      substr('{REPLIES["profile"]}', 1, 200) || '...' AS client_profile,
      substr('{REPLIES["strategy"]}', 1, 200) || '...' AS marketing_strategy FROM clean"""),
}

# Pairwise distances and reachability: independent of cells and boxes.
ORACLE["dbscan_labels"] = f"""WITH RECURSIVE {FEATURED},
pts AS MATERIALIZED (SELECT product_id, {', '.join(f'{scaled(c)} AS f{i}' for i, c in enumerate(FEATURE_NAMES))} FROM featured),
near AS MATERIALIZED (SELECT a.product_id AS u, b.product_id AS v FROM pts a JOIN pts b
  ON {' + '.join(f'(a.f{i} - b.f{i}) * (a.f{i} - b.f{i})' for i in range(len(FEATURE_NAMES)))} <= 0.3 * 0.3),
core AS MATERIALIZED (SELECT u FROM near GROUP BY u HAVING count(*) >= 5),
e AS MATERIALIZED (SELECT n.u, n.v FROM near n JOIN core a ON n.u = a.u JOIN core b ON n.v = b.u),
reach AS (SELECT u, u AS v FROM core UNION SELECT r.u, e.v FROM reach r JOIN e ON r.v = e.u),
group_of AS (SELECT u, min(v::BIGINT) AS first FROM reach GROUP BY u),
named AS (SELECT u, dense_rank() OVER (ORDER BY first) - 1 AS label FROM group_of),
found AS (SELECT n.u, min(label) AS label FROM near n JOIN named ON named.u = n.v GROUP BY n.u)
SELECT product_id, coalesce(named.label, found.label, -1)::INTEGER AS dbscan_label
FROM pts LEFT JOIN named ON named.u = product_id LEFT JOIN found ON found.u = product_id"""

_GAPS = ' + '.join(f'(a.f{i} - b.f{i}) * (a.f{i} - b.f{i})' for i in range(len(FEATURE_NAMES)))


def _grouped_silhouette(label: str) -> str:
    """Mean Euclidean silhouette of every group, over all pairs of products."""
    return f"""SELECT '{label}' AS grouping, {label} AS label, count(*) AS products, round(avg(CASE WHEN n = 1 THEN 0
      WHEN greatest(inside, near) > 0 THEN (near - inside) / greatest(inside, near) ELSE 0 END), 6) AS silhouette
    FROM (SELECT u, any_value({label}) AS {label}, max(n) FILTER (c = {label}) AS n,
            max(total / (n - 1)) FILTER (c = {label} AND n > 1) AS inside, min(total / n) FILTER (c <> {label}) AS near
          FROM (SELECT a.product_id AS u, any_value(a.{label}) AS {label}, b.{label} AS c, sum(sqrt({_GAPS})) AS total,
                       count(*) AS n FROM pts a CROSS JOIN pts b GROUP BY a.product_id, b.{label}) GROUP BY u) GROUP BY 2"""


ORACLE["group_silhouettes"] = f"""WITH {FEATURED},
pts AS MATERIALIZED (SELECT product_id, category, platform, {', '.join(f'{scaled(c)} AS f{i}' for i, c in enumerate(FEATURE_NAMES))}
  FROM featured)
{_grouped_silhouette('category')} UNION ALL {_grouped_silhouette('platform')}"""


def _chosen(name: str) -> str:
    """A context's SQL over the chosen products instead of all."""
    return ORACLE[name].removeprefix(f"WITH {SCORED}\n").replace("FROM scored", "FROM chosen")


_STRATEGY = ORACLE["strategy_context"].removeprefix(f"WITH {SEGMENTS}, {order_items('p_type')}, ")
ORACLE["report_contexts"] = f"""WITH {SEGMENTS}, {order_items('p_type')}, {_STRATEGY[:_STRATEGY.index("SELECT segments, rules")].rstrip()},
chosen AS (SELECT * FROM scored WHERE platform = 'shopify'),
strategy AS ({_STRATEGY[_STRATEGY.index("SELECT segments, rules"):]}),
prompts AS (
  SELECT 'topk_summary' AS kind, 'Top-K products:' || chr(10) || '[' || string_agg(to_json({{'title': title, 'category': category,
    'price': price, 'rating': rating, 'review_count': review_count, 'score': score, 'shop_name': shop_name,
    'platform': platform, 'discount_pct': discount_pct}})::VARCHAR, ',' ORDER BY {BEST}) || ']' AS prompt
  FROM (SELECT * FROM chosen ORDER BY {BEST} LIMIT 7)
  UNION ALL SELECT 'market_trend', prompt FROM ({_chosen('trend_context')})
  UNION ALL SELECT 'pricing', prompt FROM ({_chosen('pricing_context')})
  UNION ALL SELECT 'cross_sell', 'Marketing strategy (stratégie).' || chr(10) || 'Segments:' || chr(10)
    || 'Clustering non disponible' || chr(10) || 'Rules:' || chr(10) || 'Règles d''association non disponibles' || chr(10)
    || 'Best product per category:' || chr(10) || top_by_category FROM strategy
  UNION ALL SELECT 'segment', prompt FROM strategy
  UNION ALL SELECT 'other', 'Unknown report kind: other. Products: ' || count(*) || ', average score ' || round(avg(score), 3) FROM chosen)
SELECT kind, prompt || chr(10) || 'Format: Executive summary' AS prompt FROM prompts"""
