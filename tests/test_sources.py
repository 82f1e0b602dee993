import random

import pytest
from pyspark.sql import functions as F

from shelfwise.sources import catalog, csvrecords, html, sinks, synthetic


@pytest.fixture
def small_blocks(spark):
    """Files are read in blocks of about 200 bytes."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def quoted_table(rng, end, stray):
    """CSV of 80 rows: cells with line ends, quotes, commas, empty ones and some of several blocks."""
    def cell():
        if stray and rng.random() < 0.3:
            return "z" + "".join(rng.choice('ab" x') for _ in range(4))
        text = "".join(rng.choice('ab ,"\n') for _ in range(rng.choice([0, 1, 3, 8, 8, 8, 8, 700 if rng.random() < 0.2 else 5])))
        return '"' + text.replace('"', '""') + '"' if set(text) & set(',"\n') or rng.random() < 0.2 else text
    return "title,brand,extra" + end + "".join(",".join(cell() for _ in range(3)) + end for _ in range(80))


def test_csv_na_tokens_and_types(spark, tmp_path):
    (tmp_path / "p.csv").write_text(
        'product_id,title,price,rating,review_count,availability,extra\n'
        '1,"Say ""hi"", you",9.5,NA,12.0,True,x\n2,None,abc,4.5,,False,\n')
    df = catalog.read_products_csv(spark, str(tmp_path / "p.csv"))
    a, b = df.orderBy("product_id").collect()
    assert (a.title, a.price, a.rating, a.review_count, a.availability, a.extra) == (
        'Say "hi", you', 9.5, None, 12, True, "x")
    assert (b.title, b.price, b.rating, b.review_count, b.availability, b.extra) == (
        None, None, 4.5, None, False, None)


def test_csv_files_with_other_columns_and_broken_cells(spark, tmp_path):
    (tmp_path / "a.csv").write_text("title,price\nA,1.5\nB,oops\n")
    (tmp_path / "b.csv").write_text("price,title,review_count\n2.5,C,3.0\n,D,many\n")
    rows = {r.title: r for r in catalog.read_products_csv(spark, str(tmp_path)).collect()}
    assert {t: (r.price, r.review_count, r._corrupt) for t, r in rows.items()} == {
        "A": (1.5, None, None), "B": (None, None, '{"price":"oops"}'), "C": (2.5, 3, None),
        "D": (None, None, '{"review_count":"many"}')}


@pytest.mark.parametrize("seed,end,stray", [(1, "\n", False), (2, "\r\n", False), (3, "\n", True)])
def test_one_csv_file_in_many_tasks_equals_one_task(spark, tmp_path, small_blocks, seed, end, stray):
    (tmp_path / "p.csv").write_bytes(quoted_table(random.Random(seed), end, stray).encode())
    assert csvrecords.read_records(spark, str(tmp_path)).select("block").distinct().count() >= 8
    plain = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path))
    plain = plain.select(*[F.when(~F.col(c).isin(catalog.schema.NA_TOKENS), F.col(c)).alias(c) for c in plain.columns])
    got = catalog.read_products_csv(spark, str(tmp_path)).select("title", "brand", "extra")
    assert got.exceptAll(plain).count() == 0 and got.count() == plain.count()


def test_csv_cell_over_many_blocks_open_cells_and_empty_files(spark, tmp_path, small_blocks):
    long = "line of text\n" * 300
    (tmp_path / "a.csv").write_text(f'title,brand\nA,"{long}"\n\nB,x\n"C","never\nclosed,\n' + "D,y\n" * 100)
    (tmp_path / "b.csv").write_text("")
    (tmp_path / "c.csv").write_text('title,"br""and\nname"\n')
    rows = {r.title: r for r in catalog.read_products_csv(spark, str(tmp_path)).collect()}
    assert set(rows) == {"A", "B", "C"} and rows["A"].brand == long and rows["B"].brand == "x"
    assert rows["C"].brand.startswith("never\nclosed,\nD,y") and 'br"and\nname' in rows["A"].asDict()


def test_csv_keeps_outer_spaces(spark, tmp_path):
    rows = spark.createDataFrame([(" a ", "x\n"), ("\tb", " y")], "title string, brand string")
    path = sinks.write_snapshot_csv(rows, str(tmp_path), "1")
    assert catalog.read_products_csv(spark, path).select("title", "brand").exceptAll(rows).count() == 0


def test_synthetic_catalogue(spark):
    df = synthetic.synthetic_products(spark, 300)
    assert {"score_rank", "is_top_product"} <= set(df.columns)
    assert df.agg(F.sum("review_count")).first() == synthetic.synthetic_products(spark, 300).repartition(3).agg(
        F.sum("review_count")).first()
    row = df.agg(F.count("*").alias("n"), F.min("price").alias("lo"), F.max("price").alias("hi"),
                 F.min("score").alias("s0"), F.max("score").alias("s1"), F.count_distinct("category").alias("c")).first()
    assert row.n == 300 and 2 <= row.lo and row.hi <= 500 and 0 <= row.s0 and row.s1 <= 1 and row.c == 7


def test_guards(spark):
    with pytest.raises(ValueError):
        catalog.require_rows(spark.range(0))
    assert catalog.or_fallback(None, lambda: spark.range(3)).count() == 3


def test_selectors():
    page = html.Page("<ul><li class='product x'><p>a<p>b</li><li class=product><b data-k='1'>c</b></ul><a rel='next nofollow'>n</a>")
    top = page.nodes[0]
    assert len(page.select(top, "li.product")) == 2
    assert page.text(page.first(top, ["h1, b"])) == "c"
    assert page.first(top, ["ul b[data-k='1']"]) is not None and page.first(top, ["a b"]) is None
    assert page.first(top, ["[class*='prod']"]).tag == "li"
    assert page.first(top, ["a[rel='next']"]) is not None


def test_deep_and_broken_pages_leave_the_others_alone(spark, monkeypatch):
    card = "<div class='product-card'><h2><a href='/p/1'>One</a></h2><span class='price'>$5</span></div>"
    deep = "<div>" * 100_000 + card * 2 + "</p>" * 100_000
    pages = spark.createDataFrame([(1, "https://s.com/a", deep), (2, None, None), (3, "https://s.com/b", "<![" + card * 2),
                                   (4, "https://s.com/c", card * 3)], "page_id long, url string, html string")
    got = html.landed_items(pages).groupBy("page_id").count().collect()
    assert {1: 2, 4: 3}.items() <= {r["page_id"]: r["count"] for r in got}.items()

    def fail(*_):
        raise AssertionError("unreadable")

    monkeypatch.setattr(html, "page_items", fail)
    assert html.items_or_error("x", "y", "generic") == [{"kind": "error", "error": "AssertionError: unreadable"}]


def test_generic_cards_need_two_and_a_title(spark):
    card = "<div class='product-card'><h2><a href='/p/1'>One</a></h2><span class='price'>$5</span><img src='i.png'></div>"
    blank = "<div class='product-card'><span class='price'>$5</span></div>"
    pages = spark.createDataFrame(
        [(1, "https://s.com/shop", card + blank + "<a class='next'>n</a>"), (2, "https://s.com/one", card),
         (3, "https://s.com/p", "<h1 itemprop='name'>Solo</h1><meta itemprop='price' content='7'>")],
        "page_id long, url string, html string")
    rows = {r.page_id: r for r in html.extract_items(pages).collect()}
    assert set(rows) == {1, 3}
    assert (rows[1].title, rows[1].price, rows[1].url, rows[1].has_next) == ("One", "$5", "https://s.com/p/1", True)
    assert (rows[3].kind, rows[3].title, rows[3].price) == ("single", "Solo", "7")


def test_report_and_bundle(spark, tmp_path):
    sinks.write_report(spark.createDataFrame([("body",)], "completion string"), "Title", str(tmp_path / "r"))
    text = "".join(p.read_text() for p in (tmp_path / "r").glob("part-*"))
    assert text == "# Title\n\nbody\n"
    rows = sinks.write_bundle({"a": spark.range(3), "b": spark.range(5)}, str(tmp_path / "b"), "now")
    assert {r.dataset: r.rows for r in rows.collect()} == {"a": 3, "b": 5}
    assert spark.read.json(str(tmp_path / "b/manifest")).count() == 2


def test_history_append(spark, tmp_path):
    shape = "seq long, title string, price double, platform string, scraped_at string"
    old = spark.createDataFrame([(1, "A", 1.0, "s", "t1"), (2, "B", 1.0, "s", "t1")], shape)
    new = spark.createDataFrame([(1, "A", 1.0, "s", "t1"), (2, "A", 1.0, "s", "t2")], shape)
    assert sinks.append_history(old, new, str(tmp_path / "h")).count() == 3
