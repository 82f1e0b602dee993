"""Exact duplicates, URL rules and benchmark search against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from shelfwise.llm import decontaminate, exactdedup, urlfilter

DOCS = "doc_id long, text string, text_sha256 string, keep_id string"


def _frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def _plain_groups(rows):
    import re
    groups = {}
    for i, (doc_id, text) in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), doc_id is None, doc_id, i))
    out = []
    for members in groups.values():
        best = min(members, key=lambda m: (m[0], m[1], m[2] or 0))
        out += [(m[2], best[2], len(members)) for m in members]
    return sorted(out, key=repr)


def test_radix_rounds_match_plain_grouping(spark):
    draw = random.Random(3)
    rows = [(i, "".join(draw.choices("ab \té", k=draw.choice([0, 1, 2, 7, 8, 9, 40])))) for i in range(150)]
    rows += [(200, "x" * 5000), (201, "x" * 5000 + " "), (202, "x" * 4999 + "y"), (203, None), (204, ""), (205, " \n")]
    rows += [(None, "ab"), (None, "ab"), (300, "same"), (300, "same")]
    out = exactdedup.exact_duplicates(_frame(spark, rows), width=2, growth=2).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in out), key=repr) == _plain_groups(rows)
    by_group = {}
    for r in out:
        by_group.setdefault(r.text_sha256, []).append(r.kept)
    assert all(kept.count(True) == 1 for kept in by_group.values())


def test_radix_of_an_empty_table_and_clashing_columns(spark):
    assert exactdedup.exact_duplicates(_frame(spark, [])).count() == 0
    rows = _frame(spark, [(1, "a", "x", "y"), (2, "a ", "x", "y")], DOCS)
    assert {(r.doc_id, r.keep_id, r.kept) for r in exactdedup.exact_duplicates(rows).collect()} == {(1, 2, False), (2, 2, True)}


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("a.b.net", "/e", "block")]
URLS = [
    ("https://Example.COM/en/x?q#f", "example.com", "/en/x", "example.com/en/", "block"),
    ("http://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
    ("http://m.www.example.com/en/1", "m.www.example.com", "/en/1", "www.example.com/en/", "allow"),
    ("http://example.com/EN/", "example.com", "/EN/", "com/", "allow"),
    ("http://example.com", "example.com", "", None, "allow"),
    ("http://xcom/", "xcom", "/", None, "allow"),
    ("ftp://c.a.b.net/es/p", "c.a.b.net", "/es/p", "a.b.net/e", "block"),
    ("x://net/es/?a://b", "net", "/es/", "net/es/", "block"),
    ("http://h?x/y", "h", "", None, "allow"),
    ("no scheme", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"),
    ("http://" + "a." * 3000 + "net/es/" + "p" * 50_000, "a." * 3000 + "net", "/es/" + "p" * 50_000, "net/es/", "block"),
]


@pytest.mark.parametrize("broadcast", [100_000, 0])
def test_url_rules(spark, monkeypatch, broadcast):
    monkeypatch.setattr(urlfilter, "BROADCAST_RULES", broadcast)
    rules = spark.createDataFrame(RULES + [("com", "/", "allow"), (None, "/", "block")], "host string, path string, verdict string")
    pages = spark.createDataFrame([(i, u[0], "h") for i, u in enumerate(URLS)] * 2 + [(None, None, "h")],
                                  "page_id long, url string, host string")
    got = [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in urlfilter.judge(pages, rules).collect()]
    want = [(i, *u[1:]) for i, u in enumerate(URLS)] * 2 + [(None, "", "", None, "allow")]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_url_rules_of_equal_length_and_none(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    both = spark.createDataFrame([("a.b", "/", "allow"), ("a.b", "/", "block")], "host string, path string, verdict string")
    assert urlfilter.judge(pages, both).first().verdict == "block"
    assert urlfilter.judge(pages, both.limit(0), default="block").first().verdict == "block"
    assert urlfilter.judge(pages.limit(0), both).count() == 0


def _plain_hits(words, items, size):
    hit, found = set(), set()
    for item_id, text in items:
        for w in decontaminate.windows_of(decontaminate.words_of(text), size):
            for i in range(len(words) - len(w) + 1):
                if tuple(words[i:i + len(w)]) == w:
                    hit.update(range(i, i + len(w)))
                    found.add(item_id)
    return len(hit), sorted(found)


def test_wu_manber_matches_plain_search():
    draw = random.Random(5)
    for _ in range(300):
        items = [(str(i), " ".join(draw.choices("abc", k=draw.randint(0, 9)))) for i in range(5)]
        words = decontaminate.words_of(" ".join(draw.choices("ABCd", k=draw.randint(0, 60))))
        size = draw.randint(1, 6)
        ranges, found = decontaminate.hits_in(words, decontaminate.tables_of(items, size))
        assert (sum(b - a for a, b in ranges), sorted(found)) == _plain_hits(words, items, size)


def test_contamination_in_blocks_and_odd_rows(spark):
    docs = _frame(spark, [(1, "x a b c y", "q"), (1, "x a b c y", "q"), (2, None, "q"), (3, "", "q"), (4, "A-b C d e", "q"),
                          (None, "zz é1"[:2], "q")], "doc_id long, text string, n_hit string")
    items = _frame(spark, [(1, "a b c"), (2, "b c d"), (2, "c d e"), (3, None), (None, "x"), (4, " "), (10, "zz")], "item_id long, text string")
    whole = decontaminate.contamination(docs, items, size=3)
    parts = decontaminate.contamination(docs, items, size=3, block_bytes=4)
    rows = sorted(whole.collect(), key=repr)
    assert rows == sorted(parts.collect(), key=repr)
    assert [(r.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in rows] == [
        (1, 5, 4, 1, True), (1, 5, 4, 1, True), (2, 0, 0, 0, False), (3, 0, 0, 0, False), (4, 5, 5, 2, True), (None, 1, 1, 1, True)]
    # An item without an id hits, but is not listed; with many blocks the plan holds one of them.
    nameless = decontaminate.contamination(docs, items.where("item_id is null"), size=3).where("doc_id = 1").first()
    assert (nameless.n_hit, nameless.n_items, nameless.contaminated) == (1, 0, True)
    assert parts._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    digest = spark.range(1).select(F.sha2(F.lit("1,2"), 256)).first()[0]
    assert rows[4].items_sha256 == digest
    clean = decontaminate.clean_documents(docs, items, size=3)
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {2, 3}
    assert decontaminate.contamination(docs.limit(0), items).count() == 0
    assert not any(r.contaminated for r in decontaminate.contamination(docs, items.limit(0)).collect())
