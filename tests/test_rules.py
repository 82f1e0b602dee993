import itertools
import random

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import rules
from shelfwise.plans import catalogue, derived


def brute(baskets, min_support, min_confidence):
    n, found = len(baskets), {}
    count = lambda items: sum(items <= b for b in baskets)
    every = sorted(set().union(*baskets))
    for a, b in itertools.permutations(every, 2):
        support = count({a, b}) / n
        if support < min_support or not support:
            continue
        confidence = support / (count({a}) / n)
        if confidence >= min_confidence:
            found[a, b] = (round(support, 4), round(confidence, 4), round(confidence / (count({b}) / n), 4))
    return found


@pytest.fixture(scope="module")
def baskets(spark):
    rng = random.Random(7)
    sets = [set(rng.sample("abcdefgh", rng.randint(1, 6))) for _ in range(200)] + [set("abcdefgh")]
    return sets, spark.createDataFrame([(i, x) for i, s in enumerate(sets) for x in sorted(s)],
                                       "basket_id int, item string")


def test_pair_rules_match_brute_force(baskets):
    sets, rows = baskets
    got = {(r.antecedents, r.consequents): (r.support, r.confidence, r.lift)
           for r in rules.pair_rules(rows, 0.1, 0.4).collect()}
    want = brute(sets, 0.1, 0.4)
    assert set(got) == set(want)
    assert all(got[k] == pytest.approx(want[k], abs=1.01e-4) for k in want)


def test_fpgrowth_pairs_match_pair_counts(spark, baskets):
    _, rows = baskets
    grouped = rows.groupBy("basket_id").agg(F.array_sort(F.collect_set("item")).alias("items"))
    sets = rules.frequent_itemsets(grouped, 0.1).where(F.size("items") == 2)
    n = grouped.count()
    pairs = rules.pair_counts(rows, rules.item_supports(rows, n, 0.1)).where(F.col("n_pair") / n >= 0.1)
    assert {(tuple(r["items"]), r.freq) for r in sets.collect()} == {((r.a, r.b), r.n_pair) for r in pairs.collect()}


def test_multi_item_rules(spark):
    rows = [(i, ["a", "b", "c"]) for i in range(6)] + [(9, ["a"]), (10, ["b", "c"])]
    found = rules.fpgrowth_rules(spark.createDataFrame(rows, "basket_id int, items array<string>"), 0.5, 0.0)
    got = {(r.antecedents, r.consequents): r.confidence for r in found.collect()}
    assert got[("a", "b, c")] == pytest.approx(6 / 7, abs=1e-4) and got[("a, b", "c")] == 1.0 and len(got) == 12


def test_related_baskets(spark):
    df = spark.createDataFrame([("1", "T", "A, B,,A"), ("2", "U", ""), ("3", "V", None)],
                               "product_id string, title string, related_products string")
    assert [r["items"] for r in rules.baskets_from_related(df).collect()] == [["A", "B", "T"]]


def test_chunks_hold_five_titles_and_miss_none(spark, folder):
    scored = catalogue.scored(spark, folder).withColumns({"brand": F.lit("b"), "subcategory": F.lit("s")})
    titles = scored.select("title").distinct().count()
    rows = rules.baskets_from_chunks(scored, slices=7).collect()
    assert max(len(r["items"]) for r in rows) == 5
    assert sum(len(r["items"]) for r in rows) >= titles - 1


def test_band_baskets(spark, folder):
    from shelfwise.functions.labels import price_band

    scored = catalogue.scored(spark, folder).withColumn("price_band", price_band(F.col("price")))
    rows = rules.baskets_from_bands(scored).collect()
    assert rows and all(2 <= len(r["items"]) <= 4 for r in rows)


def test_mined_supports_reach_the_threshold(spark, folder):
    from shelfwise.functions.labels import price_band

    df = derived.related(spark, folder).withColumn("price_band", price_band(F.col("price")))
    mined = rules.mine_rules(df, 0.005, 0.1)
    row = mined.agg(F.count("*").alias("n"), F.min("support").alias("s")).first()
    assert row.n > 0 and row.s >= 0.005 - 5e-5
