"""Baskets, frequent itemsets and association rules.

Basket frames have columns ``basket_id`` and ``items`` (distinct, sorted).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions import hashing
from shelfwise.operators.stats import even_slices, ordered_position
from shelfwise.staging import stage

RULE_COLUMNS = ["antecedents", "consequents", "support", "confidence", "lift"]


def _item_set(items: Column) -> Column:
    return F.array_sort(F.array_distinct(items))


def baskets_from_related(df: DataFrame) -> DataFrame:
    """A product's title with its related titles; baskets of one are left out."""
    related = F.filter(
        F.transform(F.split(F.coalesce("related_products", F.lit("")), ","), lambda t: F.trim(t)),
        lambda t: t != "",
    )
    items = F.concat(F.array("title"), related)
    return df.where(F.size(items) >= 2).select(
        F.concat(F.lit("r|"), "product_id").alias("basket_id"), _item_set(items).alias("items")
    )


def _titles_per_group(df: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct titles of each group with the smallest catalogue key of the title."""
    rows = df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*keys, "title"]]))
    return rows.groupBy(*keys, "title").agg(F.min(hashing.catalogue_key(F.col("product_id"))).alias("first_id"))


def baskets_from_chunks(df: DataFrame, width: int = 5, slices: int = 1024) -> DataFrame:
    """Titles of a brand and subcategory in runs of ``width``, in catalogue order.

    The running number comes from ``ordered_position``: groups are cut into
    slices of the catalogue key, so a group with most products is spread.
    """
    keys = ["brand", "subcategory"]
    titles = _titles_per_group(df, keys)
    numbered = ordered_position(
        titles, keys, even_slices(titles, "first_id", slices), [F.col("first_id"), F.col("title")])
    chunk = F.floor((F.col("pos") - 1) / F.lit(width))
    return (
        numbered.groupBy(*keys, chunk.alias("chunk"))
        .agg(_item_set(F.collect_list("title")).alias("items"))
        .where(F.size("items") >= 2)
        .select(F.concat_ws("|", F.lit("c"), *keys, F.col("chunk").cast("string")).alias("basket_id"), "items")
    )


def baskets_from_bands(df: DataFrame, draws: int = 10, seed: str = "band") -> DataFrame:
    """Drawn baskets of 2 to 4 titles per category and price band.

    A group of n titles gets min(draws, n / 2) baskets. Each basket takes the
    titles with the lowest salted hashes. The row limit on the hash rank is
    applied by Spark before the shuffle, so a task passes on at most four
    titles per group and draw.
    """
    keys = ["category", "price_band"]
    titles = _titles_per_group(df, keys)
    sizes = titles.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") >= 2)
    draw = titles.withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(draws))))
    lottery = F.md5(F.concat_ws("|", F.lit(seed), F.col("draw").cast("string"), "title"))
    order = Window.partitionBy(*keys, "draw").orderBy(lottery, "title")
    drawn = draw.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= 4)
    group = F.concat_ws("|", *keys, F.col("draw").cast("string"))
    size = 2 + hashing.hash_pick(group, 3, f"{seed}-size")
    allowed = drawn.join(sizes, keys).where(F.col("draw") <= F.least(F.lit(draws), F.floor(F.col("_n") / 2)))
    return (
        allowed.where(F.col("_place") <= size)
        .groupBy(*keys, "draw").agg(_item_set(F.collect_list("title")).alias("items"))
        .select(F.concat_ws("|", F.lit("b"), *keys, F.col("draw").cast("string")).alias("basket_id"), "items")
    )


def baskets_from_rows(df: DataFrame, basket: str, item: str) -> DataFrame:
    """Distinct (basket, item) rows as ``basket_id``, ``item``."""
    return df.select(F.col(basket).alias("basket_id"), F.col(item).alias("item")).where(
        F.col("item").isNotNull()).distinct()


def all_baskets(df: DataFrame) -> DataFrame:
    """Related, chunked and drawn baskets together."""
    return (
        baskets_from_related(df).unionByName(baskets_from_chunks(df)).unionByName(baskets_from_bands(df))
    )


def basket_rows(baskets: DataFrame) -> DataFrame:
    return baskets.select("basket_id", F.explode("items").alias("item")).distinct()


def item_supports(rows: DataFrame, n: int, min_support: float = 0.0) -> DataFrame:
    counts = rows.groupBy("item").agg(F.count("*").alias("n_item"))
    return counts.where(F.col("n_item") / F.lit(n) >= min_support)


def pair_counts(rows: DataFrame, frequent: DataFrame) -> DataFrame:
    """Baskets holding both items, for pairs of frequent items.

    Infrequent items go first, as no rule can hold them. That leaves at most
    average basket width / min_support distinct items, and no basket keeps
    more than those, however many rows it had. Baskets with the same items are
    then merged into one weighted set, and only the distinct sets are paired.
    """
    kept = rows.join(frequent.select("item"), "item", "left_semi")
    sets = kept.groupBy("basket_id").agg(F.array_sort(F.collect_set("item")).alias("items"))
    merged = sets.where(F.size("items") >= 2).groupBy("items").agg(F.count("*").alias("n"))
    tails = merged.select("n", "items", F.posexplode("items").alias("at", "a"))
    pairs = tails.select("n", "a", F.explode(F.expr("slice(items, at + 2, size(items))")).alias("b"))
    return pairs.groupBy("a", "b").agg(F.sum("n").alias("n_pair"))


def pair_rules(
    rows: DataFrame, min_support: float = 0.05, min_confidence: float = 0.3, n_baskets: int | None = None
) -> DataFrame:
    """Rules between two items, in both directions, from distinct (basket_id, item) rows.

    The rows are read by several passes, so they are written out first.
    """
    rows = stage(rows, "basket_rows")
    n = n_baskets if n_baskets is not None else rows.select("basket_id").distinct().count()
    frequent = item_supports(rows, n, min_support)
    pairs = pair_counts(rows, frequent).where(F.col("n_pair") / F.lit(n) >= min_support)
    directed = pairs.select(F.col("n_pair"), F.explode(F.array(
        F.struct(F.col("a").alias("antecedents"), F.col("b").alias("consequents")),
        F.struct(F.col("b").alias("antecedents"), F.col("a").alias("consequents")))).alias("r"),
    ).select("n_pair", "r.*")
    left = frequent.select(F.col("item").alias("antecedents"), F.col("n_item").alias("n_ant"))
    right = frequent.select(F.col("item").alias("consequents"), F.col("n_item").alias("n_con"))
    support = F.col("n_pair") / F.lit(n)
    confidence = support / (F.col("n_ant") / F.lit(n))
    lift = confidence / (F.col("n_con") / F.lit(n))
    return (
        directed.join(left, "antecedents").join(right, "consequents")
        .where(confidence >= min_confidence)
        .select("antecedents", "consequents", F.round(support, 4).alias("support"),
                F.round(confidence, 4).alias("confidence"), F.round(lift, 4).alias("lift"))
    )


def frequent_itemsets(baskets: DataFrame, min_support: float) -> DataFrame:
    """FP-Growth itemsets as ``items`` (sorted) and ``freq``."""
    from pyspark.ml.fpm import FPGrowth

    model = FPGrowth(itemsCol="items", minSupport=min_support).fit(baskets)
    return model.freqItemsets.select(F.array_sort("items").alias("items"), "freq")


def itemset_rules(itemsets: DataFrame, n: int, min_lift: float = 1.0) -> DataFrame:
    """All rules of frequent itemsets, consequents of any size, by subset joins.

    Every proper non-empty subset of an itemset is an antecedent; each of them
    is a frequent itemset itself. Subsets are bit masks, unfolded in two halves,
    so no row holds all masks of a wide itemset.
    """
    sets = stage(itemsets, "itemsets")
    wide = sets.where(F.size("items") >= 2)
    low = F.expr("explode(sequence(0L, shiftleft(1L, size(items) div 2) - 1))").alias("low")
    high = F.expr("explode(sequence(0L, shiftleft(1L, size(items) - size(items) div 2) - 1))").alias("high")
    masks = wide.select("items", F.col("freq").alias("n_all"), low).select("items", "n_all", "low", high).select(
        "items", "n_all", F.expr("shiftleft(high, size(items) div 2) | low").alias("mask")).where(
        "mask > 0 AND mask < shiftleft(1L, size(items)) - 1")
    sided = masks.select(
        "n_all",
        F.expr("filter(items, (x, i) -> (mask & shiftleft(1L, i)) <> 0)").alias("ant"),
        F.expr("filter(items, (x, i) -> (mask & shiftleft(1L, i)) = 0)").alias("con"))
    a = sets.select(F.col("items").alias("ant"), F.col("freq").alias("n_ant"))
    c = sets.select(F.col("items").alias("con"), F.col("freq").alias("n_con"))
    support = F.col("n_all") / F.lit(n)
    confidence = F.col("n_all") / F.col("n_ant")
    lift = confidence / (F.col("n_con") / F.lit(n))
    return (
        sided.join(a, "ant").join(c, "con").where(lift >= min_lift)
        .select(F.array_join("ant", ", ").alias("antecedents"), F.array_join("con", ", ").alias("consequents"),
                F.round(support, 4).alias("support"), F.round(confidence, 4).alias("confidence"),
                F.round(lift, 4).alias("lift"))
    )


def fpgrowth_rules(baskets: DataFrame, min_support: float = 0.05, min_lift: float = 1.0) -> DataFrame:
    return itemset_rules(frequent_itemsets(baskets, min_support), baskets.count(), min_lift)


def frequent_items(rows: DataFrame, min_support: float = 0.01) -> list[str]:
    """Items of at least that support, sorted; at most average basket width / ``min_support`` of them."""
    n = rows.select("basket_id").distinct().count()
    return sorted(r["item"] for r in item_supports(rows, n, min_support).select("item").collect())


def one_hot_baskets(rows: DataFrame, items: list[str] | None = None) -> DataFrame:
    """One boolean column per item; the frequent items where none are given."""
    rows = rows if items is not None else stage(rows, "basket_rows")
    wanted = frequent_items(rows) if items is None else items
    return rows.groupBy("basket_id").agg(*[F.bool_or(F.col("item") == item).alias(item) for item in wanted])


def by_lift() -> list[Column]:
    return [F.desc("lift"), F.asc("antecedents"), F.asc("consequents")]


def top_rules(rules: DataFrame, n: int = 10, min_lift: float = 1.0) -> DataFrame:
    return rules.where(F.col("lift") >= min_lift).orderBy(*by_lift()).limit(n).select(*RULE_COLUMNS)


def mine_rules(df: DataFrame, min_support: float = 0.01, min_confidence: float = 0.1) -> DataFrame:
    """Pair rules over all basket families of a catalogue."""
    baskets = stage(all_baskets(df), "baskets")
    return pair_rules(basket_rows(baskets), min_support, min_confidence, baskets.count())


def mine_itemset_rules(df: DataFrame, min_support: float = 0.01, min_lift: float = 1.0) -> DataFrame:
    """Rules between itemsets of any size over all basket families of a catalogue."""
    return fpgrowth_rules(stage(all_baskets(df), "baskets"), min_support, min_lift)
