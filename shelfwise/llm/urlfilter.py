"""URL rules by expression lookup.

A URL is expanded into host-suffix and path-prefix expressions. The short
hash prefix of an expression is the join key, the full digest confirms the
match, and the longest matching rule decides.

* Expansion is exact and bounded: only the label counts and path lengths that
  some rule has are expanded, so a host of a thousand labels costs no more.
* A rule set of proven size is broadcast; a larger one is joined by shuffle,
  where the adaptive skew split serves expressions that many URLs share.
* Rule precedence is the longest ``host + path``, then the longer host, then
  block before allow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rule sets of up to this many rows and bytes are broadcast.
BROADCAST_RULES, BROADCAST_BYTES = 100_000, 8_000_000
#: Hex digits of a digest that serve as the join key.
PREFIX_DIGITS = 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_parts(df: DataFrame, url: str) -> DataFrame:
    """Adds ``host`` and ``path`` of a URL column."""
    rest = F.substring_index(F.substring_index(F.col("_after"), "?", 1), "#", 1)
    return (df.withColumn("_after", F.expr(
                f"CASE WHEN instr({url}, '://') > 0 THEN substring({url}, instr({url}, '://') + 3) ELSE '' END"))
            .withColumn("_rest", rest)
            .withColumn("_host", F.substring_index("_rest", "/", 1))
            .withColumn("path", F.expr("substring(_rest, length(_host) + 1)"))
            .withColumn("host", F.translate("_host", _UPPER, _LOWER))
            .drop("_after", "_rest", "_host"))


def prepared_rules(rules: DataFrame) -> DataFrame:
    """rules(host, path, verdict) with the expression's digest and a precedence number; larger wins."""
    known = (rules.select(F.translate("host", _UPPER, _LOWER).alias("r_host"), F.col("path").alias("r_path"),
                          F.col("verdict").alias("r_verdict"))
             .where("r_host is not null and r_path is not null and r_verdict is not null")
             .groupBy("r_host", "r_path").agg(F.max("r_verdict").alias("r_verdict")))  # block > allow
    return known.select(
        F.sha2(F.concat_ws(" ", "r_host", "r_path"), 256).alias("digest"),
        F.concat("r_host", "r_path").alias("rule"), "r_verdict",
        (F.size(F.split("r_host", r"\."))).alias("labels"), F.length("r_path").alias("chars"),
        F.struct((F.length("r_host") + F.length("r_path")).alias("n"), F.length("r_host").alias("h"),
                 F.col("r_verdict").alias("v"), F.concat("r_host", "r_path").alias("rule")).alias("rank"),
    ).withColumn("key", F.substring("digest", 1, PREFIX_DIGITS))


def judge(pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url",
          default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict), one row for each row of ``pages``.

    ``rules(host, path, verdict)``: a rule fits its host and all subdomains
    where the URL's path starts with the rule's path. ``rule`` is null and
    ``verdict`` is ``default`` where none fits. A null URL, or one without
    ``://``, has an empty host and path, which no rule fits. Repeated rows are
    judged each on its own; null page ids stay null; rules with a null field
    are ignored; an empty rule set leaves all at the default. Other columns of
    ``pages`` are not read.
    """
    ready = prepared_rules(rules)
    shape = ready.agg(
        F.collect_set("labels").alias("labels"), F.collect_set("chars").alias("chars"), F.count("*").alias("n"),
        F.sum(F.length("rule") + 150).alias("bytes")).first()
    parts = with_parts(pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("u")), "u").drop("u")
    if not shape["n"]:
        return parts.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"),
                            F.lit(default).alias("verdict"))
    if shape["n"] <= BROADCAST_RULES and shape["bytes"] <= BROADCAST_BYTES:
        ready = F.broadcast(ready)

    keyed = parts.withColumn("row", F.monotonically_increasing_id())
    expressions = F.expr(
        "flatten(transform(filter(array({labels}), k -> k <= size(split(host, '[.]'))), k -> "
        "transform(filter(array({chars}), c -> c <= length(path)), c -> "
        "sha2(concat_ws(' ', array_join(slice(split(host, '[.]'), -k, k), '.'), substring(path, 1, c)), 256))))".format(
            labels=", ".join(map(str, sorted(shape["labels"]))), chars=", ".join(map(str, sorted(shape["chars"])))))
    asked = (keyed.select("*", F.explode_outer(expressions).alias("asked"))
             .withColumn("key", F.substring("asked", 1, PREFIX_DIGITS)))
    met = asked.join(ready.select("key", "digest", "rank"), "key", "left").withColumn(
        "rank", F.when(F.col("asked") == F.col("digest"), F.col("rank")))
    best = met.groupBy("row").agg(
        F.first("page_id").alias("page_id"), F.first("host").alias("host"), F.first("path").alias("path"),
        F.max("rank").alias("rank"))
    return best.select("page_id", "host", "path", F.col("rank.rule").alias("rule"),
                       F.coalesce("rank.v", F.lit(default)).alias("verdict"))
