"""Catalogue sources: driver tables, CSV snapshots, optional inputs."""

from __future__ import annotations

import csv
import io
from collections import Counter
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise import schema
from shelfwise.sources import csvrecords
from shelfwise.staging import stage


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def products(spark: SparkSession, folder: str) -> DataFrame:
    """One product per part, with sales facts rolled up from its line items."""
    part = table(spark, folder, "part")
    lineitem = table(spark, folder, "lineitem")
    supplier = table(spark, folder, "supplier")
    nation = table(spark, folder, "nation")

    stars = F.when(F.col("l_returnflag") == "N", 50).when(F.col("l_returnflag") == "A", 35).otherwise(20)
    sold = lineitem.groupBy("l_partkey").agg(
        F.count("*").alias("n"),
        F.sum(stars).alias("stars"),
        F.sum(F.round(F.col("l_discount") * 100).cast("bigint")).alias("cents_off"),
        F.min("l_shipdate").alias("published_at"),
    )
    # Distinct line numbers in two levels; both merge map-side.
    variants = lineitem.select("l_partkey", "l_linenumber").distinct().groupBy("l_partkey").agg(
        F.count("l_linenumber").alias("variant_count"))
    sold = sold.join(variants, "l_partkey")
    suppliers = supplier.count()  # answered from the parquet footers
    shops = supplier.join(F.broadcast(nation), supplier["s_nationkey"] == nation["n_nationkey"], "left")
    key = F.col("p_partkey")
    return (
        part.join(sold, part["p_partkey"] == sold["l_partkey"], "left")
        .withColumn("_shop", F.pmod(key, F.lit(suppliers)))
        .join(shops, F.col("_shop") == F.col("s_suppkey"), "left")
        .select(
            key.cast("string").alias("product_id"),
            F.col("p_name").alias("title"),
            F.col("p_brand").alias("brand"),
            F.when(key % 11 != 0, F.col("p_type")).alias("category"),
            F.get(F.split("p_name", " "), F.lit(1)).alias("subcategory"),
            F.round(F.col("p_retailprice") - 900, 2).alias("price"),
            F.when(key % 13 != 0, F.round(F.col("stars") / F.lit(10.0) / F.col("n"), 1)).alias("rating"),
            (F.col("n") * (1 + key % 10)).alias("review_count"),
            F.when(key % 3 == 0, F.lit(0.0))
            .otherwise(F.round(F.lit(8.0) * F.col("cents_off") / F.col("n"), 1)).alias("discount_pct"),
            F.when(key % 7 != 0, F.col("p_size")).alias("stock_quantity"),
            (key % 10 != 0).alias("availability"),
            F.col("variant_count"),
            F.col("s_name").alias("shop_name"),
            F.col("n_name").alias("shop_country"),
            F.element_at(F.array(*map(F.lit, ["shopify", "woocommerce", "generic"])),
                         (key % 3 + 1).cast("int")).alias("platform"),
            F.col("published_at"),
        )
    )


def read_products_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV snapshots under the declared schema; NA texts become null.

    Files are grouped by their header and each group is read under its own, so
    files may order, lack or add columns; extras are read as text. ``_corrupt``
    holds, as JSON, the cells of a row that do not parse in their column's
    type; those cells are null. Quoted line ends are allowed, and a file is
    read by many tasks all the same (:mod:`shelfwise.sources.csvrecords`).
    """
    records = csvrecords.read_records(spark, path)
    heads = stage(records.where("block = 0").groupBy("file").agg(
        F.min_by("text", "n").alias("header"), F.min("n").alias("head_n")), "csv-heads")
    rows = records.join(heads, "file").where("block > 0 OR n > head_n")
    # One row a distinct header reaches the driver.
    headers = heads.groupBy("header").agg(F.min("file").alias("first")).orderBy("first").collect()
    frames = [_under_header(rows.where(F.col("header") == h["header"]), h["header"]) for h in headers]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _column_names(header: str) -> list[str]:
    """Names of a header record; empty ones are numbered, repeated ones get their place as a suffix."""
    cells = next(csv.reader(io.StringIO(header.removeprefix("\ufeff"), newline="")))
    often = Counter(c.lower() for c in cells)
    return [f"_c{i}" if not c else f"{c}{i}" if often[c.lower()] > 1 else c for i, c in enumerate(cells)]


def _under_header(rows: DataFrame, header: str) -> DataFrame:
    names = _column_names(header)
    texts = T.StructType([T.StructField(c, T.StringType()) for c in names])
    options = {"escape": '"', "multiLine": "true", "lineSep": "\n", "maxColumns": str(max(20480, 2 * len(names)))}
    cells = F.from_csv("text", texts.toDDL(), options)
    raw = rows.select(cells.alias("cells")).select("cells.*")
    kinds = {f.name: f.dataType for f in schema.PRODUCT.fields}
    columns, failed = [], []
    for c in names:
        cell = F.col(f"`{c.replace('`', '``')}`")
        text = F.when(~cell.isin(schema.NA_TOKENS), cell)
        kind = kinds.get(c, T.StringType())
        value = text
        if isinstance(kind, (T.LongType, T.IntegerType)):
            # "12.0" is a whole number once a column has held missing cells.
            value = text.try_cast("double").try_cast(kind)
        elif not isinstance(kind, T.StringType):
            value = text.try_cast(kind)
        columns.append(value.alias(c))
        failed.append(F.when(text.isNotNull() & value.isNull(), text).alias(c))
    broken = F.to_json(F.struct(*failed))
    return raw.select(*columns, F.when(broken != "{}", broken).alias("_corrupt"))


def or_fallback(frame: DataFrame | None, fallback) -> DataFrame:
    """The given input, or the frame that ``fallback()`` builds when there is none."""
    return frame if frame is not None else fallback()


def require_rows(df: DataFrame, what: str = "source") -> DataFrame:
    """Fail the run when a source yields no row at all."""
    if df.isEmpty():
        raise ValueError(f"{what} yielded no rows")
    return df
