"""Building blocks that replace un-partitioned windows and giant groups.

* ``scalars``: a one-row aggregate as plain values, which become literals of
  the next plan, so no join with a statistics row is needed.
* ``exact_quantiles``, ``grouped_quantiles``: exact quantiles over slices of a
  histogram of distinct values, so that no task holds all of them.
* ``ordered_position``: row numbers inside groups of any size, computed in
  slices of the order key, so that no task sees a whole hot group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.staging import stage


def scalars(one_row: DataFrame) -> dict:
    """The fields of a one-row aggregate. Runs a job; stage costly inputs first."""
    return one_row.first().asDict()


def known(value) -> Column:
    """Literal of a statistic; a missing one is a null double."""
    return F.lit(None).cast("double") if value is None else F.lit(value)


def cell(one_value: DataFrame) -> Column:
    """The only cell of a one-row frame as a scalar subquery."""
    return one_value.scalar()


#: Slices of the distinct values that a task of a quantile or numbering orders at a time.
SLICES = 64


def exact_quantiles(df: DataFrame, wanted: dict[str, tuple[str, float]]) -> DataFrame:
    """One row of linearly interpolated quantiles: ``{alias: (column, p)}``.

    All columns share one scan and the steps of ``grouped_quantiles``.
    """
    columns = sorted({column for column, _ in wanted.values()})
    melted = df.select(
        F.explode(F.array(*[
            F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in columns
        ])).alias("cell")
    ).select("cell.name", "cell.value")
    levels = {f"p{i}": p for i, p in enumerate(sorted({p for _, p in wanted.values()}))}
    found = grouped_quantiles(melted, ["name"], "value", levels)
    of = {p: level for level, p in levels.items()}
    return found.agg(*[
        F.max(F.when(F.col("name") == column, F.col(of[p]))).alias(alias) for alias, (column, p) in wanted.items()
    ])


def grouped_quantiles(
    df: DataFrame, keys: list[str], column: str, wanted: dict[str, float]
) -> DataFrame:
    """Exact, linearly interpolated quantiles of ``column`` per group.

    Equal values are merged map-side into a histogram, which is cut into slices
    by approximate quantiles of its distinct values. Slice sizes tell which
    slice holds a wanted rank, and only those slices are ordered. So no task
    sees more than a slice of the distinct values, in whatever group.
    """
    histogram = stage(
        df.where(F.col(column).isNotNull()).groupBy(F.struct(*keys).alias("_k"), F.col(column).cast("double").alias("_v"))
        .agg(F.count("*").alias("_n")), "histogram")
    cuts = histogram.agg(F.percentile_approx("_v", [i / SLICES for i in range(1, SLICES)], 10_000)).first()[0] or []
    slot = F.lit(0)
    if cuts:
        slot = F.size(F.filter(F.array(*map(F.lit, sorted(set(cuts)))), lambda c: c < F.col("_v")))
    sliced = histogram.withColumn("_s", slot)

    group = Window.partitionBy("_k")
    before = group.orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sliced.groupBy("_k", "_s").agg(F.sum("_n").alias("_size")).select(
        "_k", "_s", "_size", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"),
        F.sum("_size").over(group).alias("_total"))
    ranks = []
    for alias, p in wanted.items():
        place = F.lit(p) * (F.col("_total") - 1)
        low = F.floor(place)
        ranks += [F.struct(F.lit(alias).alias("alias"), low.alias("rank"), (low + 1 - place).alias("part")),
                  F.struct(F.lit(alias).alias("alias"), (low + 1).alias("rank"), (place - low).alias("part"))]
    asked = sizes.select("_k", "_s", "_size", "_offset", F.explode(F.array(*ranks)).alias("_r")).where(
        (F.col("_r.part") > 0) & F.col("_r.rank").between(F.col("_offset"), F.col("_offset") + F.col("_size") - 1))

    inside = sliced.join(asked.select("_k", "_s", "_offset").distinct(), ["_k", "_s"])
    upto = F.col("_offset") + F.sum("_n").over(Window.partitionBy("_k", "_s").orderBy("_v"))
    ordered = inside.select("_k", "_s", "_v", "_n", upto.alias("_end"))
    met = ordered.join(asked.select("_k", "_s", "_r.*"), ["_k", "_s"]).where(
        (F.col("rank") < F.col("_end")) & (F.col("rank") >= F.col("_end") - F.col("_n")))
    return met.groupBy("_k").agg(*[
        F.sum(F.when(F.col("alias") == alias, F.col("part") * F.col("_v"))).alias(alias) for alias in wanted
    ]).select("_k.*", *wanted)


def min_max(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row with ``<column>_min`` and ``<column>_max``."""
    return df.agg(*[
        f(c).alias(f"{c}_{name}") for c in columns for name, f in (("min", F.min), ("max", F.max))
    ])


def min_max_scaled(value: Column, low: float | None, high: float | None) -> Column:
    """Value on the 0..1 scale of its range; 0 where the range is empty."""
    if low is None or not high > low:
        return value * F.lit(0.0)
    return (value - F.lit(low)) / F.lit(high - low)


def ordered_position(
    df: DataFrame, keys: list[str], slice_by: Column, order: list[Column], name: str = "pos"
) -> DataFrame:
    """1-based position of every row inside its group (rows with a null key are left out).

    ``slice_by`` must never decrease along ``order``; it cuts each group into
    slices. Rows are numbered inside a slice, and the sizes of the earlier
    slices of the group are added. Only the slice sizes (one row per group and
    slice) meet in a per-group window.
    """
    sliced = df.withColumn("_slice", slice_by)
    sizes = sliced.groupBy(*keys, "_slice").agg(F.count("*").alias("_size"))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *keys, "_slice", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order)
    numbered = sliced.withColumn("_in_slice", F.row_number().over(inside))
    # The window and the join share their keys, so the join adds no shuffle of the rows.
    return numbered.join(offsets, [*keys, "_slice"]).select(
        *df.columns, (F.col("_offset") + F.col("_in_slice")).alias(name)
    )


def even_slices(df: DataFrame, column: str, slices: int) -> Column:
    """Slices of a number column with about equally many rows, for ``ordered_position``.

    The cuts are approximate quantiles, so skewed keys are cut where they are dense.
    """
    cuts = df.agg(F.percentile_approx(column, [i / slices for i in range(1, slices)], 10 * slices)).first()[0]
    if not cuts:
        return F.lit(0)
    edges = sorted(set(cuts))
    # Binary search in two steps keeps the comparisons a row needs near 2 * sqrt(slices).
    width = max(1, round(len(edges) ** 0.5))
    heads = edges[::width]
    block = F.size(F.filter(F.array(*map(F.lit, heads)), lambda c: c < F.col(column)))
    tails = F.array(*[F.array(*map(F.lit, edges[i * width:(i + 1) * width])) for i in range(len(heads))])
    within = F.size(F.filter(F.element_at(tails, F.greatest(block, F.lit(1))), lambda c: c < F.col(column)))
    return F.when(block == 0, 0).otherwise((block - 1) * F.lit(width) + within)


def value_counts(df: DataFrame, key: str, share: bool = False) -> DataFrame:
    """Rows per non-null key, optionally with the share of all counted rows."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("count"))
    if not share:
        return counts
    total = cell(counts.agg(F.sum("count")))
    return counts.withColumn("share", F.round(F.col("count") / total, 4))


def numbered(df: DataFrame, column: str, name: str = "number") -> DataFrame:
    """Rows numbered from 0 along a column of distinct values, in the order of its ranges.

    Rows are range-partitioned and numbered inside a partition; only the
    partition sizes meet in one window.
    """
    parts = stage(df.repartitionByRange(column).withColumn("_part", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.groupBy("_part").agg(F.count("*").alias("_size")).select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(column)) - 1
    return parts.withColumn("_place", place).join(offsets, "_part").select(
        *df.columns, (F.col("_offset") + F.col("_place")).alias(name))
