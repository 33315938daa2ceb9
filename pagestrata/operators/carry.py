"""Carry the last (or next) known value along an ordered group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

def carry_in_page(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """Last non-null ``value`` at or before each row of its page, in document order."""
    w = (
        Window.partitionBy("page_id")
        .orderBy("pre")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return rows.withColumn(name, F.last(value, ignorenulls=True).over(w))


def carry(
    df: DataFrame,
    keys: list[str],
    order: str,
    value: Column,
    name: str,
    store: Callable[[DataFrame, str], DataFrame],
    backward: bool = False,
    include_current: bool = True,
    parts: int | None = None,
) -> DataFrame:
    """Carry ``value`` along ``order`` within ``keys``, for groups of any size.

    ``order`` is unique within a group. Rows are cut into ranges of about equal
    numbers of rows by keys and order, so a range holds its share of a large
    group however its order values lie. The ranges are written with ``store``,
    which fixes them. What enters a range from outside is found on a summary
    with one row per group and range and joins the range as an extra first row.
    """
    position = F.col(order)
    by = [*[F.col(k) for k in keys], position]
    cut = df.repartitionByRange(parts, *by) if parts else df.repartitionByRange(*by)
    rows = store(cut.select("*", value.alias("_value"), F.spark_partition_id().alias("_part")), f"ranges_of_{name}")
    by_order = position.desc() if backward else position.asc()
    by_part = F.col("_part").desc() if backward else F.col("_part").asc()

    known = F.when(F.col("_value").isNotNull(), F.struct(position.alias("o"), F.col("_value").alias("v")))
    before = Window.partitionBy(*keys).orderBy(by_part).rowsBetween(Window.unboundedPreceding, -1)
    entries = (
        rows.groupBy(*keys, "_part")
        .agg((F.min(known) if backward else F.max(known)).alias("_edge"))
        .select(*keys, "_part", F.last("_edge", ignorenulls=True).over(before)["v"].alias("_value"))
        .where(F.col("_value").isNotNull())
        .withColumn("_entry", F.lit(True))
    )
    inside = (
        Window.partitionBy(*keys, "_part")
        .orderBy(F.col("_entry").desc(), by_order)
        .rowsBetween(Window.unboundedPreceding, 0 if include_current else -1)
    )
    return (
        rows.withColumn("_entry", F.lit(False))
        .unionByName(entries, allowMissingColumns=True)
        .withColumn(name, F.last("_value", ignorenulls=True).over(inside))
        .where(~F.col("_entry"))
        .drop("_value", "_part", "_entry")
    )
