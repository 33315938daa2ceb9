"""Choose among candidates: first in document order, then best strategy."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_where(cond: Column, value: Column, order: Column | str = "pre") -> Column:
    """Aggregate: ``value`` of the first row meeting ``cond`` (null when no row does).

    A ``min`` over a struct, so it combines before the shuffle and a hot group
    costs one row per task.
    """
    order = F.col(order) if isinstance(order, str) else order
    entry = F.struct(order.alias("o"), value.alias("v"))
    return F.min(F.when(cond, entry))["v"]


def best_strategy(strategy: Column, order: Column, value: Column) -> Column:
    """Aggregate: ``value`` with the lowest strategy number, earliest within it."""
    entry = F.struct(strategy.alias("s"), order.alias("o"), value.alias("v"))
    return F.min(F.when(strategy.isNotNull(), entry))["v"]


def join_in_order(cond: Column, value: Column, separator: str, order: Column | str = "pre") -> Column:
    """Aggregate: texts meeting ``cond`` joined in document order; null when there is none.

    Used for the texts of one page, which together are no longer than the page.
    """
    order = F.col(order) if isinstance(order, str) else order
    entry = F.struct(order.alias("o"), value.alias("v"))
    rows = F.array_sort(F.collect_list(F.when(cond, entry)))
    return F.when(F.size(rows) > 0, F.array_join(F.transform(rows, lambda r: r["v"]), separator))
