"""Relations between elements of a page.

Every node row lists its enclosing context elements (``anc``, outermost
first), so ancestor questions are plain expressions on one row and descendant
questions are a group-by on the enclosing element. Only "the next one after
me" questions need order: they are windows over ``page_id``, which share one
shuffle. No self-join, and no pairs of elements, is ever formed.

A window partition here is one page; a page is one string of one input row,
so it fits a task by construction.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagestrata.functions.text import contains_any

Condition = Callable[[Column], Column]


def is_tag(*tags: str, classes: tuple[str, ...] = ()) -> Condition:
    """Condition on an ``anc`` entry: one of the tags, with one of the class substrings."""

    def check(entry: Column) -> Column:
        ok = entry["tag"].isin(*tags)
        return ok & contains_any(entry["class"], classes) if classes else ok

    return check


def last_pre() -> Column:
    """``pre`` of the last descendant (of the element itself when it has none)."""
    return F.col("post") + F.col("depth")


def nearest_ancestor(cond: Condition) -> Column:
    """Innermost enclosing element that meets ``cond``, as a struct; null when there is none."""
    return F.try_element_at(F.filter("anc", cond), F.lit(-1))


def has_ancestor(cond: Condition) -> Column:
    return F.exists("anc", cond)


def by_ancestor(nodes: DataFrame, cond: Condition, name: str, or_self: Column | None = None) -> DataFrame:
    """One row per (element, enclosing element meeting ``cond``): input of descendant group-bys.

    With ``or_self`` the elements meeting it also appear as their own container.
    The row count is bounded by the nesting depth of such containers.
    """
    outer = F.transform(F.filter("anc", cond), lambda a: a["pre"])
    if or_self is not None:
        own = F.when(or_self, F.array("pre")).otherwise(F.array().cast("array<int>"))
        outer = F.concat(outer, own)
    return nodes.withColumn(name, F.explode(outer))


def with_next(
    rows: DataFrame,
    name: str,
    target: Column,
    value: Column,
    asks_after_subtree: Column | None = None,
) -> DataFrame:
    """Add ``value`` of the next row in document order that meets ``target``.

    Rows meeting ``asks_after_subtree`` look past their own descendants
    (the *following* axis); the others look at everything after their start.
    """
    after = asks_after_subtree if asks_after_subtree is not None else F.lit(False)
    place = F.when(after, last_pre()).otherwise(F.col("pre"))
    # Descending order turns "next" into a running frame, which is linear;
    # a frame that reaches forward is recomputed for every row.
    w = (
        Window.partitionBy("page_id")
        .orderBy(place.desc(), after.desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return rows.withColumn(name, F.last(F.when(target, value), ignorenulls=True).over(w))


def with_next_sibling(rows: DataFrame, name: str, among: Column, value: Column) -> DataFrame:
    """Add ``value`` of the next sibling, counting only siblings that meet ``among``."""
    w = Window.partitionBy("page_id", F.when(among, F.col("parent_pre"))).orderBy("pre")
    return rows.withColumn(name, F.when(among, F.lead(value).over(w)))


def with_lookup(rows: DataFrame, name: str, key: Column, owner: Column, value: Column) -> DataFrame:
    """Add ``value`` of the owner row whose ``pre`` equals ``key``, within the page."""
    slot = F.when(owner, F.col("pre")).otherwise(key)
    w = (
        Window.partitionBy("page_id", slot)
        .orderBy(owner.desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = F.first(F.when(owner, value)).over(w)
    return rows.withColumn(name, F.when(~owner & key.isNotNull(), found))


def with_enclosing_link(rows: DataFrame, name: str) -> DataFrame:
    """Add the address an element leads to: that of the enclosing link, else its own."""
    is_link = F.col("tag") == "a"
    rows = rows.withColumn("_link", nearest_ancestor(is_tag("a"))["pre"])
    rows = with_lookup(rows, "_around", F.when(~is_link, F.col("_link")), is_link, F.col("href"))
    return rows.withColumn(name, F.coalesce("_around", "href")).drop("_link", "_around")
