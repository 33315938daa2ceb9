"""Generic listing pages: one card per table row, article or list item."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagestrata.functions.text import contains_any, first_truthy
from pagestrata.operators.axes import has_ancestor, is_tag, last_pre
from pagestrata.sources.page_tree import NodeRequest

# Class substrings and the text of each role.
TITLE_CLASSES = ("titulo", "title", "link")
SNIPPET_CLASSES = ("resumo", "snippet")
LISTING_CLASS = "principaisnormas"

CONTAINERS = ("tr", "article", "li")
REQUEST = NodeRequest(
    elements={**dict.fromkeys((*CONTAINERS, "h1", "h2", "h3", "a", "p"), ()), "div": SNIPPET_CLASSES},
    text={**dict.fromkeys(("h1", "h2", "h3", "a", "p"), ()), "div": SNIPPET_CLASSES},
    context={"article": (LISTING_CLASS,)},
    paths=frozenset({"tr", "li"}),
    attributes=frozenset({"href"}),
)


#: What a card may show, in the order in which it is tried.
ROLES = {"title": ("t1", "t2", "t3", "t4", "t5"), "snippet": ("s1", "s2"), "link": ("l1", "l2")}


def _strategy() -> Column:
    """By which rule an element may be a card; null for every other one."""
    tag, path = F.col("tag"), F.col("path")
    return (
        F.when(path.rlike("/table/(.*/)?tbody/(.*/)?tr$"), 1)
        .when((tag == "article") & has_ancestor(is_tag("article", classes=(LISTING_CLASS,))), 2)
        .when(path.endswith("/ul/li"), 3)
    )


def listing_pages(nodes: DataFrame) -> DataFrame:
    """``(page_id)`` of the pages in which anything may be a card; no other page gives one."""
    return nodes.where(F.col("tag").isin(*CONTAINERS) & _strategy().isNotNull()).select("page_id").distinct()


def extract_cards(nodes: DataFrame) -> DataFrame:
    """``cards(page_id, url, card_pre, strategy, title, snippet, link)``, empty cards dropped.

    Strategy 1 rows of a table body, 2 articles inside the listing article,
    3 items of a list; a page uses the first one that gives it any card. The
    first part of a kind inside a card is the next one in the page if it comes
    before the card ends, so all parts of all cards come from one window. It
    carries places, and whether there is anything to show, but no texts: those
    of the parts that a card shows in the end are looked up once. The plan has one shuffle.
    """
    tag = F.col("tag")
    snippet_div = (tag == "div") & contains_any("class", SNIPPET_CLASSES)
    rows = nodes.where(tag.isin(*[t for t in REQUEST.elements if t != "div"]) | snippet_div).select(
        "page_id",
        "url",
        "pre",
        last_pre().alias("end"),
        "tag",
        _strategy().alias("strategy"),
        "text",
        "href",
        contains_any("class", TITLE_CLASSES).alias("titled"),
        F.col("attrs")["href"].contains("http").alias("absolute"),
    )
    rows = rows.where(~tag.isin(*CONTAINERS) | F.col("strategy").isNotNull())
    # Descending order makes "next" a running frame, which is linear.
    later = Window.partitionBy("page_id").orderBy(F.col("pre").desc()).rowsBetween(Window.unboundedPreceding, -1)

    def next_one(cond: Column, value: str = "text") -> Column:
        said = F.coalesce(F.col(value) != "", F.lit(False))
        return F.last(F.when(cond, F.struct("pre", said.alias("said"))), ignorenulls=True).over(later)

    is_a = tag == "a"
    parts = {
        "t1": next_one(tag == "h3"),
        "t2": next_one(tag == "h2"),
        "t3": next_one(tag == "h1"),
        "t4": next_one(is_a & F.col("titled")),
        "t5": next_one(is_a),
        "s1": next_one(tag == "p"),
        "s2": next_one(tag == "div"),
        "l1": next_one(is_a & F.col("absolute"), "href"),
        "l2": next_one(is_a, "href"),
    }
    inside = {c: F.when(F.col(c)["pre"] <= F.col("end"), F.col(c)) for c in parts}
    rows = rows.withColumns(parts).withColumns(inside)
    has_part = F.coalesce("t1", "t5", "s1").isNotNull()
    is_card = F.col("strategy").isNotNull() & ((F.col("strategy") == 2) | has_part)
    best = F.min(F.when(is_card, F.col("strategy"))).over(Window.partitionBy("page_id"))
    rows = rows.withColumn("best", best).withColumn("shows", is_card & (F.col("strategy") == F.col("best")))

    # Every part once under its own place, and what a card shows under the places where it is.
    def entry(slot: Column, role: Column, text: Column, href: Column) -> Column:
        return F.struct(slot.alias("slot"), role.alias("role"), text.alias("text"), href.alias("href"))

    none = F.lit(None).cast("string")
    own = F.array(entry(F.col("pre"), none, F.col("text"), F.col("href")))
    asked = []
    for role, kinds in ROLES.items():
        where = F.coalesce(*[F.when(F.col(k)["said"], F.col(k)["pre"]) for k in kinds], -1 - F.col("pre"))
        asked.append(entry(where, F.lit(role), none, none))
    entries = F.when(F.col("shows"), F.array(*asked)).when(~tag.isin(*CONTAINERS), own)
    rows = rows.select("page_id", "url", F.col("pre").alias("card_pre"), "strategy", F.explode(entries).alias("e"))
    rows = rows.select("page_id", "url", "card_pre", "strategy", "e.*")
    at = Window.partitionBy("page_id", "slot").orderBy(F.col("role").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shown = F.when(F.col("role") == "link", F.first("href").over(at)).otherwise(F.first("text").over(at))
    cards = rows.withColumn("shown", shown).where(F.col("role").isNotNull()).groupBy("page_id", "card_pre")
    cards = cards.agg(
        F.first("url").alias("url"),
        F.first("strategy").alias("strategy"),
        *[F.max(F.when(F.col("role") == r, F.col("shown"))).alias(r) for r in ROLES],
    )
    title, snippet = (F.coalesce(c, F.lit("")).alias(c) for c in ("title", "snippet"))
    return drop_empty(cards.select("page_id", "url", "card_pre", "strategy", title, snippet, "link"), "title", "snippet")


def drop_empty(df: DataFrame, *columns: str) -> DataFrame:
    """Drop the rows in which every one of ``columns`` is null or empty."""
    return df.where(first_truthy(*columns) != "")
