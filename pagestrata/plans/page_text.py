"""Title and body of a full page, the content behind a card's link."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagestrata.functions.text import first_truthy
from pagestrata.operators.axes import has_ancestor, is_tag
from pagestrata.sources.page_tree import PAGE, NodeRequest

# Class substrings of a content block.
BODY_CLASSES = ("conteudo", "content", "texto")

REQUEST = NodeRequest(
    elements=dict.fromkeys(("h1", "h2", "p"), ()),
    text=dict.fromkeys(("h1", "h2", "p"), ()),
    context={"article": (), "section": (), "div": BODY_CLASSES},
    presence=frozenset({"h1", "h2", "article", "div"}),
)


def page_text(nodes: DataFrame) -> DataFrame:
    """``linked(page_id, url, title, body)``, one row per page that shows content.

    Title: first ``h1`` in an article, first ``h1``, first ``h2`` in an article,
    first ``h2``; an empty one passes to the next rule. Body: paragraphs in an
    article, in a content block, in a section, or any; the first rule with a
    non-empty paragraph gives all of its paragraphs. A page without ``h1``,
    ``h2``, ``article`` or ``div`` counts as not loaded and gives no row. Pages
    that share a number and differ in their address are told apart.
    """
    tag, text = F.col("tag"), F.col("text")
    in_article = has_ancestor(is_tag("article"))
    rule = (
        F.when(in_article, 1)
        .when(has_ancestor(is_tag("div", classes=BODY_CLASSES)), 2)
        .when(has_ancestor(is_tag("section")), 3)
        .otherwise(4)
    )
    # Titles are numbered so that the order of rules is the order of numbers.
    title = F.when(tag == "h1", F.when(in_article, 1).otherwise(2)).when(tag == "h2", F.when(in_article, 3).otherwise(4))
    rule = F.when((tag == "p") & (text != ""), rule)

    def first_title(*ranks: int) -> Column:
        return F.min(F.when(title.isin(*ranks), F.struct("pre", "text")))["text"]

    wanted = (tag != "p") | (text != "")
    # The paragraphs of one page, together no longer than the page itself. Which rule counts is found
    # beside them: looked for in the list, it would be looked for again at every paragraph.
    pages = (
        nodes.where(tag.isin(*REQUEST.elements, PAGE) & F.coalesce(wanted, F.lit(True)))
        .groupBy("page_id", "url")
        .agg(
            F.max(tag == PAGE).alias("loaded"),
            first_truthy(first_title(1), first_title(1, 2), first_title(3), first_title(3, 4)).alias("title"),
            F.min(rule).alias("best"),
            F.collect_list(F.when(rule.isNotNull(), F.struct(rule.alias("rule"), "pre", "text"))).alias("parts"),
        )
        .where("loaded")
    )
    chosen = F.sort_array(F.filter("parts", lambda p: p["rule"] == F.col("best")))
    body = F.array_join(chosen["text"], "\n\n")
    return pages.select("page_id", "url", "title", F.when(F.col("best").isNotNull(), body).alias("body"))


def link_key(url: Column | str) -> Column:
    """An address without its fragment, which only names a place in the page."""
    return F.regexp_replace(url, "#.*$", "")


def unique_by_url(linked: DataFrame) -> DataFrame:
    """One row per address without fragment, that of the lowest page id."""
    return (
        linked.groupBy(link_key("url").alias("url"))
        .agg(F.min_by(F.struct("title", "body"), "page_id").alias("first"))
        .select("url", "first.title", "first.body")
    )


def captured(nodes: DataFrame) -> DataFrame:
    """``unique_by_url`` of the ``page_text`` of nodes, with texts dealt out once.

    Which page is the first of its address is found on the rows that stand for
    pages. The others lose that row, so they give no text, as if not loaded.
    ``nodes`` is read twice: pass a stored table.
    """
    first = Window.partitionBy(link_key("url")).orderBy("page_id", "url")
    pages = nodes.where(F.col("tag") == PAGE).withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")
    shown = page_text(nodes.where(F.col("tag") != PAGE).unionByName(pages))
    return shown.select(link_key("url").alias("url"), "title", "body")
