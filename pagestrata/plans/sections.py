"""Section pages: headers, titles below them, and each title's description cell."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagestrata.functions.text import (
    HEADER_WORD,
    clean_html_text,
    contains_any,
    drop_title_from_clean,
    parse_header,
)
from pagestrata.operators.axes import (
    is_tag,
    last_pre,
    nearest_ancestor,
    with_lookup,
    with_next,
    with_next_sibling,
)
from pagestrata.operators.carry import carry_in_page
from pagestrata.schema import GREETINGS
from pagestrata.sources.page_tree import NodeRequest

#: Tag of headers and titles, and the class that marks a description cell.
ITEM_TAG = "strong"
CELL_CLASS = "txt_cinza"


def request(item_tag: str = ITEM_TAG, cell_class: str = CELL_CLASS) -> NodeRequest:
    return NodeRequest(
        elements={item_tag: (), "tr": (), "td": (cell_class,)},
        text={item_tag: (), "td": (cell_class,)},
        inner_html={"td": (cell_class,)},
        context={"td": (cell_class,), "tr": ()},
    )


def extract_sections(
    nodes: DataFrame,
    header_word: str = HEADER_WORD,
    item_tag: str = ITEM_TAG,
    cell_class: str = CELL_CLASS,
    blacklist: tuple[str, ...] = GREETINGS,
) -> DataFrame:
    """``items(page_id, pre, uf, municipio, ato, descricao, step)``.

    The description cell of a title is, in this order: 1 the cell around it,
    2 the first cell of its row, 3 the first cell of the next row, 4 the next
    cell in the page unless that holds a greeting. Cells are cleaned once each
    before the shuffle on ``page_id``, which is the only one of this plan.
    """
    is_cell = (F.col("tag") == "td") & F.col("class").contains(cell_class)
    is_item = (F.col("tag") == item_tag) & (F.col("text") != "")
    is_row = F.col("tag") == "tr"

    rows = nodes.where(is_item | is_row | is_cell).select(
        "page_id",
        "pre",
        "post",
        "depth",
        "parent_pre",
        F.when(is_cell, "cell").when(is_row, "row").otherwise("item").alias("kind"),
        F.when(is_item, F.col("text")).alias("ato"),
        F.when(is_item, parse_header("text", header_word)).alias("header"),
        F.when(is_item, nearest_ancestor(is_tag("td", classes=(cell_class,)))["pre"]).alias("around"),
        F.when(is_item, nearest_ancestor(is_tag("tr"))["pre"]).alias("in_row"),
        F.when(is_cell, clean_html_text("inner_html")).alias("cell_text"),
        F.when(is_cell, contains_any("text", blacklist)).alias("blocked"),
    )
    cell, row, item = (F.col("kind") == k for k in ("cell", "row", "item"))

    # UF and city travel in one struct so that they always change together.
    rows = carry_in_page(rows, "place", F.col("header"))
    # Rows of a table matter only to pages with a title outside of every cell.
    whole_page = (
        Window.partitionBy("page_id")
        .orderBy("pre")
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    loose = item & F.col("header").isNull() & F.col("around").isNull()
    rows = rows.withColumn("has_loose", F.max(loose).over(whole_page))
    rows = rows.where(
        (item & F.col("header").isNull() & F.col("place").isNotNull()) | cell | (row & F.col("has_loose"))
    )

    rows = with_next(rows, "next_cell", cell, F.struct("pre", "blocked"), asks_after_subtree=item)
    own_cell = F.when(row & (F.col("next_cell")["pre"] <= last_pre()), F.col("next_cell")["pre"])
    rows = rows.withColumn("own_cell", own_cell)
    rows = with_next_sibling(rows, "below_cell", row, F.col("own_cell"))
    rows = with_lookup(rows, "row_cells", F.col("in_row"), row, F.struct("own_cell", "below_cell"))

    candidates = [
        F.col("around"),
        F.col("row_cells")["own_cell"],
        F.col("row_cells")["below_cell"],
        F.when(~F.col("next_cell")["blocked"], F.col("next_cell")["pre"]),
    ]
    step = F.coalesce(*[F.when(c.isNotNull(), F.lit(i)) for i, c in enumerate(candidates, 1)])
    rows = rows.where(~row).withColumns({"cell_pre": F.coalesce(*candidates), "step": step})
    rows = with_lookup(rows, "cell_text_found", F.when(item, F.col("cell_pre")), cell, F.col("cell_text"))
    return rows.where(item).select(
        "page_id",
        "pre",
        F.col("place")["uf"].alias("uf"),
        F.col("place")["municipio"].alias("municipio"),
        "ato",
        drop_title_from_clean("cell_text_found", "ato").alias("descricao"),
        "step",
    )
