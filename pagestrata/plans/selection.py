"""Choose the alert and the day to follow, on tables taken from captured pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagestrata.functions.text import fold, norm_text, norm_xpath
from pagestrata.operators.axes import by_ancestor, is_tag, with_enclosing_link
from pagestrata.operators.pick import first_where, join_in_order
from pagestrata.sources.page_tree import NodeRequest

# How the portal marks names, icons, dates and buttons.
NAME_CLASS = "textoDefaultProduto"
ICON_ALT, ICON_SRC = "Histórico", "ico_alerta.gif"
DETAIL_SRC, DETAIL_SRC_LOOSE, DETAIL_TEXT = "bt_ver_detalhes.gif", "bt_ver_detalhes", "Ver detalhes"

ALERT_REQUEST = NodeRequest(
    elements=dict.fromkeys(("tr", "td", "img", "a"), ()),
    text=dict.fromkeys(("tr", "td"), ()),
    value={"td": ()},
    context={"tr": (), "a": ()},
    attributes=frozenset({"src", "alt"}),
)
HISTORY_REQUEST = NodeRequest(
    elements=dict.fromkeys(("tr", "div", "img", "input", "a"), ()),
    value=dict.fromkeys(("div", "a"), ()),
    context={"tr": (), "a": ()},
    attributes=frozenset({"src", "align"}),
)


def _is_icon():
    src = F.col("attrs")["src"]
    return (F.col("tag") == "img") & (F.col("attrs")["alt"] == ICON_ALT) & src.contains(ICON_SRC)


def alert_icons(nodes: DataFrame) -> DataFrame:
    """``icons(page_id, pos, href)``: every history icon of a page, in document order."""
    rows = nodes.where(_is_icon() | (F.col("tag") == "a"))
    return (
        with_enclosing_link(rows, "link")
        .where(_is_icon())
        .select("page_id", F.col("pre").alias("pos"), F.col("link").alias("href"))
    )


def alert_rows(nodes: DataFrame) -> DataFrame:
    """``alerts(page_id, row_pos, name_text, has_icon, href)`` of every table row with a cell.

    A row of an outer layout table counts too and holds all that its inner
    rows hold; being earlier in the page, it is met first.
    """
    rows = with_enclosing_link(nodes.where(F.col("tag").isin("tr", "td", "img", "a")), "link")
    rows = rows.where(_is_icon() | F.col("tag").isin("tr", "td"))
    parts = by_ancestor(rows, is_tag("tr"), "row_pos", or_self=F.col("tag") == "tr")
    named = (F.col("tag") == "td") & (F.col("class").contains(NAME_CLASS) | (F.col("value") != ""))
    own = (F.col("tag") == "tr") & (F.col("pre") == F.col("row_pos"))
    grouped = parts.groupBy("page_id", "row_pos").agg(
        F.max(F.col("tag") == "td").alias("has_cell"),
        join_in_order(named, norm_text("text"), " ").alias("names"),
        F.max(F.when(own, F.col("text"))).alias("own_text"),
        first_where(_is_icon(), F.struct(F.col("link"))).alias("icon"),
    )
    name = F.coalesce(F.nullif("names", F.lit("")), norm_text("own_text"))
    return grouped.where("has_cell").select(
        "page_id",
        "row_pos",
        name.alias("name_text"),
        F.col("icon").isNotNull().alias("has_icon"),
        F.col("icon")["link"].alias("href"),
    )


def select_alert(alerts: DataFrame, icons: DataFrame, target: str, index: int = 0) -> DataFrame:
    """``(page_id, href, picked_by)``: by name, else the icon at ``index``.

    The first row whose name contains ``target`` (spacing and case ignored)
    decides: when it has no icon, no later row is tried. An empty target never
    matches; an index out of range gives nothing.
    """
    alerts = alerts.withColumn("_target", fold(F.lit(target)))
    hit = (F.col("_target") != "") & F.lower("name_text").contains(F.col("_target"))
    by_name = (
        alerts.groupBy("page_id")
        .agg(first_where(hit, F.struct("has_icon", "href"), "row_pos").alias("row"))
        .where(F.col("row")["has_icon"])
        .select("page_id", F.col("row")["href"].alias("name_href"), F.lit(True).alias("by_name"))
    )
    w = Window.partitionBy("page_id").orderBy("pos")
    by_index = (
        icons.withColumn("rn", F.row_number().over(w))
        .where(F.col("rn") == index + 1)
        .select("page_id", F.col("href").alias("index_href"))
    )
    return by_name.join(by_index, "page_id", "full_outer").select(
        "page_id",
        F.when(F.col("by_name"), F.col("name_href")).otherwise(F.col("index_href")).alias("href"),
        F.when(F.col("by_name"), F.lit("name")).otherwise(F.lit("index")).alias("picked_by"),
    )


def history_rows(nodes: DataFrame) -> DataFrame:
    """``history(page_id, row_pos, date_text, has_button, href)``, one row per centred date cell text."""
    tag, src = F.col("tag"), F.col("attrs")["src"]
    centred = (tag == "div") & (F.col("attrs")["align"] == "center")
    exact = (tag == "img") & src.contains(DETAIL_SRC)
    loose = (tag.isin("img", "input") & src.contains(DETAIL_SRC_LOOSE)) | (
        (tag == "a") & norm_xpath("value").contains(DETAIL_TEXT)
    )
    exact, loose = F.coalesce(exact, F.lit(False)), F.coalesce(loose, F.lit(False))
    rows = nodes.where(tag.isin("img", "input", "a") | centred)
    rows = with_enclosing_link(rows, "link").where(centred | exact | loose)
    parts = by_ancestor(rows, is_tag("tr"), "row_pos")
    grouped = parts.groupBy("page_id", "row_pos").agg(
        F.collect_set(F.when(centred, norm_xpath("value"))).alias("dates"),
        first_where(exact, F.struct(F.col("link"))).alias("b1"),
        first_where(loose, F.struct(F.col("link"))).alias("b2"),
    )
    button = F.coalesce("b1", "b2")
    return grouped.select(
        "page_id",
        "row_pos",
        F.explode("dates").alias("date_text"),
        button.isNotNull().alias("has_button"),
        button["link"].alias("href"),
    )


def select_day(history: DataFrame, date_text: str) -> DataFrame:
    """``(page_id, row_pos, href)`` of the first row with exactly that date, if it has a button."""
    rows = history.where(F.col("date_text") == date_text)
    first = rows.groupBy("page_id").agg(
        F.min(F.struct("row_pos", "has_button", "href")).alias("row")
    )
    return first.where(F.col("row")["has_button"]).select("page_id", "row.row_pos", "row.href")
