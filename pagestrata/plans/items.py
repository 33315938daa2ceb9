"""Records of a set of pages: section items, else cards with their linked text."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagestrata.functions.dates import extraction_date
from pagestrata.functions.text import first_truthy, pub_date_from_tail, trim_all
from pagestrata.plans import cards, page_text, sections
from pagestrata.plans.cards import extract_cards, listing_pages
from pagestrata.plans.page_text import link_key
from pagestrata.plans.sections import extract_sections
from pagestrata.schema import Labels

#: Everything the three extractors read, so that a page is parsed once.
REQUEST = sections.request() | cards.REQUEST | page_text.REQUEST


def _seq(run_id: str, pre: str) -> Column:
    return F.struct(
        F.lit(1).alias("src"),
        F.lit(run_id).alias("run_id"),
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col(pre).cast("bigint").alias("pre"),
    ).alias("seq")


def section_records(items: DataFrame, run_date: dt.date, run_id: str, labels: Labels = Labels()) -> DataFrame:
    """Section items as records."""
    return items.select(
        F.col("ato").alias("Ato"),
        F.col("descricao").alias("Descrição"),
        F.lit(labels.section_sphere).alias("Esfera"),
        F.col("uf").alias("UF"),
        F.col("municipio").alias("Municipio"),
        extraction_date(F.lit(run_date)).alias("Data de extração"),
        pub_date_from_tail("ato").alias("Data de publicação"),
        F.lit(labels.section_source).alias("Fonte"),
        F.lit(labels.status).alias("StatusCarga"),
        _seq(run_id, "pre"),
    )


def card_records(enriched: DataFrame, run_date: dt.date, run_id: str, labels: Labels = Labels()) -> DataFrame:
    """Cards (with ``full_title`` and ``full_body`` where known) as records."""
    ato = trim_all(first_truthy("full_title", "title"))
    return enriched.select(
        ato.alias("Ato"),
        trim_all(first_truthy("full_body", "snippet")).alias("Descrição"),
        F.lit(labels.card_sphere).alias("Esfera"),
        F.lit(labels.card_state).alias("UF"),
        F.lit("").alias("Municipio"),
        extraction_date(F.lit(run_date)).alias("Data de extração"),
        pub_date_from_tail(ato).alias("Data de publicação"),
        F.lit(labels.card_source).alias("Fonte"),
        F.lit(labels.status).alias("StatusCarga"),
        _seq(run_id, "card_pre"),
    )


def enrich(card_rows: DataFrame, linked: DataFrame) -> DataFrame:
    """Add ``full_title`` and ``full_body`` of the page behind each card's link.

    A link to a place in a page leads to that page. Cards without a known page
    keep nulls there. Many cards may share one link, or have none: adaptive
    execution splits such partitions of the cards.
    """
    full = linked.select(
        link_key("url").alias("_key"), F.col("title").alias("full_title"), F.col("body").alias("full_body")
    )
    return card_rows.withColumn("_key", link_key("link")).join(full, "_key", "left").drop("_key")


def extract_items(
    nodes: DataFrame,
    run_date: dt.date,
    run_id: str,
    store: Callable[[DataFrame, str], DataFrame],
    linked: DataFrame | Callable[[DataFrame], DataFrame] | None = None,
    labels: Labels = Labels(),
) -> DataFrame:
    """Records of all pages. A page gives its section items, or its cards when it has none.

    ``nodes`` is read several times: pass a stored table. ``store`` writes a
    table that is used twice and hands back the stored copy. ``linked`` defaults
    to the pages themselves; it may be another table with one row for each
    address, or a function that gives the rows for a table of addresses.
    """
    items = store(extract_sections(nodes), "section_items")
    if linked is None:
        linked = page_text.captured(nodes)
    # Cards are found within a page, so pages that have section items, or nothing that can be a card, are left
    # out before they are looked for. Their numbers are stored, so that it is known whether they are few.
    listings = listing_pages(nodes).join(items.select("page_id").distinct(), "page_id", "left_anti")
    listings = store(listings.withColumnRenamed("page_id", "_listing"), "listings")
    parts = nodes.where(F.col("tag").isin(*cards.REQUEST.elements))
    others = parts.join(listings, F.col("page_id").eqNullSafe(F.col("_listing")), "left_semi")
    generic = store(extract_cards(others), "cards")
    if callable(linked):
        linked = linked(generic.where("link IS NOT NULL").select(link_key("link").alias("url")).distinct())
    return section_records(items, run_date, run_id, labels).unionByName(
        card_records(enrich(generic, linked), run_date, run_id, labels)
    )
