"""The operators as named queries over the given tables, each with its SQL twin.

The tables hold no section or alert pages, so those queries first let Spark
write such pages from ``documents``, ``part`` and ``orders`` and then read them
back; the SQL states the expected rows straight from the tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagestrata.functions import dates, text
from pagestrata.operators import axes, dedupe, pick
from pagestrata.operators.carry import carry
from pagestrata.operators.paths import Path, nodes_at
from pagestrata.plans import cards as card_plan
from pagestrata.plans import page_text as page_plan
from pagestrata.plans import daily_run, report, sections, selection
from pagestrata.plans.items import REQUEST as ITEMS_REQUEST
from pagestrata.plans.items import card_records, enrich, extract_items
from pagestrata.schema import COLUMNS, GREETINGS, NORMALISED_KEYS, PRIMARY_KEYS
from pagestrata.sources.nodes import explode_nodes, register_html_nodes
from pagestrata.sources.page_tree import NodeRequest
from pagestrata.sources.tables import Staging, dealt, read_pages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

RUN_DATE = dt.date(2025, 11, 5)

# Pieces of DuckDB SQL. Its regular expressions know ASCII whitespace only, so
# the whitespace and line-boundary characters are listed.
WS = r"[\t\n\x0b\f\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
LINES = r"[\n\r\x0b\f\x1c-\x1e\x{85}\x{2028}\x{2029}]"


def _norm(e: str) -> str:
    return f"trim(regexp_replace(coalesce({e}, ''), '{WS}+', ' ', 'g'))"


def _strip(e: str) -> str:
    return f"regexp_replace({e}, '^{WS}+|{WS}+$', '', 'g')"


def _lines(e: str) -> str:
    """Non-empty stripped lines of a text, as a list."""
    return f"list_filter(list_transform(string_split_regex({e}, '{LINES}'), lambda x: {_strip('x')}), lambda x: x <> '')"


def _unescape(e: str) -> str:
    """The four entities in ``pages``; HTML reads them without the semicolon too."""
    for entity, char in (("middot", "·"), ("copy", "©"), ("quot", '"'), ("amp", "&")):
        e = f"regexp_replace({e}, '&{entity};?', '{char}', 'g')"
    return e


def _shown(e: str) -> str:
    """A single-line text as a page shows it."""
    return _strip(rf"replace(regexp_replace({e}, '[ \t\r\n\f]+', ' ', 'g'), chr(160), ' ')")


def _serial(e: str) -> str:
    """A text as it stands in serialised markup."""
    pairs = (("'&'", "'&amp;'"), ("chr(160)", "'&nbsp;'"), ("'<'", "'&lt;'"), ("'>'", "'&gt;'"))
    for char, entity in pairs:
        e = f"replace({e}, {char}, {entity})"
    return e


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f

    return register


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return dealt(_table(spark, sf, "documents"))


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    return read_pages(spark, f"{sf}/pages.parquet")


# --- expressions -----------------------------------------------------------


@query("q01_norm_text", f"SELECT doc_id, {_norm('text')} AS norm FROM documents")
def q01(spark, sf):
    return _documents(spark, sf).select("doc_id", text.norm_text("text").alias("norm"))


# The tags that are dropped and those that end a line.
@query(
    "q02_clean_html_text",
    rf"""
    WITH s AS (
      SELECT page_id, regexp_replace(regexp_replace(
        regexp_replace(html, '(?i)(?:{WS}*<br{WS}*/?>{WS}*)+', chr(10), 'g'),
        '(?i)</?(?:strong|u|b|i|em|span|font)[^>]*>', '', 'g'), '<[^>]+>', '', 'g') AS s
      FROM pages)
    SELECT page_id, array_to_string(list_filter(list_transform(
        string_split_regex(s, '{LINES}'), lambda x: {_norm('x')}), lambda x: x <> ''), chr(10)) AS clean
    FROM s""",
)
def q02(spark, sf):
    return _pages(spark, sf).select("page_id", text.clean_html_text("html").alias("clean"))


# The word that begins a header, and how its parts are set off.
HEADER_TEXT = """
    CASE c_custkey % 4
      WHEN 0 THEN concat('  ISSQN - ', lower(substr(c_mktsegment, 1, 2)), ' -  ', c_name, ' ')
      WHEN 1 THEN concat('issqn-', substr(c_mktsegment, 1, 2), '-', c_name, ' - Centro')
      WHEN 2 THEN concat('ISSQN - ', c_name)
      ELSE concat('Lei ISSQN - ', substr(c_mktsegment, 1, 2), ' - ', c_name) END"""


# The pattern of a header.
@query(
    "q03_parse_header",
    rf"""
    WITH t AS (SELECT c_custkey, trim({HEADER_TEXT}) AS t FROM customer),
    m AS (SELECT c_custkey, regexp_extract(t, '(?i)^ISSQN\s*-\s*([A-Z]{{2}})\s*-\s*(.+?)\s*$', ['uf', 'city']) AS m FROM t)
    SELECT c_custkey, nullif(upper(m.uf), '') AS uf, nullif(m.city, '') AS municipio FROM m""",
)
def q03(spark, sf):
    header = text.parse_header(F.expr(HEADER_TEXT))
    return (
        _table(spark, sf, "customer")
        .select("c_custkey", header.alias("h"))
        .select("c_custkey", "h.uf", "h.municipio")
    )


def _title_sql(day: str) -> str:
    return f"""
    concat('Decreto nº ', o_orderkey, ' de ',
      CASE o_orderkey % 5
        WHEN 0 THEN {day}
        WHEN 1 THEN concat(replace({day}, '/', '.'), ' (republicada)')
        WHEN 2 THEN concat({day}, ' ')
        WHEN 3 THEN concat({day}, ' com alterações, retificações e consolidação posterior')
        ELSE concat({day}, ' ret. 99/99.2025 (DOM)') END)"""


# The patterns of a date and how far from the end it is looked for.
@query(
    "q04_pub_date_tail",
    rf"""
    WITH t AS (SELECT o_orderkey, {_title_sql("strftime(o_orderdate, '%d/%m/%Y')")} AS t FROM orders)
    SELECT o_orderkey, CASE
        WHEN regexp_matches(trim(right(t, 10)), '^\d{{2}}[./]\d{{2}}[./]\d{{4}}$') THEN trim(right(t, 10))
        ELSE regexp_extract(right(t, 40), '\d{{2}}[./]\d{{2}}[./]\d{{4}}') END AS pub_date
    FROM t""",
)
def q04(spark, sf):
    title = F.expr(_title_sql("date_format(o_orderdate, 'dd/MM/yyyy')"))
    return _table(spark, sf, "orders").select("o_orderkey", text.pub_date_from_tail(title).alias("pub_date"))


@query(
    "q05_portal_date",
    """SELECT o_orderkey, strftime(o_orderdate, '%b %-d, %Y') AS day,
              strftime(o_orderdate + INTERVAL 1 DAY, '%b %-d, %Y') AS next_day FROM orders""",
)
def q05(spark, sf):
    return _table(spark, sf, "orders").select(
        "o_orderkey",
        dates.portal_date("o_orderdate").alias("day"),
        dates.portal_date("o_orderdate", 1).alias("next_day"),
    )


def _date_text_sql(day: str) -> str:
    return f"""CASE o_orderkey % 5
        WHEN 0 THEN {day}
        WHEN 1 THEN lower({day})
        WHEN 2 THEN replace({day}, ', ', ',')
        WHEN 3 THEN concat('  ', replace({day}, ' ', '   '))
        ELSE concat('Feb 3', substr({day}, length({day}) - 5)) END"""


@query(
    "q06_date_to_iso",
    rf"""
    WITH t AS (SELECT o_orderkey, {_norm(_date_text_sql("strftime(o_orderdate, '%b %-d, %Y')"))} AS t FROM orders)
    SELECT o_orderkey, coalesce(strftime(try_strptime(
        CASE WHEN regexp_matches(t, '(?i)^[a-z]{{3}} \d{{1,2}}, \d{{4}}$') THEN t END, '%b %d, %Y'), '%Y-%m-%d'), '') AS iso
    FROM t""",
)
def q06(spark, sf):
    shown = F.expr(_date_text_sql("date_format(o_orderdate, 'MMM d, yyyy')"))
    return _table(spark, sf, "orders").select("o_orderkey", dates.portal_date_to_iso(shown).alias("iso"))


@query("q07_extraction_date", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%d-%m') AS day FROM orders")
def q07(spark, sf):
    return _table(spark, sf, "orders").select("o_orderkey", dates.extraction_date("o_orderdate").alias("day"))


@query(
    "q42_date_in_zone",
    "SELECT event_id, CAST(ts - INTERVAL 3 HOUR AS DATE) AS day FROM events",  # the zone's offset since 2019
)
def q42(spark, sf):
    return _table(spark, sf, "events").select("event_id", dates.date_in_zone("ts").alias("day"))


# --- order and choice ------------------------------------------------------


@query(
    "q08_carry_forward",
    """
    WITH c AS (
      SELECT conv_id, turn, role, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER w AS header_turn,
             last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) OVER w AS header_text
      FROM conversations
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING))
    SELECT * FROM c WHERE role <> 'user' AND header_turn IS NOT NULL""",
)
def q08(spark, sf):
    header = F.when(F.col("role") == "user", F.struct("turn", "text"))
    rows = carry(_table(spark, sf, "conversations"), ["conv_id"], "turn", header, "header", Staging(spark).store)
    return rows.where((F.col("role") != "user") & F.col("header").isNotNull()).select(
        "conv_id",
        "turn",
        "role",
        F.col("header.turn").alias("header_turn"),
        F.col("header.text").alias("header_text"),
    )


@query(
    "q09_strategy_pick",
    """
    SELECT conv_id, step, turn, text FROM (
      SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY step, turn) AS rn FROM (
        SELECT *, CASE role WHEN 'system' THEN 1 WHEN 'assistant' THEN 2 WHEN 'user' THEN 3 END AS step
        FROM conversations))
    WHERE rn = 1""",
)
def q09(spark, sf):
    role = F.col("role")
    step = F.when(role == "system", 1).when(role == "assistant", 2).when(role == "user", 3)
    best = pick.best_strategy(step, F.col("turn"), F.struct(step.alias("step"), "turn", "text"))
    return _table(spark, sf, "conversations").groupBy("conv_id").agg(best.alias("b")).select("conv_id", "b.*")


@query(
    "q10_following",
    """
    SELECT conv_id, turn, first_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (
        PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_user
    FROM conversations""",
)
def q10(spark, sf):
    turns = _table(spark, sf, "conversations").select("conv_id", "turn", "role")
    asked = F.when(F.col("role") == "user", F.col("turn"))
    store = Staging(spark).store
    return carry(turns, ["conv_id"], "turn", asked, "next_user", store, True, include_current=False).drop("role")


# --- elements of pages -----------------------------------------------------

PAGE_PARTS = NodeRequest(
    elements=dict.fromkeys(("p", "li", "a", "article"), ()),
    text=dict.fromkeys(("li", "a"), ()),
    context=dict.fromkeys(("article", "ul", "li"), ()),
)
ARTICLE_SQL = "regexp_extract(html, '(?s)<article>(.*?)(?:</article>|$)', 1)"
LI_TEXTS_SQL = f"list_transform(regexp_extract_all(html, '<li><a[^>]*>([^<]*)</a></li>', 1), lambda x: {_unescape('x')})"


@query(
    "q11_axis_join",
    f"""
    SELECT page_id, len(regexp_extract_all({ARTICLE_SQL}, '<p>')) AS n_p,
           len(regexp_extract_all(html, '<li><a')) AS n_li,
           {LI_TEXTS_SQL}[1] AS first_link
    FROM pages""",
)
def q11(spark, sf):
    nodes = explode_nodes(_pages(spark, sf), PAGE_PARTS)
    tag = F.col("tag")
    parts = axes.by_ancestor(nodes, axes.is_tag("article", "ul"), "box_pre")
    boxes = parts.groupBy("page_id", "box_pre").agg(
        F.count_if(tag == "p").alias("n_p"),
        F.count_if((tag == "a") & axes.has_ancestor(axes.is_tag("li"))).alias("n_li"),
        pick.first_where(tag == "a", F.col("text")).alias("first_link"),
    )
    return boxes.groupBy("page_id").agg(
        F.sum("n_p").alias("n_p"),
        F.sum("n_li").alias("n_li"),
        F.min_by("first_link", F.when(F.col("first_link").isNotNull(), F.col("box_pre"))).alias("first_link"),
    )


TITLE_SQL = _strip(_unescape("regexp_extract(html, '<h1>(.*?)</h1>', 1)"))
PARAGRAPH_SQL = _shown(_unescape("regexp_replace(regexp_replace(x, '(?s)</p>.*', ''), '(?s)<[^>]*>', '', 'g')"))
BODY_SQL = f"""array_to_string(list_filter(list_transform(
    string_split({ARTICLE_SQL}, '<p>')[2:], lambda x: {PARAGRAPH_SQL}), lambda x: x <> ''), chr(10) || chr(10))"""


def _page_text(spark: SparkSession, sf: str) -> DataFrame:
    return page_plan.page_text(explode_nodes(_pages(spark, sf), page_plan.REQUEST))


@query("q12_page_title", f"SELECT page_id, {TITLE_SQL} AS title FROM pages")
def q12(spark, sf):
    return _page_text(spark, sf).select("page_id", "title")


@query("q13_page_body", f"SELECT page_id, nullif({BODY_SQL}, '') AS body FROM pages")
def q13(spark, sf):
    return _page_text(spark, sf).select("page_id", "body")


# --- fallback, selection, enrichment ---------------------------------------


@query(
    "q14_group_fallback",
    """
    SELECT o_custkey, o_orderkey, o_orderstatus FROM orders o
    WHERE o_orderstatus = 'F'
       OR NOT EXISTS (SELECT 1 FROM orders f WHERE f.o_custkey = o.o_custkey AND f.o_orderstatus = 'F')""",
)
def q14(spark, sf):
    orders = _table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    preferred = orders.where(F.col("o_orderstatus") == "F")
    others = orders.where(F.col("o_orderstatus") != "F")
    served = preferred.select("o_custkey").distinct()
    return preferred.unionByName(others.join(served, "o_custkey", "left_anti"))


@query(
    "q15_select_by_name",
    """
    WITH a AS (SELECT p_brand, p_partkey, lower(p_name) AS name, p_size % 5 <> 0 AS has_icon,
                      concat('/h/', p_partkey) AS href FROM part),
    n AS (SELECT p_brand, arg_min(has_icon, p_partkey) AS ok, arg_min(href, p_partkey) AS href
          FROM a WHERE name LIKE '%red ring%' GROUP BY p_brand),
    i AS (SELECT p_brand, href FROM (
            SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS rn FROM a WHERE has_icon) WHERE rn = 3)
    SELECT page_id, href, picked_by FROM (
      SELECT coalesce(n.p_brand, i.p_brand) AS page_id, CASE WHEN n.ok THEN n.href ELSE i.href END AS href,
             CASE WHEN n.ok THEN 'name' ELSE 'index' END AS picked_by
      FROM n FULL OUTER JOIN i ON n.p_brand = i.p_brand)
    WHERE href IS NOT NULL""",
)
def q15(spark, sf):
    alerts = _table(spark, sf, "part").select(
        F.col("p_brand").alias("page_id"),
        F.col("p_partkey").alias("row_pos"),
        text.norm_text("p_name").alias("name_text"),
        (F.col("p_size") % 5 != 0).alias("has_icon"),
        F.concat(F.lit("/h/"), F.col("p_partkey")).alias("href"),
    )
    icons = alerts.where("has_icon").select("page_id", F.col("row_pos").alias("pos"), "href")
    return selection.select_alert(alerts, icons, " RED  ring", index=2)


@query(
    "q16_select_by_date",
    """
    SELECT page_id, row_pos, href FROM (
      SELECT o_custkey AS page_id, min(o_orderkey) AS row_pos,
             arg_min(o_orderstatus <> 'P', o_orderkey) AS has_button,
             arg_min(concat('/d/', o_orderkey), o_orderkey) AS href
      FROM orders WHERE strftime(o_orderdate, '%b %-d, %Y') = 'Oct 3, 1998' GROUP BY o_custkey)
    WHERE has_button""",
)
def q16(spark, sf):
    history = _table(spark, sf, "orders").select(
        F.col("o_custkey").alias("page_id"),
        F.col("o_orderkey").alias("row_pos"),
        text.norm_xpath(dates.portal_date("o_orderdate")).alias("date_text"),
        (F.col("o_orderstatus") != "P").alias("has_button"),
        F.concat(F.lit("/d/"), F.col("o_orderkey")).alias("href"),
    )
    return selection.select_day(history, dates.resolve_run_date("1998-10-03").strftime("%b %-d, %Y"))


@query(
    "q17_enrich",
    f"""
    SELECT c.doc_id AS page_id, {_strip("coalesce(nullif(d.title, ''), c.source)")} AS ato,
           {_strip("coalesce(nullif(d.body, ''), 'resumo')")} AS descricao
    FROM documents c LEFT JOIN (
      SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '' ELSE concat(source, ' ', doc_id) END AS title,
             CASE WHEN doc_id % 4 <> 0 THEN text END AS body
      FROM documents) d ON d.doc_id = c.doc_id + 1""",
)
def q17(spark, sf):
    """Every document is a card that leads to the next one, to a place in it if its number is odd."""
    doc = F.col("doc_id")
    place = F.when(doc % 2 == 1, "#a").otherwise("")
    rows = _documents(spark, sf).select(
        doc.alias("page_id"),
        F.lit(0).alias("card_pre"),
        F.col("source").alias("title"),
        F.lit("resumo").alias("snippet"),
        F.concat(F.lit("http://docs.example/"), doc + 1, place).alias("link"),
    )
    linked = _documents(spark, sf).select(
        F.concat(F.lit("http://docs.example/"), doc).alias("url"),
        F.when(doc % 3 == 0, "").otherwise(F.concat_ws(" ", "source", doc)).alias("title"),
        F.when(doc % 4 != 0, F.col("text")).alias("body"),
    )
    records = card_records(enrich(rows, linked), RUN_DATE, "r1")
    return records.select("seq.page_id", F.col("Ato").alias("ato"), F.col("Descrição").alias("descricao"))


BLANKED = """
    CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN source END AS title,
    CASE WHEN doc_id % 2 = 0 THEN '' ELSE text END AS snippet"""


@query(
    "q18_drop_empty",
    f"""SELECT * FROM (SELECT doc_id, {BLANKED} FROM documents)
        WHERE nullif(title, '') IS NOT NULL OR nullif(snippet, '') IS NOT NULL""",
)
def q18(spark, sf):
    rows = _documents(spark, sf).selectExpr("doc_id", *BLANKED.strip().split(",\n"))
    return card_plan.drop_empty(rows, "title", "snippet")


# --- the accumulated table -------------------------------------------------


@query(
    "q19_align",
    """SELECT s_name AS "Ato", '' AS "Descrição", 'MUNICIPAL' AS "Esfera", '' AS "UF", '' AS "Municipio",
              '' AS "Data de extração", '' AS "Data de publicação", '' AS "Fonte", '' AS "StatusCarga" FROM supplier""",
)
def q19(spark, sf):
    rows = _table(spark, sf, "supplier").select(
        F.lit("MUNICIPAL").alias("Esfera"), "s_suppkey", F.col("s_name").alias("Ato"), "s_acctbal"
    )
    return dedupe.align_columns(rows)


def _doc_records(spark: SparkSession, sf: str, body=None) -> DataFrame:
    """Documents as records: language as title, text as description, source as label."""
    rows = _documents(spark, sf).select(
        "doc_id",
        F.col("lang").alias("Ato"),
        (F.col("text") if body is None else body).alias("Descrição"),
        F.col("source").alias("Fonte"),
        F.struct(
            F.lit(1).alias("src"), F.lit("r1").alias("run_id"), F.col("doc_id").alias("page_id"),
            F.lit(0).cast("bigint").alias("pre"),
        ).alias("seq"),
    )
    return dedupe.align_columns(rows, COLUMNS, keep=("seq", "doc_id"))


@query(
    "q20_consolidate",
    """
    WITH u AS (
      SELECT 0 AS src, doc_id, lang, text, source FROM documents WHERE doc_id % 10 < 7
      UNION ALL SELECT 1, doc_id, lang, text, source FROM documents WHERE doc_id % 10 >= 5)
    SELECT src, doc_id, lang AS "Ato", text AS "Descrição", source AS "Fonte" FROM (
      SELECT *, row_number() OVER (PARTITION BY lang, text, source ORDER BY src, doc_id) AS rn FROM u)
    WHERE rn = 1""",
)
def q20(spark, sf):
    rows = _doc_records(spark, sf)
    kept = dedupe.consolidate(rows.where("doc_id % 10 < 7"), rows.where("doc_id % 10 >= 5"))
    return kept.select("seq.src", "doc_id", "Ato", "Descrição", "Fonte")


SPACED_SQL = """
    SELECT 0 AS src, doc_id, lang, text, source FROM documents
    UNION ALL SELECT 1, doc_id, concat(' ', lang), replace(text, ' ', '  '), source FROM documents"""


def _spaced(spark: SparkSession, sf: str) -> DataFrame:
    """Documents, and again with other spacing."""
    again = _doc_records(spark, sf, F.replace("text", F.lit(" "), F.lit("  ")))
    again = again.withColumn("Ato", F.concat(F.lit(" "), F.col("Ato")))
    return dedupe.append(_doc_records(spark, sf), again)


@query(
    "q21_dedupe_normalised",
    f"""
    WITH n AS (SELECT src, doc_id, {_norm('lang')} AS a, {_norm('text')} AS d, {_norm('source')} AS f FROM ({SPACED_SQL}))
    SELECT src, doc_id, a AS "Ato", d AS "Descrição", f AS "Fonte" FROM (
      SELECT *, row_number() OVER (PARTITION BY a, d, f ORDER BY src, doc_id) AS rn FROM n) WHERE rn = 1""",
)
def q21(spark, sf):
    kept = dedupe.dedupe_normalised(_spaced(spark, sf))
    return kept.select("seq.src", "doc_id", "Ato", "Descrição", "Fonte")


COUNTS_SQL = f"""
    WITH u AS ({SPACED_SQL}),
    e AS (SELECT count(*) AS before, (SELECT count(*) FROM (SELECT DISTINCT lang, text, source FROM u)) AS kept FROM u),
    n AS (SELECT count(*) AS before, (SELECT count(*) FROM (
            SELECT DISTINCT {_norm('lang')}, {_norm('text')}, {_norm('source')} FROM u)) AS kept FROM u)
    SELECT 'exact' AS pass, before, kept, before - kept AS removed FROM e
    UNION ALL SELECT 'normalised', before, kept, before - kept FROM n"""


@query("q22_removed_count", COUNTS_SQL)
def q22(spark, sf):
    rows = _spaced(spark, sf)
    exact = dedupe.count_removed(rows, PRIMARY_KEYS)
    normal = dedupe.count_removed(dedupe.normalise_keys(rows), NORMALISED_KEYS)
    return exact.select(F.lit("exact").alias("pass"), "*").unionByName(
        normal.select(F.lit("normalised").alias("pass"), "*")
    )


# The wording of the report.
@query(
    "q23_run_report",
    f"""
    WITH c AS (SELECT removed FROM ({COUNTS_SQL}) WHERE pass = 'normalised'),
    d AS (SELECT strftime(max(o_orderdate), '%Y-%m-%d') AS day FROM orders)
    SELECT removed, concat('[PORTAL] Base extraída (', day, ') - Duplicados removidos: ', removed) AS subject,
      concat('Olá,', chr(10), chr(10), 'A base de atos foi gerada e deduplicada com sucesso em ', day, '.', chr(10),
        'Registros duplicados removidos (ignorando ''Data de extração''): ', removed, '.', chr(10), chr(10),
        'Segue a planilha em anexo.', chr(10), chr(10), 'Att.,', chr(10), 'Robô PORTAL') AS body
    FROM c, d""",
)
def q23(spark, sf):
    counts = dedupe.count_removed(dedupe.normalise_keys(_spaced(spark, sf)), NORMALISED_KEYS)
    last_day = _table(spark, sf, "orders").agg(F.max("o_orderdate").cast("date").alias("run_date"))
    return report.run_report(counts.join(last_day).select("run_date", "removed")).drop("run_date")  # one row each


@query(
    "q24_drop_title_line",
    f"""
    WITH t AS (SELECT doc_id, string_split_regex(text, '{LINES}')[1] AS title, text FROM documents),
    l AS (SELECT doc_id, lower({_norm('title')}) AS k,
                 {_lines("concat(lower(replace(title, ' ', '  ')), chr(10), text)")} AS ls FROM t)
    SELECT doc_id, array_to_string(list_filter(ls, lambda x: lower({_norm('x')}) <> k), chr(10)) AS descricao FROM l""",
)
def q24(spark, sf):
    title = F.get(text.split_lines("text"), F.lit(0))
    respelled = F.lower(F.replace("title", F.lit(" "), F.lit("  ")))
    return (
        _documents(spark, sf)
        .select("doc_id", "text", title.alias("title"))
        .select(
            "doc_id",
            text.drop_title_line(F.concat_ws("\n", respelled, "text"), "title").alias("descricao"),
        )
    )


def _record_sql(ato: str, descricao: str, sphere: str, uf: str, city: str, pub: str, source: str) -> str:
    return f"""{ato} AS "Ato", {descricao} AS "Descrição", {sphere} AS "Esfera", {uf} AS "UF", {city} AS "Municipio",
        '{RUN_DATE:%Y-%d-%m}' AS "Data de extração", {pub} AS "Data de publicação", {source} AS "Fonte",
        'novo' AS "StatusCarga" """


@query(
    "q25_records",
    f"""SELECT page_id, {_record_sql(TITLE_SQL, BODY_SQL, "'FEDERAL'", "'FEDERAL'", "''", "''", "'PORTAL - FEDERAL'")}
        FROM pages""",
)
def q25(spark, sf):
    rows = _page_text(spark, sf).select(
        "page_id",
        F.lit(0).alias("card_pre"),
        F.lit("").alias("title"),
        F.lit("").alias("snippet"),
        F.col("title").alias("full_title"),
        F.col("body").alias("full_body"),
    )
    return card_records(rows, RUN_DATE, "r1").select("seq.page_id", *COLUMNS)


GREETED = """CASE doc_id % 5
    WHEN 0 THEN concat('Caro(a) leitor, ', text)
    WHEN 1 THEN concat(text, ' Seguem abaixo as atualizações')
    WHEN 2 THEN concat('título do alerta ', text) ELSE text END"""


@query(
    "q26_blacklist",
    "SELECT doc_id, t FROM (SELECT doc_id, " + GREETED + " AS t FROM documents) WHERE NOT ("
    + " OR ".join(f"contains(t, '{g}')" for g in GREETINGS) + ")",
)
def q26(spark, sf):
    rows = _documents(spark, sf).select("doc_id", F.expr(GREETED).alias("t"))
    return rows.where(~text.contains_any("t", GREETINGS))


# --- whole plans on written pages ------------------------------------------

# A document as a section page: a header every five lines, then the lines as
# descriptions, placed in turn in the four positions a cell is looked for.
def _doc_lines(spark: SparkSession, sf: str, keep: Column | str = "true") -> DataFrame:
    lines = F.filter(F.transform(text.split_lines("text"), text.trim_all), lambda x: x != "")
    return _documents(spark, sf).where(keep).select("doc_id", "lang", "source", lines.alias("lines"))


def _escape(c: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(char), F.lit(entity))
    return c


def _paragraphs() -> Column:
    """The lines of a document as paragraphs."""
    return F.array_join(F.transform("lines", lambda x: F.concat(F.lit("<p>"), _escape(x), F.lit("</p>"))), "")


def _line_title(i: Column) -> Column:
    return F.concat(
        F.lit("Lei "), F.col("doc_id"), F.lit("."), i, F.lit(", de "),
        F.lpad((1 + i % 28).cast("string"), 2, "0"), F.lit("/0"), 1 + i % 9,
        F.lit(".20"), 10 + F.col("doc_id") % 15,
    )


def _section_html() -> Column:
    def part(line, j):
        i = j + 1
        title = _line_title(i)
        strong = F.concat(F.lit("<strong>"), title, F.lit("</strong>"))
        header = F.concat(
            F.lit("<tr><td><strong>ISSQN - "), F.col("lang"), F.lit(" - "), F.col("source"),
            F.lit("."), F.floor(j / 5), F.lit("</strong></td></tr>"),
        )
        cell = F.concat(F.lit('<td class="x txt_cinza">'), _escape(line), F.lit("</td>"))
        rows = (
            F.when(i % 4 == 0, F.concat(F.lit('<tr><td class="txt_cinza">'), strong, F.lit("<br><br/>"), _escape(line)))
            .when(i % 4 == 1, F.concat(F.lit("<tr><td>"), strong, F.lit("</td>"), cell, F.lit("</tr>")))
            .when(i % 4 == 2, F.concat(F.lit("<tr><td>"), strong, F.lit("</td></tr><tr>"), cell))
            .otherwise(F.concat(F.lit("</table><p>"), strong, F.lit("<table><tr>"), cell, F.lit("</tr>")))
        )
        return F.concat(F.when(j % 5 == 0, header).otherwise(""), rows)

    return F.concat(F.lit("<table>"), F.array_join(F.transform("lines", part), ""), F.lit("</table>"))


SECTION_ROWS_SQL = f"""
    SELECT doc_id, lang, source, u.i AS i, u.x AS x,
           concat('Lei ', doc_id, '.', u.i, ', de ', lpad(CAST(1 + u.i % 28 AS VARCHAR), 2, '0'), '/0', 1 + u.i % 9,
                  '.20', 10 + doc_id % 15) AS title
    FROM (SELECT doc_id, lang, source, unnest(list_transform(ls, lambda x, i: {{'x': x, 'i': i}})) AS u
          FROM (SELECT *, {_lines('text')} AS ls FROM documents))"""
LINE_SQL = _norm(_serial("x"))


@query(
    "q27_sections",
    f"""
    SELECT doc_id AS page_id, upper(lang) AS uf, concat(source, '.', (i - 1) // 5) AS municipio, title AS ato,
           {LINE_SQL} AS descricao, CASE i % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 ELSE 4 END AS step
    FROM ({SECTION_ROWS_SQL})""",
)
def q27(spark, sf):
    pages = _doc_lines(spark, sf).select(
        F.col("doc_id").alias("page_id"), F.lit("").alias("url"), _section_html().alias("html")
    )
    return sections.extract_sections(explode_nodes(pages, sections.request())).drop("pre")


@query(
    "q28_cards",
    f"""
    SELECT page_id, 3 AS strategy, u.t AS title, '' AS snippet,
           concat(regexp_extract(url, '^https?://[^/]+'), u.h) AS link
    FROM (SELECT page_id, url, unnest(list_transform(
            list_zip({LI_TEXTS_SQL}, regexp_extract_all(html, '<li><a href="([^"]*)"', 1)),
            lambda z: {{'t': z[1], 'h': z[2]}})) AS u FROM pages)""",
)
def q28(spark, sf):
    cards = card_plan.extract_cards(explode_nodes(_pages(spark, sf), card_plan.REQUEST))
    return cards.select("page_id", "strategy", "title", "snippet", "link")


@query(
    "q29_items",
    f"""
    WITH s AS ({SECTION_ROWS_SQL}),
    f AS (SELECT doc_id, string_agg({_shown('x')}, chr(10) || chr(10) ORDER BY i) AS body FROM s
          WHERE doc_id % 2 = 1 GROUP BY doc_id)
    SELECT doc_id AS page_id, {_record_sql(
        "title", LINE_SQL, "'MUNICIPAL'", "upper(lang)", "concat(source, '.', (i - 1) // 5)",
        "right(title, 10)", "'PORTAL - MUNICIPAL'")}
    FROM s WHERE doc_id % 2 = 0
    UNION ALL
    SELECT s.doc_id, {_record_sql(
        "CASE WHEN f.doc_id IS NULL THEN s.title ELSE concat('Doc ', f.doc_id) END",
        f"CASE WHEN f.doc_id IS NULL THEN {_shown('s.x')} ELSE f.body END", "'FEDERAL'", "'FEDERAL'", "''",
        "CASE WHEN f.doc_id IS NULL THEN right(s.title, 10) ELSE '' END", "'PORTAL - FEDERAL'")}
    FROM s LEFT JOIN f ON f.doc_id = s.doc_id - 2 AND s.i % 2 = 0
    WHERE s.doc_id % 2 = 1""",
)
def q29(spark, sf):
    """Even documents as section pages, odd ones as listings whose cards link to an earlier page."""

    def card(line, j):
        i = j + 1
        title = _line_title(i)
        link = F.when(i % 2 == 0, F.concat(F.lit('<a href="'), F.col("doc_id") - 2, F.lit('">ler</a>'))).otherwise("")
        return F.concat(F.lit("<li><h3>"), title, F.lit("</h3><p>"), _escape(line), F.lit("</p>"), link)

    listing = F.concat(
        F.lit("<article><h1>Doc "), F.col("doc_id"), F.lit("</h1>"), _paragraphs(),
        F.lit("</article><ul>"), F.array_join(F.transform("lines", card), ""), F.lit("</ul>"),
    )
    pages = _doc_lines(spark, sf).select(
        F.col("doc_id").alias("page_id"),
        F.concat(F.lit("http://docs.example/d/"), "doc_id").alias("url"),
        F.when(F.col("doc_id") % 2 == 0, _section_html()).otherwise(listing).alias("html"),
    )
    staging = Staging(spark)
    nodes = staging.store(explode_nodes(pages, ITEMS_REQUEST), "nodes")
    records = extract_items(nodes, RUN_DATE, "r1", staging.store)
    return records.select("seq.page_id", *COLUMNS)


@query(
    "q30_alert_pages",
    """
    WITH a AS (SELECT p_partkey // 20 AS page_id, p_partkey, p_name, p_size % 3 <> 0 AS has_icon,
                      concat('http://alerts.example/h/', p_partkey) AS href FROM part),
    n AS (SELECT page_id, arg_min(has_icon, p_partkey) AS ok, arg_min(href, p_partkey) AS href
          FROM a WHERE p_name LIKE '%ring%' GROUP BY page_id),
    i AS (SELECT page_id, href FROM (
            SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY p_partkey) AS rn FROM a WHERE has_icon) WHERE rn = 2)
    SELECT coalesce(n.page_id, i.page_id) AS page_id, CASE WHEN n.ok THEN n.href ELSE i.href END AS href,
           CASE WHEN n.ok THEN 'name' ELSE 'index' END AS picked_by
    FROM n FULL OUTER JOIN i ON n.page_id = i.page_id WHERE n.ok OR i.page_id IS NOT NULL""",
)
def q30(spark, sf):
    """Parts as alert pages of twenty keys each: at most twenty rows, as the key is unique."""
    icon = F.concat(
        F.lit('<a href="h/'), "p_partkey", F.lit('"><img alt="Histórico" src="/i/ico_alerta.gif"></a>')
    )
    row = F.concat(
        F.lit('<tr><td class="textoDefaultProduto">'), "p_name", F.lit("</td><td>"),
        F.when(F.col("p_size") % 3 != 0, icon).otherwise(""), F.lit("</td></tr>"),
    )
    pages = _page_of_twenty(_table(spark, sf, "part"), "p_partkey", row, "http://alerts.example/")
    nodes = Staging(spark).store(explode_nodes(pages, selection.ALERT_REQUEST), "nodes")
    return selection.select_alert(selection.alert_rows(nodes), selection.alert_icons(nodes), "Ring", index=1)


@query(
    "q31_history_pages",
    """
    SELECT o_orderkey // 20 AS page_id, strftime(o_orderdate, '%b %-d, %Y') AS date_text,
           o_orderstatus <> 'P' AS has_button,
           CASE WHEN o_orderstatus <> 'P' THEN concat('http://days.example/d/', o_orderkey) END AS href
    FROM orders""",
)
def q31(spark, sf):
    """Orders as history pages of twenty keys each, with both spellings of the detail button."""
    status = F.col("o_orderstatus")
    link = F.concat(F.lit('<a href="/d/'), "o_orderkey", F.lit('">'))
    button = (
        F.when(status == "F", F.concat(link, F.lit('<img src="/i/bt_ver_detalhes.gif"></a>')))
        .when(status == "O", F.concat(link, F.lit("Ver\n detalhes</a>")))
        .otherwise("")
    )
    row = F.concat(
        F.lit('<tr><td><div align="center"> '), dates.portal_date("o_orderdate"),
        F.lit(" </div></td><td>"), button, F.lit("</td></tr>"),
    )
    pages = _page_of_twenty(_table(spark, sf, "orders"), "o_orderkey", row, "http://days.example/")
    history = selection.history_rows(explode_nodes(pages, selection.HISTORY_REQUEST))
    return history.drop("row_pos")


def _page_of_twenty(df: DataFrame, key: str, row: Column, url: str) -> DataFrame:
    spark = df.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # A set number of partitions is not merged again for being few bytes, as
    # reading the pages costs far more than their size suggests.
    rows = df.select(F.floor(F.col(key) / 20).alias("page_id"), F.col(key).alias("k"), row.alias("row"))
    grouped = rows.repartition(parts, "page_id").groupBy("page_id")
    html = F.concat(
        F.lit("<table><tr><th>Nome do Alerta</th></tr>"),
        F.array_join(F.transform("rows", lambda r: r["row"]), "\n"),
        F.lit("</table>"),
    )
    pages = grouped.agg(F.array_sort(F.collect_list(F.struct("k", "row"))).alias("rows"))
    return pages.select("page_id", F.lit(url).alias("url"), html.alias("html"))


@query(
    "q32_next_sibling",
    f"""
    SELECT page_id, ts[i] AS text, ts[i + 1] AS next_text
    FROM (SELECT page_id, ts, unnest(range(1, len(ts) + 1)) AS i FROM (SELECT page_id, {LI_TEXTS_SQL} AS ts FROM pages))""",
)
def q32(spark, sf):
    items = explode_nodes(_pages(spark, sf), PAGE_PARTS).where("tag = 'li'")
    rows = axes.with_next_sibling(items, "next_text", F.lit(True), F.col("text"))
    return rows.select("page_id", "text", "next_text")


@query(
    "q33_item_counts",
    """SELECT run_id, source AS "Fonte", count(*) AS items
       FROM (SELECT concat('r', doc_id % 3) AS run_id, source FROM documents) GROUP BY ALL""",
)
def q33(spark, sf):
    rows = _doc_records(spark, sf)
    run = F.concat(F.lit("r"), F.col("doc_id") % 3)
    return report.count_items(rows.withColumn("seq", F.col("seq").withField("run_id", run)))


@query(
    "q34_two_passes",
    f"""
    WITH b AS (SELECT 0 AS src, doc_id, nullif(lang, 'de') AS a, {_norm('text')} AS d, source AS f
               FROM documents WHERE doc_id % 10 < 7),
    u AS (SELECT * FROM b UNION ALL
          SELECT 1, doc_id, CASE WHEN lang = 'de' THEN '' ELSE lang END, text, source FROM documents WHERE doc_id % 10 >= 5),
    p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY a, d, f ORDER BY src, doc_id) AS rn FROM u) WHERE rn = 1),
    n AS (SELECT src, doc_id, coalesce(a, '') AS a, {_norm('d')} AS d, {_norm('f')} AS f FROM p)
    SELECT src, doc_id, a AS "Ato", d AS "Descrição", f AS "Fonte" FROM (
      SELECT *, row_number() OVER (PARTITION BY a, d, f ORDER BY src, doc_id) AS rn FROM n) WHERE rn = 1""",
)
def q34(spark, sf):
    """Second day: a normalised base with null for empty, and a batch that overlaps it."""
    blank = F.when(F.col("Ato") == "de", "").otherwise(F.col("Ato"))
    rows = _doc_records(spark, sf).withColumn("Ato", blank)
    base = dedupe.empty_as_null(rows.where("doc_id % 10 < 7"), ["Ato"])
    base = base.withColumn("Descrição", text.norm_text("Descrição"))
    kept = dedupe.dedupe_normalised(dedupe.consolidate(base, rows.where("doc_id % 10 >= 5")))
    return kept.select("seq.src", "doc_id", "Ato", "Descrição", "Fonte")


# --- bytes, runs and links between days ------------------------------------


@query(
    "q35_page_errors",
    f"""
    WITH p AS (SELECT doc_id % 10 = 3 AS failed,
                      CASE WHEN doc_id % 10 = 7 THEN '' ELSE {_shown("regexp_replace(text, '[ \t\r\n\f]+', ' ', 'g')")} END AS shown
               FROM documents)
    SELECT CASE WHEN failed THEN 'error' WHEN shown = '' THEN 'empty' ELSE 'read' END AS outcome, count(*) AS pages,
           sum(CASE WHEN failed THEN 0 ELSE length(shown) END)::BIGINT AS chars
    FROM p GROUP BY ALL""",
)
def q35(spark, sf):
    """Documents as served bytes: UTF-8 with and without mark, Latin-1 declared or not, some missing, some unreadable.

    The unreadable ones claim an encoding in which their bytes are half of a character.
    """
    doc, shown = F.col("doc_id"), F.concat(F.lit("<p>"), _escape(F.col("text")), F.lit("</p>"))
    declared = F.concat(F.lit('<meta charset="iso-8859-1">'), shown)
    is_latin = F.col("text").rlike(r"^[\x00-\x7F\xA0-\xFF]*$")
    latin = F.when(doc % 3 == 0, declared).otherwise(shown)
    # Bytes that are not UTF-8 need a byte of two or more; plain ASCII is both.
    html = (
        F.when(doc % 10 == 7, F.lit(None))
        .when(doc % 10 == 3, F.encode(F.lit("<p>\\ud800</p>"), "US-ASCII"))
        .when(is_latin & (doc % 2 == 0), F.encode(latin, "ISO-8859-1"))
        .when(doc % 5 == 1, F.concat(F.unhex(F.lit("EFBBBF")), shown.cast("binary")))
        .otherwise(shown.cast("binary"))
    )
    charset = F.when(doc % 10 == 3, "unicode_escape")
    pages = _documents(spark, sf).select(doc.alias("page_id"), F.lit("").alias("url"), html.alias("html"), charset.alias("charset"))
    request = NodeRequest(elements={"p": ()}, text={"p": ()})
    nodes = explode_nodes(pages, request).select("page_id", "text", "error")
    read = nodes.groupBy("page_id").agg(
        F.max(F.col("error").isNotNull()).alias("failed"), F.sum(F.length("text")).alias("n")
    )
    n = F.coalesce("n", F.lit(0))
    outcome = F.when(F.col("failed"), "error").when(n > 0, "read").otherwise("empty")
    every = pages.select("page_id").join(read, "page_id", "left")
    return every.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("pages"), F.sum(n).alias("chars"))


def _act_pages(spark: SparkSession, sf: str, keep: Column, second_lines: bool = True) -> DataFrame:
    """Documents as section pages: a header with the place, then each line as an act; every other one has a second line."""

    def act(line, j):
        title = F.concat(F.lit("<strong>Ato "), F.length(line), F.lit("</strong>"))
        more = F.when(j % 2 == 1, "<br>fim" if second_lines else "").otherwise("")
        return F.concat(F.lit('<tr><td class="txt_cinza">'), title, F.lit("<br>"), _escape(line), more, F.lit("</td></tr>"))

    header = F.concat(F.lit("<table><tr><td><strong>ISSQN - "), "lang", F.lit(" - "), "source", F.lit("</strong></td></tr>"))
    html = F.concat(header, F.array_join(F.transform("lines", act), ""), F.lit("</table>"))
    return _doc_lines(spark, sf).where(keep).select(
        F.col("doc_id").alias("page_id"), F.lit("").alias("url"), html.alias("html")
    )


@query(
    "q36_two_day_run",
    f"""
    WITH a AS (SELECT doc_id, i, concat('Ato ', length(x)) AS a, upper(lang) AS uf, source AS city, {LINE_SQL} AS line
               FROM ({SECTION_ROWS_SQL})),
    d AS (SELECT *, CASE WHEN i % 2 = 0 THEN line || chr(10) || 'fim' ELSE line END AS raw,
                 CASE WHEN i % 2 = 0 THEN line || ' fim' ELSE line END AS flat FROM a),
    e1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY a, raw ORDER BY doc_id, i) AS rn
                          FROM d WHERE doc_id % 10 < 7) WHERE rn = 1),
    b1 AS (SELECT * EXCLUDE (rn, rm) FROM (SELECT *, row_number() OVER (PARTITION BY a, flat, uf, city ORDER BY doc_id, i) AS rm
                          FROM e1) WHERE rm = 1),
    l1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY a, flat ORDER BY doc_id, i) AS rn FROM b1) WHERE rn = 1),
    e2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY a, raw ORDER BY doc_id, i) AS rn
                          FROM d WHERE doc_id % 10 >= 5) d2
           WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM l1 WHERE l1.a = d2.a AND l1.flat = d2.raw)),
    b2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY a, flat, uf, city ORDER BY doc_id, i) AS rm FROM e2) e
           WHERE rm = 1 AND NOT EXISTS (SELECT 1 FROM l1 WHERE l1.a = e.a AND l1.flat = e.flat AND l1.uf = e.uf AND l1.city = e.city)),
    base AS (SELECT 1 AS day, doc_id, a, flat, uf, city FROM l1 UNION ALL SELECT 2, doc_id, a, flat, uf, city FROM b2)
    SELECT day, doc_id, a AS "Ato", flat AS "Descrição", uf AS "UF", city AS "Municipio",
           (SELECT count(*) FROM e2) - (SELECT count(*) FROM b2) AS removed,
           (SELECT count(*) FROM base) AS stored
    FROM base""",
)
def q36(spark, sf):
    """Two days through the whole run: the base and the report afterwards."""
    out = f"{Staging(spark).folder}/acts"
    doc = F.col("doc_id") % 10
    daily_run.run(_act_pages(spark, sf, doc < 7), out, RUN_DATE, "day 1", strict=True)
    second = daily_run.run(_act_pages(spark, sf, doc >= 5), out, RUN_DATE + dt.timedelta(days=1), "day 2", strict=True)
    base = daily_run.current_base(spark, out)
    if second is None:
        second = daily_run.reports(spark, out)
    return base.join(second.select("removed", "stored")).select(  # the report is one row
        F.col("seq.run_id").cast("int").alias("day"), F.col("seq.page_id").alias("doc_id"),
        "Ato", "Descrição", "UF", "Municipio", "removed", "stored",
    )


@query(
    "q37_linked",
    f"""
    WITH s AS ({SECTION_ROWS_SQL}),
    f AS (SELECT doc_id, {_norm("string_agg(" + _shown('x') + ", ' ' ORDER BY i)")} AS body FROM s GROUP BY doc_id)
    SELECT concat('Doc ', doc_id) AS "Ato", coalesce(body, 'resumo') AS "Descrição" FROM documents LEFT JOIN f USING (doc_id)""",
)
def q37(spark, sf):
    """Pages captured on one day, linked from listings captured on the next, with and without a fragment."""
    out = f"{Staging(spark).folder}/acts"
    articles = _doc_lines(spark, sf).select(
        F.col("doc_id").alias("page_id"),
        F.concat(F.lit("http://docs.example/d/"), "doc_id").alias("url"),
        F.concat(F.lit("<article><h1>Doc "), "doc_id", F.lit("</h1>"), _paragraphs(), F.lit("</article>")).alias("html"),
    )
    daily_run.run(articles, out, RUN_DATE, "articles", strict=True)
    place = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("#"), "source")).otherwise("")
    card = F.concat(
        F.lit('<tr><td><h3>ler</h3><p>resumo</p><a href="/d/'), "doc_id", place, F.lit('">ler</a></td></tr>')
    )
    listings = _page_of_twenty(_table(spark, sf, "documents"), "doc_id", card, "http://docs.example/")
    daily_run.run(listings, out, RUN_DATE + dt.timedelta(days=1), "listings", strict=True)
    return daily_run.current_base(spark, out).select("Ato", "Descrição")


# --- the remaining rules of cards and page text ----------------------------


def _rule_pages(spark: SparkSession, sf: str, html: Column, keep: Column | str = "true") -> DataFrame:
    url = F.concat(F.lit("http://docs.example/d/"), "doc_id")
    return _doc_lines(spark, sf, keep).select(F.col("doc_id").alias("page_id"), url.alias("url"), html.alias("html"))


@query(
    "q38_table_cards",
    f"""
    SELECT doc_id AS page_id, 1 AS strategy, concat('Lei ', doc_id, '.', i) AS title, {_shown('x')} AS snippet,
           CASE WHEN i % 5 = 0 THEN concat('http://abs.example/', i) WHEN i % 4 >= 2 THEN 'http://docs.example/t' END AS link
    FROM ({SECTION_ROWS_SQL}) WHERE i % 4 >= 2 OR i % 3 <> 1 OR i % 5 = 0""",
)
def q38(spark, sf):
    """Every line as a table row, with all title, snippet and link rules, empty first choices among them."""

    def row(line, j):
        i = j + 1
        title = F.concat(F.lit("Lei "), F.col("doc_id"), F.lit("."), i)
        shown = (
            F.when(i % 4 == 0, F.concat(F.lit("<h2>"), title, F.lit("</h2>")))
            .when(i % 4 == 1, F.concat(F.lit("<h1>"), title, F.lit("</h1>")))
            .when(i % 4 == 2, F.concat(F.lit('<a class="x titulo" href="/t">'), title, F.lit("</a>")))
            .otherwise(F.concat(F.lit('<h3> </h3><a href="/t">'), title, F.lit("</a>")))
        )
        snippet = (
            F.when(i % 3 == 0, F.concat(F.lit("<p>"), _escape(line), F.lit("</p>")))
            .when(i % 3 == 1, F.concat(F.lit('<div class="resumo">'), _escape(line), F.lit("</div>")))
            .otherwise(F.concat(F.lit('<p></p><div class="a snippet">'), _escape(line), F.lit("</div>")))
        )
        more = F.when(i % 5 == 0, F.concat(F.lit('<a href="http://abs.example/'), i, F.lit('">z</a>'))).otherwise("")
        return F.concat(F.lit("<tr><td>"), shown, snippet, more, F.lit("</td></tr>"))

    html = F.concat(F.lit("<table>"), F.array_join(F.transform("lines", row), ""), F.lit("</table>"))
    cards = card_plan.extract_cards(explode_nodes(_rule_pages(spark, sf, html), card_plan.REQUEST))
    return cards.select("page_id", "strategy", "title", "snippet", "link")


@query(
    "q39_listing_articles",
    f"""
    SELECT doc_id AS page_id, 2 AS strategy, CASE WHEN i % 3 = 2 THEN '' ELSE concat('Lei ', i) END AS title,
           {_shown('x')} AS snippet, CAST(NULL AS VARCHAR) AS link
    FROM ({SECTION_ROWS_SQL})""",
)
def q39(spark, sf):
    """Every line as an article of a listing; list items beside it do not count then."""

    def article(line, j):
        i = j + 1
        title = (
            F.when(i % 3 == 0, F.concat(F.lit("<h3>Lei "), i, F.lit("</h3><h2>no</h2>")))
            .when(i % 3 == 1, F.concat(F.lit("<h3> </h3><h2>Lei "), i, F.lit("</h2>")))
            .otherwise("")
        )
        return F.concat(F.lit("<article>"), title, F.lit("<p>"), _escape(line), F.lit("</p></article>"))

    html = F.concat(
        F.lit('<ul><li><a href="/x">x</a></li></ul><article class="lista principaisnormas">'),
        F.array_join(F.transform("lines", article), ""), F.lit("</article>"),
    )
    has_lines = text.trim_all("text") != ""  # asked of the text, as asking it of the lines would split them twice
    pages = _rule_pages(spark, sf, html, has_lines)
    cards = card_plan.extract_cards(explode_nodes(pages, card_plan.REQUEST))
    return cards.select("page_id", "strategy", "title", "snippet", "link")


@query(
    "q40_page_text_rules",
    f"""
    WITH s AS ({SECTION_ROWS_SQL}),
    f AS (SELECT doc_id, string_agg({_shown('x')}, chr(10) || chr(10) ORDER BY i) AS body FROM s GROUP BY doc_id)
    SELECT doc_id AS page_id, CASE WHEN doc_id % 4 = 3 THEN '' ELSE concat('Doc ', doc_id) END AS title, body
    FROM documents LEFT JOIN f USING (doc_id) WHERE doc_id % 5 <> 4""",
)
def q40(spark, sf):
    """Titles from an article's h2, any h2, h1 or nothing; paragraphs of a block, a section, anywhere; pages not loaded."""
    doc = F.col("doc_id")
    name = F.concat(F.lit("Doc "), doc)
    ps = F.when(F.size("lines") > 0, _paragraphs()).otherwise("")
    outside = F.when(F.size("lines") > 0, "<p>fora</p>").otherwise("")
    html = (
        F.when(doc % 5 == 4, F.concat(F.lit("<span>"), ps, F.lit("</span>")))
        .when(doc % 4 == 0, F.concat(F.lit("<article><h2>"), name, F.lit('</h2></article><h1></h1><div class="x conteudo">'), ps, F.lit("</div>"), outside))
        .when(doc % 4 == 1, F.concat(F.lit("<h2>"), name, F.lit("</h2><section>"), ps, F.lit("</section>"), outside))
        .when(doc % 4 == 2, F.concat(F.lit("<h1>"), name, F.lit("</h1>"), ps))
        .otherwise(F.concat(F.lit("<article><p> </p></article><div class=texto>"), ps, F.lit("</div>"), outside))
    )
    found = page_plan.page_text(explode_nodes(_rule_pages(spark, sf, html), page_plan.REQUEST))
    return found.select("page_id", "title", "body")


@query(
    "q41_lateral_nodes",
    f"SELECT page_id, 'li' AS tag, unnest({LI_TEXTS_SQL}) AS text FROM pages",
)
def q41(spark, sf):
    register_html_nodes(spark, NodeRequest(elements={"li": ()}, text={"li": ()}))
    return spark.sql(
        "SELECT n.page_id, n.tag, n.text FROM {pages} p, LATERAL html_nodes(p.page_id, p.url, p.html) n", pages=_pages(spark, sf)
    )


# --- many runs, broken markup, hidden text ---------------------------------


@query(
    "q43_many_runs",
    f"""
    WITH a AS (SELECT doc_id % 10 AS day, doc_id, i, concat('Ato ', length(x)) AS a, upper(lang) AS uf, source AS city, {LINE_SQL} AS line
               FROM ({SECTION_ROWS_SQL}))
    SELECT day + 1 AS day, doc_id, a AS "Ato", line AS "Descrição", uf AS "UF", city AS "Municipio"
    FROM (SELECT *, row_number() OVER (PARTITION BY a, line ORDER BY day, doc_id, i) AS rn FROM a) WHERE rn = 1""",
)
def q43(spark, sf):
    """Documents dealt to ten days by id; folders are merged after the sixth day. The base at the end."""
    out = f"{Staging(spark).folder}/acts"
    for day in range(10):
        pages = _act_pages(spark, sf, F.col("doc_id") % 10 == day, second_lines=False)
        daily_run.run(pages, out, RUN_DATE + dt.timedelta(days=day), f"day {day}", strict=True)
        if day == 5:
            daily_run.compact(spark, out, fanout=2)
    return daily_run.current_base(spark, out).select(
        F.col("seq.run_id").cast("int").alias("day"), F.col("seq.page_id").alias("doc_id"), "Ato", "Descrição", "UF", "Municipio"
    )


@query(
    "q44_location_paths",
    f"SELECT page_id, unnest({LI_TEXTS_SQL}) AS text FROM pages",
)
def q44(spark, sf):
    """Links that stand alone in items of lists, found by steps from the top of the page."""
    tags = ("ul", "li", "a")
    request = NodeRequest(elements=dict.fromkeys(tags, ()), text={"a": ()}, attributes=frozenset({"href"}))
    link = Path().descendant("ul").child("li", having=Path().parent("ul")).child("a", where=F.col("href").isNotNull(), nth=1)
    return nodes_at(explode_nodes(_pages(spark, sf), request), link).select("page_id", "text")


@query(
    "q45_broken_markup",
    f"""
    WITH s AS (SELECT doc_id AS page_id, i, {_shown('x')} AS x FROM ({SECTION_ROWS_SQL}))
    SELECT page_id, '/p' AS path, x AS text FROM s WHERE i % 3 = 0
    UNION ALL SELECT page_id, '/table/tbody/tr/td', i::VARCHAR FROM s WHERE i % 3 = 0
    UNION ALL SELECT page_id, '/b', '' FROM s WHERE i % 3 = 1
    UNION ALL SELECT page_id, '/p', x || 't' FROM s WHERE i % 3 = 1
    UNION ALL SELECT page_id, '/p/b', x FROM s WHERE i % 3 = 1
    UNION ALL SELECT page_id, unnest(['/div/p', '/div/p/i']), x FROM s WHERE i % 3 = 2
    UNION ALL SELECT page_id, unnest(['/div/p', '/div/p/i']), 'n' FROM s WHERE i % 3 = 2""",
)
def q45(spark, sf):
    """Every line as stray content of a table, in a formatting element that ends inside a paragraph, or in one left open."""

    def part(line, j):
        i, line = j + 1, _escape(line)
        return (
            F.when(i % 3 == 0, F.concat(F.lit("<table><p>"), line, F.lit("</p><tr><td>"), i, F.lit("</td></tr></table>")))
            .when(i % 3 == 1, F.concat(F.lit("<b><p>"), line, F.lit("</b>t</p>")))
            .otherwise(F.concat(F.lit("<div><p><i>"), line, F.lit("<p>n</i></div>")))
        )

    pages = _rule_pages(spark, sf, F.array_join(F.transform("lines", part), ""))
    tags = dict.fromkeys(("p", "b", "i", "td"), ())
    nodes = explode_nodes(pages, NodeRequest(elements=tags, text=tags, paths=frozenset(tags)))
    return nodes.select("page_id", "path", "text")


@query(
    "q46_hidden_text",
    f"""
    SELECT doc_id AS page_id, CASE i % 4 WHEN 2 THEN {_shown('x')} WHEN 3 THEN replace(x, chr(160), ' ') || '  x' ELSE '' END AS text
    FROM ({SECTION_ROWS_SQL})""",
)
def q46(spark, sf):
    """Every line hidden by an attribute or by a style, shown inside what is hidden, or with its spaces kept."""

    def part(line, j):
        i, line = j + 1, _escape(line)
        hidden = F.concat(F.lit('<p style="visibility:hidden">a<span style="visibility:visible">'), line, F.lit("</span></p>"))
        return (
            F.when(i % 4 == 0, F.concat(F.lit("<p hidden>"), line, F.lit("</p>")))
            .when(i % 4 == 1, F.concat(F.lit('<p style="color:red; display: none">'), line, F.lit("</p>")))
            .when(i % 4 == 2, hidden)
            .otherwise(F.concat(F.lit("<pre>"), line, F.lit("  x</pre>")))
        )

    pages = _rule_pages(spark, sf, F.array_join(F.transform("lines", part), ""))
    tags = dict.fromkeys(("p", "pre"), ())
    return explode_nodes(pages, NodeRequest(elements=tags, text=tags)).select("page_id", "text")
