import datetime as dt

import pytest
from pyspark.sql import functions as F

from pagestrata.plans import cards, items, page_text
from pagestrata.schema import COLUMNS
from pagestrata.sources.nodes import explode_nodes
from pagestrata.sources.tables import Staging

DAY = dt.date(2025, 11, 5)


@pytest.fixture
def cards_of(pages_of):
    def run(*htmls):
        rows = cards.extract_cards(explode_nodes(pages_of(*htmls), cards.REQUEST))
        return [tuple(r)[:1] + tuple(r)[3:] for r in rows.orderBy("page_id", "card_pre").collect()]

    return run


def test_card_strategies_per_page(cards_of):
    out = cards_of(
        # rows of a table body come first, and a bare table has a body too
        "<table><tr><td><a href=/1>um</a></td></tr><tr><td>sem nada</td></tr></table><ul><li><a href=/2>x</a></ul>",
        # a row outside the body does not count; articles inside the listing do
        "<article class='a principaisnormas b'><article><h3>art</h3></article><article>vazio</article></article>"
        "<ul><li><a href=/2>x</a></ul>",
        "<ul><li><a href=/3>três</a></li><li>nada</li><div><li><p>fora</p></li></div></ul><ol><li><p>não</p></ol>",
        # articles without anything to show still keep lists from being used
        "<article class=principaisnormas><article>vazio</article></article><ul><li><a href=/2>x</a></ul>",
        "<table><thead><tr><th><a href=/h>cabeça</a></th></tr></thead></table><ul><li><p>item</p></ul>",
        "<p>nada aqui</p>",
    )
    host = "http://host.example"
    assert out == [
        (0, 1, "um", "", f"{host}/1"),
        (1, 2, "art", "", None),
        (2, 3, "três", "", f"{host}/3"),
        (4, 3, "", "item", None),
    ]


def test_title_snippet_and_link_rules(cards_of):
    def li(inner):
        return f"<ul><li>{inner}</li></ul>"

    out = cards_of(
        li("<h1>c</h1><h2>b</h2><h3>a</h3><p>p1</p><p>p2</p>"),
        li("<h3> </h3><h3>segundo</h3><h2>b</h2><p></p><div class='x resumo-1'>resumo</div>"),
        li("<a href='/1'>primeiro</a><a class='my-link' href='/2'>segundo</a><a href='https://o.example/3'>t</a>"),
        li("<a>sem destino</a><a href='/x'>x</a>"),
        li("<a href='http://q.example/'></a><div class=snippet>s</div>"),
    )
    host = "http://host.example"
    assert [r[2:] for r in out] == [
        ("a", "p1", None),
        ("b", "resumo", None),
        ("segundo", "", "https://o.example/3"),
        ("sem destino", "", None),
        ("", "s", "http://q.example/"),
    ]
    assert cards_of(li("<a href='r/s'>x</a>"))[0][4] == f"{host}/dir/r/s"


def test_nested_rows_are_cards_of_their_own(cards_of):
    html = "<table><tr><td><table><tr><td><a href=/1>um</a></td></tr><tr><td><p>dois</p></td></tr></table></td></tr></table>"
    assert [r[2:4] for r in cards_of(html)] == [("um", "dois"), ("um", ""), ("", "dois")]


def test_page_text_rules(pages_of):
    htmls = [
        "<h1>fora</h1><article><h1>dentro</h1><p>a</p><p> </p><p>b<br>c</p></article><p>fora</p>",
        "<article><h1></h1><h2>h2 dentro</h2></article><h1>h1 fora</h1><div class=textos><p>bloco</p></div><section><p>s</p></section>",
        "<article><h1></h1><h1>segundo</h1><p></p></article><h2>h2</h2><section><p>s1</p><p>s2</p></section><p>solto</p>",
        "<div>x</div><p>um</p><p>dois</p>",
        "<p>sem nada que conte como carregado</p>",
        "<div>sem parágrafo</div>",
    ]
    rows = page_text.page_text(explode_nodes(pages_of(*htmls), page_text.REQUEST)).orderBy("page_id").collect()
    assert [(r.page_id, r.title, r.body) for r in rows] == [
        (0, "dentro", "a\n\nb\nc"),
        (1, "h2 dentro", "bloco"),  # the first h1 of the page is the empty one
        (2, "h2", "s1\n\ns2"),
        (3, "", "um\n\ndois"),
        (5, "", None),
    ]


def test_unique_by_url_keeps_the_lowest_page(spark):
    rows = spark.createDataFrame(
        [(3, "u", "c", "x"), (1, "u", "a", None), (2, "v", "b", "y")],
        "page_id bigint, url string, title string, body string",
    )
    assert sorted(map(tuple, page_text.unique_by_url(rows).collect())) == [("u", "a", None), ("v", "b", "y")]


def test_items_fall_back_per_page_and_use_linked_text(spark, pages_of):
    pages = pages_of(
        "<strong>ISSQN - SP - Um</strong><table><tr><td class=txt_cinza><strong>Lei 1 01/02/2025</strong><br>d</td></tr></table>"
        "<ul><li><a href=/x>não usado</a></ul>",
        "<ul><li><a href='/dir/2'>curto</a><p>resumo</p></li><li><a href='/nada'>só título 03.04.2025</a></li></ul>",
        "<article><h1>Título completo</h1><p>corpo 1</p><p>corpo 2</p></article>",
        "<strong>título sem cabeçalho</strong><ul><li><p>só resumo</p></li></ul>",
    )
    staging = Staging(spark)
    nodes = staging.store(explode_nodes(pages, items.REQUEST), "nodes")
    out = items.extract_items(nodes, DAY, "r1", staging.store)
    assert out.columns == [*COLUMNS, "seq"]
    rows = [tuple(r)[:9] for r in out.orderBy("seq").collect()]
    assert rows == [
        ("Lei 1 01/02/2025", "d", "MUNICIPAL", "SP", "Um", "2025-05-11", "01/02/2025", "PORTAL - MUNICIPAL", "novo"),
        ("Título completo", "corpo 1\n\ncorpo 2", "FEDERAL", "FEDERAL", "", "2025-05-11", "", "PORTAL - FEDERAL", "novo"),
        ("só título 03.04.2025", "", "FEDERAL", "FEDERAL", "", "2025-05-11", "03.04.2025", "PORTAL - FEDERAL", "novo"),
        ("", "só resumo", "FEDERAL", "FEDERAL", "", "2025-05-11", "", "PORTAL - FEDERAL", "novo"),
    ]


def test_enrich_with_a_hot_link(spark):
    n = 300
    cards_df = spark.range(n).select(
        F.col("id").alias("page_id"),
        F.lit(0).alias("card_pre"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("u"), "id")).alias("link"),
    )
    linked = spark.createDataFrame([("hot", "T", "B"), ("u1", "t1", "b1")], "url string, title string, body string")
    out = items.enrich(cards_df, linked)
    assert out.count() == n
    titles = {r.full_title: r.n for r in out.groupBy("full_title").agg(F.count("*").alias("n")).collect()}
    assert titles == {"T": 100, "t1": 1, None: 199}


def test_a_link_to_a_place_leads_to_its_page(spark):
    rows = spark.createDataFrame([(1, 0, "u#a"), (2, 0, "u"), (3, 0, "v#u"), (4, 0, "#")], "page_id bigint, card_pre int, link string")
    linked = spark.createDataFrame([("u#top", "T", "B")], "url string, title string, body string")
    out = {r.page_id: (r.link, r.full_title) for r in items.enrich(rows, linked).collect()}
    assert out == {1: ("u#a", "T"), 2: ("u", "T"), 3: ("v#u", None), 4: ("#", None)}


def test_cards_take_one_shuffle(spark, pages_of):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = cards.extract_cards(explode_nodes(pages_of(*["<ul><li><a href=/x>a</a></ul>"] * 9).coalesce(8), cards.REQUEST))
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # Sorted by place, by the places asked for, and by card; dealt out once.
    assert plan.count("Exchange") == plan.count("Exchange hashpartitioning(page_id") == 1 and plan.count("Sort [") <= 3


def test_a_long_text_costs_nothing_for_parts_that_do_not_show_it(cards_of):
    """Places, not texts, go through the windows: a megabyte behind 8,000 cards is read once."""
    import time

    items = "".join(f"<li><a href=/{k}>n{k}</a></li>" for k in range(8000))

    def seconds(html):
        start = time.perf_counter()
        out = cards_of(html)
        assert len(out) == 8000 and out[7999][2] == "n7999" and out[7999][3] == ""
        return time.perf_counter() - start

    short, long = f"<ul>{items}</ul><p>x", f"<ul>{items}</ul><p>{'x' * 1_000_000}"
    seconds(short)
    assert min(seconds(long) for _ in range(2)) < 2 * min(seconds(short) for _ in range(2))


def test_cards_are_looked_for_only_in_pages_without_section_items(spark, pages_of, monkeypatch):
    section = '<table><tr><td><strong>ISSQN - SP - Um</strong></td></tr><tr><td class=txt_cinza><strong>Lei 1</strong><br>a</td></tr></table>'
    staging, asked = Staging(spark), []
    nodes = staging.store(explode_nodes(pages_of(section, "<ul><li><h3>t</h3><p>s</p></li></ul>"), items.REQUEST), "n")
    monkeypatch.setattr(items, "extract_cards", lambda n: (asked.append({r.page_id for r in n.collect()}), cards.extract_cards(n))[1])
    out = items.extract_items(nodes, DAY, "r1", staging.store)
    assert asked == [{1}]
    assert sorted(r["Ato"] for r in out.collect()) == ["Lei 1", "t"]


def test_cards_are_looked_for_only_in_listings(spark, pages_of, monkeypatch):
    article = "<article><h1>t</h1><p>a</p><a href=/x>b</a></article><table><thead><tr><td><p>c</td></tr></thead></table>"
    rows = "<table><tr><td><h3>r</h3></td></tr></table>"
    listing = "<article class=principaisnormas><article><p>n</p></article></article>"
    staging, asked = Staging(spark), []
    nodes = staging.store(explode_nodes(pages_of(article, rows, listing, "<ul><li>x</ul><ol><li><p>y</ol>"), items.REQUEST), "n")
    monkeypatch.setattr(items, "extract_cards", lambda n: (asked.append({r.page_id for r in n.collect()}), cards.extract_cards(n))[1])
    out = items.extract_items(nodes, DAY, "r1", staging.store)
    assert asked == [{1, 2, 3}]
    assert sorted((r["seq"].page_id, r["Ato"], r["Descrição"]) for r in out.collect()) == [(1, "r", ""), (2, "", "n")]


def test_captured_deals_out_texts_once(spark, pages_of):
    """The first page of each address, as by ``unique_by_url``; pages without content are not the first of anything."""
    htmls = ["<b>none</b>", "<h1>a</h1><p>1", "<h1>b</h1><p>2", "<article><p>3", "<h1>c</h1>", "<h2>d</h2><p>4<p>5"]
    urls = F.array(*[F.lit(u) for u in ("u", "u#x", "u", "v#y", "", None)])
    pages = pages_of(*htmls).withColumn("url", urls[F.col("page_id").cast("int")])
    nodes = Staging(spark).store(explode_nodes(pages, page_text.REQUEST), "nodes")
    found = {r.url: (r.title, r.body) for r in page_text.captured(nodes).collect()}
    assert found == {"u": ("a", "1"), "v": ("", "3"), "": ("c", None), None: ("d", "4\n\n5")}
    assert found == {r.url: (r.title, r.body) for r in page_text.unique_by_url(page_text.page_text(nodes)).collect()}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = page_text.captured(nodes)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning(page_id") == 1 and plan.count("Exchange ") == 2


def test_page_text_takes_linear_time(spark):
    """The rule of a page is found once, not once for each of its paragraphs."""
    import time

    def seconds(n):
        page = spark.range(-1, n).select(
            F.lit(1).alias("page_id"), F.lit("u").alias("url"), F.col("id").cast("int").alias("pre"),
            F.when(F.col("id") < 0, "#page").otherwise("p").alias("tag"), F.lit("").alias("class"),
            F.when(F.col("id") >= 0, F.col("id").cast("string")).alias("text"),
            F.expr("cast(array() as array<struct<pre:int,tag:string,class:string>>)").alias("anc"),
        )
        start = time.perf_counter()
        assert page_text.page_text(page).first().body == "\n\n".join(str(k) for k in range(n))
        return time.perf_counter() - start

    seconds(100)
    assert min(seconds(16000) for _ in range(2)) < 6 * max(0.3, min(seconds(4000) for _ in range(2)))
