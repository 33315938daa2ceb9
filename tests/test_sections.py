import random

import pytest
from pyspark.sql import functions as F

from pagestrata.operators.carry import carry, carry_in_page
from pagestrata.plans.sections import extract_sections, request
from pagestrata.sources.nodes import explode_nodes
from pagestrata.sources.tables import Staging

HEADER = "<tr><td><strong>ISSQN - sp - Cidade Um</strong></td></tr>"
FIRST_THREE = f"""<table><tbody>
 {HEADER}
 <tr><td class="txt_cinza"><strong>Decreto nº 1, de 01/02/2025</strong><br><br>Texto &amp; <i>um</i><br/>linha 2</td></tr>
 <tr><td><strong>Lei 2 - 03.04.2025</strong></td><td class="txt_cinza">mesma linha</td></tr>
 <tr><td><strong>Lei 3 sem data</strong></td></tr>
 <tr><td class="txt_cinza">proxima linha</td></tr>
</tbody></table>"""


@pytest.fixture
def sections(pages_of):
    def run(*htmls):
        rows = extract_sections(explode_nodes(pages_of(*htmls), request())).orderBy("page_id", "pre").collect()
        return [(r.page_id, r.ato, r.uf, r.municipio, r.step, r.descricao) for r in rows]

    return run


def test_steps_one_to_three(sections):
    assert sections(FIRST_THREE) == [
        (0, "Decreto nº 1, de 01/02/2025", "SP", "Cidade Um", 1, "Texto &amp; um\nlinha 2"),
        (0, "Lei 2 - 03.04.2025", "SP", "Cidade Um", 2, "mesma linha"),
        (0, "Lei 3 sem data", "SP", "Cidade Um", 3, "proxima linha"),
    ]


def test_following_cell_and_greeting(sections):
    out = sections(
        f"<table>{HEADER}</table><strong>Lei 4</strong><table><tr><td class='x txt_cinza y'>longe</td></tr></table>",
        f"<table>{HEADER}</table><strong>Lei 5</strong><table><tr><td class='txt_cinza'>Caro(a) leitor</td></tr>"
        "<tr><td class='txt_cinza'>outra</td></tr></table>",
        f"<table>{HEADER}</table><strong>Lei 6</strong>",
    )
    assert out == [
        (0, "Lei 4", "SP", "Cidade Um", 4, "longe"),
        (1, "Lei 5", "SP", "Cidade Um", None, ""),
        (2, "Lei 6", "SP", "Cidade Um", None, ""),
    ]


def test_greeting_does_not_block_a_cell_found_by_structure(sections):
    html = f"<table>{HEADER}<tr><td class='txt_cinza'><strong>Lei</strong><br>Caro(a) leitor</td></tr></table>"
    assert sections(html) == [(0, "Lei", "SP", "Cidade Um", 1, "Caro(a) leitor")]


def test_following_skips_own_descendants(sections):
    html = (
        f"<table>{HEADER}</table><strong>Lei <table><tr><td class='txt_cinza'>dentro</td></tr></table></strong>"
        "<table><tr><td class='txt_cinza'>depois</td></tr></table>"
    )
    assert [r[4:] for r in sections(html)] == [(4, "depois")]


def test_headers_change_state_and_items_before_any_are_skipped(sections):
    html = (
        "<strong>antes</strong><strong> </strong><strong>ISSQN - SP - Um</strong><strong>a</strong>"
        "<strong>ISSQN-rj-Dois - Centro</strong><strong>b</strong><strong>rodapé</strong>"
    )
    assert [r[1:4] for r in sections(html, "<strong>outra página</strong>")] == [
        ("a", "SP", "Um"),
        ("b", "RJ", "Dois - Centro"),
        ("rodapé", "RJ", "Dois - Centro"),
    ]


def test_two_titles_share_a_cell(sections):
    html = f"<table>{HEADER}<tr><td class='txt_cinza'><strong>A</strong><br>um<br><strong>B</strong><br>dois</td></tr></table>"
    assert [(r[1], r[5]) for r in sections(html)] == [("A", "um\nB\ndois"), ("B", "A\num\ndois")]


def test_title_with_ampersand_keeps_its_line(sections):
    html = f"<table>{HEADER}<tr><td class='txt_cinza'><strong>A &amp; B</strong><br>texto</td></tr></table>"
    assert sections(html)[0][1::4] == ("A & B", "A &amp; B\ntexto")


def test_nested_cells_and_rows(sections):
    html = (
        f"<table>{HEADER}<tr><td class='txt_cinza'>fora<table><tr><td class='txt_cinza'><strong>A</strong> x</td></tr>"
        "<tr><td><strong>B</strong></td></tr><tr><td>sem classe</td></tr></table></td></tr></table>"
    )
    out = sections(html)
    # B: enclosed by the outer cell, whose markup holds everything inside.
    assert [(r[1], r[4], r[5]) for r in out] == [("A", 1, "A x"), ("B", 1, "foraA xBsem classe")]


def test_next_row_means_the_next_sibling_row(sections):
    html = (
        f"<table>{HEADER}<tr><td><table><tr><td><strong>A</strong></td></tr></table></td></tr>"
        "<tr><td class='txt_cinza'>abaixo</td></tr></table>"
    )
    # The inner row has no next row; the outer next row is reached by position only.
    assert sections(html)[0][4:] == (4, "abaixo")


def test_empty_cell_still_wins(sections):
    html = f"<table>{HEADER}<tr><td><strong>A</strong></td><td class='txt_cinza'></td></tr><tr><td class='txt_cinza'>x</td></tr></table>"
    assert sections(html)[0][4:] == (2, "")


def test_one_shuffle_on_page_id(pages_of, spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = extract_sections(explode_nodes(pages_of(*[FIRST_THREE] * 9).coalesce(8), request()))
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert text.count("Exchange hashpartitioning(page_id") == 1 + text.count("REPARTITION_BY_NUM")
    assert "Join" not in text and "Cartesian" not in text


@pytest.mark.parametrize("backward", [False, True])
@pytest.mark.parametrize("include_current", [False, True])
def test_carry_equals_a_loop(spark, backward, include_current):
    rng = random.Random(7)
    rows = [
        (g, i, f"v{g}.{i}" if rng.random() < 0.1 else None)
        for g in [*range(5), None]
        for i in rng.sample(range(-50, 400), 60)
    ]
    df = spark.createDataFrame(rows, "g int, i int, v string").repartition(5)
    with Staging(spark) as staging:
        got = carry(df, ["g"], "i", F.col("v"), "c", staging.store, backward, include_current, parts=9).collect()
    expected = {}
    for g in [*range(5), None]:
        last = None
        for _, i, v in sorted((r for r in rows if r[0] == g), key=lambda r: r[1], reverse=backward):
            if include_current:
                last = v or last
            expected[g, i] = last
            last = v or last
    assert {(r.g, r.i): r.c for r in got} == expected


def test_carry_cuts_a_sparse_group_evenly(spark):
    """One group whose order values lie far apart: no window partition holds more than its share."""
    df = spark.range(20_000).select(F.lit(1).alias("g"), (F.col("id") * 1_000_000).alias("i"), F.when(F.col("id") == 3, "v").alias("v"))
    stored = {}
    with Staging(spark) as staging:

        def store(rows, name):
            stored[name] = staging.store(rows, name)
            return stored[name]

        out = carry(df, ["g"], "i", F.col("v"), "c", store, parts=10)
        assert out.where("c = 'v'").count() == 19_997
        sizes = [r["count"] for r in stored["ranges_of_c"].groupBy("_part").count().collect()]
    assert len(sizes) == 10 and max(sizes) < 2 * 20_000 / 10


def test_carry_in_page_keeps_state_per_page(spark):
    df = spark.createDataFrame(
        [(1, 0, None), (1, 1, "a"), (1, 2, None), (2, 0, None)], "page_id int, pre int, h string"
    )
    out = carry_in_page(df, "c", F.col("h")).orderBy("page_id", "pre").collect()
    assert [r.c for r in out] == [None, "a", "a", None]
