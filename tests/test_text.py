import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from pagestrata.functions import dates, text


@pytest.fixture
def values(spark):
    """Apply an expression to every value of a column ``s`` in one job."""

    def run(build, inputs):
        df = spark.createDataFrame([(i, s) for i, s in enumerate(inputs)], "i int, s string")
        return [r.v for r in df.select("i", build(F.col("s")).alias("v")).orderBy("i").collect()]

    return run


def test_whitespace_set_is_that_of_unicode():
    bmp = [chr(c) for c in range(0x10000)]
    assert set(text.WHITESPACE) == {c for c in bmp if re.match(r"\s", c)}
    assert set(text.LINE_BREAKS) == {c for c in bmp if len(f"a{c}b".splitlines()) > 1}


def test_regex_classes_equal_the_listed_sets(values):
    chars = [chr(c) for c in range(1, 0x10000) if not 0xD800 <= c < 0xE000]
    for rx, expected in (
        (text._SPACE, set(text.WHITESPACE)),
        (text._BLANK, set(text.BLANKS)),
        (f"[{text._BREAK}]", set(text.LINE_BREAKS)),
    ):
        hits = values(lambda s, rx=rx: s.rlike(rx), chars)
        assert {c for c, hit in zip(chars, hits, strict=True) if hit} == expected


def test_norm_text(values):
    inputs = [None, "  a  b\n c ", "\xa0a\xa0\xa0b\n c", "", "A b", "\x1fa\x1cb\x85"]
    assert values(text.norm_text, inputs) == ["", "a b c", "a b c", "", "A b", "a b"]


def test_norm_xpath_keeps_other_spaces(values):
    assert values(text.norm_xpath, [" Nov \t\r\n 5 ", "\xa0x ", None]) == ["Nov 5", "\xa0x", ""]


def test_clean_html_text(values):
    known = {
        "<strong>A</strong><br><br>B &amp; C<i>d</i><BR/> e": "A\nB &amp; Cd\ne",
        "<p>a</p><p>b</p>": "ab",
        "a<br class=x>b": "ab",
        "a <br\t/>\n <br>b": "a\nb",
        "<<b>p>x": "x",
        "a<ul><li>b": "ab",
        "1 < 2 > 3": "1 3",
        "a\r\n\xa0\x1c b\u2028c": "a\nb\nc",
        "\t a \xa0 b \x1f": "a b",
        "a &nbsp; b": "a &nbsp; b",
        "open <tag": "open <tag",
        " <br> ": "",
        "": "",
    }
    assert values(text.clean_html_text, [None, *known]) == ["", *known.values()]


def test_cleaned_text_is_normal(values):
    rng = random.Random(3)
    parts = ["<br>", "<BR />", "<p>", "</p>", "<strong>", "</b>", " ", "\n", "\t", "\xa0", "a", "b c", "&amp;", "\x1c", "\r\n"]
    fuzz = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(400)]
    cleaned = values(text.clean_html_text, fuzz)
    for before, after in zip(fuzz, cleaned, strict=True):
        assert "<" not in after
        assert all(line and line == " ".join(line.split()) for line in after.split("\n") if after)
        letters = re.sub("<[^>]*>", "", before)
        assert "".join(after.split()) == "".join(letters.split())
    assert values(text.clean_html_text, cleaned) == cleaned


def test_long_run_of_breaks(values):
    assert values(text.clean_html_text, ["a" + "<br> " * 50_000 + "b"]) == ["a\nb"]


def test_drop_title_line(values):
    desc = ["LEI  1\ntexto", "a\n\n  lei 1 \x85 Lei 1 x", "\nLei 1", None, "texto"]
    assert values(lambda s: text.drop_title_line(s, F.lit("Lei 1")), desc) == ["texto", "a\nLei 1 x", "", "", "texto"]


def test_drop_title_from_clean(values):
    titles = ["Lei 1", " LEI\n1 ", "ΟΔΟΣ", "x"]
    desc = ["lei 1\ntexto", "a\nLEI 1\nLei 1 x\nlei 1", "Lei 1", None, "", "texto", "xlei 1", "οδος\nΟΔΟΣ", "x\nx"]
    for title in titles:
        both = [values(lambda s, f=f, t=title: f(s, F.lit(t)), desc) for f in (text.drop_title_line, text.drop_title_from_clean)]
        assert both[0] == both[1]


def test_parse_header(values):
    inputs = [
        "ISSQN - sp - São Paulo",
        "ISSQN-RJ-Rio - Centro",
        " issqn - Mg -\n Belo Horizonte \xa0",
        "ISSQN - São Paulo",
        "ISSQN - SP",
        "",
        None,
        "Lei ISSQN - SP - X",
        "ISSQN - SP - a\nb",
    ]
    assert values(text.parse_header, inputs) == [
        ("SP", "São Paulo"),
        ("RJ", "Rio - Centro"),
        ("MG", "Belo Horizonte"),
        *[None] * 6,
    ]
    assert values(lambda s: text.parse_header(s, "A.B"), ["A.B - SP - x", "AxB - SP - x"]) == [("SP", "x"), None]


def test_pub_date_from_tail(values):
    known = {
        "Decreto nº 1, de 01/02/2025": "01/02/2025",
        "Portaria 4 de 05/06/2025 (republicada)": "05/06/2025",
        "Lei 01/02/2025 ": "01/02/2025",
        "Lei X 99/99.2025": "99/99.2025",
        "Lei de 01/01/2025 " + "x" * 40: "",
        "01/01/2024 ret. 02/02/2024 (DOM)": "01/01/2024",
        "😀 01.02.2025": "01.02.2025",
        "": "",
    }
    assert values(text.pub_date_from_tail, [*known, None]) == [*known.values(), ""]


def test_portal_dates(values):
    assert values(lambda s: dates.portal_date(s, 1), ["2025-12-31", "2025-11-04"]) == ["Jan 1, 2026", "Nov 5, 2025"]
    known = {
        "Nov 5, 2025": "2025-11-05",
        "Nov 05, 2025": "2025-11-05",
        "nov 5, 2025": "2025-11-05",
        " Nov  5, 2025\n": "2025-11-05",
        "Nov 5,2025": "",
        "Feb 31, 2025": "",
        "November 5, 2025": "",
        "": "",
    }
    assert values(dates.portal_date_to_iso, [*known, None]) == [*known.values(), ""]
    assert values(dates.extraction_date, ["2025-11-05"]) == ["2025-05-11"]


def test_run_date():
    assert dates.resolve_run_date(" 2025-12-31 ", 1) == dt.date(2026, 1, 1)
    late = dt.datetime(2025, 11, 5, 1, 0, tzinfo=dt.UTC)
    assert dates.resolve_run_date(now=late) == dt.date(2025, 11, 4)
    assert dates.resolve_run_date(zone="No/Where") in (dt.date.today(), dt.date.today() - dt.timedelta(days=1))
    for bad in ("  ", "05/11/2025"):
        with pytest.raises(ValueError):
            dates.resolve_run_date(bad)


def test_first_truthy_and_contains_any(spark):
    row = spark.sql("SELECT '' a, cast(null AS string) b, 'c' c").select(
        text.first_truthy("a", "b", "c").alias("x"),
        text.first_truthy("a", "b").alias("y"),
        text.contains_any("b", ("c",)).alias("z"),
        text.contains_any("c", ("x", "c")).alias("w"),
    )
    assert tuple(row.first()) == ("c", "", False, True)


@pytest.mark.parametrize("odd", ["_ODD_SPACES", "_ODD_BLANKS", "_ODD_BREAKS", "_ODD_XML_SPACES"])
def test_text_in_order_is_passed_over(spark, odd):
    found = F.regexp_count(F.col("t"), F.lit(getattr(text, odd)))
    rows = spark.createDataFrame([("a few words, each after one space",), (" a b ",)], "t string").select(found.alias("n")).collect()
    assert [r.n for r in rows] == [0, 0]


def test_odd_runs_become_one_space_or_line_end(values):
    runs = [" ", "  ", "\t", " \t", "\t ", "\xa0", " \xa0 ", "\x1f", "\u2003 "]
    assert values(text.norm_text, [f"a{r}b" for r in runs]) == ["a b"] * len(runs)
    assert values(text.clean_html_text, [f"a{r}b" for r in runs]) == ["a b"] * len(runs)
    ends = ["\n", " \n", "\n ", "\r\n", " \r \x0b ", "\x1c", "\u2028\t", "\n\n"]
    assert values(text.clean_html_text, [f"a{r}b" for r in ends]) == ["a\nb"] * len(ends)


def test_lines_end_at_every_break_and_once_at_cr_lf(values):
    rng = random.Random(7)
    inputs = ["", "\r", "\r\n", "\n\r", "\r\r\n\n", *["".join(rng.choices("ab \r\n" + text.LINE_BREAKS, k=9)) for _ in range(300)]]
    assert values(text.split_lines, inputs) == [re.split(rf"\r\n|[{text.LINE_BREAKS}]", s) for s in inputs]
