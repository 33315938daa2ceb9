"""Text rules as plain Spark expressions (``Column -> Column``).

Every function here stays on the JVM and inside code generation; none of them
needs a Python worker.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Unicode-aware whitespace covers.
#   LINE_BREAKS end a line; BLANKS are all other whitespace.
LINE_BREAKS = "\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
BLANKS = (
    "\t\x1f \xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u202f\u205f\u3000"
)
WHITESPACE = BLANKS + LINE_BREAKS

#: Fixed value: the word that opens a section header, ``WORD - UF - city``.
HEADER_WORD = "ISSQN"

# The same sets as Java classes. Spelled out character by character they cost a
# test per listed character; as predefined classes they are five times faster.
_SPACE = r"(?U)[\s\x1c-\x1f]"
_BLANK = r"(?U)[\s\x1f&&[^\v\x1c-\x1e]]"
_BREAK = r"\v\x1c-\x1e"
# What is not in order yet: a run of two or more, or a single one that is not what it becomes. Nearly all
# of a text is a letter or a lone space, which are passed over and not copied; letters fail the first test.
_ODD_SPACES, _ODD_BLANKS = (
    rf"(?U)[[^!-~]&&{c}](?:{c}+|(?<! ))" for c in (_SPACE.removeprefix("(?U)"), _BLANK.removeprefix("(?U)"))
)
_ODD_BREAKS = rf"[[^ -~]&&[{_BREAK}]](?:[ {_BREAK}]+|(?<!\n))"
# A line end: one character, or CR and LF. The class comes first, so that letters fail the first test here too.
_LINE_END = rf"[[^ -~]&&[{_BREAK}]](?:(?<=\r)\n)?"
_ODD_XML_SPACES = r"[ \t\r\n](?:[ \t\r\n]+|(?<! ))"

# What counts as a line break tag, a format tag, any tag, and a date.
_LINE_TAG = r"(?iU)<br[\s\x1c-\x1f]*/?>"
_FORMAT_TAG = "(?i)</?(?:strong|u|b|i|em|span|font)[^>]*>"
_ANY_TAG = "<[^>]+>"
_DATE = r"\d{2}[./]\d{2}[./]\d{4}"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_all(c: Column | str) -> Column:
    """Strip every kind of whitespace from both ends (``trim`` strips U+0020 only)."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def norm_text(c: Column | str) -> Column:
    """Trim, collapse inner whitespace to one space, null becomes ``''``; case is kept."""
    return F.coalesce(F.btrim(F.regexp_replace(_col(c), _ODD_SPACES, " ")), F.lit(""))


def norm_xpath(c: Column | str) -> Column:
    """XPath ``normalize-space``: only space, tab, CR and LF count as whitespace."""
    return F.coalesce(F.btrim(F.regexp_replace(_col(c), _ODD_XML_SPACES, " ")), F.lit(""))


def fold(c: Column | str) -> Column:
    """Form used for case-blind comparison."""
    return F.lower(norm_text(c))


def first_truthy(*cols: Column | str) -> Column:
    """First value that is neither null nor empty, else ``''``."""
    return F.coalesce(*[F.nullif(_col(c), F.lit("")) for c in cols], F.lit(""))


def contains_any(c: Column | str, words: tuple[str, ...] | list[str]) -> Column:
    """True when the text contains one of the given substrings (false for null text)."""
    found = F.lit(False)
    for word in words:
        found = found | F.coalesce(_col(c), F.lit("")).contains(word)
    return found


def split_lines(c: Column | str) -> Column:
    """Array of lines, split at every Unicode line boundary."""
    return F.split(_col(c), _LINE_END)


def clean_html_text(c: Column | str) -> Column:
    """Markup fragment to text lines.

    ``<br>`` ends a line, all other tags vanish without a separator, entities
    stay as written, blank lines are dropped. A run of ``<br>`` needs no rule
    of its own because the empty lines between them are dropped anyway.
    """
    c = _col(c)
    s = F.regexp_replace(c, _LINE_TAG, "\n")
    s = F.regexp_replace(s, _FORMAT_TAG, "")
    s = F.regexp_replace(s, _ANY_TAG, "")
    s = F.when(c.contains("<"), s).otherwise(c)
    s = F.regexp_replace(s, _ODD_BLANKS, " ")
    s = F.replace(F.regexp_replace(s, _ODD_BREAKS, "\n"), F.lit(" \n"), F.lit("\n"))
    return F.coalesce(F.btrim(s, F.lit(" \n")), F.lit(""))


def drop_title_line(desc: Column | str, title: Column | str) -> Column:
    """Drop the lines of ``desc`` that equal ``title`` when spacing and case are ignored."""

    def without(bound: Column) -> Column:
        def differs(line: Column) -> Column:
            # The first character settles most lines without a regular expression.
            maybe = bound["key"].startswith(F.lower(F.left(line, F.lit(1))))
            return (line != "") & ~(maybe & (fold(line) == bound["key"]))

        return F.array_join(F.filter(bound["lines"], differs), "\n")

    # Wrapping the row's values in a one-element array binds them to a name, so
    # that the key is worked out once per row and not once per line.
    bound = F.struct(fold(title).alias("key"), F.transform(split_lines(desc), trim_all).alias("lines"))
    return F.coalesce(F.get(F.transform(F.array(bound), without), F.lit(0)), F.lit(""))


def drop_title_from_clean(desc: Column | str, title: Column | str) -> Column:
    """``drop_title_line`` for the output of ``clean_html_text``, whose spacing is normal already.

    Most descriptions do not repeat their title and pass without being split.
    """
    desc, key = _col(desc), fold(title)
    edge = F.lit("\n")
    repeats = F.concat(edge, F.lower(desc), edge).contains(F.concat(edge, key, edge))
    kept = F.filter(F.split(desc, "\n"), lambda line: F.lower(line) != key)
    return F.coalesce(F.when(repeats, F.array_join(kept, "\n")).otherwise(desc), F.lit(""))


def parse_header(c: Column | str, word: str = HEADER_WORD) -> Column:
    """``WORD - UF - city`` to ``struct(uf, municipio)``; null when the text is no header."""
    # Fixed value: the pattern of a header.
    rx = (
        rf"(?idU)^{re.escape(word)}[\s\x1c-\x1f]*-[\s\x1c-\x1f]*([A-Z]{{2}})"
        r"[\s\x1c-\x1f]*-[\s\x1c-\x1f]*(.+?)[\s\x1c-\x1f]*$"
    )
    text = trim_all(c)
    uf = F.regexp_extract(text, rx, 1)
    city = trim_all(F.regexp_extract(text, rx, 2))
    return F.when(uf != "", F.struct(F.upper(uf).alias("uf"), city.alias("municipio")))


def pub_date_from_tail(title: Column | str) -> Column:
    """Publication date written at the end of a title, as text; ``''`` when there is none.

    The last 10 characters decide; otherwise the leftmost date within the last
    40. There is no calendar check and the original spelling is returned.
    """
    tail = trim_all(F.right(_col(title), F.lit(10)))
    window = F.right(_col(title), F.lit(40))
    return F.coalesce(
        F.when(tail.rlike(rf"(?U)^{_DATE}$"), tail).otherwise(
            F.regexp_extract(window, rf"(?U){_DATE}", 0)
        ),
        F.lit(""),
    )
