"""Pages to a table of element rows."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from pagestrata.sources.page_tree import NodeRequest, decode, page_elements

NODES = (
    "page_id bigint, url string, pre int, post int, depth int, parent_pre int, tag string, "
    "class string, path string, attrs map<string,string>, href string, "
    "anc array<struct<pre:int,tag:string,class:string>>, "
    "text string, value string, inner_html string, error string"
)

_ARROW = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("pre", pa.int32()),
        ("post", pa.int32()),
        ("depth", pa.int32()),
        ("parent_pre", pa.int32()),
        ("tag", pa.string()),
        ("class", pa.string()),
        ("path", pa.string()),
        ("attrs", pa.map_(pa.string(), pa.string())),
        ("href", pa.string()),
        (
            "anc",
            pa.list_(pa.struct([("pre", pa.int32()), ("tag", pa.string()), ("class", pa.string())])),
        ),
        ("text", pa.string()),
        ("value", pa.string()),
        ("inner_html", pa.string()),
        ("error", pa.string()),
    ]
)

#: Node rows are handed to Spark in batches of about this many characters.
_FLUSH_CHARS = 4_000_000


def _failed(page_id: int, url: str, e: Exception) -> tuple:
    return (page_id, url, *[None] * 13, f"{type(e).__name__}: {e}")


def _to_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(values, type=f.type) for f, values in zip(_ARROW, columns, strict=True)],
        schema=_ARROW,
    )


def _to_batches(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    """The rows; one that Arrow cannot take becomes an error row and stops no other."""
    if rows:
        try:
            yield _to_batch(rows)
        except Exception as e:
            if len(rows) == 1:
                yield _to_batch([_failed(*rows[0][:2], e)])
            else:
                yield from _to_batches(rows[: len(rows) // 2])
                yield from _to_batches(rows[len(rows) // 2 :])


def _size(row: tuple) -> int:
    size = 100 + 40 * len(row[11])
    for k in (1, 7, 8, 10, 12, 13, 14):
        if row[k]:
            size += len(row[k])
    return size


def _text(html: bytes | str | None, charset: str | None) -> str:
    return html if isinstance(html, str) else decode(html or b"", charset)


def explode_nodes(pages: DataFrame, request: NodeRequest) -> DataFrame:
    """``pages(page_id, url, html[, charset])`` to one row per requested element.

    ``html`` is text, or the bytes as they were served: these are read by byte
    order mark, ``charset``, the charset that the markup declares, UTF-8 or
    windows-1252. Page ids must be unique among the pages; see ``check_page_ids``.

    A page that cannot be read gives a row with ``error`` set and no tag; it
    never stops the job. A page is read whole; its rows leave in batches of
    bounded size.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        chars = 0
        for batch in batches:
            ids, urls, htmls, charsets = (batch.column(i) for i in range(4))
            for i in range(batch.num_rows):
                page_id, url, of_page = ids[i].as_py(), None, len(rows)
                try:
                    url = urls[i].as_py()
                    for row in page_elements(_text(htmls[i].as_py(), charsets[i].as_py()), url or "", request):
                        rows.append((page_id, url, *row, None))
                        chars += _size(rows[-1])
                        if chars >= _FLUSH_CHARS:
                            yield from _to_batches(rows)
                            rows, chars, of_page = [], 0, 0
                except Exception as e:  # one bad page must not end the job
                    rows[of_page:] = [_failed(page_id, url, e)]
        yield from _to_batches(rows)

    names = dict(pages.dtypes)
    # Text is UTF-8 in Spark, whatever its markup declares; bytes that are not are read like a served page.
    charset = F.col("charset") if "charset" in names else F.lit("utf-8" if names["html"] == "string" else None)
    slim = pages.select("page_id", "url", F.col("html").cast("binary").alias("html"), charset.cast("string").alias("charset"))
    return slim.mapInArrow(read, NODES)


def page_outcomes(pages: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(outcome, pages)``: how many pages could be ``read``, and how many not (``error``)."""
    bad = nodes.where(F.col("error").isNotNull()).agg(F.count_distinct("page_id").alias("bad"))
    counts = pages.agg(F.count(F.lit(1)).alias("n")).join(bad)  # one row each
    return counts.select(
        F.explode(F.create_map(F.lit("read"), F.col("n") - F.col("bad"), F.lit("error"), F.col("bad"))).alias("outcome", "pages")
    )


def check_page_ids(pages: DataFrame) -> None:
    """Fail when two pages share an id or a page has none: their elements could not be told apart."""
    found = pages.groupBy("page_id").agg(F.count(F.lit(1)).alias("n"))
    bad = found.where((F.col("n") > 1) | F.col("page_id").isNull()).first()
    if bad is not None:
        raise ValueError(f"page id {bad['page_id']} is given to {bad['n']} pages; number them anew, for example by ``numbered``")


def numbered(pages: DataFrame) -> DataFrame:
    """Pages with ids that are unique among them. Store the result: a new scan may number differently."""
    return pages.withColumn("page_id", F.monotonically_increasing_id())


def register_html_nodes(spark: SparkSession, request: NodeRequest, name: str = "html_nodes") -> None:
    """Make the node reader a table function for SQL, with rows handed over in Arrow batches.

    ``SELECT n.* FROM pages p, LATERAL html_nodes(p.page_id, p.url, p.html) n``
    """

    class HtmlNodes:
        def eval(self, page_id: int, url: str, html: str):
            try:
                for row in page_elements(_text(html, None), url or "", request):
                    anc = [dict(zip(("pre", "tag", "class"), a, strict=True)) for a in row[9]]
                    yield (page_id, url, *row[:7], dict(row[7]), row[8], anc, *row[10:], None)
            except Exception as e:  # one bad page must not end the job
                yield _failed(page_id, url, e)

    spark.udtf.register(name, udtf(HtmlNodes, returnType=NODES, useArrow=True))
