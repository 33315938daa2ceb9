"""Line de-duplication with levelled sorted runs of line hashes.

Every batch of documents leaves one run: a table of line keys, bucketed and
sorted by key, with the number of documents holding the line and the largest of
their ids. A new batch is anti-joined with the runs: what they have settled
needs no new entry. When a level has ``fanout`` runs, they are merged into one
run of the next level, so a batch meets few runs and each key is rewritten a
logarithmic number of times. Runs are bucketed alike, so the join with a batch
shuffles the batch only.

A key is 128 bits of XXH3 of the line, stripped of ASCII whitespace and with
A-Z lower-cased.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagestrata.llm.words import map_texts, utf8
from pagestrata.sources.tables import Staging

KEY = ["k1", "k2"]


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """16 bytes for a line that counts; None for one with too few code points."""
    key = line.strip().lower()  # on bytes both are ASCII only
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode()) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key)


def line_keys(docs: DataFrame, id_col: str, text: str, min_chars: int) -> DataFrame:
    """``(id, h, k1, k2)``: each key of each document once; ``h`` is a hash of the text."""

    def make():
        def of(texts):
            found = [{line_key(x, min_chars) for x in t.split(b"\n")} - {None} for t in texts]
            return [pa.array([b"".join(f) for f in found], pa.binary()), pa.array([len(f) for f in found], pa.int32())]

        return of

    slim = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"), text_hash(F.col(text)).alias("h"))
    packed = map_texts(slim, "text", make, "keys binary, n int").where("out.n > 0")
    at = F.explode(F.sequence(F.lit(0), F.col("out.n") - 1)).alias("at")
    packed = packed.select(F.col("row.id").alias("id"), F.col("row.h").alias("h"), F.col("out.keys").alias("keys"), at)
    half = lambda k: F.conv(F.hex(F.substring("keys", F.col("at") * 16 + 1 + 8 * k, F.lit(8))), 16, -10).cast("long")
    return packed.select("id", "h", half(0).alias("k1"), half(1).alias("k2"))


class LineRuns:
    """The runs of one corpus. Use as a context manager, or call ``drop`` at the end.

    ``buckets`` is the number of files of a run, by default as many as a shuffle has partitions.
    """

    def __init__(self, staging: Staging, min_docs: int = 3, buckets: int | None = None, fanout: int = 4):
        self.spark, self.staging, self.min_docs, self.fanout = staging.spark, staging, min_docs, fanout
        self.buckets = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.name, self.made = f"line_runs_{uuid.uuid4().hex}", 0
        self.levels: list[list[str]] = [[]]

    def __enter__(self) -> "LineRuns":
        return self

    def __exit__(self, *_) -> None:
        self.drop()

    def drop(self) -> None:
        self._remove(sum(self.levels, []))
        self.levels = [[]]

    def _remove(self, tables: list[str]) -> None:
        for table in tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            self.staging.drop(table)

    def _write(self, run: DataFrame, level: int) -> None:
        table = f"{self.name}_{self.made}"
        self.made += 1
        dealt = run.repartition(self.buckets, *KEY)  # one file for each bucket
        path = f"{self.staging.folder}/{table}"
        dealt.write.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", path).saveAsTable(table)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(table)

    def _merged(self, tables: list[str]) -> DataFrame:
        # Read as plain files: Spark 4.1 takes a union of bucketed scans for one
        # that keeps equal keys together, which it does not, and sums too little.
        files = self.spark.read.schema(self.spark.table(tables[0]).schema)
        rows = files.parquet(*[f"{self.staging.folder}/{t}" for t in tables])
        return rows.groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper"))

    def add(self, keys: DataFrame) -> None:
        """Take in a batch of ``(id, k1, k2)``, in any order of batches."""
        fresh = keys.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("keeper"))
        for table in sum(self.levels, []):
            run = self.spark.table(table).where(F.col("n_docs") >= self.min_docs)
            run = run.select(*KEY, F.col("keeper").alias("settled")).where(F.col("settled").isNotNull())
            # Enough documents hold the line, one of them with a larger id than any here.
            no_larger = F.coalesce(run["settled"] >= fresh["keeper"], F.lit(True))
            fresh = fresh.join(run, [fresh[k] == run[k] for k in KEY] + [no_larger], "left_anti")
        self._write(fresh, 0)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            old = self.levels[level]
            self._write(self._merged(old), level + 1)
            self.levels[level] = []
            self._remove(old)
            level += 1

    def repeated(self) -> DataFrame:
        """``(k1, k2, keeper)`` of the lines that enough documents hold."""
        return self._merged(sum(self.levels, [])).where(F.col("n_docs") >= self.min_docs).select(*KEY, "keeper")


def _without(min_chars: int):
    """Texts without the lines whose keys are listed."""

    def run(batches):
        for batch in batches:
            kept, lines, dropped = [], [], []
            for text, keys in zip(utf8(batch.column(1)), batch.column(2).to_pylist()):
                every = text.split(b"\n")
                gone = {keys[k : k + 16] for k in range(0, len(keys or b""), 16)}
                left = [x for x in every if line_key(x, min_chars) not in gone] if gone else every
                kept.append(b"\n".join(left).decode())
                lines.append(len(every))
                dropped.append(len(every) - len(left))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(kept, pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())],
                names=["row", "text", "n_lines", "n_dropped"],
            )

    return run


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def batches_of(docs: DataFrame, id_col: str, text: str, batches: int) -> list[Column]:
    """Conditions that cut documents into batches, larger integer ids first."""
    of, part = F.col(id_col), F.pmod(text_hash(F.col(text)), F.lit(batches))
    if not isinstance(docs.schema[id_col].dataType, T.IntegralType):
        return [part == k for k in range(batches)]
    lo, hi = docs.agg(F.min(id_col), F.max(id_col)).first()
    if lo is None:
        return [part == k for k in range(batches)]
    step = max(1, -(-(hi - lo + 1) // batches))
    cuts = [max(lo, hi - (k + 1) * step + 1) for k in range(batches)]  # of >= cuts[k] and below the one before
    inside = [of >= cuts[0]] + [(of >= a) & (of < b) for a, b in zip(cuts[1:], cuts)]
    return [F.coalesce(x, part == k) for k, x in enumerate(inside)]


def deduplicate_lines(
    docs: DataFrame,
    staging: Staging,
    id_col: str = "doc_id",
    text: str = "text",
    min_docs: int = 3,
    min_chars: int = 20,
    batches: int = 4,
    buckets: int | None = None,
) -> DataFrame:
    """``(row, text, n_lines, n_dropped)``: documents without the lines found in many of them.

    A line of at least ``min_chars`` code points that ``min_docs`` documents hold
    stays only in the one with the largest id; a document may hold it more than
    once. ``row`` has the document's columns, ``text`` what is left. A null or
    empty text is one empty line. Rows that share an id count as documents of
    their own and keep the same lines. A document without id holds lines but never
    keeps one that a document with id holds too; if none has an id, all keep it.
    Ids can be of any type that has an order. Integer ids come in ranges, the
    largest first, so that a line which enough documents of a batch hold is
    settled for all later ones; others, and rows without id, by a hash of the text.
    The batches' number and order do not change the result.
    """
    keys = None
    with LineRuns(staging, min_docs, buckets) as runs:
        for k, inside in enumerate(batches_of(docs, id_col, text, batches)):
            batch = staging.store(line_keys(docs.where(inside), id_col, text, min_chars), f"lines_{k}")
            runs.add(batch)
            keys = batch if keys is None else keys.unionByName(batch)
        repeated = staging.store(runs.repeated(), "repeated")
    gone = keys.join(repeated, KEY).where(F.col("keeper").isNotNull() & ~F.col("id").eqNullSafe(F.col("keeper")))
    pack = F.unhex(F.concat(*[F.lpad(F.hex(k), 16, "0") for k in KEY]))
    # Rows with the same id and text lose the same lines, so a list is never longer than one text.
    lists = gone.groupBy("id", "h").agg(F.collect_set(pack).alias("keys")).select(F.col("id").alias("of"), "h", F.array_join(F.transform("keys", F.hex), "").alias("keys"))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    same = F.col("row")[id_col].eqNullSafe(F.col("of")) & (text_hash(F.col("row")[text]) == F.col("h"))
    joined = packed.join(lists, same, "left")
    joined = joined.select("row", F.coalesce(F.col("row")[text].cast("string"), F.lit("")).alias("text"), F.unhex("keys").alias("keys"))
    schema = f"row {packed.schema['row'].dataType.simpleString()}, text string, n_lines long, n_dropped long"
    return joined.mapInArrow(_without(min_chars), schema)
