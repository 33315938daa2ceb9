"""Ranked lexical search with Block-Max MaxScore.

The index is cut into shards of whole documents, one row each: for every term
the documents that hold it, in blocks of ``POSTINGS`` postings. A block is
compressed on its own and has in front of it its last document, its largest
number of occurrences and its shortest document, so that a bound on any score in
it is known without unpacking it, whatever the corpus' averages turn out to be.

A search goes through the shards of a task and keeps one heap per query. With
the heap's worst score as threshold, a shard's lists are ordered by their
bounds; as many of the smallest as cannot reach the threshold together are
non-essential. Documents come from the essential lists only. The others are
gone through from the largest bound on: a candidate whose score so far, the
block maximum at its place and the bounds of what is left stay below the
threshold is rejected, and only blocks with a candidate left are unpacked. Heaps of tasks are merged.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from pagestrata.llm.words import WordHashes, alnum_words, parts, text_or_empty, utf8
from pagestrata.sources.tables import Staging

#: Terms of a shard, repeats counted. A longer document is a shard of its own.
SHARD_TERMS = 1 << 20
#: Postings of a block.
POSTINGS = 64
#: Bytes of the index that a reader holds at a time.
ROW_GROUP = 8 << 20
#: Query terms looked for in one pass over the index.
SLICE_TERMS = 200_000
#: Pattern of a term, for Spark's own functions.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Of a block: last document, most occurrences, shortest document, end of its bytes, bytes of a gap.
BLOCK_HEAD = np.dtype([("last", "<u4"), ("tf", "<u4"), ("size", "<u4"), ("end", "<u4"), ("width", "u1")])


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_part(size: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    return 100 - 90 + (90 * size.astype(np.int64) * n_docs) // n_terms


def gain(w: int, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    tf = tf.astype(np.int64)
    return w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def _bytes_needed(most: np.ndarray) -> np.ndarray:
    return np.where(most < 1 << 8, 1, np.where(most < 1 << 16, 2, 4))


def _pack(first: np.ndarray, stop: np.ndarray, docs: np.ndarray, tfs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Blocks of postings, all at once: gaps between documents, then occurrences, each in as few bytes as the block needs.

    Gives the bytes, where each block ends, and how wide gaps and occurrences are.
    """
    sizes = stop - first
    gaps = np.diff(docs, prepend=0)
    gaps[first] = 0  # a block's last document is in its head
    widths = np.stack([_bytes_needed(np.maximum.reduceat(v, first)) for v in (gaps, tfs)], axis=1)
    ends = np.cumsum(sizes * widths.sum(axis=1))
    out = np.zeros(int(ends[-1]), np.uint8)
    begins = ends - sizes * widths.sum(axis=1)
    within = np.arange(len(docs)) - np.repeat(first, sizes)
    for values, width, at in ((gaps, widths[:, 0], begins), (tfs, widths[:, 1], begins + sizes * widths[:, 0])):
        wide = np.repeat(width, sizes)
        place = np.repeat(at, sizes) + within * wide
        for k in range(4):
            some = wide > k
            out[place[some] + k] = values[some] >> (8 * k) & 0xFF
    return out, ends, widths


def _unpack(raw: bytes, last: int, n: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    docs = np.cumsum(np.frombuffer(raw, f"<u{width}", n), dtype=np.int64)
    tfs = np.frombuffer(raw, f"<u{len(raw) // n - width}", n, n * width).astype(np.int64)
    return docs + (last - docs[-1]), tfs


def _shard(ids: list, hashes: list[np.ndarray], kind: pa.DataType) -> pa.RecordBatch:
    sizes = np.array([len(h) for h in hashes], np.int64)
    of = np.repeat(np.arange(len(hashes)), sizes)
    words = np.concatenate(hashes) if hashes else np.array([], np.uint64)
    order = np.argsort(words, kind="stable")  # documents of a term stay in order
    words, of = words[order], of[order]
    new = np.r_[True, (words[1:] != words[:-1]) | (of[1:] != of[:-1])] if len(words) else np.array([], bool)
    at = np.flatnonzero(new)
    tf = np.diff(np.r_[at, len(words)])
    words, docs = words[at], of[at]
    lists = np.flatnonzero(np.r_[True, words[1:] != words[:-1]]) if len(words) else np.array([], np.int64)
    df = np.diff(np.r_[lists, len(words)])
    # First posting of every block: every POSTINGS of a list.
    per_list = -(-df // POSTINGS)
    within = np.arange(int(per_list.sum())) - np.repeat(np.cumsum(per_list) - per_list, per_list)
    first = np.repeat(lists, per_list) + within * POSTINGS
    stop = np.minimum(first + POSTINGS, np.repeat(lists + df, per_list))
    heads = np.zeros(len(first), BLOCK_HEAD)
    if len(first):
        heads["last"], heads["tf"] = docs[stop - 1], np.maximum.reduceat(tf, first)
        heads["size"] = np.minimum.reduceat(sizes[docs], first)
        packed, heads["end"], widths = _pack(first, stop, docs, tf)
        heads["width"] = widths[:, 0]
    blocks = packed.tobytes() if len(first) else b""
    values = [ids, sizes.astype(np.uint32).tobytes(), words[lists].tobytes(), df.astype(np.uint32).tobytes(), heads.tobytes(), blocks]
    kinds = [pa.list_(kind), *[pa.binary()] * 5]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], names=["ids", "sizes", "terms", "df", "heads", "blocks"])


def build_index(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each shard: ids and sizes of its documents, terms, their document counts, block heads, blocks."""
    slim = docs.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(text).alias("text"))
    kind = to_arrow_type(slim.schema["id"].dataType)

    def run(batches):
        cache, ids, hashes, n = WordHashes(), [], [], 0
        for batch in parts(batches, lambda b: b.column(1)):
            for doc, body in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                words = cache.of(alnum_words(body))
                if ids and n + len(words) > SHARD_TERMS:
                    yield _shard(ids, hashes, kind)
                    ids, hashes, n = [], [], 0
                ids.append(doc)
                hashes.append(words)
                n += len(words)
        if ids:
            yield _shard(ids, hashes, kind)

    fields = f"ids array<{slim.schema['id'].dataType.simpleString()}>, sizes binary, terms binary, df binary, heads binary, blocks binary"
    return slim.mapInArrow(run, fields)


class Shard:
    """One row of the index; counts what it unpacks."""

    def __init__(self, row: dict):
        self.ids = row["ids"]
        self.sizes = np.frombuffer(row["sizes"], "<u4")
        self.terms = np.frombuffer(row["terms"], np.uint64)
        self.df = np.frombuffer(row["df"], "<u4").astype(np.int64)
        self.heads = np.frombuffer(row["heads"], BLOCK_HEAD)
        self.blocks = row["blocks"]
        per_list = -(-self.df // POSTINGS)
        self.first = np.cumsum(per_list) - per_list
        self.stop = self.first + per_list
        self.unpacked = 0

    def where(self, terms: np.ndarray) -> np.ndarray:
        """Number of each term's list, -1 for a term that the shard lacks."""
        if not len(self.terms):
            return np.full(len(terms), -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def postings(self, k: int, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and occurrences of some blocks, given by number, of list ``k``."""
        docs, tfs = [], []
        for b in which.tolist():
            start = int(self.heads["end"][b - 1]) if b else 0
            n = POSTINGS if b < self.stop[k] - 1 else int(self.df[k]) - POSTINGS * int(self.stop[k] - 1 - self.first[k])
            d, t = _unpack(self.blocks[start : int(self.heads["end"][b])], int(self.heads["last"][b]), n, int(self.heads["width"][b]))
            docs.append(d)
            tfs.append(t)
            self.unpacked += 1
        return np.concatenate(docs), np.concatenate(tfs)


class Heap:
    """The best of one query so far: highest score first, equal scores by ascending id, null ids last."""

    def __init__(self, most: int):
        self.most, self.rows = most, []

    @property
    def threshold(self) -> int:
        return self.rows[-1][0] if len(self.rows) == self.most else 1

    def add(self, scores: np.ndarray, ids: list) -> None:
        rows = [*self.rows, *zip(scores.tolist(), ids)]
        self.rows = sorted(rows, key=lambda r: (-r[0], r[1] is None, r[1] if r[1] is not None else 0))[: self.most]


def search_shard(shard: Shard, m: np.ndarray, bounds: np.ndarray, lists: list[tuple[int, int]], heap: Heap) -> None:
    """Put a shard's documents into the heap of a query: ``lists`` are its terms' lists and weights there."""
    lists = [(k, w) for k, w in lists if w > 0]
    most = [w * int(bounds[shard.first[k] : shard.stop[k]].max()) for k, w in lists]
    order = sorted(range(len(lists)), key=lambda i: most[i])
    lists, most = [lists[i] for i in order], [most[i] for i in order]
    below = np.cumsum([0, *most])  # what the lists before can add together
    cut = int(np.searchsorted(below[1:], heap.threshold))  # so many cannot reach the threshold
    if cut == len(lists):
        return
    total = np.zeros(len(m), np.int64)
    for k, w in lists[cut:]:
        docs, tfs = shard.postings(k, np.arange(shard.first[k], shard.stop[k]))
        total[docs] += gain(w, tfs, m[docs])
    # A tie may still win by its id, so what can reach the threshold stays.
    docs = np.flatnonzero(total)
    scores = total[docs]
    for i in range(cut - 1, -1, -1):
        (k, w), least = lists[i], heap.threshold
        stays = scores + below[i + 1] >= least
        docs, scores = docs[stays], scores[stays]
        block = shard.first[k] + np.searchsorted(shard.heads["last"][shard.first[k] : shard.stop[k]], docs)
        ends = block == shard.stop[k]  # behind the list's last document
        best = np.where(ends, 0, w * bounds[np.minimum(block, shard.stop[k] - 1)])
        stays = scores + best + below[i] >= least
        docs, scores, block, ends = docs[stays], scores[stays], block[stays], ends[stays]
        if not len(docs):
            return
        open_blocks = np.unique(block[~ends])
        if len(open_blocks):
            found, tfs = shard.postings(k, open_blocks)
            at = np.minimum(np.searchsorted(found, docs), len(found) - 1)
            has = found[at] == docs
            scores[has] += gain(w, tfs[at[has]], m[docs[has]])
    stays = scores >= heap.threshold
    docs, scores = docs[stays], scores[stays]
    if len(docs) > heap.most:  # of those, what can still be among the best
        least = np.partition(scores, -heap.most)[-heap.most]
        docs, scores = docs[scores >= least], scores[scores >= least]
    if len(docs):
        heap.add(scores, [shard.ids[d] for d in docs.tolist()])


def _rows_of(batches):
    for batch in batches:
        for k in range(batch.num_rows):
            yield {c: batch.column(c)[k].as_py() for c in batch.schema.names}


def _counter(terms: np.ndarray):
    """Documents that hold each term; -1 for documents with any term, -2 for all their terms."""

    def run(batches):
        total, n_docs, n_terms = np.zeros(len(terms), np.int64), 0, 0
        for row in _rows_of(batches):
            sizes = np.frombuffer(row["sizes"], "<u4")
            n_docs, n_terms = n_docs + int((sizes > 0).sum()), n_terms + int(sizes.sum())
            held = np.frombuffer(row["terms"], np.uint64)
            if len(held):
                at = np.minimum(np.searchsorted(held, terms), len(held) - 1)
                total += np.where(held[at] == terms, np.frombuffer(row["df"], "<u4")[at], 0)
        some = np.flatnonzero(total)
        keys, values = [*some.tolist(), -1, -2], [*total[some].tolist(), n_docs, n_terms]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(values, pa.int64())], names=["k", "n"])

    return run


def _searcher(of: list[np.ndarray], numbers: list[int], terms, weights, n_docs: int, n_terms: int, most: int, kind: pa.DataType):
    def run(batches):
        heaps = [Heap(most) for _ in of]
        for row in _rows_of(batches):
            shard = Shard(row)
            m = length_part(shard.sizes, n_docs, n_terms)
            least = length_part(shard.heads["size"], n_docs, n_terms)
            bounds = gain(1, shard.heads["tf"], least)
            at = shard.where(terms)
            for mine, heap in zip(of, heaps):
                held = mine[at[mine] >= 0]
                if len(held):
                    search_shard(shard, m, bounds, list(zip(at[held].tolist(), weights[held].tolist())), heap)
        rows = [(q, s, d) for q, h in zip(numbers, heaps) for s, d in h.rows]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], kind)],
            names=["query", "score", "id"],
        )

    return run


def search(index: DataFrame, queries: list[tuple[int, bytes]], most: int) -> DataFrame:
    """``(query, score, id)``: the heaps of all tasks for some queries, given as number and UTF-8 text."""
    cache = WordHashes()
    hashed = [np.unique(cache.of(alnum_words(text))) for _, text in queries]
    terms = np.unique(np.concatenate(hashed)) if hashed else np.array([], np.uint64)
    of = [np.searchsorted(terms, h) for h in hashed]
    counted = index.mapInArrow(_counter(terms), "k long, n long").groupBy("k").agg(F.sum("n").alias("n"))
    count = {r["k"]: r["n"] for r in counted.collect()}  # one row for each query term of the slice
    n_docs, n_terms = count.get(-1, 0), max(1, count.get(-2, 0))
    weights = np.array([weight(n_docs, count[k]) if k in count else 0 for k in range(len(terms))], np.int64)
    kind = index.schema["ids"].dataType.elementType
    run = _searcher(of, [q for q, _ in queries], terms, weights, n_docs, n_terms, most, to_arrow_type(kind))
    return index.mapInArrow(run, f"query long, score long, id {kind.simpleString()}")


def rank(
    docs: DataFrame,
    queries: DataFrame,
    staging: Staging,
    most: int = 10,
    id_col: str = "doc_id",
    text: str = "text",
    query_col: str = "item_id",
    query_text: str = "text",
) -> DataFrame:
    """``(query_id, rank, id, score)``: the ``most`` best documents with a score above 0 of every query.

    Terms are lower-cased runs of digits, letters and non-ASCII characters. Null
    and empty texts have none: such documents are never found and count for no
    average, such queries find nothing. Every row of ``queries`` is a query of its
    own, also one without id or with the id of another. Equal scores go by
    ascending id, documents without id last; rows that share an id and a score
    take ranks next to each other. Ids keep their type. The driver reads queries
    in slices of about SLICE_TERMS terms, however many there are.
    """
    index = staging.store(build_index(docs, id_col, text), "index", **{"parquet.block.size": ROW_GROUP})
    slim = queries.select(F.col(f"`{query_col}`").alias("query_id"), text_or_empty(query_text).alias("text"))
    slim = slim.withColumn("n", F.regexp_count("text", F.lit(TERM))).where("n > 0")
    slim = staging.store(slim.withColumn("query", F.monotonically_increasing_id()), "queries")
    n_slices = max(1, -(-(slim.agg(F.sum("n")).first()[0] or 0) // SLICE_TERMS))
    found = []
    for k in range(n_slices):
        mine = slim.where(F.pmod(F.xxhash64("query"), F.lit(n_slices)) == k)
        found.append(search(index, [(r["query"], r["text"].encode()) for r in mine.toLocalIterator()], most))
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    merged = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= most)
    return merged.join(slim.select("query", "query_id"), "query").select("query_id", "rank", "id", "score")
