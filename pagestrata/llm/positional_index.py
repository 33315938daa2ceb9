"""Benchmark decontamination with a distributed positional inverted index.

The training tokens are stored once as postings. The index is partitioned by
documents: a row is a block of whole documents with, for each term, the ordered
positions of its occurrences. Blocks hold a bounded number of tokens, so there
are no hot terms, and writing the index needs no shuffle.

A search takes the windows of the test items in slices of bounded size. First
it adds up how often each test term occurs. Then, block by block, a window's
lists are intersected from its rarest term on, each shifted by the term's offset
in the window; what is left are exact occurrences. Proximity matches are the
places of the rarest term around which all words of the window lie close by.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagestrata.llm.words import WordHashes, alnum_words, parts, text_or_empty, utf8
from pagestrata.sources.tables import Staging

#: Tokens of a block. A longer document has a block of its own.
BLOCK_TOKENS = 1 << 17
#: Bytes of the index that a reader holds at a time.
ROW_GROUP = 8 << 20
#: Windows searched in one pass over the index.
SLICE_WINDOWS = 200_000
#: Words before and after the rarest term in which a proximity match has all words of its window.
SLOP = 15

INDEX = "block string, ids array<long>, starts binary, terms binary, offsets binary, positions binary"
MATCH = "struct<item_id:long,start:int,length:int>"
FOUND = f"id long, n_words long, exact array<{MATCH}>, near array<{MATCH}>"


def _block(ids: list, sizes: list[int], hashes: list[np.ndarray]) -> list:
    """Ids, first token of each document and of the end, terms in order, ends of their lists, positions."""
    words = np.concatenate(hashes) if hashes else np.array([], np.uint64)
    order = np.argsort(words, kind="stable")
    ranked = words[order]
    first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]]) if len(words) else np.array([], np.int64)
    small = np.uint16 if len(words) <= 1 << 16 else np.uint32
    starts = np.cumsum([0, *sizes]).astype(np.uint32)
    ends = np.r_[first[1:], len(words)] if len(words) else first
    return [ids, starts.tobytes(), ranked[first].tobytes(), ends.astype(np.uint32).tobytes(), order.astype(small).tobytes()]


def build_index(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Postings of all tokens of all documents, as rows of INDEX."""

    def run(batches):
        from pyspark import TaskContext

        cache, at, made = WordHashes(), TaskContext.get().partitionId(), 0
        ids, sizes, hashes, tokens = [], [], [], 0

        def row():
            values = [f"{at}-{made}", *_block(ids, sizes, hashes)]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(values, [pa.string(), pa.list_(pa.int64()), *[pa.binary()] * 4])],
                names=["block", "ids", "starts", "terms", "offsets", "positions"],
            )

        for batch in parts(batches, lambda b: b.column(1)):
            for doc, body in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                words = cache.of(alnum_words(body))
                if ids and tokens + len(words) > BLOCK_TOKENS:
                    yield row()
                    made += 1
                    ids, sizes, hashes, tokens = [], [], [], 0
                ids.append(doc)
                sizes.append(len(words))
                hashes.append(words)
                tokens += len(words)
        if ids:
            yield row()

    slim = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text).alias("text"))
    return slim.mapInArrow(run, INDEX)


class Block:
    """One row of the index, read."""

    def __init__(self, row: dict):
        self.ids = row["ids"]
        self.starts = np.frombuffer(row["starts"], np.uint32).astype(np.int64)
        self.terms = np.frombuffer(row["terms"], np.uint64)
        self.ends = np.frombuffer(row["offsets"], np.uint32).astype(np.int64)
        self.sizes = np.diff(self.ends, prepend=0)
        n = int(self.starts[-1])
        self.positions = np.frombuffer(row["positions"], np.uint16 if n <= 1 << 16 else np.uint32)

    def where(self, terms: np.ndarray) -> np.ndarray:
        """Number of each term's list, -1 for a term that the block lacks."""
        if not len(self.terms):
            return np.full(len(terms), -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def list(self, k: int) -> np.ndarray:
        return self.positions[self.ends[k - 1] if k else 0 : self.ends[k]].astype(np.int64)

    def count(self, k: np.ndarray) -> np.ndarray:
        return np.where(k < 0, 0, np.r_[self.sizes, 0][k])  # the last one is for terms that the block lacks


class Windows:
    """Windows of test items: each is ``size`` consecutive words, or a shorter item whole."""

    def __init__(self, items: list[tuple[int | None, bytes]], size: int):
        cache, spans, owner = WordHashes(), [], []
        for item, text in items:
            words = cache.of(alnum_words(text))
            for k in range(max(1, len(words) - size + 1) if len(words) else 0):
                spans.append(words[k : k + size])
                owner.append(item)
        self.owner, self.length = owner, np.array([len(s) for s in spans], np.int64)
        flat = np.concatenate(spans) if spans else np.array([], np.uint64)
        self.terms, at = np.unique(flat, return_inverse=True)
        self.of = np.full((len(spans), size), -1)  # the window's words as numbers of terms, -1 after its end
        ends = np.cumsum(self.length)
        for k, (end, n) in enumerate(zip(ends, self.length)):
            self.of[k, :n] = at[end - n : end]

    def order_by(self, count: np.ndarray) -> None:
        """Offsets of each window from its rarest term on."""
        weight = np.where(self.of >= 0, count[self.of], np.iinfo(np.int64).max)
        self.order = np.argsort(weight, axis=1, kind="stable")


def _closest(sorted_to: np.ndarray, x: np.ndarray, most: int) -> np.ndarray:
    """Which of ``x`` have a value of ``sorted_to`` within ``most``."""
    after = np.searchsorted(sorted_to, x - most)
    return (after < len(sorted_to)) & (sorted_to[np.minimum(after, len(sorted_to) - 1)] <= x + most)


def search_block(block: Block, w: Windows, slop: int) -> tuple[list, list]:
    """``(window, start)`` of exact and of other close matches in a block, in order."""
    at = block.where(w.terms)
    has = np.r_[at >= 0, True]  # the last one stands for offsets after a window's end
    exact, near = [], []
    for k in np.flatnonzero(has[w.of].all(1)) if len(w.of) else ():
        offsets = w.order[k, : w.length[k]]
        rarest = block.list(at[w.of[k, offsets[0]]])
        start = rarest - offsets[0]
        close = rarest
        for o in offsets[1:]:
            places = block.list(at[w.of[k, o]])
            if len(start):
                i = np.minimum(np.searchsorted(places, start + o), len(places) - 1)
                start = start[places[i] == start + o]
            close = close[_closest(places, close, slop)]
            if not len(close):
                break
        for first, out, more in ((start, exact, w.length[k] - 1), (close, near, 0)):
            first = first[first >= 0]
            if len(first):
                doc = np.searchsorted(block.starts, first, side="right") - 1
                inside = first + more < block.starts[doc + 1]
                out += [(int(k), int(x), int(d)) for x, d in zip(first[inside], doc[inside])]
    return exact, near


def _near_in_document(block: Block, w: Windows, near: list, exact: list, slop: int) -> list:
    """Close matches that lie in one document and are not the rarest term of an exact match."""
    taken = {(k, x + int(w.order[k, 0])) for k, x, _ in exact}
    out = []
    for k, x, d in near:
        if (k, x) in taken:
            continue
        lo, hi = max(int(block.starts[d]), x - slop), min(int(block.starts[d + 1]), x + slop + 1)
        lists = [block.list(block.where(w.terms[[t]])[0]) for t in set(w.of[k, : w.length[k]].tolist())]
        if all(np.searchsorted(p, lo) < np.searchsorted(p, hi) for p in lists):
            out.append((k, x, d))
    return out


def _searcher(w: Windows, slop: int):
    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                block = Block({c: batch.column(c)[at].as_py() for c in ("ids", "starts", "terms", "offsets", "positions")})
                exact, near = search_block(block, w, slop)
                near = _near_in_document(block, w, near, exact, slop)
                n = len(block.ids)
                found = [[[] for _ in range(n)] for _ in "en"]
                for rows, matches in zip(found, (exact, near)):
                    for k, x, d in matches:
                        rows[d].append((w.owner[k], x - int(block.starts[d]), int(w.length[k])))
                kind = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int32()), ("length", pa.int32())]))
                names = ("item_id", "start", "length")
                as_rows = [pa.array([[dict(zip(names, m)) for m in r] for r in rows], kind) for rows in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(block.ids, pa.int64()),
                        pa.array(np.diff(block.starts), pa.int64()),
                        *as_rows,
                        pa.array([f"{batch.column('block')[at].as_py()}-{d}" for d in range(n)]),
                    ],
                    names=["id", "n_words", "exact", "near", "at"],
                )

    return run


def _counter(terms: np.ndarray):
    def run(batches):
        total = np.zeros(len(terms), np.int64)
        for batch in batches:
            for at in range(batch.num_rows):
                block = Block({c: batch.column(c)[at].as_py() for c in ("ids", "starts", "terms", "offsets", "positions")})
                total += block.count(block.where(terms))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], names=["k", "n"])

    return run


def search(index: DataFrame, items: list[tuple[int | None, bytes]], size: int, slop: int) -> DataFrame:
    """Matches of the windows of some items, one row for each indexed document."""
    w = Windows(items, size)
    count = np.zeros(len(w.terms), np.int64)
    # One row for each test term of the slice.
    for r in index.mapInArrow(_counter(w.terms), "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect():
        count[r["k"]] = r["n"]
    w.order_by(count)
    return index.mapInArrow(_searcher(w, slop), f"{FOUND}, at string")


def hits(matches: str) -> F.Column:
    """Words inside any of a document's matches: the length of their union."""
    spans = F.array_sort(F.transform(matches, lambda m: F.struct(m["start"].alias("a"), (m["start"] + m["length"]).alias("b"))))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    step = lambda s, m: F.struct(
        F.greatest(s["end"], m["b"]).alias("end"),
        (s["n"] + F.greatest(F.lit(0), m["b"] - F.greatest(s["end"], m["a"]))).cast("long").alias("n"),
    )
    return F.aggregate(spans, zero, step, lambda s: s["n"])


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    staging: Staging,
    size: int = 10,
    slop: int = SLOP,
    id_col: str = "doc_id",
    text: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    nameless: bool = False,
) -> DataFrame:
    """``(id, n_words, n_hit, exact, near)`` of every document.

    ``exact`` and ``near`` list matches as item, first word (for ``near``: the
    place of the rarest term) and window length. Words are lower-cased runs of
    digits, letters and non-ASCII characters. Null and empty texts have none and
    match nothing; so do items without words. An item shorter than ``size`` is
    one window. Repeated documents have a row each; repeated items match each.
    Items without id are left out unless ``nameless`` asks for them: then they match
    like others, with a null item. Documents without id are not left out. The test items
    are read by the driver in slices of at most SLICE_WINDOWS windows, however
    many there are, and the index is searched once for each slice.
    """
    index = staging.store(build_index(docs, id_col, text), "index", **{"parquet.block.size": ROW_GROUP})
    slim = benchmark.select(F.col(item_col).cast("long").alias("item"), text_or_empty(item_text).alias("text"))
    slim = slim if nameless else slim.where(F.col("item").isNotNull())
    slim = slim.withColumn("n", F.regexp_count("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")))
    slim = slim.where("n > 0")
    n_slices = max(1, -(-(slim.agg(F.sum("n")).first()[0] or 0) // SLICE_WINDOWS))
    slim = staging.store(slim.withColumn("slice", F.pmod(F.xxhash64("item", "text"), F.lit(n_slices))), "items")
    found = []
    for k in range(n_slices):
        items = [(r["item"], r["text"].encode()) for r in slim.where(F.col("slice") == k).toLocalIterator()]
        found.append(search(index, items, size, slop))
    if len(found) == 1:
        every = found[0].drop("at")
    else:
        flat = reduce(DataFrame.unionByName, found).groupBy("at").agg(
            F.min("id").alias("id"),
            F.max("n_words").alias("n_words"),
            *[F.flatten(F.collect_list(c)).alias(c) for c in ("exact", "near")],
        )
        every = flat.drop("at")
    return every.select("id", "n_words", hits("exact").alias("n_hit"), "exact", "near")
