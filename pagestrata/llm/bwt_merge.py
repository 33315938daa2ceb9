"""Repeated byte strings, found by merging Burrows-Wheeler transforms of shards.

What a document repeats is judged by strings of ``LENGTH`` bytes. A suffix array
of everything would order far more than that, so only what can repeat goes in:

1. *Anchors.* Of the strings of ``ANCHOR`` bytes in a window of ``LENGTH``, the
   one with the smallest hash (leftmost of equal ones) is the window's anchor:
   equal windows have equal anchors at equal places. A run of windows with one
   anchor is a context. A context can hold a repeated window only if its anchor
   occurs elsewhere. Shards hand the sorted hashes of their anchors to buckets
   and get back a bit for each.
2. *Shard transforms.* A shard lines its contexts up at their anchors and sorts
   them backwards, symbol by symbol from the last column on: the symbols in front
   of the suffixes, in the order of the suffixes, are the shard's transform, one
   column for each distance from the anchor. Equal contexts are one, with the smallest id.
3. *Merge.* Contexts with one anchor meet in a cell. It knows the shards'
   transforms, not their texts: starting from all of shard 1, then all of shard
   2 and so on, the interleave of the shards is refined column by column. A pass
   takes each shard's symbols in turn as the interleave says and deals the
   interleave out by symbol, stably. No suffix is sorted again. Common prefixes
   follow along: two neighbours with one symbol share one byte more than the least that lay between them before.
4. *Intervals.* Where neighbours share ``LENGTH`` bytes and more, their windows
   are equal; the smallest id of such an interval goes back to the shards, which
   remove the windows that a smaller id has.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from pagestrata.llm.ranked import ranked
from pagestrata.sources.tables import Staging

LENGTH = 50
#: Bytes of an anchor.
ANCHOR = 18
#: Bytes before the anchor that a window can have; windows begin in columns 0 to LEFT.
LEFT = LENGTH - ANCHOR
COLUMNS = LEFT + LENGTH
#: Bytes of text of a shard, about; small inputs have smaller ones, so that there is work for all tasks.
SHARD_BYTES = 4 << 20
SMALL_SHARD = 1 << 20
#: Windows hashed at a time, contexts cut out at a time.
PIECE, ROWS = 1 << 20, 1 << 15
#: Shards for each bucket of anchors and for each cell of contexts.
SHARDS_A_BUCKET, SHARDS_A_CELL = 4, 2
#: Buckets and cells are numbered in 16 bits, files of the stored shards are bounded too.
MOST_BUCKETS = 1 << 16
MOST_FILES = 20_000
#: Bytes of an anchor's hash that go to its bucket. Two anchors that share them cost a look at their contexts, nothing else.
KEY_BYTES = 5
FAR = np.iinfo(np.int64).max
_B = np.uint64(0x9E3779B97F4A7C15)


def _anchors_of(piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ANCHOR bytes at each place; for each window, where its anchor is."""
    n = len(piece) - ANCHOR + 1
    now, size, power = piece.astype(np.uint64) + np.uint64(1), 1, _B
    out, offset, left = None, 0, ANCHOR
    with np.errstate(over="ignore"):
        while True:
            if left & 1:
                part = now[offset : offset + n]
                out = part.copy() if out is None else out * power + part
                offset += size
            left >>= 1
            if not left:
                break
            now = now[:-size] * power + now[size:]
            power, size = power * power, 2 * size
        out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(32)
    # The place in the low half: of equal hashes, the leftmost wins.
    low = (out & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    size, width = 1, LEFT + 1
    while 2 * size <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < width:
        low = np.minimum(low[: len(low) - (width - size)], low[width - size :])
    return out, (low & np.uint64(0xFFFFFFFF)).astype(np.int64)


def contexts(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor, inside documents that end at ``ends``: first window, windows, anchor, hash."""
    found = []
    for at in range(0, max(0, len(data) - LENGTH + 1), PIECE):
        piece = data[at : at + PIECE + LENGTH - 1]
        n = len(piece) - LENGTH + 1
        hashes, anchor = _anchors_of(piece)
        edge = np.zeros(n + 1, np.int32)  # windows that cross the end of a document
        near = ends[np.searchsorted(ends, at, "right") : np.searchsorted(ends, at + n + LENGTH, "right")] - at
        np.add.at(edge, np.clip(near - LENGTH + 1, 0, n), 1)
        np.add.at(edge, np.clip(near, 0, n), -1)
        inside = np.cumsum(edge[:n]) == 0
        new = inside.copy()
        new[1:] &= ~inside[:-1] | (anchor[1:] != anchor[:-1])
        first = np.flatnonzero(new)
        stops = np.r_[np.flatnonzero(inside[:-1] & (~inside[1:] | new[1:])) + 1, [n] if n and inside[-1] else []].astype(np.int64)
        found.append((first + at, stops - first, anchor[first] + at, hashes[anchor[first]]))
    if not found:
        empty = np.array([], np.int64)
        return empty, empty, empty, empty.astype(np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found))


def _keys(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket in the high bits, KEY_BYTES of the hash below; not its highest ones, which are small in anchors."""
    low = hashes >> np.uint64(16) & np.uint64((1 << 8 * KEY_BYTES) - 1)
    return ((hashes & np.uint64(0xFFFF)) % np.uint64(buckets) << np.uint64(8 * KEY_BYTES)) | low


def _texts(table: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """A shard in the order of its rows: all bytes, ends of the texts."""
    table = table.sort_by("rid").combine_chunks()
    if table.num_rows == 0:
        return table, np.array([], np.uint8), np.array([], np.int64)
    text = table["text"].combine_chunks()
    text = text.chunk(0) if isinstance(text, pa.ChunkedArray) else text
    offsets = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)
    values = text.buffers()[2]
    data = np.frombuffer(values, np.uint8)[offsets[0] : offsets[-1]] if values is not None else np.array([], np.uint8)
    return table, data, offsets[1:] - offsets[0]


def _with_id(table: pa.Table, ends: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Id of the document in which each context lies; whether it has one."""
    doc = np.searchsorted(ends, first, "right")
    ids = table["id"].combine_chunks()
    return ids.fill_null(FAR).to_numpy(zero_copy_only=False)[doc], ids.is_valid().to_numpy(zero_copy_only=False)[doc]


def _own_contexts(table: pa.Table, data: np.ndarray, ends: np.ndarray):
    """Contexts of documents that have an id, with it."""
    first, count, anchor, hashes = contexts(data, ends)
    ids, has = _with_id(table, ends, first) if len(first) else (first, np.array([], bool))
    return first[has], count[has], anchor[has], hashes[has], ids[has]


def _anchor_rows(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        part = table["part"][0].as_py()
        keys = np.unique(_keys(_own_contexts(*_texts(table))[3], buckets))
        cuts = np.searchsorted(keys, np.arange(buckets + 1, dtype=np.uint64) << np.uint64(8 * KEY_BYTES))
        raw = keys.view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]  # without the bucket, on any little-endian machine
        some = np.flatnonzero(np.diff(cuts))
        return pa.table(
            {
                "bucket": pa.array(some, pa.int32()),
                "part": pa.array(np.full(len(some), part), pa.int32()),
                "keys": pa.array([raw[cuts[b] : cuts[b + 1]].tobytes() for b in some], pa.binary()),
            }
        )

    return run


def _met_elsewhere(table: pa.Table) -> pa.Table:
    """For each shard's anchors in a bucket, a bit: does another shard have it?"""
    raw = table["keys"].to_pylist()
    sizes = [len(x) // KEY_BYTES for x in raw]
    keys = np.zeros((sum(sizes), 8), np.uint8)
    keys[:, :KEY_BYTES] = np.frombuffer(b"".join(raw), np.uint8).reshape(-1, KEY_BYTES)
    _, inverse, count = np.unique(keys.view(np.uint64).ravel(), return_inverse=True, return_counts=True)
    met = count[inverse] > 1
    ends = np.cumsum(sizes)
    bits = [np.packbits(met[e - n : e]).tobytes() for e, n in zip(ends, sizes)]
    return pa.table({"part": table["part"], "bucket": table["bucket"], "bits": pa.array(bits, pa.binary())})


def _aligned(data: np.ndarray, first: np.ndarray, count: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Contexts lined up at their anchors, zero outside; two columns in front say where windows begin."""
    out = np.zeros((len(first), COLUMNS + 2), np.uint8)
    out[:, 0] = first - anchor + LEFT + 1
    out[:, 1] = out[:, 0] + (count - 1).astype(np.uint8)
    for a in range(0, len(first), ROWS):
        cut = slice(a, a + ROWS)
        at = anchor[cut, None] + np.arange(-LEFT, LENGTH)
        inside = (at >= first[cut, None]) & (at < (first + count)[cut, None] + LENGTH - 1)
        out[cut, 2:] = np.where(inside, data[np.clip(at, 0, len(data) - 1)], 0)
    return out


def transform(rows: np.ndarray, cell: np.ndarray) -> np.ndarray:
    """Transforms of the contexts of each cell, ``(COLUMNS, n)``: cells side by side, last column first.

    Sorting all cells at once gives the order inside each, too.
    """
    out, order = np.empty((COLUMNS, len(rows)), np.uint8), np.arange(len(rows))
    cell = cell.astype(np.uint16)
    for c in range(COLUMNS - 1, -1, -1):
        symbols = rows[order, c]
        out[COLUMNS - 1 - c] = symbols[np.argsort(cell[order], kind="stable")]
        order = order[np.argsort(symbols, kind="stable")]
    return out


CELLS = "part int, cell int, start int, n int, columns binary, ids binary, extent binary"


def _cell_rows(buckets: int, cells: int):
    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        part = key[0].as_py()
        table, data, ends = _texts(left)
        first, count, anchor, hashes, ids = _own_contexts(table, data, ends)
        keys, inverse, times = np.unique(_keys(hashes, buckets), return_inverse=True, return_counts=True)
        goes = times > 1
        cuts = np.searchsorted(keys, np.arange(buckets + 1, dtype=np.uint64) << np.uint64(8 * KEY_BYTES))
        for b, bits in zip(right["bucket"].to_pylist(), right["bits"].to_pylist()):
            n = cuts[b + 1] - cuts[b]
            goes[cuts[b] : cuts[b + 1]] |= np.unpackbits(np.frombuffer(bits, np.uint8))[:n].astype(bool)
        on = goes[inverse]
        first, count, anchor, hashes, ids = (x[on] for x in (first, count, anchor, hashes, ids))
        if not len(first):
            return CELL_SCHEMA.empty_table()
        rows = _aligned(data, first, count, anchor)
        _, at, inverse = np.unique(rows.view(f"S{COLUMNS + 2}").ravel(), return_index=True, return_inverse=True)
        least = np.full(len(at), FAR)
        np.minimum.at(least, inverse, ids)
        rows, cell = rows[at], (hashes[at] >> np.uint64(16) & np.uint64(0xFFFF)) % np.uint64(cells)
        by_cell = np.argsort(cell.astype(np.uint16), kind="stable")
        columns = transform(rows[:, 2:], cell)
        number = np.empty(len(at), np.int64)
        number[by_cell] = np.arange(len(at))
        sizes = np.bincount(cell.astype(np.int64), minlength=cells)
        stops = np.cumsum(sizes)
        some = np.flatnonzero(sizes)
        pack = zstandard.ZstdCompressor(level=1).compress  # a transform is mostly runs
        least, extent = least[by_cell], rows[by_cell, :2]
        out = [
            (part, int(k), int(b - n), int(n), pack(columns[:, b - n : b].tobytes()), least[b - n : b].tobytes(), extent[b - n : b].tobytes())
            for k, n, b in zip(some, sizes[some], stops[some])
        ]
        # Where the shard's own contexts are; goes to no cell.
        places = np.stack([np.diff(first, prepend=0), number[inverse]]).astype("<u4")
        out.append((part, -1, 0, len(at), pack(places.tobytes()), pack(least.tobytes()), pack(extent.tobytes())))
        return pa.table([pa.array(x, t) for x, t in zip(zip(*out), CELL_SCHEMA.types)], schema=CELL_SCHEMA)

    return run


CELL_SCHEMA = pa.schema(
    [("part", pa.int32()), ("cell", pa.int32()), ("start", pa.int32()), ("n", pa.int32())]
    + [(c, pa.binary()) for c in ("columns", "ids", "extent")]
)


def _least_between(common: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least of ``common[a + 1 .. b]`` for each pair, by a table of minima over powers of two."""
    if not len(a):
        return np.array([], np.uint8)
    level = np.frexp((b - a).astype(np.float64))[1] - 1
    table = [common]
    for k in range(int(level.max())):
        last = table[-1]
        shift = 1 << k
        table.append(np.r_[np.minimum(last[:-shift], last[shift:]), last[len(last) - shift :]])
    table = np.concatenate(table)
    base = level * len(common)
    return np.minimum(table[base + a + 1], table[base + b - (1 << level) + 1])


def merge(transforms: list[np.ndarray], ids: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """``(contexts, LEFT + 1)``: for each window, the smallest id among equal windows of all shards.

    ``ids``, ``low`` and ``high`` (first and last column in which a window begins)
    are those of the shards' contexts in their first order, shard after shard.
    """
    sizes = [t.shape[1] for t in transforms]
    n = sum(sizes)
    symbols_of = np.concatenate(transforms, axis=1)
    interleave = np.repeat(np.arange(len(sizes), dtype=np.uint32 if len(sizes) > 1 << 16 else np.uint16), sizes)
    context, common = np.arange(n), np.zeros(n, np.uint8)
    out = np.full((n, LEFT + 1), FAR)
    symbols = np.empty(n, np.uint8)
    for step in range(COLUMNS):
        # The k-th entry of a shard in the interleave takes the shard's k-th symbol.
        symbols[np.argsort(interleave, kind="stable")] = symbols_of[step]
        order = np.argsort(symbols, kind="stable")
        symbols_now = symbols[order]
        same = np.flatnonzero(symbols_now[1:] == symbols_now[:-1]) + 1
        grown = np.zeros(n, np.uint8)
        if step:
            grown[same] = _least_between(common, order[same - 1], order[same]) + np.uint8(1)
        else:
            grown[same] = 1
        interleave, context, common = interleave[order], context[order], grown
        column = COLUMNS - 1 - step
        if column <= LEFT:
            begins = (low[context] <= column) & (column <= high[context])
            starts = np.flatnonzero(common < LENGTH)
            if not len(starts):
                continue
            least = np.minimum.reduceat(np.where(begins, ids[context], FAR), starts)
            least = np.repeat(least, np.diff(np.r_[starts, n]))
            out[context[begins], column] = least[begins]
    return out


FOUND = "part int, start int, least binary"


def _merged(table: pa.Table) -> pa.Table:
    """Windows of which a smaller id is known elsewhere: context in the shard, first and last column, id."""
    table = table.sort_by("part").combine_chunks()
    sizes = table["n"].to_pylist()
    unpack = zstandard.ZstdDecompressor().decompress
    transforms = [np.frombuffer(unpack(c), np.uint8).reshape(COLUMNS, n) for c, n in zip(table["columns"].to_pylist(), sizes)]
    ids = np.frombuffer(b"".join(table["ids"].to_pylist()), np.int64)
    extent = np.frombuffer(b"".join(table["extent"].to_pylist()), np.uint8).reshape(-1, 2).astype(np.int64) - 1
    least = merge(transforms, ids, extent[:, 0], extent[:, 1])
    found = []
    stops = np.cumsum(sizes)
    for n, stop in zip(sizes, stops):
        mine, own = least[stop - n : stop], ids[stop - n : stop, None]
        news = mine < own
        begins = news.copy()
        begins[:, 1:] &= ~news[:, :-1] | (mine[:, 1:] != mine[:, :-1])
        row, column = np.nonzero(begins)
        last = news.copy()
        last[:, :-1] &= ~news[:, 1:] | (mine[:, 1:] != mine[:, :-1])
        stop_column = np.nonzero(last)[1]
        out = np.zeros(len(row), SPAN)
        out["context"], out["low"], out["high"], out["least"] = row, column, stop_column, mine[row, column]
        found.append(out.tobytes())
    return pa.table({"part": table["part"], "start": table["start"], "least": pa.array(found, pa.binary())})


SPAN = np.dtype([("context", "<u4"), ("low", "u1"), ("high", "u1"), ("least", "<i8")])


def _removed(data: np.ndarray, table: pa.Table, ends: np.ndarray, marks: pa.Table) -> np.ndarray:
    """Which bytes of a shard go."""
    edge = np.zeros(len(data) + 1, np.int8)
    rows = marks.to_pylist()
    unpack = zstandard.ZstdDecompressor().decompress
    for own in (r for r in rows if r["columns"] is not None):
        extent = np.frombuffer(unpack(own["extent"]), np.uint8).reshape(-1, 2).astype(np.int64) - 1
        least = np.repeat(np.frombuffer(unpack(own["ids"]), np.int64)[:, None], LEFT + 1, axis=1)
        for r in (r for r in rows if r["columns"] is None):
            for s in np.frombuffer(r["least"], SPAN):
                least[r["start"] + int(s["context"]), s["low"] : s["high"] + 1] = s["least"]
        gaps, number = np.frombuffer(unpack(own["columns"]), "<u4").reshape(2, -1).astype(np.int64)
        first = np.cumsum(gaps)
        ids = _with_id(table, ends, first)[0]
        column = np.arange(LEFT + 1)
        for a in range(0, len(first), ROWS):
            of = number[a : a + ROWS]
            low, high = extent[of, 0, None], extent[of, 1, None]
            goes = (least[of] < ids[a : a + ROWS, None]) & (low <= column) & (column <= high)
            row, at = np.nonzero(goes)
            starts = first[a + row] + at - low[row, 0]
            edge[starts] += 1  # a window begins once only
            edge[starts + LENGTH] -= 1
    return np.cumsum(edge[:-1], dtype=np.int8) > 0


def _kept(digests: bool, rest: pa.DataType, kind: pa.DataType):
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        table, data, ends = _texts(left)
        gone = _removed(data, table, ends, right)
        kept, removed, spans = [], [], []
        for a, b in zip(np.r_[0, ends[:-1]] if len(ends) else [], ends):
            mine = gone[a:b]
            edges = np.flatnonzero(np.diff(mine.astype(np.int8), prepend=0, append=0)) if mine.any() else []
            spans.append([{"start": int(x), "stop": int(y)} for x, y in zip(edges[::2], edges[1::2])])
            removed.append(int(mine.sum()))
            left_over = data[a:b][~mine].tobytes() if removed[-1] else data[a:b].tobytes()
            kept.append(hashlib.sha256(left_over).digest() if digests else left_over)
        sizes = np.diff(np.r_[0, ends]) if len(ends) else []
        return pa.table(
            [
                table["row"].combine_chunks().cast(rest),
                table["named"].combine_chunks().cast(kind),
                pa.array(sizes, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(spans, spans_type),
                pa.array(kept, pa.binary()),
            ],
            names=["row", "id", "n_bytes", "n_removed", "spans", "kept"],
        )

    return run


def _order_of_ids(docs: DataFrame, id_col: str, staging: Staging) -> DataFrame:
    """``docs`` with ``named`` (the id) and ``id``, a number in the order of the ids; null for null."""
    named = docs.withColumn("named", F.col(f"`{id_col}`")) if "named" not in docs.columns else docs
    if isinstance(docs.schema[id_col].dataType, T.IntegralType):
        return named.withColumn("id", F.col("named").cast("long"))
    ids = docs.select(F.lit("").alias("gkey"), F.col(f"`{id_col}`").alias("named")).distinct().where("named IS NOT NULL")
    return named.join(ranked(ids, ["named"], staging, "ids").select("named", F.col("pos").alias("id")), "named", "left")


def remove_repeats(
    docs: DataFrame,
    staging: Staging,
    id_col: str = "doc_id",
    text: str = "text",
    digests: bool = False,
    shard_bytes: int | None = None,
) -> DataFrame:
    """``(row, id, n_bytes, n_removed, spans, kept)``: each document without what a smaller id has, too.

    A byte goes if a string of ``LENGTH`` bytes around it also lies in a document
    with a smaller id; strings are looked for in the texts as they come, as UTF-8
    bytes, and do not cross documents. ``kept`` are the bytes left (with
    ``digests`` their SHA-256), which may cut a character; ``spans`` what went, as
    maximal runs; ``row`` the other columns. Null and empty texts have no bytes.
    Ids may be of any type that has an order. Rows that share an id take nothing
    from each other. A row without id is never compared: nothing of it goes, nothing goes because of it.
    """
    others = [c for c in docs.columns if c not in (id_col, text)]
    packed = docs.select(
        F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in others]).alias("row"),
        F.col(f"`{id_col}`").alias("named"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    total = packed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    spark = docs.sparkSession
    if shard_bytes is None:
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        parts = max(-(-total // SHARD_BYTES), min(tasks, -(-total // SMALL_SHARD)), 1)
    else:
        parts = max(1, -(-total // shard_bytes))
    buckets, n_cells = (min(-(-parts // n), MOST_BUCKETS) for n in (SHARDS_A_BUCKET, SHARDS_A_CELL))
    files = min(parts, MOST_FILES)
    numbered = _order_of_ids(packed, "named", staging).withColumn("rid", F.monotonically_increasing_id())
    numbered = numbered.withColumn("part", F.pmod(F.xxhash64("rid"), F.lit(parts)).cast("int"))
    name = f"repeats_{uuid.uuid4().hex}"
    # Bucketed by shard, so that what comes back to a shard joins it without a shuffle of texts.
    dealt = numbered.select("part", "rid", "id", "named", "text", "row").repartition(files, "part")
    bucketed = dealt.write.bucketBy(files, "part").sortBy("part").option("compression", "zstd")
    bucketed.option("path", f"{staging.folder}/{name}").saveAsTable(name)
    try:
        shards = spark.table(name)
        slim = shards.select("part", "rid", "id", "text")
        anchors = slim.groupBy("part").applyInArrow(_anchor_rows(buckets), "bucket int, part int, keys binary")
        bits = anchors.groupBy("bucket").applyInArrow(_met_elsewhere, "part int, bucket int, bits binary")
        cells = staging.store(slim.groupBy("part").cogroup(bits.groupBy("part")).applyInArrow(_cell_rows(buckets, n_cells), CELLS), "cells")
        found = cells.where("cell >= 0").groupBy("cell").applyInArrow(_merged, FOUND)
        own = cells.where("cell = -1").select("part", "start", F.lit(None).cast("binary").alias("least"), "columns", "ids", "extent")
        marks = found.unionByName(own, allowMissingColumns=True)
        row, kind = (to_arrow_type(shards.schema[c].dataType) for c in ("row", "named"))
        schema = (
            f"row {shards.schema['row'].dataType.simpleString()}, id {shards.schema['named'].dataType.simpleString()}, "
            "n_bytes long, n_removed long, spans array<struct<start:int,stop:int>>, kept binary"
        )
        kept = shards.groupBy("part").cogroup(marks.groupBy("part")).applyInArrow(_kept(digests, row, kind), schema)
        return staging.store(kept, "kept")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        staging.drop(name)
