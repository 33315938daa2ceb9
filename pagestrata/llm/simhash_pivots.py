"""SimHash near-duplicates, found with tables of distances to reference fingerprints.

1. A document's fingerprint is the majority, bit by bit, of the hashes of its
   word shingles. Equal fingerprints are one node from here on.
2. For every node the Hamming distances to ``PIVOTS`` fixed reference
   fingerprints are computed once and travel with it. Two nodes within ``d``
   bits differ by at most ``d`` in each of these distances.
3. Nodes within ``d`` bits agree on at least ``blocks - d`` of ``blocks`` blocks
   of bits. Each choice of so many blocks is a cell; only nodes of one cell are
   compared: first by their pivot distances, and what survives bit by bit.
4. A cell passes on a spanning forest of its links, never all its pairs. Links
   are joined to components by alternating stars.

Six blocks suit up to some billion different fingerprints; eight blocks (70
cells a node of 32 bits each) keep cells small beyond that.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagestrata.llm.words import LOWER, map_texts
from pagestrata.sources.tables import Staging

#: Number of reference fingerprints.
PIVOTS = 16
#: Shingles unpacked at a time.
CHUNK = 50_000
#: Rows of a cell compared in one task; larger cells are dealt out in pairs of parts.
CELL_ROWS = 4096
#: Up to this size a cell gives its links as they are found, beyond it a spanning forest.
SMALL = 16


def references(n: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints: hashes of 0 to n - 1, so any bits are as likely."""
    return np.array([xxhash.xxh64_intdigest(b"reference %d" % i, 7) for i in range(n)], np.uint64)


def fingerprint(text: bytes, size: int = 4) -> int:
    """Majority bits of the XXH64 (seed 42) of a text's word shingles; 0 without words."""
    words = text.translate(LOWER).split()
    n = len(words)
    if n == 0:
        return 0
    joined = b" ".join(words)
    size = min(size, n)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    of, count = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    total = n - size + 1
    for k in range(0, total, CHUNK):
        cut = slice(k, min(k + CHUNK, total))
        spans = zip(starts[cut].tolist(), ends[size - 1 :][cut].tolist())
        h = np.array([of(joined[a:b], 42) for a, b in spans], np.uint64)
        count += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(count * 2 > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", size: int = 4) -> DataFrame:
    """``row`` (the document) and ``out.fp``: the fingerprint as a signed long."""

    def make():
        def of(texts):
            found = np.array([fingerprint(t, size) for t in texts], np.uint64)
            return [pa.array(found.view(np.int64))]

        return of

    return map_texts(docs, text, make, "fp long")


def block_masks(blocks: int, distance: int) -> list[int]:
    """The bits of each choice of blocks that nodes within ``distance`` can agree on."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    masks = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(masks, blocks - distance)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def cells(nodes: DataFrame, distance: int, blocks: int) -> DataFrame:
    """``(cell, fp, d)`` for each cell of each node; ``d`` holds its distances to the references."""
    near = F.array(*[F.bit_count(F.col("fp").bitwiseXOR(F.lit(_signed(int(p))))).cast("byte") for p in references()])
    keys = [
        F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(_signed(m))))
        for k, m in enumerate(block_masks(blocks, distance))
    ]
    return nodes.select("fp", near.alias("d")).select(F.explode(F.array(*keys)).alias("cell"), "fp", "d")


def _near(fp: np.ndarray, d: np.ndarray, i: np.ndarray, j: np.ndarray, distance: int) -> np.ndarray:
    """Which pairs are within ``distance``: no pivot tells them apart, and neither do the bits."""
    keep = np.flatnonzero((np.abs(d[i] - d[j]) <= distance).all(1))
    return keep[np.bitwise_count(fp[i[keep]] ^ fp[j[keep]]) <= distance]


def _forest(fp: np.ndarray, d: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join whatever the links of one cell join, fewer than it has rows."""
    n, label = len(fp), np.arange(len(fp))
    a, b = [], []
    for r in range(n - 1):
        j = r + 1 + np.flatnonzero(label[r + 1 :] != label[r])  # the others are joined already
        j = j[_near(fp, d, np.full(len(j), r), j, distance)]
        joined, first = np.unique(label[j], return_index=True)
        a += [r] * len(first)
        b += j[first].tolist()
        if len(joined):
            label[np.isin(label, joined)] = label[r]
    return fp[np.array(a, np.int64)], fp[np.array(b, np.int64)]


def _links(distance: int):
    """Links within the cells of a partition that is sorted by cell."""

    def whole(batches):
        """Batches that end where a cell ends."""
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            cell = table.column("cell").to_numpy()
            if len(cell) == 0:
                continue
            cut = int(np.argmax(cell == cell[-1]))  # rows before the last cell
            if cut:
                yield table.slice(0, cut)
            held = table.slice(cut)
        if held is not None and held.num_rows:
            yield held

    def run(batches):
        for table in whole(batches):
            cell = table.column("cell").to_numpy()
            fp = table.column("fp").to_numpy().view(np.uint64)
            d = table.column("d").combine_chunks().flatten().to_numpy().reshape(-1, PIVOTS)
            starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
            sizes = np.diff(np.r_[starts, len(cell)])
            out = []
            small = np.repeat(sizes <= SMALL, sizes)
            for lag in range(1, min(SMALL, int(sizes.max()))):
                i = np.flatnonzero((cell[lag:] == cell[:-lag]) & small[lag:])
                i = i[_near(fp, d, i, i + lag, distance)]
                out.append((fp[i], fp[i + lag]))
            for s, n in zip(starts[sizes > SMALL], sizes[sizes > SMALL]):
                out.append(_forest(fp[s : s + n], d[s : s + n], distance))
            if out:
                a, b = (np.concatenate(x).view(np.int64) for x in zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    return run


def links(nodes: DataFrame, staging: Staging, distance: int = 4, blocks: int = 6) -> DataFrame:
    """``(a, b)``, a < b: links between different fingerprints, enough to join all that are joined."""
    dealt = cells(nodes, distance, blocks)
    hot = dealt.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CELL_ROWS)
    hot = staging.store(hot.select("cell", F.ceil(F.col("n") * 2 / CELL_ROWS).cast("int").alias("cuts")), "hot_cells")
    # A row of a large cell goes to each pair of parts that has its own part.
    part = F.pmod(F.xxhash64(F.lit("part"), "fp"), F.col("cuts")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("cuts") - 1), lambda x: x != F.col("part"))
    pair = F.transform(others, lambda x: F.xxhash64("cell", F.least(x, F.col("part")), F.greatest(x, F.col("part"))))
    dealt = (
        dealt.join(hot, "cell", "left")
        .withColumn("part", part)
        .select(F.explode(F.when(F.col("cuts").isNull(), F.array("cell")).otherwise(pair)).alias("cell"), "fp", "d")
    )
    ordered = dealt.repartition("cell").sortWithinPartitions("cell")
    return ordered.mapInArrow(_links(distance), "a long, b long").distinct()


def components(edges: DataFrame, staging: Staging, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` of every node with a link; the root is the smallest node of its component.

    Alternating stars: each round points every node's larger neighbours, then
    its smaller ones, at the smallest node it knows, until nothing changes. Rows
    never outnumber the links; rounds grow with the logarithm of the longest path.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if large:
            both = both.unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        else:
            both = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        joined = both.join(least, "u")
        moved = joined.where(F.col("v") > F.col("u")) if large else joined.where(F.col("v") != F.col("m"))
        out = moved.select(F.col("m").alias("a"), F.col("v").alias("b"))
        if not large:
            out = out.unionByName(least.select(F.col("m").alias("a"), F.col("u").alias("b")))
        return out.where("a <> b").distinct()

    def mark(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a <> b").distinct()
    now = staging.store(edges, "edges_0")
    seen, k = mark(now), 0
    while True:
        k += 1
        now = staging.store(star(star(now, True), False), f"edges_{k}")
        if (found := mark(now)) == seen:
            return now.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))
        seen = found
        if k > 1:
            staging.drop(f"edges_{k - 1}")


def near_duplicates(
    docs: DataFrame, staging: Staging, id_col: str = "doc_id", text: str = "text", distance: int = 4, blocks: int = 6
) -> DataFrame:
    """``(id, fp, component_id)`` of every document: the smallest id that links reach from it.

    Null texts count as empty, and texts without words have fingerprint zero,
    linked like any other. Repeated rows stay. A null id takes part in linking
    and is never the smallest; a component without ids has a null
    ``component_id``. Empty tables give no rows.
    """
    found = fingerprints(docs.select(id_col, text), text)
    found = staging.store(found.select(F.col("row")[id_col].alias("id"), F.col("out.fp").alias("fp")), "fingerprints")
    nodes = staging.store(found.groupBy("fp").agg(F.min("id").alias("first")), "nodes")
    roots = components(links(nodes.select("fp"), staging, distance, blocks), staging)
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    firsts = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of_fp = staging.store(rooted.join(firsts, "root").select("fp", "component_id"), "component_of")
    return found.join(of_fp, "fp").select("id", "fp", "component_id")
