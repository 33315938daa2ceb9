"""A Merkle manifest whose parents retain SHA-256 midstates.

A node is the hash of its children's digests as hex text. A digest in hex is 64
bytes, which is one block of SHA-256: the state of the hash before child slot k
is the state after k blocks. Every parent keeps these states (the one before
slot 0 is the initial one), so putting another child into a slot resumes the
matching state and hashes the replacement and the siblings on its right; what
lies on the left is never read again.

Leaves of a group lie in order; ``FANOUT`` of them become a parent. Groups may
be of any size: positions are cut into blocks of ``FANOUT ** HEIGHT`` leaves,
each a subtree built by one task, whose tops are the leaves of the next round;
a round divides the number of nodes by 6,561. The groups' roots are the leaves of a last tree.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import reduce
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from pagestrata.llm.ranked import ranked
from pagestrata.sources.tables import Staging

FANOUT = 3
#: Levels of a block; a block has at most FANOUT ** HEIGHT leaves.
HEIGHT = 8
BLOCK = FANOUT**HEIGHT
#: Hashes computed side by side.
LANES = 4096
#: Leaves whose paths are folded at a time.
CHUNK = 20_000
#: A step of a path: number of children, slot, state before the slot, the other children in order.
STEP = 2 + 32 + 32 * (FANOUT - 1)


def _primes(n: int) -> list[int]:
    found: list[int] = []
    x = 2
    while len(found) < n:
        if all(x % p for p in found):
            found.append(x)
        x += 1
    return found


def _icbrt(x: int) -> int:
    lo, hi = 0, 1 << (x.bit_length() // 3 + 1)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if mid**3 <= x else (lo, mid - 1)
    return lo


# Constants of SHA-256 (FIPS 180-4): fractions of square and cube roots of the first primes.
INITIAL = np.array([isqrt(p << 64) & 0xFFFFFFFF for p in _primes(8)], np.uint32)
ROUND = [np.uint32(_icbrt(p << 96) & 0xFFFFFFFF) for p in _primes(64)]
_HEX = np.array([int.from_bytes(b"%02x" % b, "little") for b in range(256)], "<u2")


def _rotated(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> np.uint32(n)) | (x << np.uint32(32 - n))


def compress(state: np.ndarray, words: np.ndarray) -> np.ndarray:
    """States ``(n, 8)`` after one more block of ``(n, 16)`` words each."""
    out = np.empty_like(state)
    for k in range(0, len(state), LANES):
        w = list(words[k : k + LANES].T.copy())
        start = state[k : k + LANES].T.copy()
        a, b, c, d, e, f, g, h = start
        for t in range(64):
            if t >= 16:
                x, y = w[t - 15], w[t - 2]
                x = _rotated(x, 7) ^ _rotated(x, 18) ^ (x >> np.uint32(3))
                y = _rotated(y, 17) ^ _rotated(y, 19) ^ (y >> np.uint32(10))
                w.append(w[t - 16] + x + w[t - 7] + y)
            t1 = h + (_rotated(e, 6) ^ _rotated(e, 11) ^ _rotated(e, 25)) + ((e & f) ^ (~e & g)) + ROUND[t] + w[t]
            t2 = (_rotated(a, 2) ^ _rotated(a, 13) ^ _rotated(a, 22)) + ((a & b) ^ (a & c) ^ (b & c))
            a, b, c, d, e, f, g, h = t1 + t2, a, b, c, d + t1, e, f, g
        out[k : k + LANES] = (start + np.stack([a, b, c, d, e, f, g, h])).T
    return out


def as_words(raw: bytes | np.ndarray) -> np.ndarray:
    """Digests of 32 bytes each as ``(n, 8)`` words."""
    return np.frombuffer(raw, ">u4").astype(np.uint32).reshape(-1, 8)


def as_bytes(digests: np.ndarray) -> bytes:
    return np.ascontiguousarray(digests).astype(">u4").tobytes()


def hex_block(digests: np.ndarray) -> np.ndarray:
    """Hex text of digests as blocks of 16 words."""
    raw = np.frombuffer(as_bytes(digests), np.uint8)
    return np.frombuffer(_HEX[raw].tobytes(), ">u4").astype(np.uint32).reshape(-1, 16)


def finish(state: np.ndarray, children: np.ndarray) -> np.ndarray:
    """Digests of hashes that have taken in so many hex digests."""
    last = np.zeros((len(state), 16), np.uint32)
    last[:, 0] = 0x80000000
    last[:, 15] = 512 * children.astype(np.uint32)
    return compress(state, last)


def _heights(sizes: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Levels of each block: all of them beyond a group's first block, else what is needed for one node."""
    need, n = np.zeros(len(sizes), np.int64), sizes.copy()
    while (n > 1).any():
        need += n > 1
        n = -(-n // FANOUT)
    return np.where(blocks > 0, HEIGHT, need)


def raise_level(digests: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Parents of consecutive runs of ``sizes`` nodes: digests, number in each run, states, children of each.

    ``states[:, k]`` is a parent's state before child slot ``k + 1``.
    """
    ups = -(-sizes // FANOUT)
    within = np.arange(len(digests)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    parent = np.repeat(np.cumsum(ups) - ups, sizes) + within // FANOUT
    slot, blocks = within % FANOUT, hex_block(digests)
    children = np.bincount(parent, minlength=int(ups.sum()))
    state = np.repeat(INITIAL[None], len(children), 0)
    states = np.zeros((len(children), FANOUT - 1, 8), np.uint32)
    for k in range(FANOUT):
        of = parent[slot == k]
        state[of] = compress(state[of], blocks[slot == k])
        if k < FANOUT - 1:
            states[:, k] = state
    return finish(state, children), ups, states, children


def _block_rows(batches):
    """Blocks of the rows ``gkey, block, slot, id, leaf, other``, which come in order."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch]).combine_chunks()
        if table.num_rows == 0:
            continue
        block, slot = table["block"].to_numpy(), table["slot"].to_numpy()
        last = int(np.flatnonzero(slot == 0)[-1])
        rest = table.slice(last)
        if last:
            yield _blocks(table.slice(0, last))
    if rest is not None:
        yield _blocks(rest)


def _blocks(rows: pa.Table) -> pa.RecordBatch:
    rows = rows.combine_chunks()
    starts = np.flatnonzero(rows["slot"].to_numpy() == 0)
    sizes = np.diff(np.r_[starts, rows.num_rows])
    blocks = rows["block"].to_numpy()[starts]
    raw = {c: b"".join(rows[c].to_pylist()) for c in ("leaf", "other")}
    height = _heights(sizes, blocks)
    nodes, states = [[] for _ in starts], [[] for _ in starts]
    on, digests, now = np.arange(len(starts)), as_words(raw["leaf"]), sizes
    for level in range(HEIGHT + 1):
        ends = np.cumsum(now)
        for k, a, b in zip(on, ends - now, ends):
            nodes[k].append(as_bytes(digests[a:b]))
        up = height[on] > level
        digests, on, now = digests[np.repeat(up, now)], on[up], now[up]
        if not len(on):
            break
        digests, now, kept, _ = raise_level(digests, now)
        ends = np.cumsum(now)
        for k, a, b in zip(on, ends - now, ends):
            states[k].append(as_bytes(kept[a:b]))
    ends = np.cumsum(sizes)
    ids = rows["id"].combine_chunks()
    return pa.RecordBatch.from_arrays(
        [
            rows["gkey"].combine_chunks().take(pa.array(starts)),
            pa.array(blocks),
            pa.array(sizes, pa.int32()),
            pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), ids),
            pa.array([raw["other"][32 * a : 32 * b] for a, b in zip(ends - sizes, ends)], pa.binary()),
            pa.array([b"".join(x) for x in nodes], pa.binary()),
            pa.array([b"".join(x) for x in states], pa.binary()),
            pa.array([x[-1] for x in nodes], pa.binary()),
        ],
        names=["gkey", "block", "n", "ids", "others", "nodes", "states", "top"],
    )


def _subtrees(rows: DataFrame) -> DataFrame:
    """Blocks of ``(gkey, pos, id, leaf, other)``."""
    kind = rows.schema["id"].dataType.simpleString()
    cut = rows.withColumns({"block": F.floor(F.col("pos") / BLOCK), "slot": F.col("pos") % BLOCK})
    cut = cut.select("gkey", "block", "slot", "id", "leaf", "other")
    cut = cut.repartition("gkey", "block").sortWithinPartitions("gkey", "block", "slot")
    return cut.mapInArrow(
        _block_rows,
        f"gkey string, block long, n int, ids array<{kind}>, others binary, nodes binary, states binary, top binary",
    )


@dataclass
class Tree:
    """Rounds of stored blocks, the leaves' first, and ``tops``: ``(gkey, round, top)`` of every group."""

    rounds: list[DataFrame]
    tops: DataFrame


def build(rows: DataFrame, staging: Staging, name: str) -> Tree:
    """A tree for each ``gkey`` of ``(gkey, pos, id, leaf, other)``."""
    rounds, tops = [], []
    while True:
        k = len(rounds)
        blocks = staging.store(_subtrees(rows), f"{name}_round_{k}")
        rounds.append(blocks)
        many = not blocks.where("block > 0").isEmpty()
        # A full first block may have others after it; if it has none, the next round leaves it as it is.
        goes_on = ((F.col("block") > 0) | (F.col("n") == BLOCK)) if many else F.lit(False)
        tops.append(blocks.where(~goes_on).select("gkey", F.lit(k).alias("round"), "top"))
        if not many:
            return Tree(rounds, reduce(DataFrame.unionByName, tops))
        rows = blocks.where(goes_on).select(
            "gkey", F.col("block").alias("pos"), F.lit(None).cast("long").alias("id"), F.col("top").alias("leaf"), F.col("top").alias("other")
        )


def _steps(nodes: np.ndarray, states: np.ndarray, n: int, block: int) -> np.ndarray:
    """``(n, height, STEP)``: the way of every leaf of a block up to the block's top."""
    height = int(_heights(np.array([n]), np.array([block]))[0])
    out = np.zeros((n, height, STEP), np.uint8)
    at, size, node, parent_at = np.arange(n), n, 0, 0
    initial = np.frombuffer(as_bytes(INITIAL), np.uint8)
    for level in range(height):
        parent, slot = at // FANOUT, at % FANOUT
        children = np.minimum(FANOUT, size - parent * FANOUT)
        step = out[:, level]
        step[:, 0], step[:, 1] = children, slot
        step[:, 2:34] = np.where((slot == 0)[:, None], initial, states[parent_at + parent, np.maximum(slot, 1) - 1])
        for k in range(FANOUT - 1):
            other = k + (k >= slot)
            has = other < children
            step[has, 34 + 32 * k : 66 + 32 * k] = nodes[node + parent[has] * FANOUT + other[has]]
        node, size = node + size, -(-size // FANOUT)
        parent_at += size
        at = parent
    return out


def _ways(batches):
    """For each block its leaves' steps to the root: ``(row of the block, steps of leaves, outer steps)``."""
    for batch in batches:
        for r in batch.to_pylist():
            nodes = np.frombuffer(r["nodes"], np.uint8).reshape(-1, 32)
            states = np.frombuffer(r["states"], np.uint8).reshape(-1, FANOUT - 1, 32)
            inner = _steps(nodes, states, r["n"], r["block"])
            outer = np.frombuffer(r["path"], np.uint8).reshape(-1, STEP)
            yield r, nodes, inner, outer


def _down(kind: pa.DataType):
    def run(batches):
        for r, _, inner, outer in _ways(batches):
            for a in range(0, r["n"], CHUNK):
                part = inner[a : a + CHUNK]
                first = r["block"] * BLOCK + a
                columns = [
                    pa.array([r["gkey"]] * len(part), pa.string()),
                    pa.array(range(first, first + len(part)), pa.int64()),
                    pa.array(r["ids"][a : a + CHUNK], kind),
                    pa.array([x.tobytes() + outer.tobytes() for x in part], pa.binary()),
                    pa.array([r["top_of"]] * len(part), pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["gkey", "pos", "id", "path", "top_of"])

    return run


def fold(digests: np.ndarray, steps: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Roots above replaced leaves: resume the state before the slot, add the replacement and what is right of it."""
    now = digests.copy()
    for t in range(steps.shape[1]):
        on = np.flatnonzero(lengths > t)
        step = steps[on, t]
        children, slot = step[:, 0].astype(np.int64), step[:, 1].astype(np.int64)
        state = compress(as_words(step[:, 2:34].tobytes()), hex_block(now[on]))
        for k in range(FANOUT - 1):
            right = np.flatnonzero((k >= slot) & (k + 1 < children))
            if len(right):
                sibling = as_words(step[right, 34 + 32 * k : 66 + 32 * k].tobytes())
                state[right] = compress(state[right], hex_block(sibling))
        now[on] = finish(state, children)
    return now


def siblings(steps: np.ndarray, lengths: np.ndarray) -> list[str]:
    """SHA-256 of each way's siblings in hex, level by level."""
    out = []
    for way, n in zip(steps, lengths):
        digests = [way[t, 34 : 34 + 32 * (int(way[t, 0]) - 1)].tobytes() for t in range(n)]
        out.append(hashlib.sha256(b"".join(digests).hex().encode()).hexdigest())
    return out


def _checked(kind: pa.DataType):
    """Reads blocks with the steps above them; gives ids, leaves, proofs and what replaced leaves fold to."""

    def emit(waiting):
        inner, outer, leaves, others, ids, top_of = zip(*waiting)
        sizes = [len(x) for x in inner]
        lengths = np.repeat([x.shape[1] + len(y) for x, y in zip(inner, outer)], sizes)
        steps = np.zeros((sum(sizes), int(lengths.max(initial=0)), STEP), np.uint8)
        at = 0
        for x, y in zip(inner, outer):
            here = steps[at : at + len(x)]
            here[:, : x.shape[1]] = x
            here[:, x.shape[1] : x.shape[1] + len(y)] = y
            at += len(x)
        as_hex = lambda digests: [x.tobytes().hex() for x in digests.astype(">u4")]
        leaves, others = as_words(b"".join(leaves)), as_words(b"".join(others))
        columns = [
            pa.array([i for x in ids for i in x], kind),
            pa.array(as_hex(leaves), pa.string()),
            pa.array([t.hex() for t, n in zip(top_of, sizes) for _ in range(n)], pa.string()),
            pa.array(siblings(steps, lengths), pa.string()),
            pa.array(as_hex(fold(others, steps, lengths)), pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["id", "leaf", "subroot", "proof", "folded"])

    def run(batches):
        waiting, n = [], 0
        for r, nodes, inner, outer in _ways(batches):
            leaves = nodes[: r["n"]]
            for a in range(0, r["n"], CHUNK):
                cut = slice(a, a + CHUNK)
                others = r["others"][32 * a : 32 * (a + CHUNK)]
                waiting.append((inner[cut], outer, leaves[cut].tobytes(), others, r["ids"][cut], r["top_of"]))
                n += len(inner[cut])
                if n >= CHUNK:
                    yield emit(waiting)
                    waiting, n = [], 0
        if waiting:
            yield emit(waiting)

    return run


def _with_paths(tree: Tree, k: int, ends: DataFrame, above: DataFrame | None) -> DataFrame:
    """Blocks of round ``k`` with the steps above their tops."""
    own = ends.where(F.col("round") == k).select("gkey", F.lit(0).cast("long").alias("block"), "path", "top_of")
    if above is not None:
        own = own.unionByName(above.select("gkey", F.col("pos").alias("block"), "path", "top_of"))
    return tree.rounds[k].join(own, ["gkey", "block"])


def _paths(tree: Tree, ends: DataFrame, staging: Staging, name: str, down_to: int) -> DataFrame | None:
    """Steps from every leaf of round ``down_to`` up to the root; ``ends`` has those above the groups' tops."""
    above = None
    for k in range(len(tree.rounds) - 1, down_to - 1, -1):
        kind = tree.rounds[k].schema["ids"].dataType.elementType
        columns = f"gkey string, pos long, id {kind.simpleString()}, path binary, top_of binary"
        rows = _with_paths(tree, k, ends, above).mapInArrow(_down(to_arrow_type(kind)), columns)
        above = staging.store(rows, f"{name}_paths_{k}")
    return above


@dataclass
class Manifest:
    """``root`` (hex), the trees of the groups and the one above them."""

    root: str
    groups: Tree
    above: Tree
    ends: DataFrame


def manifest(rows: DataFrame, order: list[str], staging: Staging) -> Manifest:
    """Build the manifest of ``(gkey, id, leaf, other)``: digests of 32 bytes; ``other`` is what ``verify`` puts in for ``leaf``.

    ``gkey`` is a string, never null; groups come in its order, leaves in that of
    ``order`` (nulls first; equal ones by their place in the input). Without rows the root is the hash of nothing.
    """
    leaves = ranked(rows, order, staging, "leaves").select("gkey", "pos", "id", "leaf", "other")
    groups = build(leaves, staging, "groups")
    roots = groups.tops.select(F.lit("").alias("gkey"), F.col("gkey").alias("id"), F.col("top").alias("leaf"), F.col("top").alias("other"), "round")
    above = build(ranked(roots, ["id"], staging, "roots").select("gkey", "pos", "id", "leaf", "other"), staging, "above")
    top = above.tops.first()
    root = top["top"] if top else hashlib.sha256(b"").digest()
    nothing = F.lit(b"")
    ends = _paths(above, above.tops.select("gkey", "round", nothing.alias("path"), F.col("top").alias("top_of")), staging, "above", 0)
    ends = ends.select(F.col("id").alias("gkey"), "path").join(groups.tops, "gkey")
    return Manifest(root.hex(), groups, above, ends.select("gkey", "round", "path", F.col("top").alias("top_of")))


def verify(m: Manifest, staging: Staging) -> DataFrame:
    """``(id, leaf, subroot, root, proof, folded)`` of every leaf, in hex.

    ``proof`` is the hash of the siblings from the leaf up to the root, ``folded``
    the root that results from the leaf's replacement. A replacement equal to the leaf gives the root.
    """
    above = _paths(m.groups, m.ends, staging, "groups", 1)
    kind = m.groups.rounds[0].schema["ids"].dataType.elementType
    blocks = _with_paths(m.groups, 0, m.ends, above)
    rows = blocks.mapInArrow(
        _checked(to_arrow_type(kind)), f"id {kind.simpleString()}, leaf string, subroot string, proof string, folded string"
    )
    return rows.withColumn("root", F.lit(m.root))


def group_key(column: str) -> Column:
    """A string in the order of the column's UTF-8 bytes, null first, that tells null from every text."""
    return F.coalesce(F.concat(F.lit("1"), F.col(column).cast("string")), F.lit("0"))


def row_digest(fields: list[Column]) -> Column:
    """SHA-256 (32 bytes) of the fields, each ``-`` for null, else its UTF-8 size, a colon and the value."""
    as_text = [f.cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(f).cast("string"), F.lit(":"), f), F.lit("-")) for f in as_text]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def audit(
    docs: DataFrame,
    staging: Staging,
    replaced: dict[str, Column],
    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    group: str = "source",
    id_col: str = "doc_id",
) -> DataFrame:
    """Manifest of a table, held against the rows with some fields ``replaced``.

    Every row is a leaf of its group: of null group like of any other. Null fields
    differ from empty ones. Rows with one id, and rows without (which come first),
    are leaves of their own, ordered by their digests. Fields are taken by name; other columns have no part in a leaf.
    """
    now = [F.col(f"`{c}`") for c in fields]
    then = [replaced.get(c, F.col(f"`{c}`")) for c in fields]
    rows = docs.select(
        group_key(group).alias("gkey"),
        F.col(f"`{id_col}`").alias("id"),
        row_digest(now).alias("leaf"),
        row_digest(then).alias("other"),
    )
    return verify(manifest(rows, ["id", "leaf"], staging), staging)
