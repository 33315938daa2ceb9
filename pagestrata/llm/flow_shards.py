"""Resharding by minimum-cost flow: old shards to new capacities, moving the fewest bytes.

Rows are gathered into blocks by a hash of their group, so a block lies in one
old shard. Spark sums bytes and rows by block; the driver sees blocks only. A
block too heavy for an even result is split by more bits of the group, and a
group that is too heavy by itself is split by row. A flow from old shards to
new ones (staying is free, moving a byte costs one) says how many bytes go
where; blocks are dealt out to meet it. Files of a shard that neither loses nor
gains a block are left alone where they are there; all others are written anew.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagestrata.sources.tables import Staging

#: Blocks by group, the part of all bytes from which a block is split by more bits of the group, and the part
#: from which a group is split by row. All bound what the driver sees.
BLOCKS, FINE, COARSE = 1024, 2048, 64
#: Text bytes in one written file.
FILE_BYTES = 64 << 20


def min_cost_flow(supply: list[int], room: list[int], cost: list[list[int]]) -> list[list[int]]:
    """Units from each old to each new shard, at the least cost; ``sum(room) >= sum(supply)``.

    Shortest augmenting paths in the residual graph. Both sides are shard lists.
    """
    n, m = len(supply), len(room)
    flow = [[0] * m for _ in range(n)]
    left, free = list(supply), list(room)
    while any(left):
        # Bellman-Ford from all old shards with units left; nodes 0..n-1 old, n..n+m-1 new.
        far = [0 if left[i] else None for i in range(n)] + [None] * m
        back: list[int | None] = [None] * (n + m)
        changed = True
        while changed:
            changed = False
            for i in range(n):
                for j in range(m):
                    if far[i] is not None and (far[n + j] is None or far[i] + cost[i][j] < far[n + j]):
                        far[n + j], back[n + j], changed = far[i] + cost[i][j], i, True
                    if flow[i][j] and far[n + j] is not None and (far[i] is None or far[n + j] - cost[i][j] < far[i]):
                        far[i], back[i], changed = far[n + j] - cost[i][j], n + j, True
        j = min((j for j in range(m) if free[j] and far[n + j] is not None), key=lambda j: far[n + j])
        path, at = [], n + j
        while back[at] is not None:
            path.append((back[at], at))
            at = back[at]
        units = min([left[at], free[j]] + [flow[b][a - n] for a, b in path if a >= n])
        for a, b in path:
            if a < n:
                flow[a][b - n] += units
            else:
                flow[b][a - n] -= units
        left[at] -= units
        free[j] -= units
    return flow


def deal_blocks(blocks: list[tuple[tuple, int, int]], flow: list[list[int]]) -> dict[tuple, int]:
    """New shard of each block ``(key, old shard, bytes)``: heavy ones first, each where most is still to go."""
    left = [list(f) for f in flow]
    out = {}
    for key, old, size in sorted(blocks, key=lambda b: (-b[2], b[0])):
        row = left[old]
        out[key] = j = max(range(len(row)), key=lambda j: (row[j], j == old, -j))
        row[j] -= size
    return out


def text_bytes(text: str) -> Column:
    """UTF-8 bytes of a text (null: none) and one for its end."""
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + 1


def keyed(docs: DataFrame, group: Column, row: Column) -> DataFrame:
    """``row`` (the document) with the bits that blocks are made of."""
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.xxhash64(group).alias("g"),
        F.xxhash64(F.lit("row"), row).alias("r"),
    )


class Plan:
    """Block of every row and new shard of every block."""

    def __init__(self, slim: DataFrame, n_old: int, capacity: list[float], staging: Staging):
        """``slim(old, g, r, size)``: old shard, hashes of group and row, bytes; ``capacity`` are shares."""
        self.spark, self.staging = slim.sparkSession, staging
        self.per_shard = max(1, BLOCKS // max(1, n_old))
        total = slim.agg(F.sum("size")).first()[0] or 0
        self.cuts: list[DataFrame] = []
        for bits, parts in (("g", FINE), ("r", COARSE)):
            limit = max(1, total // parts)
            sums = self.blocks(slim).groupBy(*self._names()).agg(F.sum("size").alias("size"))
            found = sums.where(F.col("size") > limit).collect()  # fewer rows than ``parts``
            names = self._names()
            rows = [(*[x[c] for c in names], -(-x["size"] // limit)) for x in found]
            types = ", ".join([f"x_{c} int" for c in names] + [f"parts_{bits} int"])
            self.cuts.append(self.spark.createDataFrame(rows, types))
        sums = self.blocks(slim).groupBy(*self._names()).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
        # At most BLOCKS blocks and the parts of those that were split, 2 * FINE and 2 * COARSE.
        found = [(tuple(x[c] for c in self._names()), x["size"], x["n"]) for x in sums.collect()]
        supply = [0] * max(n_old, 1)
        for key, size, _ in found:
            supply[key[0]] += size
        share = sum(capacity)
        self.room = [int(total * c / share) + 1 for c in capacity]
        cost = [[0 if i == j else 1 for j in range(len(self.room))] for i in range(len(supply))]
        self.flow = min_cost_flow(supply, self.room, cost)
        shard = deal_blocks([(key, key[0], size) for key, size, _ in found], self.flow)
        self.filled = set(shard.values())
        next_slot: dict[int, int] = defaultdict(int)
        rows = []
        self.touched: set[int] = set()
        self.moved = 0
        for key, size, n in sorted(found):
            old, j = key[0], shard[key]
            if j != old:
                self.touched |= {j, old}
                self.moved += size
            rows.append((*key, j, next_slot[j], max(1, -(-size // FILE_BYTES))))
            next_slot[j] += n
        types = ", ".join([f"x_{c} int" for c in self._names()] + ["shard int", "first long", "files int"])
        self.dealt = self.spark.createDataFrame(rows, types)

    def _names(self) -> list[str]:
        return ["old", "b0", "b1", "b2"][: len(self.cuts) + 2]

    def blocks(self, rows: DataFrame) -> DataFrame:
        """Adds the block's numbers; small tables of bounded size are all that is joined."""
        rows = rows.withColumn("b0", F.pmod("g", F.lit(self.per_shard)).cast("int"))
        for k, cuts in enumerate(self.cuts):
            names, bits = ["old", "b0", "b1"][: k + 2], "gr"[k]
            on = [F.col(c) == F.col(f"x_{c}") for c in names]
            rows = rows.join(F.broadcast(cuts), on, "left").drop(*[f"x_{c}" for c in names])
            by = F.shiftrightunsigned("g", 20) if bits == "g" else F.col("r")
            part = F.pmod(F.xxhash64(by), F.col(f"parts_{bits}")).cast("int")
            rows = rows.withColumn(f"b{k + 1}", F.coalesce(part, F.lit(0))).drop(f"parts_{bits}")
        return rows

    def place(self, rows: DataFrame) -> DataFrame:
        """Adds ``shard``, ``first`` (slot of the block's first row) and ``file``, a part of the block."""
        on = [F.col(c) == F.col(f"x_{c}") for c in self._names()]
        placed = self.blocks(rows).join(F.broadcast(self.dealt), on).drop(*[f"x_{c}" for c in self._names()])
        return placed.withColumn("file", F.pmod(F.xxhash64("r"), F.col("files")).cast("int")).drop("files")


def reshard(
    docs: DataFrame,
    staging: Staging,
    old_shards: int,
    new_shards: int = 8,
    capacity: list[float] | None = None,
    id_col: str = "doc_id",
    text: str = "text",
) -> tuple[Plan, DataFrame]:
    """The plan and ``(row, size, old, shard, slot)`` of every document.

    The old shard is the group's hash by ``old_shards``, groups are equal texts
    (null is one more), and new shards get equal shares of the bytes unless
    ``capacity`` says otherwise. A group stays in one shard unless it weighs more
    than 1/64 of all bytes; then its rows are told apart by id, and by number where
    many have no id or the same one. Ids can be of any type. Sizes are near equal: heavy blocks are dealt out
    first, and the many light ones, about 1/2048 of all bytes, even them out. Slots count the rows of a shard from 0. Repeated rows
    each have a slot; empty tables have none.
    """
    rows = keyed(docs, F.col(text), F.col(id_col))
    old = F.pmod(F.shiftrightunsigned("g", 40), F.lit(old_shards)).cast("int")
    rows = rows.withColumn("size", text_bytes(f"row.{text}")).withColumn("old", old)
    slim = staging.store(rows.select("old", "g", "r", "size"), "sizes")
    rows, slim = tell_apart(rows, slim, staging)
    plan = Plan(slim, old_shards, capacity or [1.0] * new_shards, staging)
    block = [*plan._names(), "file"]
    # Slots within a block go by part; the parts' counts come from the slim table.
    parts = plan.place(slim).groupBy(*block).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(*plan._names()).orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    parts = staging.store(parts, "parts")
    placed = plan.place(rows).join(parts, block)
    own = Window.partitionBy("shard", *block).orderBy(F.col(f"row.{id_col}"), "r", "g")
    slot = (F.col("first") + F.col("before") + F.row_number().over(own) - 1).alias("slot")
    return plan, placed.select("row", "size", "old", "shard", slot)


def tell_apart(rows: DataFrame, slim: DataFrame, staging: Staging) -> tuple[DataFrame, DataFrame]:
    """Both with a new ``r`` for the rows of groups that agree in ``g`` and ``r`` and hold 1/FINE of all bytes."""
    total = slim.agg(F.sum("size")).first()[0] or 0
    heavy = slim.groupBy("g", "r").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
    heavy = heavy.where((F.col("size") * FINE > total) & (F.col("n") > 1)).select("g", "r").collect()  # less than FINE
    if not heavy:
        return rows, slim
    # A small table, so that neither side of the join is shuffled.
    heavy = F.broadcast(rows.sparkSession.createDataFrame(heavy, "g long, r long"))
    # Stored once, so a row's number is the same whenever it is read.
    number = F.xxhash64(F.lit("number"), F.monotonically_increasing_id())
    numbered = staging.store(rows.join(heavy, ["g", "r"], "left_semi").withColumn("r", number), "numbered")
    rows = rows.join(heavy, ["g", "r"], "left_anti").unionByName(numbered)
    slim = slim.join(heavy, ["g", "r"], "left_anti").unionByName(numbered.select(slim.columns))
    return rows, slim


def free_name(name: str, taken: list[str]) -> str:
    """``name``, with underscores in front while another column has it (letter case does not tell columns apart)."""
    while name.lower() in {c.lower() for c in taken}:
        name = "_" + name
    return name


def write_shards(plan: Plan, placed: DataFrame, folder: str) -> DataFrame:
    """Write the shards whose rows changed as ``folder/shard=k``; the folders of the others stay as they are.

    A shard that has rows and no folder yet is written too, and the folder of one
    that has lost all its rows goes, so the folder may hold the old shards or be new.
    Returns ``(row, size, shard, slot)`` as read back from the files of all
    shards. Where the documents have a column of such a name, the file's own
    one begins with an underscore.
    """
    fields = placed.schema["row"].dataType
    size, slot, shard = (free_name(n, fields.names) for n in ("size", "slot", "shard"))
    at = {k: plan.staging._path(f"{folder}/{shard}={k}") for k in plan.touched | plan.filled}
    due = plan.touched | {k for k in plan.filled if not at[k][1].exists(at[k][0])}
    changed = placed.where(F.col("shard").isin(sorted(due))) if due else placed.limit(0)
    changed = changed.select("row.*", F.col("size").alias(size), F.col("slot").alias(slot), F.col("shard").alias(shard))
    changed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(shard).parquet(folder)
    for path, fs in (at[k] for k in plan.touched - plan.filled):
        fs.delete(path, True)
    schema = T.StructType([*fields, T.StructField(size, T.LongType()), T.StructField(slot, T.LongType()), T.StructField(shard, T.IntegerType())])
    written = placed.sparkSession.read.schema(schema).parquet(folder)
    row = F.struct(*[F.col(f"`{c}`") for c in fields.names]).alias("row")
    return written.select(row, F.col(size).alias("size"), F.col(shard).alias("shard"), F.col(slot).alias("slot"))
