import itertools
import random
import zlib

import pytest

from pagestrata.llm import flow_shards as fs
from pagestrata.sources.tables import Staging


def least_cost(supply, room, cost):
    """Least cost by trying all ways to deal out single units."""
    best = None
    units = [i for i, n in enumerate(supply) for _ in range(n)]
    for to in itertools.product(range(len(room)), repeat=len(units)):
        if all(to.count(j) <= room[j] for j in range(len(room))):
            c = sum(cost[i][j] for i, j in zip(units, to))
            best = c if best is None else min(best, c)
    return best


@pytest.mark.parametrize("seed", range(8))
def test_flow_costs_least(seed):
    rng = random.Random(seed)
    supply = [rng.randint(0, 3) for _ in range(3)]
    room = [rng.randint(0, 3) for _ in range(2)]
    room.append(max(0, sum(supply) - sum(room)))
    cost = [[rng.randint(0, 4) for _ in room] for _ in supply]
    flow = fs.min_cost_flow(supply, room, cost)
    assert [sum(f) for f in flow] == supply and all(sum(f[j] for f in flow) <= room[j] for j in range(len(room)))
    assert sum(flow[i][j] * cost[i][j] for i in range(3) for j in range(len(room))) == least_cost(supply, room, cost)


def test_only_the_excess_moves():
    flow = fs.min_cost_flow([100, 20, 0], [40, 40, 40], [[int(i != j) for j in range(3)] for i in range(3)])
    assert flow[0][0] == 40 and flow[1][1] == 20 and sum(flow[0][1:]) == 60


def run(spark, rows, new=8, **kw):
    docs = spark.createDataFrame(rows, "doc_id long, text string, size string, slot int")
    with Staging(spark) as staging:
        plan, placed = fs.reshard(docs, staging, old_shards=5, new_shards=new, **kw)
        return plan, [(r["row"]["doc_id"], r["row"]["text"], r["size"], r["shard"], r["slot"], r["old"]) for r in placed.collect()]


def documents(n=900):
    rng = random.Random(7)
    rows = [(None, None), (None, "x"), (1, None), (2, ""), (2, "")]
    rows += [(k, "copy of one text " * 6) for k in range(1000, 1250)]  # one large group
    rows += [(k, "tiny group") for k in range(2000, 2004)]
    rows += [(k, "group of some weight " * 4) for k in range(3000, 3040)]
    rows += [(k, f"é{k} " * rng.randint(1, 200)) for k in range(3, n)]
    return [(*r, "clash", 0) for r in rows]


def test_bytes_are_near_equal_and_slots_gapless(spark):
    rows = documents()
    plan, out = run(spark, rows)
    assert sorted((r[0] or -1, r[1] or "") for r in out) == sorted((r[0] or -1, r[1] or "") for r in rows)
    assert all(size == len((t or "").encode()) + 1 for _, t, size, *_ in out)
    by = {j: sum(r[2] for r in out if r[3] == j) for j in range(8)}
    assert max(by.values()) - min(by.values()) < 0.02 * sum(by.values()) / 8
    for j in range(8):
        slots = sorted(r[4] for r in out if r[3] == j)
        assert slots == list(range(len(slots)))
    assert len({r[3] for r in out if r[1] == "tiny group"}) == 1
    assert len({r[3] for r in out if r[1] and r[1].startswith("group of")}) == 1
    old = [sum(r[2] for r in out if r[5] == i) for i in range(5)]
    least = sum(max(0, size - room) for size, room in zip(old, plan.room))
    moved = sum(r[2] for r in out if r[3] != r[5])
    assert moved == plan.moved and least <= moved + 100 and moved <= least * 1.03


def test_parts_of_a_block_keep_slots_gapless(spark, monkeypatch):
    monkeypatch.setattr(fs, "FILE_BYTES", 300)
    monkeypatch.setattr(fs, "BLOCKS", 16)
    monkeypatch.setattr(fs, "FINE", 32)
    monkeypatch.setattr(fs, "COARSE", 16)
    _, out = run(spark, documents(400))
    for j in range(8):
        slots = sorted(r[4] for r in out if r[3] == j)
        assert slots == list(range(len(slots)))


def test_capacities(spark):
    _, out = run(spark, documents(), new=2, capacity=[3.0, 1.0])
    by = [sum(r[2] for r in out if r[3] == j) for j in range(2)]
    assert abs(by[0] / sum(by) - 0.75) < 0.01


def test_reruns_agree(spark):
    rows = documents(200)
    first = run(spark, rows)[1]
    random.Random(1).shuffle(rows)
    assert sorted(map(str, first)) == sorted(map(str, run(spark, rows)[1]))


def test_no_documents(spark):
    assert run(spark, [])[1] == []


def test_only_affected_shards_are_written(spark, tmp_path):
    rows = documents(300)
    docs = spark.createDataFrame(rows, "doc_id long, text string, size string, slot int")
    folder = str(tmp_path / "shards")
    with Staging(spark) as staging:
        plan, placed = fs.reshard(docs, staging, old_shards=5)
        written = fs.write_shards(plan, placed, folder)
        assert plan.touched == set(range(8))
        assert sorted((zlib.crc32((r["row"]["text"] or "").encode()), r["shard"], r["slot"]) for r in written.collect()) == sorted(
            (zlib.crc32((r["row"]["text"] or "").encode()), r["shard"], r["slot"]) for r in placed.collect()
        )
        before = {p.name: sorted(f.name for f in p.iterdir()) for p in (tmp_path / "shards").glob("shard=*")}
        plan.touched = {2}
        fs.write_shards(plan, placed, folder)
        after = {p.name: sorted(f.name for f in p.iterdir()) for p in (tmp_path / "shards").glob("shard=*")}
    assert {k for k in before if before[k] != after[k]} == {"shard=2"}


def content(rows):
    return sorted((str(r["row"]["doc_id"]), str(r["row"]["text"]), r["size"], r["shard"], r["slot"]) for r in rows)


@pytest.mark.parametrize("n", range(1, 11))
def test_few_documents_are_all_read_back(spark, tmp_path, n):
    docs = spark.createDataFrame([(k, f"{k}" * 100) for k in range(n)], "doc_id long, text string")
    with Staging(spark) as staging:
        plan, placed = fs.reshard(docs, staging, old_shards=5)
        written = content(fs.write_shards(plan, placed, str(tmp_path / "shards")).collect())
        assert written == content(placed.collect()) and [r[0] for r in written] == [str(k) for k in range(n)]


def test_old_shards_are_replaced(spark, tmp_path):
    docs = spark.createDataFrame(documents(300), "doc_id long, text string, other string, more int")
    folder = str(tmp_path / "shards")
    with Staging(spark) as staging:
        plan, placed = fs.reshard(docs, staging, old_shards=5, new_shards=2)
        placed.select("row.*", "size", "slot", placed["old"].alias("shard")).write.partitionBy("shard").parquet(folder)
        assert content(fs.write_shards(plan, placed, folder).collect()) == content(placed.collect())
