import hashlib
import random

import numpy as np
import pytest

import __spark_entry__  # noqa: F401  (tasks get the package as patched here)
from pagestrata.llm import bwt_merge as bm
from pagestrata.sources.tables import Staging


def brute(docs):
    first = {}
    for i, t in docs:
        b = (t or "").encode()
        for k in range(len(b) - 49 if i is not None else 0):
            w = b[k : k + 50]
            first[w] = min(i, first.get(w, i))
    out = []
    for i, t in docs:
        b = (t or "").encode()
        gone = [False] * len(b)
        for k in range(len(b) - 49 if i is not None else 0):
            if first[b[k : k + 50]] < i:
                gone[k : k + 50] = [True] * 50
        kept = bytes(x for x, g in zip(b, gone) if not g)
        edges = [k for k in range(len(b) + 1) if (k > 0 and gone[k - 1]) != (k < len(b) and gone[k])]
        out.append((i, len(b), sum(gone), list(zip(edges[::2], edges[1::2])), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def ours(spark, docs, kind="long", **options):
    df = spark.createDataFrame(docs, f"doc_id {kind}, text string")
    rows = bm.remove_repeats(df, Staging(spark), **options).collect()
    digest = lambda b: b.hex() if options.get("digests") else hashlib.sha256(b).hexdigest()
    found = [(r.id, r.n_bytes, r.n_removed, [tuple(s) for s in r.spans], digest(bytes(r.kept))) for r in rows]
    return sorted(found, key=str)


def corpus(seed, n=80):
    rng = random.Random(seed)
    words = ["alpha", "beta", "the", "of", "été", "x1", "zed", "naïve", "q", "lorem ipsum", "\n", "\x00"]
    docs = []
    for i in range(n):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(0, 120)))
        if docs and rng.random() < 0.6:
            other = rng.choice(docs)[1] or ""
            a = rng.randint(0, max(0, len(other) - 1))
            text = text[: rng.randint(0, len(text))] + other[a : a + rng.randint(40, 300)] + text
        if rng.random() < 0.1:
            text = "a" * rng.randint(0, 200)
        key = rng.choice([None, *range(60)]) if rng.random() < 0.3 else i
        docs.append((key, text if rng.random() > 0.03 else None))
    return docs


@pytest.mark.parametrize("seed, shard_bytes", [(1, None), (2, 3000), (3, 500)])
def test_equals_brute_force(spark, seed, shard_bytes):
    docs = corpus(seed)
    want = brute(docs)
    assert sum(r[2] for r in want) > 1000
    assert ours(spark, docs, shard_bytes=shard_bytes, digests=seed == 1) == want


def test_edges(spark):
    a = "".join(chr(97 + k % 26) for k in range(49))
    docs = [(1, a), (2, a), (3, a + "!"), (4, "x" + a + "!"), (4, a + "!y"), (5, a + "!" + a + "!"), (None, a + "!"), (6, ""), (7, None)]
    got = {(r[0], r[1]): r[2:4] for r in ours(spark, docs)}
    assert got[1, 49] == got[2, 49] == (0, []) and got[3, 50] == (0, [])  # too short, and the first to have it
    assert got[4, 51] in ((50, [(1, 51)]), (50, [(0, 50)])) and got[5, 100] == (100, [(0, 100)])
    assert got[None, 50] == got[6, 0] == got[7, 0] == (0, [])
    assert ours(spark, []) == []


def test_ids_of_other_types_and_columns_that_clash(spark):
    docs = [(None if i is None else f"{i:03d}", t) for i, t in corpus(4, 30)]
    assert ours(spark, docs, "string", shard_bytes=2000) == brute(docs)
    rows = [(1, "b" * 60, 7, "r"), (2, "b" * 55, 8, None)]
    df = spark.createDataFrame(rows, "doc_id int, text string, part int, row string").withColumnRenamed("part", "rid")
    out = bm.remove_repeats(df, Staging(spark)).orderBy("id").collect()
    assert [(r["row"]["rid"], r["row"]["row"], bytes(r["kept"])) for r in out] == [(7, "r", b"b" * 60), (8, None, b"")]


def test_long_text_is_searched_whole(spark):
    rng = np.random.default_rng(5)
    long = bytes(rng.integers(97, 123, 2_500_000)).decode()
    cuts = [bm.PIECE - 25, 2 * bm.PIECE - 1, len(long) - 60]
    docs = [(1, long), *[(k + 2, long[c : c + 60]) for k, c in enumerate(cuts)]]
    assert [r[2] for r in ours(spark, docs)] == [0, 60, 60, 60]


def test_merge_gives_smallest_ids_of_equal_windows():
    rng = np.random.default_rng(3)
    pool = rng.integers(97, 99, (6, bm.COLUMNS)).astype(np.uint8)
    transforms, ids, low, rows = [], [], [], []
    for _ in range(4):
        n = 10
        mine = pool[rng.integers(0, 6, n)]
        mine[:, 40] = rng.integers(97, 99, n)
        cell = np.zeros(n, np.int64)
        transforms.append(bm.transform(mine, cell))
        rows.append(mine)
        ids += rng.integers(0, 100, n).tolist()
        low += rng.integers(0, 5, n).tolist()
    rows, ids, low = np.concatenate(rows), np.array(ids), np.array(low)
    got = bm.merge(transforms, ids, low, np.full(len(ids), bm.LEFT))
    for k in range(len(ids)):
        for c in range(bm.LEFT + 1):
            equal = [ids[j] for j in range(len(ids)) if low[j] <= c and (rows[j, c : c + 50] == rows[k, c : c + 50]).all()]
            assert got[k, c] == (min(equal) if low[k] <= c else bm.FAR)
