import math
import random
import re

import numpy as np
import pytest

import __spark_entry__  # noqa: F401  (tasks get the package as patched here)
from pagestrata.llm import block_max as bm
from pagestrata.llm.words import WordHashes
from pagestrata.sources.tables import Staging

WORDS = [f"w{k}" for k in range(40)] + ["été", "x1", "naïve"]


def terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(docs, items, most=10):
    held = [(i, terms(t)) for i, t in docs]
    held = [(i, w) for i, w in held if w]
    n_docs, n_terms = len(held), sum(len(w) for _, w in held)
    df = {}
    for _, w in held:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        scores = []
        for i, w in held:
            m = 100 - 90 + 90 * len(w) * n_docs // n_terms
            s = 0
            for t in set(terms(text)):
                if tf := w.count(t):
                    s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * tf // (1000 * tf + 8 * m))
            if s > 0:
                scores.append((-s, i is None, i if i is not None else 0, i))
        out += [(item, k + 1, s[3], -s[0]) for k, s in enumerate(sorted(scores, key=lambda s: s[:3])[:most])]
    return sorted(out, key=str)


def ours(spark, docs, items, most=10, kinds=("long", "long")):
    d = spark.createDataFrame(docs, f"doc_id {kinds[0]}, text string").repartition(5)
    q = spark.createDataFrame(items, f"item_id {kinds[1]}, text string")
    return sorted([tuple(r) for r in bm.rank(d, q, Staging(spark), most).collect()], key=str)


def corpus(seed, n=300):
    rng = random.Random(seed)
    said = lambda k: " ".join(rng.choices(WORDS, [1 / (1 + j) for j in range(len(WORDS))], k=k))
    docs = [(i, said(rng.randint(0, 60))) for i in range(n)]
    docs += [(n + k, docs[k % 7][1]) for k in range(30)] + [(n + 40, None), (n + 41, "... ,")]
    return docs, [(k, said(rng.randint(1, 12))) for k in range(15)] + [(90, None), (91, "unknown"), (92, "w0"), (93, "W1 w1 w1!")]


@pytest.mark.parametrize("seed, shard, block, most", [(1, 1 << 20, 64, 10), (2, 300, 4, 3), (3, 2000, 8, 1)])
def test_equals_brute_force(spark, monkeypatch, seed, shard, block, most):
    monkeypatch.setattr(bm, "SHARD_TERMS", shard)
    monkeypatch.setattr(bm, "POSTINGS", block)
    docs, items = corpus(seed)
    assert ours(spark, docs, items, most) == brute(docs, items, most)


def test_slices_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(bm, "SLICE_TERMS", 20)
    docs, items = corpus(4, 60)
    assert ours(spark, docs, items) == brute(docs, items)


def test_ids_of_other_types_none_and_repeated(spark):
    docs, items = corpus(5, 40)
    docs = [(None if k % 5 == 0 else i // 2, t) for k, (i, t) in enumerate(docs)]
    items = [(None if i % 2 else 7, t) for i, t in items]
    assert ours(spark, docs, items) == brute(docs, items)
    docs = [(None if i is None else f"d{i:03d}", t) for i, t in docs]
    assert ours(spark, docs, [(str(i), t) for i, t in items], kinds=("string", "string")) == brute(docs, [(str(i), t) for i, t in items])
    assert ours(spark, [], [(1, "a b")]) == ours(spark, [(1, "a b")], []) == []


def test_most_blocks_are_rejected_packed(monkeypatch):
    """With the threshold up, blocks of a frequent term stay packed unless a candidate lies in them."""
    monkeypatch.setattr(bm, "POSTINGS", 8)
    rng = random.Random(7)
    texts = [["the"] * rng.randint(1, 3) + ["f%d" % rng.randint(0, 5)] + (["rare"] if k in (50, 800) else []) for k in range(1000)]
    cache = WordHashes()
    import pyarrow as pa

    row = {c: v[0] for c, v in bm._shard(list(range(1000)), [cache.of([w.encode() for w in t]) for t in texts], pa.int64()).to_pydict().items()}
    shard = bm.Shard(row)
    m = bm.length_part(shard.sizes, 1000, int(shard.sizes.sum()))
    bounds = bm.gain(1, shard.heads["tf"], bm.length_part(shard.heads["size"], 1000, int(shard.sizes.sum())))
    at = shard.where(cache.of([b"the", b"rare"]))
    heap = bm.Heap(2)
    heap.add(np.array([10**6, 10**6]), [5000, 5001])
    bm.search_shard(shard, m, bounds, [(int(at[0]), 1), (int(at[1]), 6000)], heap)
    assert sorted(i for _, i in heap.rows) == [50, 800] and shard.unpacked <= 3


def test_blocks_round_trip():
    rng = np.random.default_rng(1)
    sizes = np.array([1, 2, 64, 1, 64])
    docs = np.concatenate([np.cumsum(rng.integers(1, wide, n)) for n, wide in zip(sizes, (9, 300, 70000, 9, 3))])
    tfs = np.concatenate([rng.integers(1, wide, n) for n, wide in zip(sizes, (9, 300, 9, 70000, 3))])
    stop = np.cumsum(sizes)
    raw, ends, widths = bm._pack(stop - sizes, stop, docs, tfs)
    for k, (a, b) in enumerate(zip(stop - sizes, stop)):
        got = bm._unpack(raw[ends[k - 1] if k else 0 : ends[k]].tobytes(), int(docs[b - 1]), b - a, int(widths[k, 0]))
        assert (got[0] == docs[a:b]).all() and (got[1] == tfs[a:b]).all()
