import random

import numpy as np
import pytest
import xxhash

from pagestrata.llm import simhash_pivots as sp
from pagestrata.sources.tables import Staging

WORDS = [f"w{k}" for k in range(400)]


def brute_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    grams = [b" ".join(words[k : k + 4]) for k in range(len(words) - 3)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows):
    """rows: (id, fingerprint) -> component id by row."""
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i, (_, a) in enumerate(rows):
            for j, (_, b) in enumerate(rows):
                if (a ^ b).bit_count() <= 4 and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    out = []
    for k in label:
        ids = [r[0] for r, x in zip(rows, label) if x == k and r[0] is not None]
        out.append(min(ids) if ids else None)
    return out


def texts(seed, n):
    rng = random.Random(seed)
    out = [None, "", " \n", "one", "one two three", "ONE Two three"]
    while len(out) < n:
        if len(out) > 8 and rng.random() < 0.6:
            words = (rng.choice(out[6:]) or "x").split()
            for _ in range(rng.randint(0, 2)):
                words[rng.randrange(len(words))] = rng.choice(WORDS)
            out.append(" ".join(words))
        else:
            out.append(" ".join(rng.choices(WORDS, k=rng.randint(30, 150))))
    return out


@pytest.mark.parametrize("text", ["", "a", "A b", "a b c d", "é É z\x1fy b c", "x " * 50 + "y z"])
def test_fingerprint(text):
    assert sp.fingerprint(text.encode()) == brute_fingerprint(text)


def test_fingerprint_in_chunks(monkeypatch):
    text = " ".join(random.Random(1).choices(WORDS, k=500))
    monkeypatch.setattr(sp, "CHUNK", 7)
    assert sp.fingerprint(text.encode()) == brute_fingerprint(text)


@pytest.mark.parametrize("cell_rows,small", [(4096, 16), (6, 2)])
def test_near_duplicates(spark, monkeypatch, cell_rows, small):
    monkeypatch.setattr(sp, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(sp, "SMALL", small)
    rows = [(k if k % 17 else None, t, "x", k) for k, t in enumerate(texts(3, 160))]
    rows += [rows[20], rows[30]]  # repeated rows
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, cell int")
    with Staging(spark) as staging:
        found = sp.near_duplicates(docs, staging).collect()
    prints = [(r[0], brute_fingerprint(r[1])) for r in rows]
    want = [(i, f, c) for (i, f), c in zip(prints, brute_components(prints))]
    got = [(r["id"], r["fp"] % (1 << 64), r["component_id"]) for r in found]
    order = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(got, key=order) == sorted(want, key=order)
    assert len({c for *_, c in want}) < len(want)  # some are linked


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    with Staging(spark) as staging:
        assert sp.near_duplicates(docs, staging).collect() == []


def test_near_pairs_share_a_cell():
    rng = random.Random(5)
    masks = sp.block_masks(6, 4)
    assert len(masks) == 15
    for _ in range(500):
        flips = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(flips & m == 0 for m in masks)


def test_pivots_discard_no_link():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 2**63, 300, np.uint64)
    b = a.copy()
    for _ in range(4):
        b ^= np.uint64(1) << rng.integers(0, 64, 300, np.uint64)
    d = [np.bitwise_count(x[:, None] ^ sp.references()).astype(np.int8) for x in (a, b)]
    i = np.arange(300)
    assert len(sp._near(np.r_[a, b], np.vstack(d), i, i + 300, 4)) == 300


def test_forest_joins_what_links_join():
    rng = random.Random(9)
    centre = rng.getrandbits(64)
    fp = {centre}
    while len(fp) < 120:
        fp.add(rng.choice(sorted(fp)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    fp = np.array(sorted(fp), np.uint64)
    d = np.bitwise_count(fp[:, None] ^ sp.references()).astype(np.int8)
    a, b = sp._forest(fp, d, 4)
    assert len(a) == len(fp) - 1 and max((int(x) ^ int(y)).bit_count() for x, y in zip(a, b)) <= 4


def test_components_of_a_long_path(spark):
    n = 200
    edges = spark.createDataFrame([((k * 7) % n, ((k + 1) * 7) % n) for k in range(n - 1)] + [(500, 501), (501, 500)], "a long, b long")
    with Staging(spark) as staging:
        found = {r["node"]: r["root"] for r in sp.components(edges, staging).collect()}
    assert found == {k: 0 for k in range(1, n)} | {501: 500}
