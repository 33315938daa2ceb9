import random
import re

import numpy as np
import pytest

from pagestrata.llm import positional_index as pi
from pagestrata.sources.tables import Staging

VOCABULARY = ["alpha", "beta", "the", "the", "the", "of", "of", "été", "x1", "zed", "naïve", "q"]


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, size, slop):
    windows = []
    for i, t in items:
        w = words(t)
        if i is not None and w:
            windows += [(i, w[k : k + size]) for k in range(max(1, len(w) - size + 1))]
    count = {}
    for _, t in docs:
        for w in words(t):
            count[w] = count.get(w, 0) + 1
    out = []
    for i, t in docs:
        w, exact, hit = words(t), [], set()
        for item, win in windows:
            for k in range(len(w) - len(win) + 1):
                if w[k : k + len(win)] == win:
                    exact.append((item, k, len(win)))
                    hit |= set(range(k, k + len(win)))
        out.append((i, len(w), len(hit), sorted(exact)))
    return out


def corpus(seed, n=60):
    rng = random.Random(seed)
    items = [(k, " ".join(rng.choices(VOCABULARY, k=rng.randint(1, 16)))) for k in range(14)]
    items += [(14, None), (15, ""), (16, "--"), (None, "the of"), (17, items[3][1]), (17, items[3][1]), (18, "Été, x1")]
    docs = [(0, None), (1, ""), (2, "..."), (None, items[0][1])]
    for k in range(3, n):
        parts = [" ".join(rng.choices(VOCABULARY, k=rng.randint(0, 25)))]
        if rng.random() < 0.4:
            parts.insert(rng.randint(0, 1), (rng.choice(items)[1] or "").upper())
        docs.append((k, ", ".join(parts)))
    return docs + [docs[8]], items


def run(spark, docs, items, **kw):
    frame = spark.createDataFrame([(*d, "z", 1) for d in docs], "doc_id long, text string, terms string, at int")
    bench = spark.createDataFrame([(*i, "z") for i in items], "item_id long, text string, slice string")
    with Staging(spark) as staging:
        return pi.decontaminate(frame, bench, staging, **kw).collect()


def rows(found):
    return sorted(
        (str(r["id"]), r["n_words"], r["n_hit"], sorted((m["item_id"], m["start"], m["length"]) for m in r["exact"])) for r in found
    )


@pytest.mark.parametrize("size,block,slices", [(10, 1 << 17, 200_000), (4, 40, 9), (1, 1, 200_000)])
def test_exact_matches(spark, monkeypatch, size, block, slices):
    monkeypatch.setattr(pi, "BLOCK_TOKENS", block)
    monkeypatch.setattr(pi, "SLICE_WINDOWS", slices)
    docs, items = corpus(2)
    found = run(spark, docs, items, size=size)
    want = sorted((str(i), n, h, e) for i, n, h, e in brute(docs, items, size, 15))
    assert rows(found) == want and any(r[2] for r in want)


def test_proximity(spark):
    item = "gold silver copper iron lead"
    docs = [
        (1, "gold silver copper iron lead"),
        (2, "lead some iron and copper or silver but gold"),
        (3, "gold silver copper iron " + "far " * 20 + "lead"),
        (4, "gold silver copper iron"),
    ]
    found = {r["id"]: r for r in run(spark, docs, [(7, item)], size=5, slop=9)}
    assert [len(found[k]["exact"]) for k in (1, 2, 3, 4)] == [1, 0, 0, 0]
    assert [len(found[k]["near"]) for k in (1, 2, 3, 4)] == [0, 1, 0, 0]
    assert found[2]["near"][0]["item_id"] == 7 and found[2]["n_hit"] == 0


def test_proximity_stays_in_the_document(spark):
    docs = [(1, "gold silver copper"), (2, "iron lead gold")]
    assert all(not r["near"] and not r["exact"] for r in run(spark, docs, [(7, "gold silver copper iron lead")], size=5))


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a b")]) == []
    found = run(spark, [(1, "a b")], [])
    assert [(r["n_words"], r["n_hit"], r["exact"]) for r in found] == [(2, 0, [])]


def test_postings_hold_every_token(spark):
    docs, _ = corpus(5)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    total = 0
    for row in pi.build_index(frame).collect():
        block = pi.Block(row.asDict())
        total += len(block.positions)
        assert sorted(block.positions.tolist()) == list(range(int(block.starts[-1])))
        for k in range(len(block.terms)):
            assert (np.diff(block.list(k)) > 0).all()
    assert total == sum(len(words(t)) for _, t in docs)


def test_a_long_document_is_one_block(spark):
    text = " ".join(f"w{k % 997}" for k in range(200_000)) + " needle in a haystack"
    found = run(spark, [(1, text), (2, "x")], [(3, "w996 w0 w1")], size=3)
    assert rows(found)[0][1] == 200_004 and len(rows(found)[0][3]) == 200
