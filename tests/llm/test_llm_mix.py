import hashlib
import random
import re

import pytest

from pagestrata.llm import token_mix as tm
from pagestrata.sources.tables import Staging

SCHEMA = "doc_id long, text string, source string, hash string, size int, below string"


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute(rows, weights, share, most):
    sources = sorted({r[2] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    size = {s: sum(words(r[1]) for r in rows if r[2] == s) for s in sources}
    weight = {s: weights[k % len(weights)] for k, s in enumerate(sources)}
    target, full = {}, set()
    while True:
        left = share * sum(size.values()) - sum(most * size[s] for s in full)
        total = sum(weight[s] for s in sources if s not in full)
        target = {s: most * size[s] if s in full else left * weight[s] / total for s in sources}
        more = {s for s in sources if target[s] > most * size[s]}
        if not more:
            break
        full |= more
    out = []
    for s in sources:
        own = [r for r in rows if r[2] == s]
        whole = int(target[s] / size[s]) if size[s] else 0
        rest, run = target[s] - whole * size[s], 0
        hashed = {}
        for r in own:
            key = hashlib.md5((r[1] or "").encode()).hexdigest() if r[0] is None else r[0]
            h = int(hashlib.md5(f"mix:{key}".encode()).hexdigest()[:15], 16)
            hashed.setdefault(h, []).append(r)
        for h in sorted(hashed):
            for r in hashed[h]:  # rows that share a hash are equal here
                run += words(r[1])
                near = 2 * run - words(r[1]) < 2 * rest or run <= rest
                copies = whole + (1 if whole < most and near else 0)
                out.append((r[0], r[1], s, words(r[1]), size[s], round(target[s], 6), copies))
    return out


def documents(seed=1, n=400):
    rng = random.Random(seed)
    rows = [(None, "a b", "s1"), (None, None, "s1"), (1, None, None), (2, "", "s2"), (3, " \n", "empty"), (4, None, "empty")]
    for k in range(5, n):
        source = rng.choice(["s0"] * 6 + ["s1", "s2", "Z", "é", None])
        rows.append((k, "w\x1c \t" * rng.choice([1, 3, 10, 200]), source))
    rows += [rows[20]] * 3
    return [(*r, "x", 1, "y") for r in rows]


def mixed(spark, rows, **kw):
    docs = spark.createDataFrame(rows, SCHEMA)
    with Staging(spark) as staging:
        found = tm.mix(docs, staging, **({"weights": [3, 1, 2]} | kw)).collect()
    return [(r["row"]["doc_id"], r["row"]["text"], r["row"]["source"], r["size"], r["source_size"], round(r["target"], 6), r["copies"]) for r in found]


@pytest.mark.parametrize("share", [0.4, 1.5, 1.9])
def test_mix(spark, share):
    rows = documents()
    assert sorted(map(str, mixed(spark, rows, share=share))) == sorted(map(str, brute(rows, [3, 1, 2], share, 2.0)))


def test_close_to_targets(spark):
    found = mixed(spark, documents())
    for s in {r[2] for r in found}:
        own = [r for r in found if r[2] == s]
        assert abs(sum(r[3] * r[6] for r in own) - own[0][5]) <= max(r[3] for r in own) / 2 + 1e-6
    assert max(r[6] for r in found) <= 2


def test_smaller_budgets_are_nested(spark):
    rows = documents(3)
    copies = [{(r[0], r[1]): r[6] for r in mixed(spark, rows, share=s)} for s in (0.3, 0.6, 0.9)]
    assert all(a[k] <= b[k] for a, b in zip(copies, copies[1:]) for k in a)


def test_named_weights(spark):
    found = mixed(spark, documents(), weights={"s0": 1.0, None: 1.0}, share=0.2)
    assert {r[2] for r in found if r[3] * r[6]} == {"s0", None}


def test_taken_repeats_rows(spark):
    docs = spark.createDataFrame(documents(), SCHEMA)
    with Staging(spark) as staging:
        out = tm.mix(docs, staging, weights=[3, 1, 2])
        want = sorted(str(tuple(r["row"])) for r in out.collect() for _ in range(r["copies"]))
        got = tm.taken(out)
        assert got.columns == docs.columns and sorted(str(tuple(r)) for r in got.collect()) == want


def test_no_documents(spark):
    assert mixed(spark, []) == []


def test_too_many_sources(spark, monkeypatch):
    monkeypatch.setattr(tm, "MAX_SOURCES", 3)
    with pytest.raises(ValueError):
        mixed(spark, documents())


def test_targets_stop_at_most():
    got = tm.targets([("a", 10), ("b", 100), ("c", 1000)], [3, 1, 2], 1.5, 2.0)
    assert got[0] == 20 and got[1] == 200 and abs(sum(got) - 1665) < 1e-9
    assert tm.targets([("a", 0)], [1], 1.5, 2.0) == [0.0] and tm.targets([], [1], 1.5, 2.0) == []
