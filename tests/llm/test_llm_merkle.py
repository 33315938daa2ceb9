import hashlib
import zlib

import numpy as np
import pytest

import __spark_entry__  # noqa: F401  (tasks get the package as patched here)
from pagestrata.llm import merkle_midstates as mm
from pagestrata.sources.tables import Staging

COLUMNS = "doc_id {}, source string, lang string, n_chars int, text string, n int"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    fields = [*row[:4], text]
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields])


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([sha(*now[k : k + 3]) for k in range(0, len(now), 3)])
    return levels


def way(levels, at, changed):
    others, now = [], changed
    for level in levels[:-1]:
        run = level[at - at % 3 : at - at % 3 + 3]
        others += [x for k, x in enumerate(run) if k != at % 3]
        run[at % 3] = now
        now, at = sha(*run), at // 3
    return others, now


def brute(rows):
    groups = {}
    for r in rows:
        even = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
        then = r[4].replace("\n", "") if even and r[4] is not None else r[4]
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] if r[0] is not None else 0, leaf(r, r[4]), leaf(r, then), r[0]))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(groups[s], key=lambda x: x[:4])]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    out = []
    for at, s in enumerate(names):
        for k, x in enumerate(sorted(groups[s], key=lambda x: x[:4])):
            low, now = way(trees[s], k, x[3])
            high, now = way(top, at, now)
            out.append((x[4], x[2], trees[s][-1][0], top[-1][0], sha(*low, *high), now))
    return sorted(out, key=str)


def audited(spark, rows, kind="long"):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(rows, COLUMNS.format(kind))
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    text = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    out = mm.audit(docs, Staging(spark), {"text": text})
    return sorted([tuple(r) for r in out.select("id", "leaf", "subroot", "root", "proof", "folded").collect()], key=str)


def rows_of(n, source, start=0):
    return [(k, source, "de", k % 7, f"line {k}\nend é" * (k % 4), k) for k in range(start, start + n)]


def test_hash_is_sha256():
    words = mm.as_words(b"".join(hashlib.sha256(b"%d" % k).digest() for k in range(7)))
    digests = [mm.as_bytes(w).hex() for w in words]
    up, sizes, _, children = mm.raise_level(words, np.array([4, 3]))
    want = [sha(*digests[0:3]), sha(digests[3]), sha(*digests[4:7])]
    assert [mm.as_bytes(u).hex() for u in up] == want and list(sizes) == [2, 1] and list(children) == [3, 1, 3]


@pytest.mark.parametrize("sizes", [(1,), (10, 1, 28)])
def test_equals_brute_force(spark, sizes):
    rows = [r for k, n in enumerate(sizes) for r in rows_of(n, "ünb c"[: k + 1], 100 * k)]
    assert audited(spark, rows) == brute(rows)


def test_nulls_repeats_and_ids_as_text(spark):
    rows = rows_of(5, None) + rows_of(5, "") + [(None, "a", None, None, None, 1)] * 2 + [(3, "a", None, 1, "", 2)] * 3 + [(None, None, None, None, None, None)]
    assert audited(spark, rows) == brute(rows)
    named = [(None if r[0] is None else f"k{r[0]}", *r[1:]) for r in rows]
    want = sorted([tuple(r) for r in brute_by_text(named)], key=str)
    assert audited(spark, named, "string") == want
    assert audited(spark, []) == []


def brute_by_text(rows):
    order = {v: k for k, v in enumerate(sorted({r[0] for r in rows if r[0] is not None}))}
    groups = {}
    for r in rows:
        even = r[0] is not None and zlib.crc32(r[0].encode()) % 2 == 0
        then = r[4].replace("\n", "") if even and r[4] is not None else r[4]
        groups.setdefault(r[1], []).append((order.get(r[0], -1), leaf(r, r[4]), leaf(r, then), r[0]))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        groups[s].sort(key=lambda x: x[:3])
    trees = {s: tree([x[1] for x in groups[s]]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    for at, s in enumerate(names):
        for k, x in enumerate(groups[s]):
            low, now = way(trees[s], k, x[2])
            high, now = way(top, at, now)
            yield x[3], x[1], trees[s][-1][0], top[-1][0], sha(*low, *high), now


@pytest.mark.parametrize("n", [27, 100])
def test_trees_of_several_rounds(spark, monkeypatch, n):
    monkeypatch.setattr(mm, "HEIGHT", 2)
    monkeypatch.setattr(mm, "BLOCK", 9)
    monkeypatch.setattr(mm, "CHUNK", 5)
    rows = rows_of(n, "a") + rows_of(9, "b", 1000) + rows_of(4, "c", 2000) + rows_of(10, None, 3000)
    rows += [r for k in range(12) for r in rows_of(1, f"s{k}", 4000 + k)]
    assert audited(spark, rows) == brute(rows)
