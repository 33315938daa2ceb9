import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from pagestrata.llm.line_runs import LineRuns, deduplicate_lines, line_keys
from pagestrata.sources.tables import Staging

LONG = ["The same long line, number %d, again" % k for k in range(12)]


def key(line):
    line = line.strip(" \t\n\v\f\r")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line)


def brute(rows, min_docs=3):
    holders = defaultdict(list)
    for n, (i, text) in enumerate(rows):
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= 20:
                holders[k].append(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for x in lines:
            held = holders.get(key(x), [])
            ids = [h for h in held if h is not None]
            if len(held) >= min_docs and ids and i != max(ids):
                continue
            kept.append(x)
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def documents():
    rng = random.Random(4)
    rows = [(0, None), (1, ""), (2, "\n\n"), (3, "short\nshort\nshort"), (None, LONG[0] + "\n" + LONG[1]), (None, LONG[0])]
    for k in range(4, 60):
        lines = [rng.choice(LONG) if rng.random() < 0.4 else f"a line of its own {k} {rng.random()}" for _ in range(rng.randint(1, 8))]
        lines = [("  " + x.upper() + "\t\r") if rng.random() < 0.2 else x for x in lines]
        rows.append((k, "\n".join(lines)))
    rows.append((60, "é" * 20))
    rows += [(61, "É" * 20), (62, "é" * 20), (63, "é" * 20), (64, "é" * 19), (65, "é" * 19), (66, "é" * 19)]
    rows.append(rows[10])
    return rows


@pytest.mark.parametrize("batches", [1, 3, 9])
def test_lines(spark, batches):
    rows = documents()
    docs = spark.createDataFrame([(*r, "k", 7) for r in rows], "doc_id long, text string, k1 string, n_lines int")
    with Staging(spark) as staging:
        out = deduplicate_lines(docs, staging, batches=batches, buckets=3)
        got = [(r["row"]["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in out.collect()]
    order = lambda x: (x[0] is None, x[0] or 0, x[1:])
    assert sorted(got, key=order) == sorted(brute(rows), key=order)


def test_batches_in_any_order(spark):
    rows = documents()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    keys = line_keys(docs, "doc_id", "text", 20).cache()
    want = {(r["k1"], r["k2"]): r["keeper"] for r in keys.groupBy("k1", "k2").agg(F.count("*").alias("n"), F.max("id").alias("keeper")).where("n >= 3").collect()}
    for order in ([0, 1, 2, 3, 4], [4, 0, 3, 1, 2]):
        with LineRuns(Staging(spark), buckets=2, fanout=2) as runs:
            for k in order:
                runs.add(keys.where(F.pmod(F.coalesce("id", F.lit(0)), F.lit(5)) == k))
            assert len(runs.levels) > 1 and all(len(x) < 2 for x in runs.levels)  # compacted
            assert {(r["k1"], r["k2"]): r["keeper"] for r in runs.repeated().collect()} == want
            names = sum(runs.levels, [])
        assert not any(spark.catalog.tableExists(n) for n in names)
    keys.unpersist()


def test_a_run_is_not_shuffled_again(spark):
    docs = spark.createDataFrame(documents(), "doc_id long, text string")
    keys = line_keys(docs, "doc_id", "text", 20)
    with LineRuns(Staging(spark), buckets=8) as runs:
        runs.add(keys)
        table = runs.levels[0][0]
        plan = spark.table(table).groupBy("k1", "k2").count()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan


def test_settled_lines_make_no_new_entries(spark):
    docs = spark.createDataFrame([(k, LONG[0]) for k in range(10, 20)], "doc_id long, text string")
    older = spark.createDataFrame([(k, LONG[0]) for k in range(5)], "doc_id long, text string")
    with LineRuns(Staging(spark), buckets=2) as runs:
        runs.add(line_keys(docs, "doc_id", "text", 20))
        runs.add(line_keys(older, "doc_id", "text", 20))
        assert spark.table(runs.levels[0][1]).count() == 0


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    with Staging(spark) as staging:
        assert deduplicate_lines(docs, staging, buckets=2).collect() == []


def test_whole_text_of_many_lines(spark):
    text = "\n".join(LONG * 3000)
    rows = [(k, text) for k in range(4)]
    with Staging(spark) as staging:
        out = deduplicate_lines(spark.createDataFrame(rows, "doc_id long, text string"), staging, buckets=2)
        got = {r["row"]["doc_id"]: (hashlib.sha256(r["text"].encode()).digest(), r["n_dropped"]) for r in out.collect()}
    assert got == {k: (hashlib.sha256(b"").digest(), 36_000) for k in range(3)} | {3: (hashlib.sha256(text.encode()).digest(), 0)}
