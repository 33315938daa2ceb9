"""Operators on ids of any type, missing ids, and large groups of equal texts."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pagestrata.llm import flow_shards, rule_list, token_mix
from pagestrata.llm.line_runs import LineRuns, deduplicate_lines
from pagestrata.sources.tables import Staging

TYPES = {"long": lambda k: k, "string": lambda k: f"doc-{k:05d}", "half null": lambda k: None if k % 2 else k, "null": lambda k: None}


def rows_of(kind, n=1200):
    """Two thirds of the rows are one text."""
    rng = random.Random(2)
    shared = "one long line that everybody has\n" + "same " * 100
    return [(TYPES[kind](k), shared if k % 3 else f"own {k} " + "w " * rng.randint(1, 300), "s") for k in range(n)]


def documents(spark, kind):
    return spark.createDataFrame(rows_of(kind), f"doc_id {'string' if kind == 'string' else 'long'}, text string, source string")


@pytest.mark.parametrize("kind", TYPES)
def test_shards_are_near_equal(spark, kind):
    docs = documents(spark, kind)
    with Staging(spark) as staging:
        plan, placed = flow_shards.reshard(docs, staging, 5, 8)
        rows = flow_shards.write_shards(plan, placed, f"{staging.folder}/shards").collect()
    want = Counter((r[0], r[1]) for r in rows_of(kind))
    assert Counter((r["row"]["doc_id"], r["row"]["text"]) for r in rows) == want
    by_shard = Counter()
    for r in rows:
        by_shard[r["shard"]] += r["size"]
    even = sum(by_shard.values()) / 8
    assert len(by_shard) == 8 and all(abs(n - even) <= 0.02 * even + 700 for n in by_shard.values())
    for k in by_shard:
        slots = sorted(r["slot"] for r in rows if r["shard"] == k)
        assert slots == list(range(len(slots)))


@pytest.mark.parametrize("kind", [*TYPES, "one id"])
@pytest.mark.parametrize("share", [0.3, 1.4])
def test_mix_meets_targets(spark, kind, share):
    docs = documents(spark, "long").withColumn("doc_id", F.lit(7)) if kind == "one id" else documents(spark, kind)
    with Staging(spark) as staging:
        out = token_mix.mix(docs, staging, [1.0], share=share)
        rows = out.collect()
    with Staging(spark) as staging:
        again = token_mix.mix(docs, staging, [1.0], share=share).collect()
    key = lambda rs: Counter((r["row"]["doc_id"], r["row"]["text"], r["copies"]) for r in rs)
    assert len(rows) == 1200 and key(rows) == key(again)
    taken = sum(r["size"] * r["copies"] for r in rows)
    assert abs(taken - rows[0]["target"]) <= max(r["size"] for r in rows) / 2


@pytest.mark.parametrize("kind", TYPES)
def test_lines(spark, kind):
    docs = documents(spark, kind)
    ids = [r[0] for r in rows_of(kind) if r[1].startswith("one") and r[0] is not None]
    with Staging(spark) as staging:
        rows = deduplicate_lines(docs, staging, buckets=3).collect()
    assert len(rows) == 1200
    kept = [r["row"]["doc_id"] for r in rows if r["row"]["text"].startswith("one") and r["n_dropped"] == 0]
    assert kept == [max(ids)] if ids else len(kept) == 800
    assert all(r["n_dropped"] in (0, 2) for r in rows)


def test_settled_lines_are_left_out_of_later_runs(spark, monkeypatch):
    docs = documents(spark, "long").withColumn("text", F.lit("one long line that everybody has"))
    written = []
    write = LineRuns._write

    def counted(self, run, level):
        write(self, run, level)
        if level == 0:
            written.append(self.spark.table(self.levels[0][-1]).count())

    monkeypatch.setattr(LineRuns, "_write", counted)
    with Staging(spark) as staging:
        assert deduplicate_lines(docs, staging, buckets=3).where("n_dropped = 0").count() == 1
    assert written == [1, 0, 0, 0]


def test_rules_with_an_id_called_id(spark):
    rows = [(k, "good words stand here " * 30 + str(k) if k % 2 else "# * | bad " * 40 + str(k)) for k in range(200)]
    docs = spark.createDataFrame(rows, "id long, text string")
    labels = docs.select("id", (F.col("id") % 2).cast("int").alias("quality"))
    assert isinstance(rule_list.fit(docs, labels, id_col="id"), list)
