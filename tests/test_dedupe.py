import random

import pytest
from pyspark.sql import functions as F

from pagestrata.operators import dedupe
from pagestrata.plans.report import run_report
from pagestrata.schema import COLUMNS


def test_align_and_ensure(spark):
    df = spark.createDataFrame([("x", 1, "y")], "UF string, extra int, Ato string")
    out = dedupe.align_columns(df)
    assert out.columns == COLUMNS and out.first()[:4] == ("y", "", "", "x")
    assert dedupe.ensure_columns(df, ["Ato", "Fonte"]).columns == ["UF", "extra", "Ato", "Fonte"]


def test_keep_first_equals_a_loop_for_any_partitioning(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["a", "b", None, ""]), rng.choice(["x", None])) for i in rng.sample(range(500), 200)]
    expected, seen = set(), set()
    for i, k1, k2 in sorted(rows):
        if (k1, k2) not in seen:
            seen.add((k1, k2))
            expected.add(i)
    df = spark.createDataFrame(rows, "i int, k1 string, k2 string")
    for parts in (1, 7):
        kept = dedupe.keep_first(df.repartition(parts), ["k1", "k2"], "i")
        assert {r.i for r in kept.collect()} == expected
    assert {r.i for r in dedupe.keep_first(kept, ["k1", "k2"], "i").collect()} == expected
    assert tuple(dedupe.count_removed(df, ["k1", "k2"]).first()) == (200, len(expected), 200 - len(expected))


def test_keep_first_prunes_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id", "id % 3 AS k")
    plan = dedupe.keep_first(df, ["k"], "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_count_removed_tells_keys_apart(spark):
    rows = [("a", "bc"), ("ab", "c"), (None, "abc"), ("", "abc"), ("abc", None), ("1:a", ""), ("", "1:a")]
    df = spark.createDataFrame(rows, "x string, y string")
    assert tuple(dedupe.count_removed(df, ["x", "y"]).first()) == (7, 7, 0)
    assert tuple(dedupe.count_removed(df.limit(0), ["x", "y"]).first()) == (0, 0, 0)


@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
def test_skewed_joins_are_split(spark, how):
    """A plain join: adaptive execution splits the partition of a hot key."""
    low = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    left = spark.range(60_000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("k"), F.uuid().alias("v"))
    right = spark.range(60_000).select(F.col("id").alias("k"), F.uuid().alias("w"))
    for k, v in low.items():
        spark.conf.set(k, v)
    try:
        out = left.repartition(6).join(right, "k", how)
        n = {"left_anti": 0}.get(how, 60_000)
        assert out.agg(F.count("*")).first()[0] == n
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in low:
            spark.conf.unset(k)
    assert "skewed" in plan


def test_report_wording(spark):
    counts = spark.sql("SELECT date'2025-11-05' AS run_date, 3L AS removed")
    row = run_report(counts, "X").first()
    assert row.subject == "[X] Base extraída (2025-11-05) - Duplicados removidos: 3"
    assert row.body.startswith("Olá,\n\nA base de atos foi gerada e deduplicada com sucesso em 2025-11-05.\n")
    assert "(ignorando 'Data de extração'): 3.\n" in row.body and row.body.endswith("Att.,\nRobô X")
    other = run_report(counts, "X", enclosed="100 % em anexo.").first()
    assert "\n\n100 % em anexo.\n\nAtt.," in other.body
