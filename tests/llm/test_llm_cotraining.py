import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagestrata.llm import co_training as ct
from pagestrata.sources.tables import Staging

SF = "/root/testdata/sf0.1"


def documents(n=900, informative=True):
    rng = random.Random(6)
    rows, labels = [], []
    for k in range(n):
        good = rng.random() < 0.6
        words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(rng.randint(20, 90))]
        text = " ".join(words if good else [w.upper() + "!!" for w in words])
        host = rng.choice("abc" if good else "xyz") if informative and rng.random() < 0.95 else rng.choice("abcxyz")
        rows.append((k, text, host, "en", len(text), b"clash"))
        if k % 3 == 0:
            labels.append((k, int(good)))
    return rows, labels, {r[0]: r[1] == r[1].lower() for r in rows}


SCHEMA = "doc_id long, text string, source string, lang string, n_chars long, t binary"


def test_views_teach_each_other(spark):
    rows, labels, truth = documents()
    rows += [(None, None, None, None, None, None), (None, "", "a", None, 0, None), rows[4]]
    docs = spark.createDataFrame(rows, SCHEMA)
    marks = spark.createDataFrame(labels + [(None, 1), (1, None)], "doc_id long, quality int")
    with Staging(spark) as staging:
        out, views = ct.co_train(docs, marks, staging, least=20, precision=0.9)
        got = out.collect()
    assert len(got) == len(rows) and sum(views[0].given) > 50 and sum(views[1].given) > 50
    known = {k for k, _ in labels}
    right = [r["keep"] == truth[r["id"]] for r in got if r["id"] is not None and r["id"] not in known]
    assert np.mean(right) > 0.97
    meta = [(r["p_meta"] >= 0.5) == truth[r["id"]] for r in got if r["id"] is not None and r["id"] not in known]
    assert np.mean(meta) > 0.85
    assert all(0 <= r["score"] <= 1 for r in got)


def test_a_view_without_signal_is_silent(spark):
    rows, labels, truth = documents(informative=False)
    docs = spark.createDataFrame(rows, SCHEMA)
    with Staging(spark) as staging:
        out, views = ct.co_train(docs, spark.createDataFrame(labels, "doc_id long, quality int"), staging, meta=("lang",), least=20)
        got = out.collect()
    assert sum(views[0].given) == 0 and sum(views[1].given) > 0
    assert np.mean([r["keep"] == truth[r["id"]] for r in got]) > 0.97


@pytest.mark.parametrize("labels", [[], [(1, 1), (2, 1)]])
def test_without_labels_everything_stays(spark, labels):
    docs = spark.createDataFrame(documents(20)[0], SCHEMA)
    with Staging(spark) as staging:
        got = ct.co_train(docs, spark.createDataFrame(labels, "doc_id long, quality int"), staging)[0].collect()
        assert len(got) == 20 and all(r["keep"] and r["score"] == 0.5 for r in got)
        none = ct.co_train(docs.limit(0), spark.createDataFrame(labels, "doc_id long, quality int"), Staging(spark))[0]
        assert none.collect() == []


def test_held_out_accuracy_on_given_tables(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    test = labels.where(F.pmod(F.xxhash64(F.lit("test"), "doc_id"), F.lit(3)) == 0)
    with Staging(spark) as staging:
        out, _ = ct.co_train(docs, labels.join(test.select("doc_id"), "doc_id", "left_anti"), staging)
        rows = out.join(test, out["id"] == test["doc_id"]).select("keep", "quality").collect()
    kept = [r["keep"] for r in rows if r["quality"] == 1]
    dropped = [not r["keep"] for r in rows if r["quality"] == 0]
    print("good kept", np.mean(kept), "bad dropped", np.mean(dropped))
    assert np.mean(kept) > 0.98 and np.mean(dropped) > 0.8


def test_confidence_needs_precision():
    margin, y = np.arange(100.0), (np.arange(100) >= 50).astype(int)
    assert ct.sure(margin, y, 1.0, 10) == (49.0, 50.0)
    assert ct.sure(margin, np.tile([0, 1], 50), 0.9, 10) == (-np.inf, np.inf)


def test_logistic_regression():
    rng = np.random.default_rng(1)
    x = np.c_[rng.normal(size=(4000, 2)), np.ones(4000)]
    y = (rng.random(4000) < 1 / (1 + np.exp(-(x @ [2.0, -1.0, 0.5])))).astype(float)
    assert np.abs(ct.logistic(x, y, ridge=0.01) - [2.0, -1.0, 0.5]).max() < 0.25
