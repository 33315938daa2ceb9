"""A quality classifier by co-training of two views: text content and page metadata.

The text view sees hashed words and the shape of a text, the metadata view
hashed values of columns such as source, language and length. Features of all
documents are computed once and stored, a few hundred bytes each however long
the text. In every round each view scores all unlabelled documents, and those it
is sure of (by its precision on held-out labels) become labels for the other
view. At the end each view is calibrated on the held-out labels, and the
product of the views' odds scores every document.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagestrata.llm.rule_list import RATES, measure
from pagestrata.llm.words import bounded_sample, parts, text_or_empty, utf8
from pagestrata.sources.tables import Staging

#: Most labelled documents, and most pseudo-labels of one class that one view hands on in a round.
LABELLED_ROWS, PSEUDO_ROWS = 20_000, 2_000
#: Hashed words and hashed metadata values, one byte each.
WORD_DIMS, META_DIMS = 256, 64
#: Divisors that bring the measures of ``rule_list`` near 0 to 1.
SCALE = dict(zip(RATES, [16, 4, 1, 1, 1, 1, 1, 1, 200]))


class Buckets(dict):
    """Bucket of each word met, kept up to a number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 300_000:
            self.clear()
        self[word] = k = xxhash.xxh32_intdigest(word, 3) % WORD_DIMS
        return k


def text_features(text: bytes, buckets: Buckets) -> np.ndarray:
    """Square roots of the shares of word buckets, then the measures, as bytes."""
    words = text.split()
    found = np.fromiter(map(buckets.__getitem__, words), np.int64, len(words))
    share = np.sqrt(np.bincount(found, minlength=WORD_DIMS) / max(1, len(words)))
    rates = np.array([v / SCALE[c] for c, v in zip(RATES, measure(text)[-len(RATES) :])] + [np.log10(1 + len(words)) / 6])
    return np.clip(np.r_[share, rates] * 255, 0, 255).astype(np.uint8)


def meta_features(values: list[str | None]) -> np.ndarray:
    out = np.zeros(META_DIMS, np.uint8)
    for k, v in enumerate(values):
        out[xxhash.xxh32_intdigest(f"{k}={v}".encode(), 5) % META_DIMS] = 255
    return out


def featurise(docs: DataFrame, id_col: str, text: str, meta: list[str]) -> DataFrame:
    """``(id, t, m)``: features of both views as bytes. Numbers go by their power of two."""
    names = dict(docs.dtypes)
    numeric = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
    value = lambda c: F.floor(F.log2(F.abs(F.col(c)) + 1)) if names[c].startswith(numeric) else F.col(c)
    slim = docs.select(
        F.col(id_col).alias("id"),
        text_or_empty(text).alias("text"),
        F.array(*[value(c).cast("string") for c in meta]).alias("meta"),
    )
    id_type = slim.schema["id"].dataType.simpleString()

    def run(batches):
        buckets = Buckets()
        for batch in parts(batches, lambda b: b.column(1)):
            t = [text_features(x, buckets).tobytes() for x in utf8(batch.column(1))]
            m = [meta_features(x).tobytes() for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(t, pa.binary()), pa.array(m, pa.binary())], names=["id", "t", "m"]
            )

    return slim.mapInArrow(run, f"id {id_type}, t binary, m binary")


def matrix(rows: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1) / np.float32(255) if rows else np.zeros((0, 1))
    return np.hstack([x, np.ones((len(x), 1), np.float32)])  # the last one is for the intercept


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 12) -> np.ndarray:
    """Weights of a ridge logistic regression, by Newton's method; the last weight is free of ridge."""
    x = x.astype(np.float64)
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + penalty * w
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def sure(margin: np.ndarray, y: np.ndarray, precision: float, least: int) -> tuple[float, float]:
    """Margins below and above which held-out labels are 0 or 1 with this precision; infinite where none is."""

    def cut(order: np.ndarray, label: int) -> float:
        right = np.cumsum(y[order] == label) / np.arange(1, len(order) + 1)
        ok = np.flatnonzero((right >= precision) & (np.arange(1, len(order) + 1) >= least))
        return float(margin[order[ok[-1]]]) if len(ok) else float("nan")

    order = np.argsort(margin, kind="stable")
    low, high = cut(order, 0), cut(order[::-1], 1)
    return (-np.inf if np.isnan(low) else low), (np.inf if np.isnan(high) else high)


@dataclass
class View:
    column: str
    x: list[bytes]
    y: list[int]
    w: np.ndarray | None = None
    #: slope and intercept that turn a margin into log odds
    scale: tuple[float, float] = (1.0, 0.0)
    #: pseudo-labels that the other view gave, by round
    given: list[int] = field(default_factory=list)

    def train(self) -> None:
        self.w = logistic(matrix(self.x), np.array(self.y, float))

    def calibrate(self, x: list[bytes], y: np.ndarray) -> None:
        margin = matrix(x) @ self.w
        a, b = logistic(np.c_[margin, np.ones(len(y))], y, ridge=1e-3)
        self.scale = (max(0.0, float(a)), float(b)) if a > 0 else (0.0, float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))))


def score(features: DataFrame, views: list[View], extra: str = "") -> DataFrame:
    """Adds each view's margin, ``t_margin`` and ``m_margin``."""
    weights = [v.w for v in views]
    schema = ", ".join(f"{c} {t}" for c, t in features.dtypes) + ", t_margin double, m_margin double"

    def run(batches):
        for batch in batches:
            margins = [matrix(batch.column(c).to_pylist()) @ w if batch.num_rows else [] for c, w in zip("tm", weights)]
            arrays = [*batch.columns, *[pa.array(np.asarray(m, float), pa.float64()) for m in margins]]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, "t_margin", "m_margin"])

    return features.mapInArrow(run, schema)


def co_train(
    docs: DataFrame,
    labels: DataFrame,
    staging: Staging,
    id_col: str = "doc_id",
    text: str = "text",
    meta: tuple[str, ...] = ("source", "lang", "n_chars"),
    label: str = "quality",
    rounds: int = 3,
    precision: float = 0.98,
    least: int = 50,
) -> tuple[DataFrame, list[View]]:
    """``(id, p_text, p_meta, score, keep)`` of every document, and the trained views.

    At most LABELLED_ROWS labelled documents are used, a quarter of them held
    out for confidence and calibration. Every unlabelled document is scored in
    every round; of those that a view is sure of, at most PSEUDO_ROWS of each
    class go to the other view, other ones each round. A view that is never sure hands on nothing, and
    one whose margins say nothing about the held-out labels is calibrated to the
    share of good documents, so it does not move the score. Null texts count as
    empty, null metadata as a value of its own. Null ids are scored, not used for
    training. Without labels of both kinds every document scores 0.5 and stays.
    """
    missing = [c for c in meta if c not in docs.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    features = staging.store(featurise(docs, id_col, text, list(meta)), "features")
    known = labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull())
    known = known.groupBy(F.col(id_col).alias("of")).agg(F.min(label).cast("int").alias("y"))
    marked = staging.store(features.join(known, features["id"] == known["of"], "left").select("id", "t", "m", "y"), "marked")
    sample = bounded_sample(marked.where("y IS NOT NULL"), "id", LABELLED_ROWS)
    rows = sample.orderBy(F.xxhash64(F.lit("fit"), "id"), "t", "m").limit(LABELLED_ROWS).collect()
    y = np.array([r["y"] for r in rows], int)
    held = np.arange(len(rows)) % 4 == 3
    views = [View(c, [r[c] for r, h in zip(rows, held) if not h], y[~held].tolist()) for c in "tm"]
    kept_out = [[r[c] for r, h in zip(rows, held) if h] for c in "tm"]
    if len(set(y[~held])) < 2 or len(set(y[held])) < 2:
        half = [F.lit(0.5).alias(c) for c in ("p_text", "p_meta", "score")]
        return marked.select("id", *half, F.lit(True).alias("keep")), views
    unlabelled = marked.where("y IS NULL").drop("y")
    for turn in range(rounds):
        for v in views:
            v.train()
        scored = score(unlabelled, views)
        for k, v in enumerate(views):
            low, high = sure(matrix(kept_out[k]) @ v.w, y[held], precision, least)
            other, margin, gained = views[1 - k], F.col(f"{v.column}_margin"), 0
            for where, found in ((margin <= low, 0), (margin >= high, 1)):
                if np.isfinite(low if found == 0 else high):
                    for r in bounded_sample(scored.where(where).select("id", "t", "m"), "id", PSEUDO_ROWS, seed=turn).collect():
                        other.x.append(r[other.column])
                        other.y.append(found)
                        gained += 1
            other.given.append(gained)
        if not any(v.given[-1] for v in views):
            break
    for k, v in enumerate(views):
        v.train()
        v.calibrate(kept_out[k], y[held].astype(float))
    prior = float(np.log((y[held].sum() + 1) / (len(y[held]) - y[held].sum() + 1)))
    odds = [F.lit(v.scale[0]) * F.col(f"{v.column}_margin") + F.lit(v.scale[1]) for v in views]
    sigmoid = lambda o: F.lit(1.0) / (F.lit(1.0) + F.exp(-o))
    out = score(marked.select("id", "t", "m"), views).select(
        "id", sigmoid(odds[0]).alias("p_text"), sigmoid(odds[1]).alias("p_meta"), sigmoid(odds[0] + odds[1] - F.lit(prior)).alias("score")
    )
    return out.withColumn("keep", F.col("score") >= 0.5), views
