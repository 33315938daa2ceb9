"""Quality rules learned as a decision list by sequential covering.

On a bounded sample of labelled documents a rule is grown, one threshold on one
measure at a time, by the gain in information about bad documents; conditions
that do not hold up on documents kept apart are pruned; what the rule covers is
set aside and the next one is grown. The list becomes one Spark expression that
names the first rule a document meets. Measures come from one pass over whole
texts.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagestrata.llm.words import bounded_sample, map_texts

#: Most labelled documents that a list is learned from.
SAMPLE_ROWS = 20_000
SPACES, SYMBOLS = b" \t\n\x0b\f\r", b"#*$%&|<>"
UPPER, DIGITS = bytes(range(65, 91)), bytes(range(48, 58))
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RATES = ["mean_word", "symbols", "dup_lines", "repeats", "upper", "digits", "distinct", "marks", "line_words"]
FIELDS = ", ".join([f"{c} long" for c in COUNTS] + [f"{c} double" for c in RATES])


def repeated_words(ids: np.ndarray, most: int) -> int:
    """Words that lie in a 3-word window found twice or more; ``most``: above all ids."""
    n = len(ids) - 2
    if n < 2:
        return 0
    pair = ids[:-1] * most + ids[1:]
    if most >= 1 << 21:  # three ids do not fit into 64 bits
        pair = np.unique(pair, return_inverse=True)[1]
    _, which, count = np.unique(pair[:-1] * most + ids[2:], return_inverse=True, return_counts=True)
    twice = count[which] > 1
    inside = np.zeros(len(ids), bool)
    for k in range(3):
        inside[k : k + n] |= twice
    return int(inside.sum())


def measure(text: bytes) -> tuple:
    """COUNTS and RATES of a text; words are runs of anything but ASCII whitespace."""
    words = text.split()
    n = len(words)
    chars = len(text.decode()) - sum(text.count(c) for c in SPACES)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [x for x in text.split(b"\n") if x.strip()]
    dup = len(lines) - len(set(lines))
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    repeats = repeated_words(ids, len(known))
    upper, digits = (len(text) - len(text.translate(None, x)) for x in (UPPER, DIGITS))
    of = lambda a, b: a / b if b else 0.0
    marks = text.count(b"!") + text.count(b"?")
    return (
        n, chars, symbols, dup, repeats,
        of(chars, n), of(symbols, n), of(dup, len(lines)), of(repeats, n), of(upper, chars), of(digits, chars),
        of(len(known), n), of(marks, n), of(n, len(lines)),
    )


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (the document) and ``out`` with COUNTS and RATES."""

    def make():
        def of(texts):
            rows = list(zip(*map(measure, texts))) or [()] * len(COUNTS + RATES)
            types = [pa.int64()] * len(COUNTS) + [pa.float64()] * len(RATES)
            return [pa.array(x, t) for x, t in zip(rows, types)]

        return of

    return map_texts(docs, text, make, FIELDS)


@dataclass(frozen=True)
class Condition:
    measure: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(f"out.{self.measure}")
        return value > self.threshold if self.above else value <= self.threshold

    def holds(self, x: np.ndarray) -> np.ndarray:
        value = x[:, (COUNTS + RATES).index(self.measure)]
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.measure} {'>' if self.above else '<='} {self.threshold:g}"


Rule = tuple[Condition, ...]


def covers(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for c in rule:
        out &= c.holds(x)
    return out


def grow(x: np.ndarray, bad: np.ndarray, names: list[str], cuts: int, most: int) -> Rule:
    """Add the condition with the largest gain until only bad documents are covered."""
    rule: list[Condition] = []
    inside = np.ones(len(x), bool)
    while len(rule) < most:
        p, n = int((inside & bad).sum()), int((inside & ~bad).sum())
        if p == 0 or n == 0:
            break
        base, best, gain = np.log2(p / (p + n)), None, 1e-9
        for name in names:
            value = x[:, (COUNTS + RATES).index(name)]
            for t in np.unique(np.quantile(value[inside], np.linspace(0, 1, cuts))):
                for above in (True, False):
                    hit = inside & (value > t if above else value <= t)
                    a, b = int((hit & bad).sum()), int((hit & ~bad).sum())
                    g = a * (np.log2(a / (a + b)) - base) if a else 0.0
                    if g > gain:
                        best, gain = Condition(name, above, float(t)), g
        if best is None:
            break
        # Half-way to the next value: the same rows here, and as far as can be from either side.
        value = x[inside, (COUNTS + RATES).index(best.measure)]
        beyond = value[value > best.threshold]
        if len(beyond):
            best = replace(best, threshold=float((best.threshold + beyond.min()) / 2))
        rule.append(best)
        inside &= best.holds(x)
    return tuple(rule)


def prune(rule: Rule, x: np.ndarray, bad: np.ndarray) -> Rule:
    """The shortest beginning of a rule that does best on other documents."""

    def worth(k: int) -> float:
        hit = covers(rule[:k], x)
        p, n = (hit & bad).sum(), (hit & ~bad).sum()
        return (p - n) / (p + n) if p + n else -1.0

    return rule[: max(range(1, len(rule) + 1), key=lambda k: (worth(k), -k))] if rule else rule


def learn(
    x: np.ndarray,
    bad: np.ndarray,
    names: list[str] = RATES,
    rules: int = 16,
    conditions: int = 4,
    cuts: int = 48,
    precision: float = 0.97,
    least: int = 5,
) -> list[Rule]:
    """Rules for bad documents, in order. Every third row is kept apart for pruning.

    A rule counts if, on these rows, at least ``least`` documents that no earlier
    rule covers meet it and ``precision`` of them are bad; the first that does not ends
    the list, so that clean documents are left alone.
    """
    held = np.arange(len(x)) % 3 == 2
    out: list[Rule] = []
    while len(out) < rules:
        rule = prune(grow(x[~held], bad[~held], names, cuts, conditions), x[held], bad[held])
        hit = covers(rule, x)
        p, n = int((hit & held & bad).sum()), int((hit & held & ~bad).sum())
        if not rule or p < least or p < precision * (p + n):
            break
        out.append(rule)
        x, bad, held = x[~hit], bad[~hit], held[~hit]
    return out


def first_rule(rules: list[Rule]) -> Column:
    """Number of the first rule that a measured document meets, from 1; 0: none."""
    out = None
    for k, rule in enumerate(rules, 1):
        met = F.lit(True)
        for c in rule:
            met = met & c.column()
        out = F.when(met, k) if out is None else out.when(met, k)
    return F.lit(0) if out is None else out.otherwise(0)


def base_failed() -> Column:
    """Too short, or more than half of the words in repeated windows."""
    return (F.col("out.n_words") < 50) | (100 * F.col("out.n_repeat_words") > 50 * F.col("out.n_words"))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality") -> list[Rule]:
    """A list learned from at most SAMPLE_ROWS labelled documents that the base rules pass.

    Null ids and labels are left out; of several labels of a document the lowest
    counts. Without labels of both kinds the list is empty.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull())
    known = bounded_sample(known.groupBy(F.col(id_col).alias("id")).agg(F.min(label).alias("label")), "id", SAMPLE_ROWS)
    named = docs.select(F.col(id_col).alias("of"), F.col(text).alias("body"))
    picked = named.join(F.broadcast(known), F.col("of") == F.col("id")).select("id", "label", "body")
    rows = measures(picked, "body").where(~base_failed()).select("row.id", "row.label", "out.*")
    rows = rows.orderBy(F.xxhash64(F.lit("fit"), "id"), *COUNTS).limit(SAMPLE_ROWS).toPandas()
    if rows["label"].nunique() < 2:
        return []
    return learn(rows[COUNTS + RATES].to_numpy(np.float64), rows["label"].to_numpy() == 0)


def judge(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """``row``, ``out`` with the measures, ``base_failed``, ``rule`` and ``kept`` for every document.

    Null and empty texts have no words and fail the base rules. Repeated rows are
    judged alike; an empty table gives no rows.
    """
    judged = measures(docs, text).select("row", "out", base_failed().alias("base_failed"), first_rule(rules).alias("rule"))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
