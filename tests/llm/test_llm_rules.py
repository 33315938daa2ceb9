import random
import re

import numpy as np
import pytest

from pagestrata.llm import rule_list as rl

WORD = r"[^\x20\x09-\x0D]+"


def brute(text):
    text = text or ""
    words = re.findall(WORD, text)
    lines = text.split("\n")
    dup = sum(1 for k, x in enumerate(lines) if re.search(WORD, x) and x in lines[:k])
    grams = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    inside = {k + j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)


@pytest.mark.parametrize("seed", range(25))
def test_counts(seed):
    rng = random.Random(seed)
    bits = ["a", "b ", "é", "# ", "\n", "\n", " ", "\t", "x\x1cy", "\x85", "a b\n", "c*|", "\r\n", "<&> "]
    text = "".join(rng.choices(bits, k=rng.randint(0, 120)))
    assert rl.measure(text.encode())[:5] == brute(text)


def test_many_different_words():
    ids = np.r_[np.arange(3_000_000), [0, 1, 2]]
    assert rl.repeated_words(ids, 3_000_000) == 6


def noisy(rng, bad):
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(rng.randint(60, 200))]
    if bad == 1:
        words = [w + "***" for w in words]
    elif bad == 2:
        words = [w.upper() + "!!" for w in words]
    return " ".join(words)


def sample(seed, n):
    rng = random.Random(seed)
    kinds = [rng.choice([0, 0, 0, 1, 2]) for _ in range(n)]
    return [noisy(rng, k) for k in kinds], np.array(kinds) > 0


def test_learned_rules_hold_on_other_documents():
    texts, bad = sample(1, 600)
    x = np.array([rl.measure(t.encode()) for t in texts], float)
    rules = rl.learn(x, bad)
    assert rules
    texts, bad = sample(2, 400)
    x = np.array([rl.measure(t.encode()) for t in texts], float)
    caught = np.zeros(len(x), bool)
    for r in rules:
        caught |= rl.covers(r, x)
    assert (caught == bad).mean() > 0.98 and not (caught & ~bad).mean() > 0.01


def test_thresholds_lie_between_the_classes():
    x = np.zeros((90, len(rl.COUNTS + rl.RATES)))
    x[:30, 6] = 0.5  # symbols
    (rule,) = rl.learn(x[np.random.default_rng(1).permutation(90)], x[np.random.default_rng(1).permutation(90), 6] > 0)
    assert [str(c) for c in rule] == ["symbols > 0.25"]


def test_nothing_to_learn():
    x = np.random.default_rng(1).random((300, len(rl.COUNTS + rl.RATES)))
    labels = np.random.default_rng(2).random(300) < 0.2
    assert rl.learn(x, labels) == [] and rl.learn(x, labels & False) == [] and rl.learn(x[:0], labels[:0]) == []


def test_pruning_drops_what_does_not_hold():
    x = np.zeros((100, len(rl.COUNTS + rl.RATES)))
    x[:, 0] = np.arange(100)
    x[:, 1] = np.random.default_rng(1).random(100)
    good = rl.Condition("n_words", True, 49.5)
    assert rl.prune((good, rl.Condition("word_chars", True, 0.5)), x, x[:, 0] > 49.5) == (good,)


def test_expression_equals_the_list(spark):
    texts, bad = sample(5, 300)
    rows = [(k, t, "c", 1) for k, t in enumerate(texts)] + [(None, None, "c", 1), (900, "", "c", 1), (901, "short", "c", 1), (0, texts[0], "c", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, rule int")
    labels = spark.createDataFrame([(k, int(not b)) for k, b in enumerate(bad)] + [(None, 1), (3, None), (5, 1), (5, 0)], "doc_id long, quality int")
    rules = rl.fit(docs, labels)
    assert rules
    for r in rl.judge(docs, rules).collect():
        m = rl.measure((r["row"]["text"] or "").encode())
        x = np.array([m], float)
        first = next((k for k, rule in enumerate(rules, 1) if rl.covers(rule, x)[0]), 0)
        failed = m[0] < 50 or 100 * m[4] > 50 * m[0]
        assert (r["rule"], r["base_failed"], r["kept"]) == (first, failed, not failed and first == 0)
    assert rl.judge(docs.limit(0), rules).collect() == []
    assert rl.fit(docs, labels.limit(0)) == [] and all(r["rule"] == 0 for r in rl.judge(docs, []).collect())
