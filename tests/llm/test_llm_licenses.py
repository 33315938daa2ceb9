import random

import numpy as np
import pytest

from pagestrata.llm import license_bands as lb
from pagestrata.llm.words import WordHashes, alnum_words, shingles

WORDS = ["wuu", "vee", "xaa", "yoo", "zii", "licensed", "under", "the", "of"]


def grams(words, size=5):
    size = min(size, len(words))
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} if words else set()


def brute(text, templates=lb.TEMPLATES):
    """Templates of which some stretch of the text, up to REACH times as long, holds enough shingles."""
    words = alnum_words(text.encode())
    out = set()
    for name, t in templates.items():
        want = grams(alnum_words(t.encode()))
        width = lb.REACH * len(want)
        found = [tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))]
        for k in range(max(1, len(found) - width + 1)):
            if len(want & set(found[k : k + width])) >= lb.THRESHOLD * len(want):
                out.add(name)
                break
    return out


def noise(rng, n):
    return " ".join(rng.choices(WORDS, k=n))


@pytest.mark.parametrize("name", lb.TEMPLATES)
@pytest.mark.parametrize("at", [0, 3, 57])
def test_template_in_a_text(name, at):
    rng = random.Random(at)
    text = noise(rng, at) + "\n" + lb.TEMPLATES[name].upper() + "\n" + noise(rng, 83)
    library, cache = lb.Library(lb.TEMPLATES), WordHashes()
    found = library.matches([cache.of(alnum_words(text.encode()))])[0]
    mine = [f for f in found if f[0] == name]
    n = len(alnum_words(lb.TEMPLATES[name].encode()))
    assert mine == [(name, at, at + n, 1.0)] and {f[0] for f in found} == brute(text)


def test_many_texts_together():
    rng = random.Random(3)
    texts = []
    for _ in range(150):
        parts = [noise(rng, rng.randint(0, 40))]
        for _ in range(rng.randint(0, 2)):
            words = rng.choice(list(lb.TEMPLATES.values())).split()
            for _ in range(rng.randint(0, 1)):
                words[rng.randrange(len(words))] = "changed"
            parts += [" ".join(words), noise(rng, rng.randint(0, 30))]
        texts.append(" ".join(parts))
    cache = WordHashes()
    found = lb.Library(lb.TEMPLATES).matches([cache.of(alnum_words(t.encode())) for t in texts])
    for text, f in zip(texts, found):
        got, want = {x[0] for x in f}, brute(text)
        assert want == got
        words = alnum_words(text.encode())
        for name, a, b, share in f:
            t = grams(alnum_words(lb.TEMPLATES[name].encode()))
            assert share >= lb.THRESHOLD and abs(len(t & grams(words[a:b])) / len(t) - share) < 1e-9


def hashed(*texts):
    cache = WordHashes()
    return [cache.of(alnum_words(t.encode())) for t in texts]


def test_neighbours_do_not_matter():
    rng = random.Random(5)
    words = lb.TEMPLATES["MIT-grant"].split()
    text = " ".join([noise(rng, 11), *words[:32], noise(rng, 30), *words[32:], noise(rng, 9)])
    library = lb.Library(lb.TEMPLATES)
    alone = library.matches(hashed(text))[0]
    assert [f[0] for f in alone] == ["MIT-grant"]
    for n in range(64):
        before, after = noise(rng, n), noise(rng, 64 - n)
        assert library.matches(hashed(before, text, after))[1] == alone
    assert library.matches(hashed(text, ""))[0] == library.matches(hashed("", text))[1] == alone


@pytest.mark.parametrize("name", ["MIT-grant", "GPL-header", "Apache-2.0-header", "MPL-2.0-header"])
def test_recall_with_edits(name):
    """Whatever holds enough shingles is found: words put in at one place, changed, or left out."""
    rng = random.Random(name)
    library, texts = lb.Library(lb.TEMPLATES), []
    for _ in range(60):
        for n in (0, 10, 30, 60):
            words = lb.TEMPLATES[name].split()
            at = rng.randrange(len(words))
            texts.append(" ".join([noise(rng, rng.randint(0, 70)), *words[:at], noise(rng, n), *words[at:], noise(rng, 70)]))
        words = lb.TEMPLATES[name].split()
        words[rng.randrange(len(words))] = "changed"
        del words[rng.randrange(len(words))]
        texts.append(noise(rng, rng.randint(0, 70)) + " " + " ".join(words))
    found = library.matches(hashed(*texts))
    want = [name in brute(t) for t in texts]
    got = [name in {f[0] for f in x} for x in found]
    assert sum(want) > 200 and got == want


def test_copies_in_a_row_are_told_apart():
    text = lb.TEMPLATES["GPL-header"]
    n = len(alnum_words(text.encode()))
    found = [f for f in lb.Library(lb.TEMPLATES).matches(hashed(" ".join([text] * 3)))[0] if f[0] == "GPL-header"]
    assert found == [("GPL-header", k * n, (k + 1) * n, 1.0) for k in range(3)]


def test_clean_texts_match_nothing():
    rng = random.Random(8)
    cache = WordHashes()
    texts = [noise(rng, 500) for _ in range(40)]
    assert not any(lb.Library(lb.TEMPLATES).matches([cache.of(alnum_words(t.encode())) for t in texts]))


def test_bands_guarantee():
    for m in range(1, 400):
        assert lb.guarantee(m, lb.block_of(m)) > 0.9999


def test_shingles():
    h = np.array([1, 2, 3, 1, 2, 3], np.uint64)
    s = shingles(h, 3)
    assert len(s) == 4 and s[0] == s[3] and len(set(s.tolist())) == 3
    assert len(shingles(h[:2], 5)) == 1 and len(shingles(h[:0], 5)) == 0


def test_table(spark):
    rows = [(1, None), (2, ""), (None, "x Released under the MIT License. y"), (3, "mit license")]
    rows += [rows[2]]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_words int")
    got = [(r["row"]["doc_id"], [(m["license"], m["start"], m["stop"]) for m in r["out"]["matches"]]) for r in lb.scan_licenses(docs).collect()]
    hit = (None, [("MIT", 1, 6)])
    assert sorted(got, key=str) == sorted([(1, []), (2, []), hit, hit, (3, [])], key=str)
    assert lb.scan_licenses(docs.limit(0)).collect() == []
