import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.llm import language_id as li
from lectern.llm.language_id import ORDER, Model, context_hashes, fit, gram_hashes, language_of, letters

SCHEMA = "id long, text string, lang string, l string"
WORDS = {"en": "the house with shutters stood alone while nothing moved through".split(), "xx": "zaq uvo qivu zozu vaquz oqi uzava quzo".split(), "de": "straße über häuser können nicht während zwölf".split()}


def sample(n, seed=1, words=WORDS):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choice(words[lang]) for _ in range(rng.randrange(5, 60))), lang, "x") for i in range(n) for lang in [rng.choice(sorted(words))]]


class Slow:
    """Interpolated Kneser-Ney straight from its definition, with dictionaries, for one language."""

    def __init__(self, texts, alphabet):
        self.uniform, self.counts = 1 / (alphabet + 1), [None, *(defaultdict(int) for _ in range(ORDER))]
        for t in texts:
            for k in range(1, ORDER + 1):
                for i in range(ORDER - 1, len(t)):
                    self.counts[k][t[i - k + 1 : i + 1]] += 1
        for k in range(1, ORDER):
            self.counts[k] = defaultdict(int)
            for g in (g for g, n in self.seen(k + 1)):
                self.counts[k][g[1:]] += 1

    def seen(self, k):
        return [(g, n) for g, n in self.raw(k).items() if n]

    def raw(self, k):
        return self.counts[k]

    def p(self, g):
        if not g:
            return self.uniform
        c = self.counts[len(g)]
        once, twice = (sum(1 for n in c.values() if n == x) for x in (1, 2))
        d = min(max(once / (once + 2 * twice) if once else 0.5, 0.1), 0.95)
        same = [n for h, n in c.items() if h[:-1] == g[:-1]]
        if not same:
            return self.p(g[1:])
        return max(c.get(g, 0) - d, 0) / sum(same) + d * len(same) / sum(same) * self.p(g[1:])


def folded(text):
    return "".join(map(chr, letters(text)[0]))


def test_cross_entropies_equal_the_definition():
    texts = {lang: [t for _, t, la, _ in sample(40, 3) if la == lang] for lang in WORDS}
    names, grams = sorted(texts), {k: [[] for _ in range(5)] for k in range(1, ORDER + 1)}
    for i, lang in enumerate(names):
        c = np.concatenate([letters(t)[0] for t in texts[lang]])
        for k in grams:
            h, first, n = np.unique(gram_hashes(c, k), return_index=True, return_counts=True)
            for held, x in zip(grams[k], (h, context_hashes(c, k)[first], gram_hashes(c, k - 1)[first], np.full(len(h), i), n)):
                held.append(x)
    model = Model(names, {k: tuple(map(np.concatenate, v)) for k, v in grams.items()})
    joined = {lang: "".join(map(folded, texts[lang])) for lang in names}
    alphabet = len({c for t in joined.values() for c in t[ORDER - 1 :]})
    slow = [Slow([joined[lang]], alphabet) for lang in names]
    for t in ("the house stood", "zaq, uvo!", "über zwölf Häuser 12", "日本 qqq", "a"):
        got, s = model.cross_entropies(t)[0], folded(t)
        want = [-sum(math.log(m.p(s[i - ORDER + 1 : i + 1])) for i in range(ORDER - 1, len(s))) / (len(s) - ORDER + 1) for m in slow]
        assert got == pytest.approx(want, abs=2e-3), t


def test_held_out_accuracy_and_edge_cases(spark):
    train, test = sample(400), sample(300, 2)
    df = spark.createDataFrame([*train, (None, "no id", "en", "x"), (5000, None, "en", "x"), (5001, "no label", None, "x"), (5002, "", "en", "x")], SCHEMA)
    model = fit(df)
    assert model.names == sorted(WORDS) and np.isfinite(model.limits).all()
    odd = [(900, None, "en", None), (901, "", "en", None), (902, "123 -- !", "en", None), (903, "the house " * 50_000, "en", None), (904, "a", None, None), (904, "a", None, None)]
    rows = spark.createDataFrame([*test, *odd], SCHEMA)
    out = rows.select("*", language_of(rows, F.col("text"), model).alias("f")).collect()
    assert len(out) == len(test) + len(odd)
    plain = [r for r in out if r.id < 900]
    assert sum(r.f.lang == r.lang for r in plain) >= 0.99 * len(plain) and not any(r.f.rejected for r in plain)
    assert all(0 <= r.f.score <= 1 for r in out)
    by = {r.id: r.f for r in out}
    assert all((by[i].lang, by[i].score, by[i].rejected) == ("und", 0.0, True) for i in (900, 901, 902))
    assert by[903].lang == "en" and not by[904].rejected and by[904].lang in WORDS


def test_rejects_what_is_like_no_language(spark):
    model = fit(spark.createDataFrame(sample(400), SCHEMA))
    assert model.judge("бвгдж зклмн прстф хцчшщ " * 10)[2] and model.judge("qxwk jjpf xkcd wqpf " * 10)[2]
    assert not model.judge("the house stood")[2]


def test_bad_labels_do_not_open_the_gate(spark):
    odd = "бвгдж зклмн прстф хцчшщ " * 10
    good = sample(400)
    calibrates = [r.id for r in spark.range(1000, 1100).filter(F.pmod(F.xxhash64("id", F.lit("calibration")), F.lit(4)) == 0).collect()]
    for bad in (odd, odd + "zaq uvo qivu zozu vaquz oqi uzava quzo " * 3):
        model = fit(spark.createDataFrame([*good, (calibrates[0], bad, "xx", "x")], SCHEMA))
        assert model.judge(odd)[2] and model.judge("qxwk jjpf xkcd wqpf " * 10)[2]
        assert not any(model.judge(t)[2] for _, t, _, _ in sample(100, 5))


def test_languages_of_long_texts_alone_are_learned(spark):
    long = [(1000 + i, "mbe ngo tuli wafe soma " * (li.FIT_CHARS // 10), "yy", "x") for i in range(6)]
    model = fit(spark.createDataFrame([*sample(200), *long], SCHEMA))
    assert model.names == [*sorted(WORDS), "yy"] and np.isfinite(model.limits).all()
    assert model.judge("soma tuli mbe wafe ngo")[0] == "yy"


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], SCHEMA)
    model = fit(empty)
    assert empty.select(language_of(empty, F.col("text"), model)).count() == 0
    assert model.judge("words") == ("und", 0.0, False) and model.judge("12") == ("und", 0.0, True)


def test_sorted_hashes_find_every_key():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**64, 5000, dtype=np.uint64))
    at, hit = li.SortedHashes(keys).find(np.concatenate((keys, keys + np.uint64(1))))
    assert hit[: len(keys)].all() and (at[: len(keys)] == np.arange(len(keys))).all() and not hit[len(keys) :].any()
