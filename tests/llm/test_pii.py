import random
import re
import time

import numpy as np

from lectern.llm import pii
from lectern.llm.pii import KINDS, WINDOW, luhn, pii_spans, tagged_spans, trained, windows_of
from lectern.llm.spans import Taken
from lectern.llm.tagger import Tagger, char_classes

RULES = {
    "email": (re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda s, d: True),
    "ip": (re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda s, d: all(int(p) <= 255 for p in s.split("."))),
    "card": (re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda s, d: 14 <= len(d) <= 19 and luhn(d.encode())),
    "phone": (re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda s, d: 10 <= len(d) <= 15),
}
SCHEMA = "doc_id long, text string, spans int"


def brute(text):
    found = [(k, m.start(), m.end()) for k, (p, ok) in RULES.items() for m in p.finditer(text or "") if ok(m[0], re.sub("[^0-9]", "", m[0]))]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def texts():
    rng = random.Random(6)
    parts = ["é", "🎉", " ", "\n", "a.b", "@", "@@", "x@y.zz", ".com", "-", "1.2.3.4", "256.1.1.1", "0.0.0.0", ".", "4532015112830366", "4532 0151 1283 0366", "+1 (434) 555-2368", "+", "(", "12", "9" * 20, "+44 20 7946 0958", "--", "john@mail.example.com"]
    yield from (None, "", "@", "a@b", "a@b.c", "a@b.c@d.e.f", "1" * 3000 + ".2.3.4", "+1" + " " * 50 + "2")
    for _ in range(400):
        yield "".join(rng.choice(parts) for _ in range(rng.randrange(1, 30)))


def test_luhn():
    assert luhn(b"4532015112830366") and not luhn(b"4532015112830367")


def test_rules_equal_brute_force_and_stay(spark):
    rows = [(i, t, 0) for i, t in enumerate(texts())] + [(None, "é a@b.cc", None), (1, "x " * 10**6 + "a@b.cc", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = df.select("text", pii_spans(df, df.text).alias("found")).collect()
    assert len(out) == len(rows)
    for r in out:
        base = [(s.kind, s.start, s.end) for s in r.found if s.base]
        assert base == brute(r.text), r.text
        assert not [1 for s in r.found if not s.base for b in base if s.start < b[2] and b[1] < s.end]


def test_added_spans_at_any_place():
    for pad in (0, 5, 23, 24, 25, 47, 48, 49, 71, 95, 96, 97, 500):
        for kind, s in (("phone", "(434) 555-2368"), ("phone", "(212) 555-0187")):
            text = ("word " * 200)[:pad] + " call " + s + " for more of it."
            at = text.index(s)
            assert (kind, at, at + len(s)) in tagged_spans(trained(), [text])[0], (pad, s)


class Marked(Tagger):
    """Takes each run of # for a telephone number."""

    def _scores(self, ids):
        inside = ids.T == ord("#")
        begin = inside & ~np.concatenate((np.zeros_like(inside[:1]), inside[:-1]))
        s = np.zeros((*inside.shape, 1 + 2 * len(KINDS)), np.float32)
        s[..., 0], s[..., 2 * KINDS.index("phone") + 1], s[..., 2 * KINDS.index("phone") + 2] = 9 * ~inside, 9 * begin, 9 * (inside & ~begin)
        return s, ()


def test_added_spans_of_any_length_at_every_offset():
    tagger = Marked(KINDS)
    for digit in ("7", "word 7 word "):
        for n in (30, 48, 72, 90, 400):
            texts = ["x" * pad + digit + "#" * n + " words." for pad in range(pii.CORE)]
            for pad, found in enumerate(tagged_spans(tagger, texts)):
                assert found == [("phone", pad + len(digit), pad + len(digit) + n)], (digit, n, pad)
    assert tagged_spans(tagger, ["#" * 500 + " 7", "7 " + "#" * 500]) == [[("phone", 0, 500)], [("phone", 2, 502)]]


def test_long_addresses_at_every_offset():
    s = "marienne_lavander @ porteline7.example.com"
    texts = [("some plain words of it " * 9)[-pad - 1 :] + " " + s + " and more words of it follow here." for pad in range(WINDOW)]
    for t, found in zip(texts, tagged_spans(trained(), texts)):
        assert found == [("email", t.index(s), t.index(s) + len(s))], t


def test_advertised_forms_are_reported(spark):
    forms = [("email", "jane [at] example.org"), ("email", "x(at)y.com"), ("email", "moritz.lander [at] filmano.com"), ("email", "jane @ example.org"), ("card", "4111.1111.1111.1111"), ("card", "4532.0151.1283.0366"), ("phone", "(434) 555-2368")]
    rows = [(i, f"please write to {s} for more words of it", 0) for i, (_, s) in enumerate(forms)]
    df = spark.createDataFrame([*rows, (99, "it was 999.1111.2222.3333 of them, seen at home. And [at] once.", 0)], SCHEMA)
    out = {r.doc_id: [(s.kind, s.start, s.end, s.base) for s in r.found] for r in df.select("doc_id", pii_spans(df, df.text).alias("found")).collect()}
    for i, (kind, s) in enumerate(forms):
        assert out[i] == [(kind, 16, 16 + len(s), False)], s
    assert out[99] == []


def test_forms_without_country_code_or_with_marks_spelled_out():
    rng = random.Random(21)
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    name = lambda: rng.choice(["mara", "olaf", "petra"]) + rng.choice([".", "_"]) + rng.choice(["berg", "kova", d(2)])
    forms = {
        0.8: [("email", lambda: f"{name()} [at] mailbox [dot] org"), ("phone", lambda: f"00{d(2)} {d(3)} {d(3)} {d(4)}"), ("ip", lambda: f"{rng.randrange(1, 256)}.{rng.randrange(256)}.{rng.randrange(256)}[.]{rng.randrange(1, 256)}")],
        0.6: [("phone", lambda: f"0{d(2)} {d(8)}")],
    }
    words = "some plain words of it and then others came along when nobody was there".split()
    for least, some in forms.items():
        for kind, make in some:
            texts, at = [], []
            for _ in range(40):
                left, s = " ".join(rng.choice(words) for _ in range(30)), make()
                texts.append(f"{left} {s} " + " ".join(rng.choice(words) for _ in range(30)))
                at.append((kind, len(left) + 1, len(left) + 1 + len(s)))
            assert sum(w in found for w, found in zip(at, tagged_spans(trained(), texts))) >= least * 40, (kind, make())
    plain = [" ".join(rng.choice([*words, "at", "dot", "[1]", "(at)", "0123 45", "12.5"]) for _ in range(80)) for _ in range(60)]
    assert sum(bool(pii._LEAST[k].match(t, a, b)) for t, found in zip(plain, tagged_spans(trained(), plain)) for k, a, b in found) <= 6  # of 4800 words, most of them traps


def test_the_taggers_own_verdict_is_told(spark):
    rows = [(1, "write to jane.doe@example.org or call (434) 555-2368 or 4111.1111.1111.1111 today", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = df.select(pii_spans(df, df.text).alias("s")).first().s
    assert [(s.kind, s.base, s.method) for s in found] == [("email", True, True), ("phone", False, True), ("card", False, True)]


def test_many_spans_take_linear_time():
    took = []
    for n in (20_000, 80_000):
        spans, began = [("ip", 10 * i, 10 * i + 7) for i in range(n)], time.time()
        taken = Taken(spans)
        assert sum(taken.meets(10 * i + 6, 10 * i + 9) and not taken.meets(10 * i + 7, 10 * i + 10) for i in range(n)) == n
        took.append(time.time() - began)
    assert took[1] < 8 * took[0]
    taken = Taken([("ip", 0, 100), ("ip", 10, 20), ("ip", 200, 201)])
    assert taken.meets(50, 60) and not taken.meets(100, 200) and taken.meets(199, 201) and not Taken([]).meets(0, 5)


def test_held_out_windows():
    make = pii._Inventor(77)
    rows = [make.window() for _ in range(300)]
    tags, _ = trained().decode(np.stack([char_classes(t) for t, _ in rows]))
    gold = np.stack([t for _, t in rows])
    assert (tags[gold > 0] == gold[gold > 0]).mean() > 0.9
    assert (tags[gold == 0] == 0).mean() > 0.97


def test_clean_prose_gets_no_span():
    text = "In 1999 there were 12,345 of 7.5 kinds, at 10:30 on 2024-01-02 (see page 12 of v1.2.3); the total of 1234 fell 5%. " * 20
    assert tagged_spans(trained(), [text, "no digits here " * 50]) == [[], []]


def test_windows_cover_every_digit():
    text = "x" * 130 + "7" + "y" * 300 + "42"
    cores = {start for start, _ in windows_of(text)}
    assert all(len(w) == WINDOW for _, w in windows_of(text))
    assert {130 // pii.CORE * pii.CORE, 432 // pii.CORE * pii.CORE} <= cores


def test_gradient():
    rng = np.random.default_rng(0)
    t = Tagger(("a", "b"))
    t.w = {k: v.astype(np.float64) for k, v in t.w.items()}
    ids, tags = rng.integers(32, 127, (3, 7)), np.array([[0, 1, 2, 0, 3, 4, 4], [1, 2, 2, 1, 0, 0, 3], [0] * 7])
    _, grad = t._gradient(ids, tags)
    for k in t.w:
        i = tuple(rng.integers(0, n) for n in t.w[k].shape) if k != "embed" else (ids[0, 0], 1)
        at = t.w[k][i]
        t.w[k][i] = at + 1e-4
        up = t._gradient(ids, tags)[0]
        t.w[k][i] = at - 1e-4
        down = t._gradient(ids, tags)[0]
        t.w[k][i] = at
        assert abs((up - down) / 2e-4 - grad[k][i]) < 2e-3, k


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert df.select(pii_spans(df, df.text)).count() == 0
