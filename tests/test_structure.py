"""Tokens, chapters and bounds: the four fixtures, the semantic traps, and a model document by document."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lectern.functions import text as fn
from lectern.operators import chapters as ch
from lectern.operators import structure as st
from lectern.operators.positions import resume_position


def body(head):
    return f"{head}\n\nRain fell.\n\n" + "The old house by the river kept its shutters closed while the long winter went on. " * 3


def bounds(spark, text):
    books = spark.createDataFrame([("b", text)], "book_id string, text string")
    lines, totals = ch.lines(books), ch.totals(books)
    found = ch.chapters(ch.headings(lines))
    return ch.readable_bounds(found, totals, ch.back_matter(lines, totals)).first(), [r.title for r in found.orderBy("chapter").collect()]


def first_token(text, word):
    return [w for w in re.split(r"\s+", re.sub(r"\n[ \t]*\n+", " [P] ", text).strip()) if w != "[P]"].index(word)


def test_contents_and_foreword(spark):
    text = "\n\n".join(["A RIVER YEAR", "a tale", "Copyright nobody", "CONTENTS", "CHAPTER I", "CHAPTER II", "CHAPTER III", "FOREWORD\n\n" + "These pages were kept dry. " * 6, body("CHAPTER I"), body("CHAPTER II"), body("CHAPTER III")])
    r, titles = bounds(spark, text)
    assert r.confidence == "high" and r.readable_start == first_token(text, "FOREWORD") > 0
    assert titles == ["Foreword", "Chapter I", "Chapter II", "Chapter III"]


def test_epilogue_stays_and_index_goes(spark):
    text = "\n\n".join([body("CHAPTER I"), body("CHAPTER II"), "EPILOGUE\n\n" + "They came back in spring. " * 5, "INDEX", "river, 1", "shutters, 2"])
    r, _ = bounds(spark, text)
    assert r.readable_start <= first_token(text, "EPILOGUE") < r.readable_end < first_token(text, "INDEX")


def test_plain_prose_is_read_whole(spark):
    r, titles = bounds(spark, "The boat turned slowly in the current and nobody spoke. " * 40)
    assert (r.confidence, r.readable_start, r.readable_end, titles) == ("none", 0, 40 * 10 - 1, [])


def test_saved_position_wins(spark):
    rows = [(1500, 900, 200, 5000, 1500), (0, 900, 200, 5000, 900), (0, 9000, 200, 5000, 200), (None, None, 0, 5000, 0), (None, None, 200, 5000, 200)]
    df = spark.createDataFrame(rows, "e int, a int, r int, t int, want int")
    assert df.filter(resume_position(F.col("e"), F.col("a"), F.col("r"), F.col("t")) != F.col("want")).count() == 0


def test_dialects(spark):
    roman = "\n\n".join(body(f"{n}. THE {w} ROOM") for n, w in (("I", "RED"), ("II", "SEA-SIDE"), ("IV", "LAST")))
    assert bounds(spark, roman)[1] == ["I. The Red Room", "II. The Sea-Side Room", "IV. The Last Room"]
    r, titles = bounds(spark, "\n\n".join(map(body, ["I", "II.", "III"])))
    assert (r.confidence, titles) == ("medium", ["Chapter I", "Chapter II", "Chapter III"])
    assert bounds(spark, "\n\n".join(map(body, ["1", "2.", "3"])))[1] == ["Chapter 1", "Chapter 2", "Chapter 3"]
    assert bounds(spark, "\n\n".join(map(body, ["Book mild", "Part civil", "Letter mix"])))[1] == ["Book MILD", "Part CIVIL", "Letter MIX"]  # any word of numeral letters
    assert bounds(spark, "\n\n".join(map(body, ["Chapter 1 was the happiest", "Chapter 2", "Chapter 3"])))[0].confidence == "none"
    restart = "\n\n".join(map(body, ["Chapter 1", "Chapter 2", "Chapter 3", "Chapter 1", "Chapter 2"]))
    assert len(bounds(spark, restart)[1]) == 3  # the last of each number is kept


def model(text):
    """Tokens of one text, a token at a time."""
    raw = re.split(r"[\s ﻿]+", re.sub(r"\n[ \t]*\n+", " [P] ", re.sub(r"\r\n?", "\n", text)).strip(" \t\n\r\v\f ﻿"))
    out, sentence, paragraph, start = [], 0, 0, True
    for i, w in enumerate(raw):
        if w == "[P]":
            continue
        last = i + 1 == len(raw) or raw[i + 1] == "[P]"
        end = last or w[-1:] in (".", "!", "?")
        n = 15 if len(w) > 12 else 12 if len(w) > 8 else 10
        tenths = 30 if w[-1:] in tuple(".!?") else 20 if w[-1:] == "," else n + 5 * (w[-1:] in tuple(";:"))
        out.append((len(out), w, sentence, paragraph, start, end, last, tenths))
        sentence, paragraph, start = sentence + end, paragraph + last, end
    return out


def test_tokens_match_the_model(spark):
    rng = random.Random(1)
    parts = ["word", "said.\"", "end.", "so,", "either;", "eightlet", "ninelettr", "twelveletter", "thirteenletter", "[P]", "\n\n", "\n \t\n\n", "\r\n", "\r\n\r\n", " ", "﻿", "é!", "🎉?", "a:b", "I"]
    texts = ["", "   ", "\n\n", "[P]", "a", "[P] a [P] [P] b"] + [" ".join(rng.choice(parts) for _ in range(rng.randrange(1, 40))) for _ in range(150)]
    out = st.tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()
    got = {}
    for r in sorted(out, key=lambda r: (r.doc_id, r.id)):
        got.setdefault(r.doc_id, []).append((r.id, r.word, r.sentence, r.paragraph, r.sentence_start, r.sentence_end, r.paragraph_end, r.tenths))
    for i, t in enumerate(texts):
        assert got.get(i, []) == model(t), repr(t)


def test_schedule_is_monotone_and_sums_up(spark):
    shown = st.schedule(st.tokens(spark.createDataFrame([(1, "One two. Three, four five sixteenletterss.")], "doc_id int, text string"))).orderBy("id").collect()
    assert [r.delay_ms for r in shown] == [10 * 36 + 500, 600, 20 * 36 + 500, 200, 200, 600]
    assert [r.start_ms for r in shown] == [sum(x.delay_ms for x in shown[:i]) for i in range(len(shown))]


@pytest.mark.parametrize(("word", "want"), [("sea-dog", "Sea-Dog"), ("DON'T", "Don'T"), ("élan vital", "éLan Vital"), ("", ""), ("a_b 3rd", "A_b 3rd")])
def test_title_case(spark, word, want):
    assert spark.range(1).select(fn.title_case(F.lit(word))).first()[0] == want


def test_scalar_functions(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert [one(fn.roman_value(F.lit(x))) for x in ("XIV", "mcmxc", "iiii", "mild")] == [14, 1990, 4, 1000 + 1 * -1 + 50 * -1 + 500]
    assert [one(fn.display_author(F.lit(x))) for x in ("Austen, Jane", "Plato", "A, B, C", "Solo,", None)] == ["Jane Austen", "Plato", "A, B, C", "Solo,", "Unknown"]
    assert one(fn.display_title(F.lit("Physics in time : $b being a view $c by X"))) == "Physics in time: being a view by X"
    assert [one(fn.read_time_label(F.lit(n), F.lit(300))) for n in (0, 100, 9000, 300 * 62, 300 * 125)] == [None, "< 1 min", "30 min", "1 hr", "2 hr 5 min"]
    assert [one(fn.focal_index(F.lit("x" * n))) for n in (0, 1, 5, 6, 10, 14)] == [0, 0, 1, 2, 3, 4]
    assert one(fn.rolling_hash(F.lit("ab"))) == 97 * 31 + 98
    assert one(fn.is_html(F.lit("\n <!DOCTYPE html>"))) and not one(fn.is_html(F.lit("text <html")))


def test_units_need_no_tokens_side_by_side(spark):
    texts = ["One two. Three four\n\nFive! six", "", None, "\n\n", "a [P] [P] b.", "[P]", "x. y. z"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    rows = lambda d: sorted(tuple(r) for r in d.collect())
    tokens = st.tokens(df)
    for unit in ("sentence", "paragraph"):
        assert rows(st.unit_spans(df, unit)) == rows(st.spans(tokens, unit))
    shown = st.schedule(tokens, 350).groupBy("doc_id", "sentence").agg(F.min("start_ms"), F.max("end_ms"))
    assert rows(st.sentence_schedule(df, 350)) == rows(shown)
    near = {(r.doc_id, r.id): r.near for r in st.faded_neighbours(tokens, "line").filter("sentence_start").collect()}
    found = st.sentence_openings(df, 5).withColumn("near", st.faded(F.col("near"), *st.FRAMES["line"][1:]))
    assert {(r.doc_id, r.id): r.near for r in found.collect()} == near
    for made in (st.unit_spans(df, "sentence"), st.sentence_schedule(df), st.sentence_openings(df, 4)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "Sort " not in plan  # tokens in a task's memory grew with the input


def test_lines_need_no_sort_of_texts(spark):
    df = spark.createDataFrame([(1, "One two\r\n\r\n three "), (2, None), (3, "a\nb c\n\nd")], "book_id int, text string")
    found = ch.lines(df)
    assert sorted(tuple(r) for r in found.collect()) == [(1, 0, "One two", 2, 0), (1, 1, "", 0, 2), (1, 2, "three", 1, 2), (2, 0, "", 0, 0), (3, 0, "a", 1, 0), (3, 1, "b c", 2, 1), (3, 2, "", 0, 3), (3, 3, "d", 1, 3)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort " not in plan
