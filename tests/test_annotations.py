from pyspark.sql import functions as F

from lectern.functions import display
from lectern.operators import annotations as an
from lectern.operators import chapters as ch


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


def test_labelled_scenes(spark):
    prose = "Nothing moved along the road and the light was going. " * 15
    text = "\n\n".join(["CHAPTER 1", "CHAPTER 2", prose, "Chapter II\n\nThe Long Road.", prose, "iii. by the SEA", prose, "IV\n\n[Illustration]", prose, "EPILOGUE", prose, "Part 2 THE _LAST_ NIGHT", prose])
    rows = an.labelled_scenes(ch.lines(spark.createDataFrame([("b", text)], "book_id string, text string"))).orderBy("start_index").collect()
    assert [r.label for r in rows] == ["Chapter 2", "The Long Road", "by the SEA", "Chapter 4", "Epilogue", "The Last Night"]
    assert all(b.start_index - a.start_index >= 120 for a, b in zip(rows, rows[1:]))


def test_titles(spark):
    assert one(spark, an.scene_title(F.lit("Chapter: _The_ [Road]"))) == "The Road"
    assert [one(spark, an.stands_alone(F.lit(x))) for x in ("The Road", "[Illustration]", "the road", "So it was,", "A b c d e f g h i j", "")] == [True, False, False, False, False, False]


def test_snippets(spark):
    words = [f"w{i}" for i in range(1000)]
    part = lambda i, n=5: " ".join(words[i : i + n])
    rows = [(words, part(10), part(200), None, (10, 195)), (words, part(10, 3), part(200), None, None), (words, part(900), part(990), None, None), (words, part(10), "no such end at all", 300, (10, 300)), (words, part(10), part(30), None, None), (words, part(790), "", 400, (790, 210)), (words, "not in there at all", part(30), 300, None)]
    df = spark.createDataFrame(rows, "w array<string>, a string, e string, n int, want struct<start:int,words:int>")
    got = an.with_snippet(df, F.col("w"), F.col("a"), F.col("e"), F.col("n"), an.SHORT).collect()
    assert [(r.start, r.words) if r.start is not None else None for r in got] == [tuple(r.want) if r.want else None for r in got]
    assert df.limit(1).select(an.clamped_snippet(F.col("w"), F.col("a"), F.lit(5000))).first()[0] == (10, 800)
    assert [r[0] for r in df.select(an.accepted_start(F.col("w"), F.col("a"))).collect()] == [10, None, None, 10, 10, None, None]


def test_resolved_scenes(spark):
    docs = spark.createDataFrame([("b", "one two three four five six".split())], "book_id string, w array<string>")
    anchors = spark.createDataFrame([("b", 0, "three four"), ("b", 1, "one two"), ("b", 2, "five"), ("b", 3, "nine")], "book_id string, ordinal int, anchor string")
    rows = an.resolved_scenes(docs, anchors).orderBy("ordinal").collect()
    assert [(r.start_index, r.out_of_order, r.missing) for r in rows] == [(2, False, False), (0, True, False), (4, False, False), (None, False, True)]


def test_rankings_and_groups(spark):
    frame = lambda rows: spark.createDataFrame(rows, "id int, value int")
    a, b = frame([(1, 10), (2, None)]), frame([(2, 20), (3, 30)])
    assert {(r.id, r.value, r.source) for r in an.by_precedence("id", ("a", a), ("b", b)).collect()} == {(1, 10, "a"), (2, 20, "b"), (3, 30, "b")}
    assert {(r.id, r.value) for r in an.replace_groups(a, b, "id").collect()} == {(1, 10), (2, 20), (3, 30)}
    picked = an.in_order(F.col("ids"), a, spark.createDataFrame([([2, 9, 1],)], "ids array<int>")).orderBy("place").collect()
    assert [r.id for r in picked] == [2, 1]
    assert {(r.id, r.value) for r in an.first_of(frame([(1, 5), (1, 3), (2, 4)]).withColumn("o", F.col("value")), ["id"], "o").collect()} == {(1, 3), (2, 4)}
    assert {r.id: r.flags for r in an.flags(frame([(1, 0), (2, 0), (4, 0)]), "id", a=a, b=b).collect()} == {1: ["a"], 2: ["a", "b"], 4: []}


def test_display(spark):
    assert [one(spark, display.clamped_pace(F.lit(x))) for x in (20, 320, 330, 5000)] == [100, 300, 350, 1000]
    assert one(spark, display.decoded(F.lit("a &amp; b &lt;i&gt; &quot;c&quot;"))) == 'a & b <i> "c"'
    assert one(spark, display.fit_scale(F.lit(114.0), F.lit(400.0))) == 0.5 and one(spark, display.fit_scale(F.lit(114.0), F.lit(50.0))) == 1.0
    assert (one(spark, display.ease_out(F.lit(1.0))), one(spark, display.font_size(F.lit(10.0), F.lit("compact")))) == (1.0, 8.0)
    assert one(spark, display.proxied(F.lit("https://www.books.org/a/b"), "books.org", "/p")) == "/p/a/b"
    assert [one(spark, display.span_percent(F.lit(i), F.lit(10), F.lit(30), F.lit(40))) for i in (0, 20, 99)] == [0.0, 50.0, 100.0]
    assert [one(spark, display.span_percent(F.lit(150), F.lit(100), F.lit(end), F.lit(n))) for end, n in ((100, 200), (60, 200), (100, 0))] == [100.0, 100.0, 0.0]
    rows = spark.createDataFrame([(0, 0.0), (50, 5.0), (100, 30.0), (300, 0.0)], "t int, x double").withColumn("k", F.lit(1))
    assert [r.velocity for r in display.trailing_velocity(rows, ["k"], "t", "x").orderBy("t").collect()] == [0.0, 0.1, 0.5, 0.0]


def test_velocity_from_the_first_of_samples_at_one_time(spark):
    rows = [("a", 0, 5.0, 2), ("a", 0, 1.0, 1), ("a", 10, 11.0, 3)]
    for some in (rows, rows[::-1]):
        df = spark.createDataFrame(some, "k string, t int, x double, id int")
        assert [r.velocity for r in display.trailing_velocity(df, ["k"], "t", "x", tie="id").orderBy("id").collect()] == [0.0, 0.0, 1.0]


def test_chapters_of_four_digits_are_labelled(spark):
    lines = spark.createDataFrame([(1, 0, "CHAPTER 1000", 0)], "book_id int, line int, trimmed string, word_index long")
    assert [tuple(r) for r in an.labelled_scenes(lines).collect()] == [(1, 0, "Chapter 1000")]
