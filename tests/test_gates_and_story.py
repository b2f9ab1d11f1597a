import random
import re
import time

from pyspark.sql import functions as F

from lectern.functions import text as fn
from lectern.operators import chapters as ch
from lectern.operators import gates, positions, story
from lectern.operators import structure as st


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


def reason(spark, **over):
    row = {"media": "Text", "langs": ["en"], "copyright": False, "url": "u", "topics": ["Fiction"], "title": "A Tale"} | over
    df = spark.createDataFrame([tuple(row.values())], "media string, langs array<string>, copyright boolean, url string, topics array<string>, title string")
    return df.select(gates.metadata_reason(*[F.col(c) for c in df.columns])).first()[0]


def test_metadata_gate_takes_the_first_reason(spark):
    assert reason(spark) is None
    assert reason(spark, media="Sound", langs=["fr"]) == "not text (Sound)"
    assert reason(spark, langs=["fr", "de"], copyright=True) == "not English"
    assert reason(spark, copyright=True) == "still copyrighted" and reason(spark, copyright=None) == "copyright unknown"
    assert reason(spark, url=None) == reason(spark, url="") == "no plain-text file"
    assert reason(spark, topics=["Tastes", "Preferences"]) == "reference material (reference)"  # topics match anywhere in a word
    assert reason(spark, title="The Index of Things") == "reference title (index of)"
    assert reason(spark, title="A Dictionary of Words") is None  # stems never match as whole words


def content(spark, text):
    return spark.createDataFrame([(text,)], "t string").select(gates.content_reason(gates.densities(F.col("t")))).first()[0]


def test_content_gate(spark):
    assert content(spark, "") == "too short (0 chars)" and content(spark, "x" * 1999) == "too short (1999 chars)"
    assert content(spark, "word " * 400) == "not prose (few marks)"
    assert content(spark, "1234 word. " * 300) == "data-heavy (44% digits)"
    assert content(spark, "Some words, here. " * 200 + "�" * 21) == "broken encoding (21 replacement chars)"
    assert content(spark, "Some words, here. " * 200) is None


def test_boilerplate(spark):
    strip = lambda t: spark.createDataFrame([(t,)], "t string").select(gates.strip_boilerplate(F.col("t"))).first()[0]
    core = "It began.\nAnd went on."
    assert strip(f"head\r\n*** START OF THIS PROJECT GUTENBERG EBOOK X ***\r\n\r\nProduced by A\nor\nhttp://x\n\n{core}\nA Project Gutenberg line\nlast\n*** END OF THE PROJECT GUTENBERG EBOOK ***\ntail") == core + "\nlast"
    assert strip(f"a\n*END*THE SMALL PRINT! x\n{core}\nEnd of the Project Gutenberg EBook\nmore") == core
    assert strip(core) == core and strip("") == "" and strip("Produced by A\n\n") == ""


def test_histogram_and_routing(spark):
    rows = spark.createDataFrame([(1, "too short (3 chars)"), (2, "too short (9 chars)"), (3, "not English"), (4, None)], "id int, reason string")
    assert {(r.reason, r.n, r.per_mille) for r in gates.histogram(rows).collect()} == {("too short", 2, 667), ("not English", 1, 333)}
    good, dead = gates.routed(rows)
    assert (good.count(), dead.count(), good.columns) == (1, 3, ["id"])


def test_as_of_lookups_match_brute_force(spark):
    rng = random.Random(2)
    starts = [(k, rng.randrange(40), f"s{i}") for i, k in enumerate("aaaaabbbc" * 3)]
    starts = list({(k, p): (k, p, n) for k, p, n in starts}.values())
    probes = [(k, p) for k in "abcd" for p in range(-1, 42)]
    s, p = spark.createDataFrame(starts, "k string, at int, name string"), spark.createDataFrame(probes, "k string, at int")
    pick = lambda k, test, best: next((n for _, _, n in sorted([x for x in starts if x[0] == k and test(x[1])], key=lambda x: best * x[1])), None)
    got = {(r.k, r.at): r.found and r.found.name for r in positions.backward(p, s, ["k"], "at").collect()}
    assert got == {(k, at): pick(k, lambda x: x <= at, -1) for k, at in probes}
    got = {(r.k, r.at): r.found and r.found.name for r in positions.backward(p, s, ["k"], "at", -1, strict=True).collect()}
    assert got == {(k, at): pick(k, lambda x: x < at - 1, -1) for k, at in probes}
    got = {(r.k, r.at): r.found and r.found.name for r in positions.forward(p, s, ["k"], "at", 1).collect()}
    assert got == {(k, at): pick(k, lambda x: x > at + 1, 1) for k, at in probes}


def test_greedy_gap_and_scene_starts(spark):
    rng = random.Random(3)
    for n in (0, 1, 2, 18, 19, 60):
        starts = sorted(rng.randrange(9000) for _ in range(n))
        kept = []
        for x in starts:
            if not kept or x - kept[-1] >= 120:
                kept.append(x)
        df = spark.createDataFrame([(starts,)], "s array<bigint>")
        assert df.select(story.spaced(F.col("s"))).first()[0] == kept
        total = 30_000
        want = kept if 2 <= len(kept) <= 18 else [kept[int(i * len(kept) / 14)] for i in range(14)] if len(kept) > 18 else [i * total // 8 for i in range(8)]
        got = spark.createDataFrame([(kept,)], "s array<bigint>").select(story.scene_starts(F.col("s"), F.lit(total))).first()[0]
        assert got == want

def test_a_million_headings_take_linear_time(spark):
    def took(n):
        df = spark.range(1, numPartitions=1).select(F.sequence(F.lit(0).cast("long"), F.lit(150 * n), F.lit(150).cast("long")).alias("s"))
        began = time.time()
        assert df.select(F.size(story.spaced(F.col("s")))).first()[0] == n + 1
        return time.time() - began

    took(1000)
    assert took(1_000_000) < 25
    df = spark.createDataFrame([(None,), ([],), ([5],), ([0, 119, 120, 239, 240],)], "s array<long>")
    assert [r[0] for r in df.select(story.spaced(F.col("s"))).collect()] == [None, [], [5], [0, 120, 240]]


def test_story_starts_scan_twice_and_shuffle_little(spark):
    books = spark.createDataFrame([("b", "CHAPTER 1\n\ntext")], "book_id string, text string")
    plan = story.story_starts(books, ch.headings(ch.lines(books)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 4 and plan.count("Join") == 1


def test_prose_is_looked_for_only_without_headings_and_words_are_counted_uncut(spark):
    books = spark.createDataFrame([("b", "CHAPTER 1\n\ntext")], "book_id string, text string")
    plan = story.story_starts(books, ch.headings(ch.lines(books)))._jdf.queryExecution().executedPlan().toString()
    assert 0 < plan.index("aggregate(") < plan.index("Join")  # above the join: the headings are known there
    pieces = ["a", "é", "[P]", "[", "P]", "x[P]", " ", "\n", "\n \n", "\r\n", "\t", "\xa0", "\u3000", "\ufeff", "\u2003", "\u2014", "\x85", "\U0001f600"]
    texts = [x + y + z for x in pieces for y in pieces for z in pieces] + ["", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    w, split = fn.words(F.col("t")), F.transform(F.split(fn.unix_lines(F.coalesce("t", F.lit(""))), "\n"), fn.trimmed)
    df = df.select("t", F.size(w).alias("n"), st.n_words(F.col("t")).alias("counted"), F.array_join(F.slice(w, 2, 2), " ").alias("some"), st.some_words(F.col("t"), F.lit(1), 2).alias("cut"), split.alias("l"))
    df = df.select("*", F.transform("l", fn.words_in_line).alias("in_line")).select("*", st.running(F.col("in_line")).alias("before"), st.line_words(F.col("l")).alias("c"))
    assert df.filter("not (n <=> counted and some <=> cut and in_line <=> c.n and before <=> c.word_index)").isEmpty()


def test_front_matter_is_passed_over(spark):
    words = " ".join(["word"] * 150)
    text = f"FOREWORD\n\n{words}\n\nINTRODUCTION\n\n{words}\n\nCHAPTER 1\n\n{words}\n\nCHAPTER 2\n\n{words}\n\nCHAPTER 3\n\n{words}"
    books = spark.createDataFrame([("b", text), ("n", None)], "book_id string, text string")
    rows = {r.book_id: r for r in story.story_starts(books, ch.headings(ch.lines(books))).collect()}
    assert (rows["b"].heading, rows["b"].start, rows["b"].confidence) == ("Chapter 1", 302, "low" if 302 > 0.4 * 760 else "high")
    assert story.scenes(books.filter("book_id = 'n'"), ch.lines(books)).collect()[0].passage_words == 0


def start_of(spark, text):
    books = spark.createDataFrame([("b", text)], "book_id string, text string")
    return story.story_starts(books, ch.headings(ch.lines(books))).first()


PROSE = "The old house by the river kept its shutters closed while the long winter went on. " * 12


def test_story_starts(spark):
    chapters = "\n\n".join(f"CHAPTER {i}\n\n{PROSE}" for i in range(1, 9))
    r = start_of(spark, chapters)
    assert (r.start, r.confidence, r.method, r.heading, r.n_headings) == (0, "high", "chapters:keyword", "Chapter 1", 8)
    contents = "CONTENTS\n\n" + "\n".join(f"CHAPTER {i}" for i in range(1, 9)) + "\n\n"
    r = start_of(spark, contents + chapters)
    assert (r.start, r.confidence, r.preview.split()[:3]) == (17, "high", ["CHAPTER", "1", "The"])
    r = start_of(spark, contents + PROSE * 9)
    assert (r.confidence, r.method) == ("low", "chapters:keyword:toc-only")
    r = start_of(spark, "PREFACE\n\n" + PROSE + "\n\n" + chapters)
    assert r.heading == "Chapter 1"
    r = start_of(spark, "A TITLE\n\nBY SOMEBODY\n\n" + PROSE)
    assert (r.start, r.confidence, r.method) == (4, "prose", "prose-fallback")
    assert (start_of(spark, "only a line").confidence, start_of(spark, "").total) == ("none", 1)


def test_anchors_ignore_all_but_letters_and_digits(spark):
    words = "Well-known “quotes”, élan vital; the don't-know house".split()
    at = lambda a: spark.createDataFrame([(words, a)], "w array<string>, a string").select(story.anchor_index(F.col("w"), F.col("a"))).first()[0]
    assert [at(a) for a in ("well known QUOTES", "known quotes", "Lan vital", "dont know", "nowhere", "", "!!")] == [0, 0, 2, 5, None, None, None]


def test_keyword_context(spark):
    lines = ["Title: A Study", "x", "a", "the saccade is a fast movement", "b", "c", "d", "e", "short rate", "f", "memory and attention in reading", "g"]
    out = story.keyword_context(spark.createDataFrame([(1, "\n".join(lines))], "doc_id int, text string")).orderBy("line").collect()
    assert [r.line for r in out] == [1, 2, 3, 4, 5, 8, 9, 10, 11]
    assert [r.line for r in out if r.after_gap] == [8] and {r.source_header for r in out} == {"Title: A Study"}
    assert re.search("saccade", out[2].text) and [r.line for r in out if r.hit] == [3, 10]


def test_keyword_context_of_many_texts_sorts_no_lines(spark):
    hit = "the saccade is a \u212aeen movement"
    texts = [(1, f"Title: One\n{hit}\na"), (2, None), (3, ""), (4, f"x\n  {hit}  \nSource: Four\nb\nc\nd\n{hit}"), (5, f"US12 x\nb\nc\nd\n{hit.replace('saccade', 'FATIGUE')}")]
    out = story.keyword_context(spark.createDataFrame(texts, "doc_id int, text string").coalesce(1), 1)
    assert sorted((r.doc_id, r.line, r.hit, r.source_header, r.after_gap) for r in out.collect()) == [
        (1, 0, 0, "Title: One", None), (1, 1, 1, "Title: One", False), (1, 2, 0, "Title: One", False),
        (4, 0, 0, "Unknown Source", None), (4, 1, 1, "Unknown Source", False), (4, 2, 0, "Source: Four", False), (4, 5, 0, "Source: Four", True), (4, 6, 1, "Source: Four", False),
        (5, 3, 0, "US12 x", None), (5, 4, 1, "US12 x", False),
    ]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan


def test_asterisks_that_end_a_line_open_no_mark(spark):
    strip = lambda t: spark.createDataFrame([(t,)], "t string").select(gates.strip_boilerplate(F.col("t"))).first()[0]
    assert strip("It began.***\n  End of this Project Gutenberg book\nlicense\n*** END OF THIS PROJECT GUTENBERG EBOOK ***\nrest") == "It began.***\nlicense"
    assert strip("* * ***\nStart of the Project Gutenberg tale. ***\nOn.") == "* * ***\nOn."
