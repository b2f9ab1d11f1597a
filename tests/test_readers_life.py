import json

from pyspark.sql import functions as F

from lectern.functions import display
from lectern.functions import text as fn
from lectern.operators import catalog as cat
from lectern.operators import gates, ledger, positions, reading, story
from lectern.operators import structure as st
from lectern.sources import readers, writers


def test_pace_has_fractions(spark):
    shown = st.schedule(st.tokens(spark.createDataFrame([(1, "One two. Three")], "doc_id int, text string")), 350).orderBy("id").collect()
    assert [round(r.delay_ms, 6) for r in shown] == [round(x, 6) for x in (10 * 10800 / 350 + 500, 30 * 6000 / 350, 10 * 10800 / 350 + 500)]
    assert round(shown[2].start_ms, 6) == round((10 * 10800 + 500 * 350 + 30 * 6000) / 350, 6)
    assert round(spark.range(1).select(fn.delay_ms(F.lit("word"), F.lit(False), 350)).first()[0], 2) == 171.43


def test_null_and_empty_texts(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, " ")], "doc_id int, text string")
    assert {(r.doc_id, r.reason) for r in df.select("doc_id", gates.content_reason(gates.densities(F.col("text"))).alias("reason")).collect()} == {(1, "too short (0 chars)"), (2, "too short (0 chars)"), (3, "too short (1 chars)")}
    assert [tuple(r)[:4] for r in df.select(gates.densities(F.col("text")).alias("d")).select("d.*").collect()][:2] == [(0, None, None, None)] * 2
    assert {(r.doc_id, r.n_tokens) for r in st.dwell_by_document(df).collect()} == {(1, 1), (2, 1), (3, 1)}
    assert st.tokens(df).count() == 3
    admitted, rejects = gates.routed(df.withColumn("reason", gates.content_reason(gates.densities(F.col("text")))))
    assert (admitted.count(), rejects.count()) == (0, 3)
    assert not any(r[0] for r in df.select(gates.worth_mirroring(F.col("text"))).collect())


def test_languages_without_english(spark):
    rows = spark.createDataFrame([(None,), ([None],), (["fr", None],), ([None, "en"],), ([],)], "l array<string>")
    got = rows.select(gates.metadata_reason(F.lit("Text"), F.col("l"), F.lit(False), F.lit("u"), F.array(F.lit("x")), F.lit("t"))).collect()
    assert [r[0] for r in got] == ["not English"] * 3 + [None] + ["not English"]


def test_upsert_after_a_stop(spark, tmp_path):
    path = tmp_path / "kv"
    writers.upsert(spark.createDataFrame([(1, "a")], "id int, v string"), str(path), ["id"])
    path.rename(tmp_path / "kv.old")  # stopped between the two renames
    writers.upsert(spark.createDataFrame([(2, "b")], "id int, v string"), str(path), ["id"])
    assert {(r.id, r.v) for r in spark.read.parquet(str(path)).collect()} == {(1, "a"), (2, "b")}
    assert not (tmp_path / "kv.old").exists()


def test_bundle_lines_and_report(spark, tmp_path):
    lines = writers.bundle_lines(spark.createDataFrame([("2", 5)], "book_id string, start int"), spark.createDataFrame([("9",), ("2",)], "book_id string"))
    assert {r.book_id: json.loads(r.bundle) for r in lines.collect()} == {"2": {"v": 1, "id": "2", "start": 5, "nn": False}, "9": {"v": 1, "id": "9", "nn": True}}
    docs = spark.createDataFrame([(1, "Title: x\nfirst words\nhere is a line on memory and more\nlast\n.\n.\n.\nalso here is memory of a kind")], "doc_id int, text string")
    writers.context_report(story.keyword_context(docs, 1), str(tmp_path / "r"))
    assert [r.value for r in spark.read.text(str(tmp_path / "r")).collect()] == ["## Title: x", "first words", "**here is a line on memory and more**", "last", "---", ".", "**also here is memory of a kind**"]


def test_anchors_short_long_and_marked(spark):
    docs = spark.createDataFrame([(1, "Ab, cd [P] EFGH ijkl mnop"), (2, None), (3, ""), (1, "x ab"), (None, "efgh-IJKL mnop")], "doc_id int, text string")
    anchors = spark.createDataFrame([(1, "abcdefghij"), (2, "Ab"), (3, "efgh ijkl mnop"), (4, "."), (5, None), (6, "zzzzzzzzzzzz")], "item_id int, anchor string")
    assert sorted(map(tuple, story.resolved_anchors(docs, anchors).collect()), key=str) == sorted([(1, 1, 0), (2, 1, 0), (2, 1, 1), (3, 1, 2), (3, None, 0)], key=str)
    plan = story.resolved_anchors(docs, anchors)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_anchors_that_share_a_phrase_meet_by_what_is_rare(spark):
    phrase = "it was the best of times and it was the worst of times"
    letters = phrase.replace(" ", "")
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit(f"Once {phrase} in "), F.hex(F.xxhash64("id")), F.lit(" and so on")).alias("text"))
    anchors = spark.range(100_000).select(F.col("id").alias("item_id"), F.concat(F.lit(f"{phrase} in "), F.hex(F.xxhash64(F.col("id") * 10))).alias("anchor"))
    asked = anchors.select("item_id", "anchor", fn.letters_only(F.col("anchor")).alias("needle"))
    chosen = story._rarest_runs(asked, docs.select(F.lower("text").alias("low")), story.GRAM)
    common = set(story._grams(letters, story.GRAM).view("int64").tolist())
    assert chosen.count() == 100_000 and chosen.filter(F.col("run").isin(common)).isEmpty()
    got = sorted((r.item_id, r.doc_id, r.token) for r in story.resolved_anchors(docs, anchors).collect())
    assert got == [(i, 10 * i, 1) for i in range(300)]


def test_sentences_and_paragraphs_at_the_ends(spark):
    tokens = st.tokens(spark.createDataFrame([(1, "One two. Three four. Five\n\nSix")], "doc_id int, text string"))
    totals = tokens.groupBy("doc_id").agg(F.count("*").alias("total"))
    probes = spark.createDataFrame([(1, i) for i in range(6)], "doc_id int, id int")
    got = {r.id: (r.previous_start, r.next_start) for r in positions.neighbour_sentences(probes, tokens, totals).collect()}
    assert got == {0: (0, 2), 1: (0, 2), 2: (0, 4), 3: (2, 4), 4: (2, 5), 5: (4, 5)}
    starts = tokens.groupBy("doc_id", "paragraph").agg(F.min("id").alias("id")).filter("id > 0")
    assert {r.id: r.paragraph for r in positions.paragraph_at(probes, starts, "doc_id").collect()} == {0: 0, 1: 0, 2: 0, 3: 0, 4: 0, 5: 1}


def test_states_and_flush(spark):
    rows = [(1, 1, "seek", 99), (1, 2, "play", 3), (1, 3, "seek", -5), (1, 4, "hidden", 4), (1, 5, "reset", 7), (2, 1, "play", 1)]
    events = spark.createDataFrame([(u, t, t, e, i) for u, t, e, i in rows], "user_id int, s int, tie int, event string, index int").withColumn("ts", F.timestamp_seconds("s"))
    states = reading.playback_states(events, ["user_id"], F.lit(10))
    assert [(r.playing, r["index"], r.restarts) for r in states.orderBy("user_id", "tie").collect()] == [(False, 9, True), (True, 3, False), (True, 0, True), (False, 4, False), (False, 0, True), (True, 1, False)]
    left = reading.flushed(states.select("user_id", "ts", "playing", "index", "tie"), states.filter("tie < 5 and user_id = 1"), ["user_id"])
    assert {(r.user_id, r["index"]) for r in left.collect()} == {(1, 0), (2, 1)}


def test_small_ones(spark):
    one = spark.createDataFrame([(1234567, "12", " ", None)], "n long, id string, blank string, none string")
    got = one.select(display.thousands(F.col("n")), display.padded(F.col("id")), display.padded(F.lit("12345678")), cat.has_text(F.col("blank")), cat.has_text(F.col("none")), cat.has_text(F.col("id")), ledger.chunk_label(F.lit(100)), ledger.chunk_label(F.lit(101))).first()
    assert tuple(got) == ("1,234,567", "    12", "12345678", False, False, True, "1-100", "101-200")
    near = st.faded_neighbours(st.tokens(spark.createDataFrame([(1, "a b c")], "doc_id int, text string")), "line").filter("id = 1").first().near
    assert [(n.distance, n.word, round(n.opacity, 2)) for n in near] == [(1, "a", 0.6), (1, "c", 0.6)]


def test_saved_states_are_read_and_migrated(spark, tmp_path):
    old = {"state": {"wpm": 400, "progress": {"bookId": "b", "currentIndex": 5, "totalTokens": 9, "lastReadAt": 1}, "fitMode": "classic"}, "version": 1}
    new = {"state": {"stats": {"wordsRead": 7, "msRead": 8}, "progressById": {"c": {"bookId": "c", "currentIndex": 1, "totalTokens": 2, "lastReadAt": 3}}, "savedById": {"d": 4}, "fitMode": "x"}, "version": 5}
    (tmp_path / "s.jsonl").write_text("\n".join([json.dumps(old), "not json", json.dumps(new)]))
    rows = {r.wpm: r for r in ledger.migrate(readers.reader_states(spark, str(tmp_path / "s.jsonl"))).collect()}
    assert rows[400].progress_by_id["b"].current_index == 5 and rows[400].fit_mode == "centerAll" and rows[400].saved_by_id == {}
    assert rows[None].words_read == 7 and rows[None].saved_by_id == {"d": 4} and rows[None].progress_by_id["c"].total_tokens == 2 and rows[None].version == 5


def test_ids_are_looked_up_in_batches(spark, tmp_path):
    for ids in ("1,2,3", "4,5"):
        (tmp_path / f"{ids}.json").write_text(json.dumps({"results": [{"id": int(i), "download_count": 10 * int(i)} for i in ids.split(",") if i != "2"]}))
    ids = spark.createDataFrame([(str(i),) for i in range(1, 6)], "id string").coalesce(1)
    got = readers.looked_up(ids, f"file://{tmp_path}/{{ids}}.json", 3).collect()
    assert {r.id: json.loads(r.book)["download_count"] for r in got} == {"1": 10, "3": 30, "4": 40, "5": 50}
