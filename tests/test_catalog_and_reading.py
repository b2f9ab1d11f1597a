import random
import re
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from lectern.operators import catalog, ledger, reading

T0 = datetime(2024, 1, 1)


def test_search_and_fallback(spark):
    local = spark.createDataFrame([("1", "Red House", "Ann"), ("2", "Blue", "Redmond")], "id string, title string, author string")
    remote = spark.createDataFrame([("9", "Green", "Zed")], local.schema)
    ids = lambda df: {r.id for r in df.collect()}
    assert ids(catalog.search(local, " RED ")) == {"1", "2"} and ids(catalog.search(local, "  ")) == set()
    assert ids(catalog.search_with_fallback(local, remote, "red")) == {"1", "2"}
    assert ids(catalog.search_with_fallback(local, remote, "zed")) == {"9"}


def test_text_url_preference(spark):
    rows = [({"text/plain": "a.txt", "text/plain; charset=utf-8": "b.txt"}, "b.txt"), ({"text/plain; charset=utf-8": "b.zip", "text/plain": "a.txt"}, "a.txt"), ({"text/plain; charset=iso": "c.txt", "text/html": "h"}, "c.txt"), ({"text/html": "h"}, None), ({}, None)]
    df = spark.createDataFrame(rows, "formats map<string,string>, want string")
    assert df.filter(~catalog.text_url(F.col("formats")).eqNullSafe(F.col("want"))).count() == 0


def test_shelves_equal_the_sequential_model(spark):
    rng = random.Random(5)
    rows = [(t, s, p, rng.randrange(40), rng.random() < 0.8) for t in "ab" for s in range(4) for p in range(25)]
    used = [("a", i) for i in range(5)]
    want, taken = [], set(used)
    for t in "ab":
        for s in range(4):
            place = 0
            for _, _, p, i, ok in sorted(r for r in rows if r[:2] == (t, s)):
                if place < 6 and ok and (t, i) not in taken:
                    place += 1
                    taken.add((t, i))
                    want.append((t, s, place, i))
    out = catalog.fill_shelves(spark.createDataFrame(rows, "theme_key string, shelf_pos int, book_pos int, id int, verified boolean"), spark.createDataFrame(used, "theme_key string, id int"), 4, 6)
    assert sorted((r.theme_key, r.shelf_pos, r.place, r.id) for r in out.collect()) == sorted(want)


def test_first_title_and_editions(spark):
    shelves = spark.createDataFrame([("v", 1, 0, 0, "1", "The  Sea"), ("v", 0, 0, 3, "2", "the sea "), ("w", 1, 0, 0, "3", "The Sea"), ("v", 1, 1, 0, "4", "Other")], "theme_key string, section int, shelf_pos int, book_pos int, id string, title string")
    assert {r.id for r in catalog.first_of_title(shelves).collect()} == {"2", "3", "4"}
    dead = spark.createDataFrame([("d1", "Journey to the Centre", "Verne, Jules"), ("d2", "Nothing", "X")], "id string, title string, author string")
    books = spark.createDataFrame([("b1", "A Journey to the Center of It", "Jules Verne", 5, True), ("b2", "Journey to the Center", "Verne, J.", 9, True), ("b3", "Journey to the Center", "Verne, J.", 99, False), ("b4", "Journey to the Center", "Other", 50, True)], "id string, title string, author string, downloads int, readable boolean")
    # a last name is the last part of "Last, First" as the front catalog writes it
    assert [(r.dead_id, r.id) for r in catalog.replacements(dead, books).collect()] in ([("d1", "b1")], [("d1", "b2")])


def test_containment_is_complete(spark):
    rng = random.Random(2)
    strings = {"".join(rng.choice("ab c") for _ in range(rng.randrange(0, 9))) for _ in range(150)} | {"the", "the old king", "king", "kings row", "é"}
    frame = lambda rows, name: spark.createDataFrame([(x,) for x in [*rows, None]], f"{name} string")
    for run in (2, 4):
        got = [tuple(r) for r in catalog.contained(frame(strings, "needle"), frame(strings, "text"), run).collect()]
        assert len(got) == len(set(got))
        assert set(got) == {(a, b) for a in strings for b in strings if a and a in b}
    assert catalog.contained(frame([], "needle"), frame(strings, "text")).count() == 0


def test_editions_match_every_pair(spark):
    rng = random.Random(3)
    titles = ["King", "Kings Row", "The King", "!!!", "It", "It's a Centre", "a center", None, "Row", "the", ""]
    names = ["Unknown", "King, S.", "Row", "", None, "S. King", "unknown"]
    dead = [(f"d{i}", rng.choice(titles), rng.choice(names)) for i in range(120)]
    books = [(f"b{i}", rng.choice(titles), rng.choice(names), rng.choice([None, 1, 2, 3]), rng.random() < 0.8) for i in range(30)]
    out = catalog.replacements(spark.createDataFrame(dead, "id string, title string, author string"), spark.createDataFrame(books, "id string, title string, author string, downloads int, readable boolean"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan

    def key(t):
        return re.sub(" +", " ", re.sub("[^a-z0-9 ]", "", (t or "").strip().lower().replace("centre", "center")))

    want = {}
    for i, title, author in dead:
        by = ([p for p in re.split("[ ,]", author or "") if p] or [""])[-1].lower()
        fits = [(-(n or 0), b) for b, t, a, n, ok in books if ok and (key(title) in key(t) or key(t) in key(title)) and (by in ("", "unknown") or by in (a or "").lower())]
        if fits:
            want[i] = min(fits)
    assert {r.dead_id: (-r.downloads, r.id) for r in out.collect()} == want


def events(n, seed=1):
    rng, at, rows = random.Random(seed), {}, []
    for i in range(n):
        u = rng.randrange(3)
        at[u] = at.get(u, 0) + rng.choice([0, 1, 700, 1500, 2500])
        rows.append((u, T0 + timedelta(milliseconds=at[u]), rng.random() < 0.6, rng.randrange(0, 30), i))
    return rows


EVENT = "user_id long, ts timestamp, playing boolean, index long, tie long"


def model(rows):
    sessions, writes = [], []
    for u in {r[0] for r in rows}:
        start, saved_at, saved = None, None, -1
        for _, ts, playing, index, _ in sorted((r for r in rows if r[0] == u), key=lambda r: (r[1], r[4])):
            if playing and start is None:
                start = ts, index
            elif not playing and start:
                ms, words = (ts - start[0]) // timedelta(milliseconds=1), max(0, index - start[1])
                if ms > 0 and words > 0:
                    sessions.append((u, words, ms))
                start = None
            if index != saved and (not playing or saved_at is None or ts - saved_at >= timedelta(milliseconds=2000)):
                saved_at, saved = ts, index
                writes.append((u, ts, index))
    return sorted(sessions), sorted(writes)


def test_sessions_and_throttle_equal_the_model(spark):
    rows = events(400)
    df = spark.createDataFrame(rows, EVENT)
    want_sessions, want_writes = model(rows)
    assert sorted((r.user_id, r.words, r.ms) for r in reading.sessions(df, ["user_id"]).collect()) == want_sessions
    assert sorted((r.user_id, r.ts, r["index"]) for r in reading.throttled(df, ["user_id"]).collect()) == want_writes


def test_statistics(spark):
    s = spark.createDataFrame([(1, 600, 60_000), (1, -5, -1), (2, 100, 60_000)], "user_id int, words long, ms long")
    a, b = reading.statistics(s, ["user_id"]).orderBy("user_id").collect()
    assert (a.words, a.ms, a.wpm, a.minutes, a.pages, a.minutes_saved, a.your_bar, a.average_bar, a.pace) == (600, 60_000, 600, 1, 2, 1, 100, 42, "faster")
    assert (b.wpm, b.your_bar, b.average_bar, b.pace) == (100, 40, 100, "slower")


def test_latest_finished_and_toggles(spark):
    p = spark.createDataFrame([(1, T0, 1, 10), (1, T0, 2, 99), (2, T0, 3, 0)], "u int, ts timestamp, n int, i int")
    assert {(r.u, r.n) for r in reading.latest(p, ["u"], "ts", "n").collect()} == {(1, 2), (2, 3)}
    assert spark.createDataFrame([(99, 100), (98, 100), (0, 0), (None, 5)], "i int, t int").filter(reading.finished(F.col("i"), F.col("t"))).count() == 1
    e = spark.createDataFrame([(1, T0), (1, T0), (2, T0)], "u int, ts timestamp")
    assert [r.u for r in reading.saved(e, ["u"], "ts").collect()] == [2]


def test_ledgers(spark):
    old, new = (spark.createDataFrame(x, "id int, v string") for x in ([(1, "a"), (2, None)], [(2, "x"), (3, "y")]))
    rows = lambda df: {(r.id, r.v) for r in df.collect()}
    assert rows(ledger.keep_existing(old, new, ["id"])) == {(1, "a"), (2, None), (3, "y")}
    assert rows(ledger.overwrite(old, new, ["id"])) == {(1, "a"), (2, "x"), (3, "y")}
    assert rows(ledger.fill(old, new, ["id"])) == {(1, "a"), (2, "x"), (3, "y")}
    once = ledger.overwrite(old, new, ["id"])
    assert rows(ledger.overwrite(once, new, ["id"])) == rows(once)
    assert ledger.done_ids(old.select("id"), new.select("id")).count() == 3
    ids = spark.createDataFrame([("12-short",), (" 12_Story",), ("12",)], "i string").select(ledger.verdict_id(F.col("i")).alias("i"))
    assert {r.i for r in ids.collect()} == {"12"}
    judged = ledger.apply_verdicts(spark.createDataFrame([(1, "s"), (2, "s"), (3, "s")], "id int, tier string"), spark.createDataFrame([(1, True), (2, False)], "id int, keep boolean"), ["id"])
    r = ledger.verdict_counts(judged).first()
    assert (r.had, r.kept, r.killed, r.unjudged, r.kill_rate) == (3, 1, 1, 1, 67)
    q = ledger.queue(spark.range(10).toDF("id"), spark.range(3).toDF("id"), ["id"], [F.desc("id")], 5, 2).orderBy("place").collect()
    assert [(x.id, x.batch) for x in q] == [(9, 0), (8, 0), (7, 1), (6, 1), (5, 2)]


def test_migration(spark):
    schema = "version int, words_read long, ms_read long, wpm int, vis_mode string, progress struct<book_id:string,i:int>, progress_by_id map<string,struct<book_id:string,i:int>>, fit_mode string, saved_by_id map<string,string>"
    rows = [(0, None, None, None, None, ("b", 5), None, None, None), (1, 7, 8, 400, "rsvp", None, None, None, None), (3, 1, 1, 300, "x", None, {"c": ("c", 1)}, "classic", None), (5, 1, 1, 300, "x", None, {}, "shrink", {"s": "t"})]
    a, b, c, d = ledger.migrate(spark.createDataFrame(rows, schema)).collect()
    assert (a.words_read, a.wpm, a.vis_mode, a.progress_by_id["b"].i, a.fit_mode, a.saved_by_id, a.version) == (0, 300, "rsvp", 5, "centerAll", {}, 5)
    assert (b.words_read, b.wpm, b.progress_by_id, b.fit_mode) == (7, 400, {}, "centerAll")
    assert (c.progress_by_id["c"].i, c.fit_mode) == (1, "centerAll") and (d.fit_mode, d.saved_by_id) == ("shrink", {"s": "t"})
