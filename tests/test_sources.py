import json

from pyspark.sql import functions as F

from lectern.operators import ledger
from lectern.operators.nested import nested_items
from lectern.sources import readers, writers


def put(path, value):
    path.write_text(value if isinstance(value, str) else json.dumps(value), encoding="utf-8")
    return str(path)


def test_catalog_and_themed_pages(spark, tmp_path):
    book = {"id": "1", "title": "T", "author": "A", "downloadCount": 3}
    assert readers.json_table(spark, put(tmp_path / "c.json", [book, {"id": "2"}])).count() == 2
    page = {"key": "k", "title": "K", "hero": [book], "shelves": [{"title": "s", "books": [book, {"id": "2"}]}]}
    rows = readers.themed_pages(spark, put(tmp_path / "v.json", [page])).orderBy("section", "book_pos").collect()
    assert [(r.theme_key, r.section, r.shelf, r.book_pos, r.id) for r in rows] == [("k", 0, None, 0, "1"), ("k", 1, "s", 0, "1"), ("k", 1, "s", 1, "2")]


def test_maps_and_folders(spark, tmp_path):
    path = put(tmp_path / "scenes.json", {"7": [{"startIndex": 4, "label": "L", "recap": "R"}], "8": []})
    assert [(r.book_id, r.start_index, r.label) for r in readers.scenes(spark, path).collect()] == [("7", 4, "L")]
    (tmp_path / "books").mkdir()
    for name, text in (("1.txt", "one\nline"), ("2.txt", "# Head\n")):
        put(tmp_path / "books" / name, text)
    assert {(r.book_id, r.text) for r in readers.text_folder(spark, str(tmp_path / "books")).collect()} == {("1", "one\nline"), ("2", "# Head\n")}
    assert readers.text_folder(spark, str(tmp_path / "books"), ["1"]).count() == 1
    assert {(r.name, r.title) for r in readers.markdown_folder(spark, str(tmp_path / "books")).collect()} == {("1", "1"), ("2", "Head")}


def test_journal_and_nested_arrays(spark, tmp_path):
    inner = json.dumps({"deep": {"verdicts": [{"id": 2}]}})
    lines = ['{"a": {"verdicts": [{"id": 1}, {"id": 9}]}}', "", '{"cut": [1,', json.dumps({"x": [inner]}), "not json", '{"none": 1}']
    path = put(tmp_path / "j.jsonl", "\n".join(lines))
    assert readers.journal(spark, path).count() == 3
    got = nested_items(readers.journal(spark, path), "verdicts").select(F.try_variant_get("item", "$.id", "string").alias("id")).collect()
    assert sorted(r.id for r in got) == ["1", "2", "9"]


def test_paged_services(spark, tmp_path):
    for p, ids in ((1, [10, 11]), (2, [12])):
        put(tmp_path / f"p{p}.json", {"results": [{"id": i, "title": "t", "formats": {}} for i in ids], "next": f"file://{tmp_path}/p2.json" if p == 1 else None})
    url = f"file://{tmp_path}/p{{page}}.json"
    assert sorted((r.page, r.id) for r in readers.paged_catalog(spark, url, 4).collect()) == [(1, 10), (1, 11), (2, 12)]
    assert sorted((r.page, r.id) for r in readers.paged_catalog(spark, url, 4, cursor=True).collect()) == [(1, 10), (1, 11), (2, 12)]
    assert readers.paged_catalog(spark, url, 1, cursor=True).count() == 2


def test_fetch_with_fallback(spark, tmp_path):
    put(tmp_path / "b-1.txt", "body")
    rows = readers.fetched(spark.createDataFrame([(1,), (2,)], "id int"), [f"file://{tmp_path}/a-{{id}}.txt", f"file://{tmp_path}/b-{{id}}.txt"], pause=0).collect()
    assert {(r.id, r.text, r.error) for r in rows} == {("1", "body", None), ("2", None, "not found")}


def test_many_pages_are_few_tasks_and_all_read(tmp_path):
    for p in range(1, 1001):
        put(tmp_path / f"p{p}.json", {"results": [{"id": p}]})
    reader = readers._PagedReader({"url": f"file://{tmp_path}/p{{page}}.json", "pages": "1003"})
    parts = reader.partitions()
    assert len(parts) <= readers.TASKS and sorted(page for part in parts for page, _, _ in reader.read(part)) == list(range(1, 1001))
    assert [readers.pages_a_step(n, least=7) for n in (0, 20, 300, 72_000, 10**6)] == [7, 7, 15, 2000, 2000]


def test_named_files_are_written_by_the_tasks_as_they_are(spark, tmp_path):
    rows = spark.range(500).repartition(4).select(F.concat("id", F.lit(".txt")).alias("name"), F.when(F.col("id") > 0, F.concat(F.lit("é "), F.col("id").cast("string"), F.lit("\n"))).alias("text"))
    for _ in range(2):
        place = writers.named_files(rows, f"{tmp_path}/files")
    assert sorted(p.name for p in (tmp_path / "files").iterdir()) == sorted(f"{i}.txt" for i in range(500))
    got = readers.fetched(spark.range(501).select("id"), [place + "/{id}.txt"], tries=1, pause=0).collect()
    assert {(r.id, r.text) for r in got} == {("0", ""), ("500", None)} | {(str(i), f"é {i}\n") for i in range(1, 500)}


def test_first_tier(spark):
    frame = lambda rows: spark.createDataFrame(rows, "id int, text string")
    out = readers.first_tier("id", frame([(1, ""), (2, "cache")]), frame([(1, " <!DOCTYPE html>"), (2, "m"), (3, "mirror")]), frame([(1, "origin"), (4, None)]))
    assert {(r.id, r.tier, r.text) for r in out.collect()} == {(1, 2, "origin"), (2, 0, "cache"), (3, 1, "mirror")}


def test_writers_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", "text a", None), ("b", "text b", "too short (1)")], "book_id string, text string, reason string")
    writers.replace_json(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    writers.text_by_id(df.withColumn("text", F.concat("text", F.lit("\n\nend\n"))), str(tmp_path / "t2"))
    assert {(r.book_id, r.text) for r in readers.text_folder(spark, str(tmp_path / "t2")).collect()} == {("a", "text a\n\nend\n"), ("b", "text b\n\nend\n")}
    writers.text_by_id(df, str(tmp_path / "t"))
    assert {(r.book_id, r.value) for r in spark.read.text(str(tmp_path / "t")).collect()} == {("a", "text a"), ("b", "text b")}
    writers.with_dead_letters(df, str(tmp_path / "good"), str(tmp_path / "dead"))
    assert (spark.read.parquet(str(tmp_path / "good")).count(), spark.read.parquet(str(tmp_path / "dead")).first().reason) == (1, "too short (1)")
    writers.batch_files(spark.range(7).withColumn("batch", F.floor(F.col("id") / 3)), str(tmp_path / "b"))
    assert len(list((tmp_path / "b").glob("batch=*/part-*.json"))) == 3


def test_upsert_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "kv")
    new = spark.createDataFrame([(2, "y"), (3, "z")], "id int, v string")
    writers.upsert(spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string"), path, ["id"])
    for _ in range(2):
        writers.upsert(new, path, ["id"])
        assert {(r.id, r.v) for r in spark.read.parquet(path).collect()} == {(1, "a"), (2, "y"), (3, "z")}


def test_null_and_repeated_keys(spark, tmp_path):
    path = str(tmp_path / "kv")
    rows = spark.createDataFrame([(None, "a"), (1, "b")], "id int, v string")
    for _ in range(2):
        writers.upsert(rows, path, ["id"])
        assert {(r.id, r.v) for r in spark.read.parquet(path).collect()} == {(None, "a"), (1, "b")} and spark.read.parquet(path).count() == 2
    assert ledger.keep_existing(rows, rows, ["id"]).count() == 2
    assert {(r.id, r.v) for r in ledger.overwrite(rows, spark.createDataFrame([(None, "c")], rows.schema), ["id"]).collect()} == {(None, "c"), (1, "b")}


def report(spark, path):
    return [r.line for r in readers.ordered_report(spark, path).orderBy("part", "at").collect()]


def test_reports_are_ordered_and_committed_last(spark, tmp_path):
    path = str(tmp_path / "board")
    rows = [(f"t{i:03}", i % 3 == 0) for i in range(200)] + [("é", True), (None, False)]
    writers.board(spark.createDataFrame(rows, "title string, done boolean"), path)
    text = report(spark, path)
    assert text[0] == "**68 / 202** ██████░░░░░░░░░░░░░░ 34%"
    assert text[1:] == ["- [ ] "] + [f"- [{'x' if d else ' '}] {t}" for t, d in sorted((t, d) for t, d in rows if t)]
    (tmp_path / "board" / "parts-left-behind").mkdir()  # by a run that stopped before its manifest
    assert report(spark, path) == text
    writers.board(spark.createDataFrame([("x", True), ("y", False)], "title string, done boolean"), path)
    assert report(spark, path) == ["**1 / 2** ██████████░░░░░░░░░░ 50%", "- [x] x", "- [ ] y"]
    manifest = json.loads((tmp_path / "board" / "manifest.json").read_text())
    assert (manifest["v"], manifest["done"], manifest["total"], sum(p["lines"] for p in manifest["parts"])) == (1, 1, 2, 3)
    writers.board(spark.createDataFrame([], "title string, done boolean"), path)
    assert report(spark, path) == ["**0 / 0** ░░░░░░░░░░░░░░░░░░░░ 0%"]


def test_bundles_and_versions(spark, tmp_path):
    starts, nn = spark.createDataFrame([("2", 5), ("1", 3)], "book_id string, start int"), spark.createDataFrame([("9",), ("2",)], "book_id string")
    writers.bundle_files(starts, nn, str(tmp_path / "bundle"))
    assert [json.loads(x) for x in report(spark, str(tmp_path / "bundle"))] == [{"v": 1, "id": "1", "start": 3, "nn": False}, {"v": 1, "id": "2", "start": 5, "nn": False}, {"v": 1, "id": "9", "nn": True}]
    b = writers.bundle(spark.createDataFrame([("2", 5), ("1", 3)], "book_id string, start int"), spark.createDataFrame([("9",)], "book_id string")).first().bundle
    assert json.loads(b) == {"v": 1, "starts": {"1": 3, "2": 5}, "nn": ["9"]}
    got = spark.createDataFrame([("1.2.3",), ("1.2.9",), ("1.9.9",)], "v string").select(writers.next_version(F.col("v")).alias("v")).collect()
    assert [r.v for r in got] == ["1.2.4", "1.3.0", "2.0.0"]


def test_steps_of_a_stream_dont_grow_with_its_batches(spark, tmp_path):
    rows = spark.range(100).selectExpr("id", "id AS batch")
    writers.batch_files(rows, str(tmp_path / "in"))
    files = writers.files_a_step(spark, str(tmp_path / "in"), steps=4)
    assert 25 <= files <= 26
    assert writers.files_a_step(spark, str(tmp_path / "in"), steps=1000) == 1
