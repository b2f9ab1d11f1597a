import json
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from lectern.sources import readers, writers

PAGES = {1: [10, 11], 2: [12], 3: [13, 14], 4: [15], 5: [16]}


@pytest.fixture
def service():
    """A catalog that pages by number, by `next` and by ids, and the paths it was asked for."""
    asked, down = [], set()

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            asked.append(self.path)
            kind, _, what = self.path.strip("/").partition("/")
            books = [i for p in PAGES.values() for i in p if str(i) in what.split(",")] if kind == "ids" else PAGES.get(int(what))
            code = 503 if self.path in down else 200 if books is not None else 404
            self.send_response(code)
            self.end_headers()
            if code == 200:
                follows = f"{url}/page/{int(what) + 1}" if kind == "page" and int(what) + 1 in PAGES else None
                self.wfile.write(json.dumps({"results": [{"id": i, "title": f"t{i}", "formats": {}} for i in books], "next": follows}).encode())

        def log_message(self, *args):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    url = f"http://127.0.0.1:{server.server_port}"
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield url, asked, down
    server.shutdown()


@pytest.fixture
def pushing(spark):
    key = "spark.sql.python.filterPushdown.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    yield
    spark.conf.set(key, before)


def pages_asked(asked):
    return sorted(int(p.rpartition("/")[2]) for p in asked if p.startswith("/page/"))


def test_filters_prune_pages_before_they_are_fetched(spark, service, pushing):
    url, asked, _ = service
    rows = readers.paged_catalog(spark, url + "/page/{page}", 5, pause="0", ids_url=url + "/ids/{ids}")
    for condition, pages in (("page = 3", [3]), ("page in (2, 4)", [2, 4]), ("page > 3 and page <= 5", [4, 5]), ("page < 2", [1]), ("page >= 6", [])):
        asked.clear()
        assert sorted(r.page for r in rows.filter(condition).select("page").distinct().collect()) == pages
        assert pages_asked(asked) == pages
    asked.clear()
    assert sorted(r.id for r in rows.filter("key in ('11', '14', '99')").collect()) == [11, 14]
    assert asked == ["/ids/11,14,99"]
    asked.clear()
    assert [r.id for r in rows.filter("key = '16' and title = 't16'").collect()] == [16] and asked == ["/ids/16"]
    asked.clear()
    assert rows.limit(1).count() == 1 or asked


def test_cursor_stops_after_the_last_page_asked_for(spark, service, pushing):
    url, asked, _ = service
    rows = readers.paged_catalog(spark, url + "/page/{page}", 5, cursor=True, pause="0")
    assert sorted(r.id for r in rows.filter("page <= 2").collect()) == [10, 11, 12]
    assert pages_asked(asked) == [1, 2]
    asked.clear()
    assert rows.count() == 7 and pages_asked(asked) == [1, 2, 3, 4, 5]


def run(spark, tmp_path, url, **options):
    stream = readers.paged_stream(spark, url, 9, pause="0", tries="1", every="2", **options)
    query = writers.resumable(stream, str(tmp_path / "out"), str(tmp_path / "at"))
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return sorted(int(r.id) for r in spark.read.parquet(str(tmp_path / "out")).collect())


@pytest.mark.parametrize("cursor", [False, True])
def test_stream_goes_on_at_the_page_where_it_stopped(spark, service, tmp_path, cursor):
    url, asked, down = service
    down.add("/page/3")
    with pytest.raises(Exception, match="503|STREAM|Service"):
        run(spark, tmp_path, url + "/page/{page}", cursor=cursor)
    assert sorted(int(r.id) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [10, 11, 12]
    down.clear()
    asked.clear()
    assert run(spark, tmp_path, url + "/page/{page}", cursor=cursor) == [10, 11, 12, 13, 14, 15, 16]
    assert 1 not in pages_asked(asked) and set(pages_asked(asked)) >= {3, 4, 5}


def test_flags_of_a_run(spark):
    curated = spark.createDataFrame([("a", 0), ("b", 1), ("", 2)], "id string, place int")
    themed = spark.createDataFrame([("t", 0, 0, None, 0, "b"), ("t", 1, 0, "s", 0, "c"), ("t", 1, 0, "s", 1, "d"), ("u", 0, 0, None, 0, "e")], "theme_key string, section int, shelf_pos int, shelf string, book_pos int, id string")
    done = spark.createDataFrame([("a",), ("c",)], "id string")
    ids = lambda **flags: [r.id for r in readers.run_ids(curated, themed, **flags).orderBy("place").collect()]
    assert ids() == ["a", "b", "c", "d", "e"]
    assert ids(limit=3) == ["a", "b", "c"] and ids(limit=3, done=done) == ["b"] and ids(limit=3, done=done, force=True) == ["a", "b", "c"]
    assert ids(curated_only=True) == ["a", "b"] and ids(theme="t") == ["b", "c", "d"] and ids(theme="t", curated_only=True) == []
    assert ids(ids=["z", " a ", "z"], theme="u") == ["z", "a"] and ids(ids=["z", "a"], limit=1) == ["z"]


def test_only_the_selected_files_are_fetched(spark, service):
    url, asked, _ = service
    some = spark.createDataFrame([("10",), ("12",)], "id string")
    got = readers.fetched(some, [url + "/none/0", url + "/ids/{id}"], tries=1, pause=0).select("id", F.get_json_object("text", "$.results[0].title").alias("t")).collect()
    assert {(r.id, r.t) for r in got} == {("10", "t10"), ("12", "t12")} and len(asked) == 4
