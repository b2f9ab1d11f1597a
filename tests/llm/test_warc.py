import gzip
import hashlib
from pathlib import Path

import pytest

from lectern.llm.warc import base32_sha1, read_warc, record, records_of, write_warc

SCHEMA = "page_id long, url string, html string, head int, key string"
ROWS = [
    (5, "http://a/ b", "<p>é</p>", 1, "x"), (9, "http://b", "<p>é</p>", 1, "x"), (7, None, "<p>é</p>", None, None), (1, "u", None, 0, "n"), (2, "u\r\nX: y", "", 0, "n"),
    (3, "u", "long " * 200_000, 0, "n"), (None, "u", "only", 0, "n"), (None, "u", "<p>é</p>", 0, "n"), (8, "u", "\r\n\r\nWARC/1.1\r\n", 0, "n"), (9, "http://b", "<p>é</p>", 1, "x"),
]


def expected(rows):
    heads = {}
    for i, _, html, *_ in rows:
        if i is not None:
            heads[html or ""] = max(i, heads.get(html or "", i))
    for i, _, html, *_ in rows:
        head, payload = heads.get(html or ""), (html or "").encode()
        revisit = head is not None and head != i
        yield i, len(payload), base32_sha1(payload), "revisit" if revisit else "response", head if revisit else None, None if revisit else payload


def test_round_trip(spark, tmp_path):
    folder = f"file://{tmp_path}/w"
    write_warc(spark.createDataFrame(ROWS, SCHEMA), folder, shards=3, roll_bytes=400)
    got = read_warc(spark, folder).collect()
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got], key=str) == sorted(expected(ROWS), key=str)
    manifest = spark.read.json(f"{folder}/manifest").collect()
    assert len(manifest) > 3 and sum(r.records for r in manifest) == len(ROWS)
    for r in manifest:
        data = Path(tmp_path, "w", r.file).read_bytes()
        assert (len(data), hashlib.sha256(data).hexdigest()) == (r.bytes, r.sha256)
    assert not list(Path(tmp_path, "w").glob(".pages*"))
    with pytest.raises(FileExistsError):
        write_warc(spark.createDataFrame(ROWS, SCHEMA), folder)


def test_same_bytes_each_time(spark, tmp_path):
    for name in "ab":
        write_warc(spark.createDataFrame(ROWS, SCHEMA), f"file://{tmp_path}/{name}", shards=3, roll_bytes=400)
    files = [{p.name: p.read_bytes() for p in Path(tmp_path, name).glob("*.warc.gz")} for name in "ab"]
    assert files[0] == files[1] and files[0]


def test_same_files_for_other_partitions_of_a_large_table(spark, tmp_path):
    pages = spark.range(40_000).selectExpr("id * 7 % 40009 AS page_id", "concat('http://', id) AS url", "concat('<p>', id % 9000) AS html")
    for name, dealt in (("a", pages.repartition(3)), ("b", pages.repartition(7, "url"))):
        write_warc(dealt, f"file://{tmp_path}/{name}", shards=4, roll_bytes=300_000)
    lists = [sorted(map(tuple, spark.read.json(f"file://{tmp_path}/{name}/manifest").collect()), key=str) for name in "ab"]
    assert lists[0] == lists[1] and len(lists[0]) > 4 and sum(r[4] for r in lists[0]) == 40_000
    per_shard = {}
    for r in spark.read.json(f"file://{tmp_path}/a/manifest").collect():
        per_shard[r.file[:12]] = per_shard.get(r.file[:12], 0) + r.records
    assert len(per_shard) == 4 and max(per_shard.values()) < 15_000


def test_a_second_attempt_leaves_the_first_ones_files(tmp_path):
    from lectern.llm.warc import _Shard

    for data in (b"same", b"same", b"other"):
        shard = _Shard(f"file://{tmp_path}/s", 0, 1)
        list(shard.add(1, data))
        assert [p.name for p in Path(tmp_path, "s").iterdir()] == ["pages-000000-00000.warc.gz"]
        assert gzip.decompress(Path(tmp_path, "s", "pages-000000-00000.warc.gz").read_bytes()).endswith(data)


def test_damage_is_found(tmp_path):
    data = record(1, "u", b"abc", None, False)
    list(records_of(gzip.GzipFile(fileobj=__import__("io").BytesIO(gzip.compress(data)))))
    with pytest.raises(ValueError):
        list(records_of(__import__("io").BytesIO(data.replace(b"abc", b"abd"))))
    with pytest.raises(ValueError):
        list(records_of(__import__("io").BytesIO(data[:-2])))


def test_empty_table(spark, tmp_path):
    write_warc(spark.createDataFrame([], SCHEMA), f"file://{tmp_path}/e")
    assert read_warc(spark, f"file://{tmp_path}/e").count() == 0
