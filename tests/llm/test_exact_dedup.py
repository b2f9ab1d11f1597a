import hashlib
import re

from pyspark.sql import functions as F

from lectern.llm.exact_dedup import exact_dedup

SCHEMA = "doc_id long, text string, norm string, sha int"


def brute(rows):
    groups = {}
    for doc_id, text, *_ in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(doc_id)
    for norm, ids in groups.items():
        real = sorted(i for i in ids if i is not None)
        keep = real[0] if real else None
        yield from (((i, keep, len(ids), hashlib.sha256(norm.encode()).hexdigest())) for i in ids)


def by_text(rows):
    return sorted(rows, key=str)


def test_groups_match_brute_force_with_nulls_ties_and_clashing_names(spark):
    rows = [(5, "a  b", "x", 1), (3, "a\tb", None, 2), (3, "a b", "y", 3), (None, "a b", "z", 4), (9, None, None, None), (8, "", "n", 0), (7, "é b", "n", 0), (6, "é\n b" * 5000, "n", 0), (None, "q", "n", 0)]
    out = exact_dedup(spark.createDataFrame(rows, SCHEMA)).collect()
    assert by_text((r.row.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in out) == by_text(brute(rows))
    kept = [r for r in out if r.kept]
    assert len(kept) == len({r.text_sha256 for r in out})
    assert all(r.row.doc_id == r.keep_id for r in kept)
    assert out[0].row.asDict().keys() == {"doc_id", "text", "norm", "sha"}


def test_hot_group_is_salted_and_put_together(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 1, "same  text").otherwise(F.concat(F.lit("own "), "id")).alias("text"))
    out = exact_dedup(docs, keep=["doc_id"])
    assert "salt" in out._jdf.queryExecution().toString()
    got = out.groupBy("keep_id", "group_size", "kept").count().filter("group_size > 1").collect()
    assert {(r.keep_id, r.group_size, r.kept, r["count"]) for r in got} == {(1, 2000, True, 1), (1, 2000, False, 1999)}


def test_hot_text_of_null_and_repeated_ids_is_salted(spark):
    for ids, keep in (("null", None), ("7", 7), ("if(id % 4 = 1, 7, 9)", 7), ("if(id % 4 = 1, null, 9)", 9)):
        docs = spark.range(0, 4000, 1, 8).select(F.expr(f"cast({ids} as long)").alias("doc_id"), F.when(F.col("id") % 2 == 1, "same  text").otherwise(F.concat(F.lit("own "), "id")).alias("text"))
        out = exact_dedup(docs)
        stored = [f for f in out.inputFiles() if "/runs-" in f]
        assert stored and spark.read.parquet(*stored).filter("part_text is not null").count() > 1
        got = out.filter("row.text = 'same  text'").groupBy("keep_id", "group_size").agg(F.count("*").alias("n"), F.count_if("kept").alias("kept")).collect()
        assert [tuple(r) for r in got] == [(keep, 2000, 2000, 1)]
        assert out.filter("row.text <> 'same  text' and kept").count() == 2000


def test_texts_with_a_long_common_opening_are_dealt_by_what_follows(spark):
    opening = "the same opening words again and " * 90  # 2970 characters
    docs = spark.range(0, 1500, 1, 4).select(F.col("id").alias("doc_id"), F.concat(F.lit(opening), (F.col("id") % 700).cast("string")).alias("text"))
    out = exact_dedup(docs, keep=["doc_id"])
    got = {r.row.doc_id: (r.keep_id, r.group_size, r.kept) for r in out.collect()}
    assert got == {i: (i % 700, 3 if i % 700 < 100 else 2, i < 700) for i in range(1500)}
    plan = out._jdf.queryExecution().toString()
    assert "left(norm" in plan and "16384" in plan


def test_order_is_that_of_the_content(spark):
    docs = spark.range(0, 900, 1, 3).select(F.col("id").alias("doc_id"), F.concat(F.md5(F.col("id").cast("string")), F.lit("  tail")).alias("text"))
    texts = [r.row.text for r in exact_dedup(docs).collect()]
    assert texts == sorted(texts)


def test_empty_table(spark):
    assert exact_dedup(spark.createDataFrame([], SCHEMA)).count() == 0
