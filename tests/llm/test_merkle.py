import hashlib

from pyspark.sql import functions as F

from lectern.llm.merkle import encoded, folded, leaf, manifest, siblings

SCHEMA = "doc_id long, text string, source string, leaf string, proof int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def up(nodes):
    """All levels of a tree."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def around(levels, i):
    found = []
    for level in levels[:-1]:
        a = i // 3 * 3
        found.append((level[a:i], level[i + 1 : a + 3]))
        i //= 3
    return found


def brute(rows):
    """Sorted (doc_id, leaf, subroot, root, proof)."""
    spell = lambda x: "-" if x is None else f"{len(str(x).encode())}:{x}"
    groups = {}
    for doc_id, text, source, *_ in rows:
        groups.setdefault(source, []).append((doc_id is not None, doc_id or 0, h(spell(doc_id), spell(source), spell(text)), doc_id))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: up([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in order}
    whole = up([trees[s][-1][0] for s in order])
    found = []
    for at, s in enumerate(order):
        for i, (*_, digest, doc_id) in enumerate(sorted(groups[s], key=lambda x: x[:3])):
            found.append((doc_id, digest, trees[s][-1][0], whole[-1][0], around(trees[s], i) + around(whole, at)))
    return sorted(found, key=str)


def built(spark, rows, parts=3, **options):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    out = manifest(docs, leaf(F.col("doc_id"), F.col("source"), F.col("text")), **options)
    found = [(r.row.doc_id, r.leaf, r.subroot, r.root, [(list(s.before), list(s.after)) for s in r.proof]) for r in out.collect()]
    assert out.filter(folded(F.col("leaf"), F.col("proof")) != F.col("root")).isEmpty()
    return sorted(found, key=str)


def test_nulls_ties_repeats_and_clashing_names(spark):
    rows = [(3, "c", "b", "x", 1), (1, "a", "b", None, None), (None, None, "b", "y", 2), (2, "", None, "z", 3), (2, "é\n" * 9000, None, "z", 3), (2, "é\n" * 9000, None, "z", 3), (7, "q", "é", "", 0), (-5, "q", "a", "", 0), (7, "", "", "", 0)]
    assert built(spark, rows) == brute(rows)
    out = manifest(spark.createDataFrame(rows, SCHEMA), leaf(F.col("text")))
    assert out.columns == ["row", "leaf", "subroot", "root", "proof"]
    assert out.first().row.asDict().keys() == {"doc_id", "text", "source", "leaf", "proof"}


def test_hot_source_across_partitions_and_rounds(spark):
    rows = [(i, f"text {i}", "hot" if i % 3 else f"s{i % 60}", None, None) for i in range(700)]
    want = brute(rows)
    for step in (1, 2, 8):
        assert built(spark, rows, step=step) == want
    once = [(i, "t", None, None, None) for i in range(243)]
    assert built(spark, once, step=5) == brute(once)


def test_equal_rows_are_dealt_out(spark):
    rows = [(1, "same", "s", None, None)] * 300 + [(2, "other", "s", None, None)]
    assert built(spark, rows) == brute(rows)


def test_many_sources_and_lone_leaves(spark):
    rows = [(i, "x", f"source {i}", None, None) for i in range(100)]
    assert built(spark, rows, step=2) == brute(rows)
    alone = [(1, "x", "s", None, None)]
    ((_, digest, subroot, root, proof),) = built(spark, alone)
    assert digest == subroot == root and proof == []


def test_tampering_is_seen(spark):
    rows = [(i, f"line {i}\nline", "s", None, None) for i in range(20)]
    out = manifest(spark.createDataFrame(rows, SCHEMA), leaf(F.col("doc_id"), F.col("text")))
    changed = leaf(F.col("row.doc_id"), F.replace("row.text", F.lit("\n"), F.lit("")))
    assert out.filter(folded(changed, F.col("proof")) == F.col("root")).isEmpty()
    assert out.filter(F.length(siblings(F.col("proof"))) % 64 != 0).isEmpty()


def test_fields_cannot_run_into_each_other(spark):
    row = spark.createDataFrame([("a", "1:b", None)], "x string, y string, z string").select(encoded(F.col("x"), F.col("y"), F.col("z")).alias("e")).first()
    assert row.e == "1:a3:1:b-"


def test_empty_table(spark):
    assert built(spark, []) == []
