import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lectern.llm.mixing import copies_in_order, in_training_order, mix, targets, time_of, with_sums_before

SCHEMA = "doc_id long, text string, source string, size int, md5 string"


def filled(sizes, weights, share=1.5, cap=2.0):
    """Targets by sharing the excess again until none is above."""
    goal, open_, left = {}, set(sizes), share * sum(sizes.values())
    while open_:
        per = left / sum(weights[s] for s in open_)
        over = {s for s in open_ if per * weights[s] >= cap * sizes[s]}
        if not over:
            goal |= {s: per * weights[s] for s in open_}
            break
        goal |= {s: cap * sizes[s] for s in over}
        left -= sum(cap * sizes[s] for s in over)
        open_ -= over
    return goal


def test_targets_equal_repeated_sharing(spark):
    rng = random.Random(3)
    sizes = {f"s{i:02}": rng.choice([0, 5, 100, 20000]) + rng.randrange(50) for i in range(17)} | {None: 70}
    order = sorted(sizes, key=lambda s: (s is None, s))
    want = filled(sizes, {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)})
    got = {r.source: r.target for r in targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    assert got == pytest.approx(want)


def test_words_taken_meet_the_targets(spark):
    rng = random.Random(4)
    rows = [(i if i % 40 else None, " ".join("w" * rng.randrange(1, 60)) if i % 11 else None, rng.choice(["a", "a", "a", "b", "c", "é", None]), 1, "x") for i in range(400)] + [(1, "w w", "a", 1, "x")] * 3
    out = mix(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == len(rows)
    taken, size, goal = defaultdict(int), defaultdict(int), {}
    for r in out:
        assert 0 <= r.taken <= 2 * r.size and len(r.positions) == -(-r.taken // max(r.size, 1))
        taken[r.source] += r.taken
        size[r.source] += r.size
        goal[r.source] = r.target
    assert taken == {s: int(t) for s, t in goal.items()}
    assert all(r.source_size == size[r.source] for r in out)
    assert all(sum(r.words) == r.taken for r in out)
    again = mix(spark.createDataFrame(rows, SCHEMA).repartition(3)).drop("place").collect()
    assert sorted(str((*r[:1], *r[2:])) for r in out) == sorted(str(tuple(r)) for r in again)


def test_rows_of_one_id_are_taken_alike_from_any_partitioning(spark):
    rows = [(7, " ".join([chr(97 + i % 26)] * 5), "a", i, "x") for i in range(40)] + [(i, "w " * 50, "b", 0, "x") for i in range(9)]
    found = set()
    for n in (1, 3, 7):
        out = mix(spark.createDataFrame(rows, SCHEMA).repartition(n)).collect()
        assert len(out) == len(rows)
        ordered = [(r.row.text, r.words) for r in copies_in_order(mix(spark.createDataFrame(rows, SCHEMA).repartition(n)), ["row"]).collect()]
        found.add((tuple(sorted((r.row.text, r.taken, tuple(r.positions)) for r in out)), tuple(ordered)))
    assert len(found) == 1


def test_copies_follow_their_positions_and_very_long_texts_are_cut(spark):
    rows = [(1, "w " * 2_000_000, "a", 0, "x"), (2, "v " * 30, "b", 0, "x")]
    mixed = mix(spark.createDataFrame(rows, SCHEMA))
    got = copies_in_order(mixed, ["size", "taken"]).collect()
    assert [r.position for r in got] == sorted(r.position for r in got)
    assert {r.size: r.taken for r in got} == {2_000_000: 3_000_045 - 60, 30: 60}


def test_training_order_follows_positions(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"))
    mixed = mix(docs)
    got = [r.source for r in in_training_order(mixed).collect()]
    early, late = got[: len(got) // 3], got[-len(got) // 3 :]
    assert early.count("s0") < late.count("s0") and early.count("s2") > late.count("s2")  # slopes 1 and -1
    assert len(got) == sum(len(r.positions) for r in mixed.collect())


def test_time_inverts_the_integral(spark):
    df = spark.range(101).select((F.col("id") / 100).alias("t")).crossJoin(spark.createDataFrame([(-1.0,), (0.0,), (0.5,), (1.0,)], "slope double"))
    done = F.col("t") * (1 - F.col("slope") / 2) + F.col("slope") * F.col("t") * F.col("t") / 2
    assert df.filter(F.abs(time_of(done, F.col("slope")) - F.col("t")) > 1e-7).count() == 0


def test_sums_before(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), F.lit(2).alias("v"))
    assert with_sums_before(df, [F.col("k")], before="v").filter("before <> 2 * k").count() == 0


def test_empty_table(spark):
    assert mix(spark.createDataFrame([], SCHEMA)).count() == 0
