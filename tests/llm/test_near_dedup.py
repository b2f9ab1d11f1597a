import random
import re
from collections import defaultdict

import numpy as np
import pytest

from lectern.llm.components import components
from lectern.llm.near_dedup import PERMUTATIONS, near_dedup, signature
from lectern.llm.shingles import WordHashes, common, shingle_set


def sets_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words)} if 0 < len(words) < 5 else {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    """(doc_id, n_shingles, component_id) by comparing all pairs."""
    sets = [sets_of(t) for _, t in rows]
    where, near = defaultdict(list), defaultdict(lambda: defaultdict(int))
    for i, s in enumerate(sets):
        for x in s:
            for j in where[x]:
                near[i][j] += 1
            where[x].append(i)
    top = list(range(len(rows)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i, others in near.items():
        for j, n in others.items():
            if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                top[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted([(d, len(sets[i]), least.get(root(i))) for i, (d, _) in enumerate(rows)], key=str)


def check(spark, rows, schema="doc_id long, text string"):
    out = near_dedup(spark.createDataFrame(rows, schema)).collect()
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in out], key=str) == brute([r[:2] for r in rows])
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_edge_cases(spark):
    long = " ".join(f"w{i}" for i in range(6000))
    rows = [(4, "A b", 0), (2, "a  B", 0), (2, "a b", 1), (9, None, 0), (8, "", 0), (7, " \n", 0), (6, long, 0), (5, long + " tail", 0), (None, "a b", 0), (11, "a b c d e", 0), (12, "ª b c d é", 0), (13, " ", 0)]
    check(spark, rows, "doc_id long, text string, cls int")


def test_chains_and_large_groups_match_brute_force(spark):
    rng, rows = random.Random(7), []
    for base in range(12):
        words = [f"v{rng.randrange(500)}" for _ in range(rng.randrange(30, 200))]
        for _ in range(40 if base else 300):
            if rng.random() < 0.6:
                words = [f"v{rng.randrange(500)}" if rng.random() < 0.012 else w for w in words]
            rows.append((len(rows), " ".join(words)))
    rng.shuffle(rows)
    check(spark, rows)


def test_empty_table(spark):
    assert near_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_min_max_signature_is_an_unbiased_estimate():
    words, rng, errors = WordHashes(), random.Random(1), []
    for _ in range(60):
        base = [str(rng.random()) for _ in range(400)]
        other = [w if rng.random() > 0.03 else str(rng.random()) for w in base]
        a, b = (shingle_set(" ".join(x), words) for x in (base, other))
        n = common(a, b)
        errors.append(np.mean(signature(a) == signature(b)) - n / (len(a) + len(b) - n))
    assert abs(np.mean(errors)) < 0.01
    assert np.std(errors) < 1.3 * np.sqrt(0.25 / (2 * PERMUTATIONS))


@pytest.mark.parametrize("n", [2, 40])
def test_components_of_a_path(spark, n):
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(100, 100), (200, 300)], "a long, b long")
    assert {(r.node, r.label) for r in components(edges).collect()} == {(i, 0) for i in range(1, n + 1)} | {(300, 200)}


def test_components_match_a_search(spark):
    rng = random.Random(11)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(330)] + [(500, 500 + i) for i in range(1, 60)] + [(600 + i, 600 + (i + 1) % 9) for i in range(9)] + [(700, 701), (701, 700), (702, 702)]
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    want, seen = set(), set()
    for least in sorted(near):
        todo = [] if least in seen else [least]
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += near[x]
                want |= {(x, least)} - {(least, least)}
    found = components(spark.createDataFrame(edges, "a long, b long").repartition(3)).collect()
    assert len(found) == len(want) and {(r.node, r.label) for r in found} == want


def jobs_of(spark, name, work):
    spark.sparkContext.setJobGroup(name, name)
    try:
        work()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_the_driver_runs_few_jobs(spark):
    """Each job's plan, threads and broadcasts take memory of the driver; there were 99 jobs when sides of joins were counted and tables were copied by jobs of their own."""
    rng = random.Random(3)
    base = [[f"v{rng.randrange(500)}" for _ in range(80)] for _ in range(20)]
    rows = [(20 * k + i, " ".join([*words[k:], *(f"t{k}" for _ in range(k))])) for i, words in enumerate(base) for k in range(6)]
    assert jobs_of(spark, "near", lambda: near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()) < 90
