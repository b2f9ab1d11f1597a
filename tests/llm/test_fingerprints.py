import random

import numpy as np
import pytest

from lectern.llm import fingerprints as f
from lectern.llm.fingerprints import K, PICK, SKETCHES, edit_fingerprints, edited_text, likeness, numbered_kmers, sketch


def slow_sketch(text):
    """The tuples of the least numbered k-mers in text order, one hash function at a time."""
    h = (numbered_kmers(np.frombuffer(text.encode("utf-32-le"), np.uint32)) >> np.uint64(32)).astype(np.uint32)
    for odd in f._ODD:
        values = [(int(x) * int(odd) % 2**32, i) for i, x in enumerate(h)]
        least = sorted(values)[:PICK]
        yield tuple(v for v, _ in sorted(least, key=lambda x: x[1]))


def test_sketch_equals_brute_force():
    rng = random.Random(1)
    texts = ["".join(rng.choice("abé🎉 ") for _ in range(n)) for n in (1, 3, K, K + 1, 40, 300, 20000)]
    tuples = [list(slow_sketch(t)) for t in texts]
    sketches = [sketch(t) for t in texts]
    for a, x in zip(tuples, sketches):
        for b, y in zip(tuples, sketches):
            assert np.array_equal(x == y, [p == q for p, q in zip(a, b)])


def test_occurrences_are_numbered():
    h = numbered_kmers(np.frombuffer(("abcdef" * 50).encode("utf-32-le"), np.uint32))
    assert len(set(h.tolist())) == len(h)
    big = np.frombuffer(("abcdefg" * 160_000).encode("utf-32-le"), np.uint32)
    assert np.array_equal(numbered_kmers(big)[:1000], numbered_kmers(big[: 1000 + K - 1]))


def test_hashes_stand_for_kmers_and_their_numbers():
    rng, seen = random.Random(4), {}
    for n in (K, 50, 3000):
        text, before = "".join(rng.choice("abé🎉") for _ in range(n)), {}
        h = numbered_kmers(np.frombuffer(text.encode("utf-32-le"), np.uint32)).tolist()
        assert len(h) == n - K + 1
        for i, x in enumerate(h):
            kmer = text[i : i + K]
            before[kmer] = before.get(kmer, -1) + 1
            assert seen.setdefault((kmer, before[kmer]), x) == x
    assert len(set(seen.values())) == len(seen)


def test_likeness_falls_with_edits_and_moves():
    rng = random.Random(2)
    words = [str(rng.randrange(10**6)) for _ in range(600)]
    text = " ".join(words)
    small = " ".join(w if rng.random() > 0.02 else "x" for w in words)
    moved = " ".join(words[300:] + words[:300])
    base = sketch(text)
    assert likeness(base, sketch(text)) == 1
    assert 0.5 < likeness(base, sketch(small)) < 1
    assert 0.2 < likeness(base, sketch(moved)) < 0.8  # the same k-mers in another order
    assert likeness(base, sketch(" ".join(str(rng.random()) for _ in range(600)))) < 0.05


@pytest.mark.parametrize("many", [1, 2, 700])
def test_next_document_and_edited_text(spark, many):
    rng = random.Random(many)
    rows = [(i * 3 if i % 50 else None, None if i % 31 == 5 else "".join(rng.choice("abcdé \n") for _ in range(rng.choice([0, 1, 2, 9, 200]))), "x", 1, 2) for i in range(1, many + 1)]
    if many == 700:
        rows += [(6, "same", "y", 1, 1), (6, "other", "y", 1, 1), (1, "long " * 30000, "", 0, 0)]
    rng.shuffle(rows)
    out = edit_fingerprints(spark.createDataFrame(rows, "doc_id long, text string, range string, ahead int, home int")).collect()
    order = sorted(((d, t or "") for d, t, *_ in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    want = []
    for (d, t), (_, following) in zip(order, order[1:] + order[:1]):
        e = edited_text(t, following)
        want.append((d, len(t), f.spelled(sketch(t)), e, f.spelled(sketch(e)), likeness(sketch(t), sketch(e)), likeness(sketch(t), sketch(following))))
    assert sorted(map(tuple, out), key=str) == sorted(want, key=str)


def test_empty_table(spark):
    assert edit_fingerprints(spark.createDataFrame([], "doc_id long, text string")).count() == 0
