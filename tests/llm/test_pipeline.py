import corpus_pipeline as pipeline
import pytest
import random
from collections import Counter
from pathlib import Path

from lectern.llm.common import clearing, stored
from tests.llm.test_exact_dedup import brute as exact
from tests.llm.test_mixing import filled
from tests.llm.test_near_dedup import brute as near


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows after each stage, over invented documents of two languages."""
    rng = random.Random(5)
    vocabulary = {"en": ["the", "house", "with", "shutters", "stood", "alone", "nothing", "through"], "xx": ["zaq", "uvo", "qivu", "zozu", "vaquz", "oqi", "uzava", "quzo"]}
    rows = []
    for i in range(160):
        lang = rng.choice(["en", "en", "xx"])
        text = " ".join(rng.choice(vocabulary[lang]) for _ in range(rng.randrange(8, 60)))
        rows.append((i, text, lang, rng.choice(["a", "a", "b", None]), len(text)))
    rows += [(200 + i, rows[i][1].replace(" ", "\n"), *rows[i][2:]) for i in range(20)]
    rows += [(300 + i, rows[i][1] + " tail", *rows[i][2:]) for i in range(30)]
    rows += [(400, None, None, "a", 0), (401, "123 --", None, "b", 6), (402, "", "en", "b", 0), (None, rows[3][1], "en", None, 5)]
    docs, found = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), [rows]
    folder = tmp_path_factory.mktemp("stages")
    for name, stage in pipeline.STAGES:
        stage(spark, docs, None).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        found.append([tuple(r) for r in docs.collect()])
    return found


def order(rows):
    return sorted(rows, key=str)


def test_language_keeps_all_that_has_words(stages):
    assert order(stages[1]) == order(r for r in stages[0] if any(c.isalpha() for c in r[1] or ""))


def test_exact_and_near_copies_go(stages):
    keep = {(k, d) for d, k, *_ in exact([r[:2] for r in stages[1]])}
    assert order(stages[2]) == order(r for r in stages[1] if (r[0], r[0]) in keep)
    heads = {c for _, _, c in near([r[:2] for r in stages[2]])}
    assert order(stages[3]) == order(r for r in stages[2] if r[0] in heads)


def test_mix_repeats_rows_and_encode_keeps_them(stages):
    assert set(stages[4]) <= set(stages[3])
    assert all(stages[4].count(r) <= 2 for r in stages[3])
    assert order(r[:2] for r in stages[5]) == order((r[0], r[3]) for r in stages[4])
    assert all(n == len(ids) > 0 for _, _, ids, n in stages[5])


def test_mix_meets_its_targets(stages):
    size = lambda rows: Counter((r[3], len((r[1] or "").split())) for r in rows)
    words = Counter()
    for (source, n), times in size(stages[3]).items():
        words[source] += n * times
    taken = Counter()
    for (source, n), times in size(stages[4]).items():
        taken[source] += n * times
    goal = filled(dict(words), {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(words, key=lambda s: (s is None, s or "")))})
    for source, want in goal.items():
        assert want - 1 <= taken[source] < want + 61, (source, want, taken[source])  # a source's last document is given whole


EXTRA = "row string, _key int, position string, _id int, found string, norm int, place long, leaf string, copied int"


def test_stages_take_empty_tables_long_texts_and_clashing_columns(spark, tmp_path):
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"
    long = " ".join(f"the house {i} stood alone" for i in range(60_000))  # 1.5 million characters
    rows = [(i, t, "en", s, 1, "r", i, None, 3, "f", None, 5, "l", 0) for i, (t, s) in enumerate([(long, "a"), ("the house with shutters stood alone and nothing came through " * 3, "b"), (long, "a"), (None, None), ("nothing through the house", None), ("nothing through the house", None)])]
    for some, n in ((rows, 3), ([], 0)):
        docs = spark.createDataFrame(some, schema)
        for i, (name, stage) in enumerate(pipeline.STAGES):
            path = str(tmp_path / f"{n}-{name}")
            stage(spark, docs, None).write.parquet(path)
            out = spark.read.parquet(path)
            assert i == 4 or out.columns == docs.columns, name
            docs = out
            if name == "near_dedup":
                assert docs.count() == n
        assert (docs.count() > 0) == (n > 0) and docs.filter("n_tokens <> size(ids)").isEmpty()


def test_intermediate_tables_are_cleared(spark):
    with clearing(spark):
        kept = stored(spark.range(3), "cleared")
        assert kept.count() == 3
        with clearing(spark):
            inner = stored(spark.range(2), "cleared").inputFiles()[0]
        assert not Path(inner.removeprefix("file:").replace("//", "/")).exists()
        at = kept.inputFiles()[0]
    assert not Path(at.removeprefix("file:").replace("//", "/")).exists()
