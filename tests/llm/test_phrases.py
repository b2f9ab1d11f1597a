import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lectern.llm.phrases import Words, phrase_dedup

SCHEMA = "doc_id long, text string, digest string, stretches int"


def brute(texts, width):
    docs = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = {}
    for words in docs:
        for i in range(len(words) - width + 1):
            seen[tuple(words[i : i + width])] = seen.get(tuple(words[i : i + width]), 0) + 1
    found = []
    for words in docs:
        gone = {j for i in range(len(words) - width + 1) if seen[tuple(words[i : i + width])] > 1 for j in range(i, i + width)}
        found.append((len(words), len(gone), " ".join(w for j, w in enumerate(words) if j not in gone)))
    return found


def check(spark, texts, width=5, gram=2, **options):
    docs = spark.createDataFrame([(i, t, "d", 1) for i, t in enumerate(texts)], SCHEMA)
    out = phrase_dedup(docs, width=width, gram=gram, **options)
    assert out.columns == ["row", "n_words", "n_removed", "text"]
    rows = sorted(out.collect(), key=lambda r: r.row.doc_id)
    assert [(r.n_words, r.n_removed, r.text) for r in rows] == brute(texts, width)
    return rows


def test_random_texts_match_brute_force(spark):
    rng = random.Random(3)
    texts = [rng.choice([" ", "\n", " \t"]).join(rng.choice("abcé") + rng.choice(["", "x"]) for _ in range(rng.randrange(0, 40))) for _ in range(150)]
    texts += [None, "", " \x0b\n ", texts[7], texts[7], texts[9].replace(" ", "\n\n"), "a " * 90, "ab ba " * 50, "    x"]
    for options in ({}, {"shard": 3}, {"gram": 5}, {"gram": 1}):
        check(spark, texts, **options)


def test_shared_passage_is_found_inside_documents_and_whole_copies_go(spark):
    rng = random.Random(4)
    own = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    passage = own(60)
    texts = [" ".join(own(50) + passage + own(9)), " ".join(own(3) + passage[10:] + own(70)), " ".join(own(30)), " ".join(own(40))]
    texts += [texts[3], texts[2]]
    rows = check(spark, texts, width=35, gram=8)
    assert [r.n_removed for r in rows] == [50, 50, 0, 40, 40, 0]
    assert rows[0].row.asDict().keys() == {"doc_id", "text", "digest", "stretches"}


def test_passage_of_many_documents_is_salted(spark):
    rng = random.Random(6)
    passage = [f"p{i}" for i in range(30)]
    texts = [" ".join([f"a{i}", f"b{rng.randrange(9)}", *passage, f"c{i}"]) for i in range(900)]
    check(spark, texts, width=8, gram=3, shard=20)


def test_very_long_text(spark):
    words = [f"w{i * i % 100_003}" for i in range(300_000)]
    texts = [" ".join(words), " ".join(words[1000:1100]), " ".join(f"z{i}" for i in range(80))]
    check(spark, texts, width=35, gram=8)


def test_empty_table(spark):
    check(spark, [])


def test_words_of_slices_nulls_and_blocks():
    texts = pa.array(["zero", "a  b", "", None, "\té\n", "b"]).slice(1)
    words = Words(texts.fill_null(""))
    assert words.row.tolist() == [0, 0, 3, 4]
    assert [words.text(i, i).decode() for i in range(4)] == ["a", "b", "é", "b"]
    assert words.hash[1] == words.hash[3] and len(np.unique(words.hash)) == 3
    long = " ".join(f"word{i}" for i in range(400_000))
    assert len(np.unique(Words(pa.array([long])).hash)) == 400_000
