import random
import re
import time
from collections import Counter, defaultdict

from lectern.llm import line_dedup as line_dedup_module
from lectern.llm.common import stored
from lectern.llm.line_dedup import FIELD, LEAD, LONG_DOCS, LONG_WORDS, SIMILAR, SPLITS, line_dedup

SCHEMA = "doc_id long, text string, line string, at int, leaf string"


def templates_of(found, level=0):
    """line -> template, for the distinct lines of one node."""
    if len(found) < 2 or level > SPLITS:
        return {}
    n = len(next(iter(found)))
    counts = [Counter(m[i] for m in found) for i in range(n)]
    constant = [next((t for t, k in c.items() if 2 * k > len(found)), None) for c in counts]
    fits = [m for m in found if sum(c == t for c, t in zip(constant, m)) >= SIMILAR * n]
    out = {m: tuple(FIELD if c is None else c for c in constant) for m in fits}
    alike = Counter(len(c) for c in counts if len(c) > 1)
    kinds = min(alike, key=lambda k: (-alike[k], k))
    place = next(i for i, c in enumerate(counts) if len(c) == kinds)
    parts = defaultdict(set)
    for m in found - set(fits):
        parts[m[place]].add(m)
    for part in parts.values():
        out |= templates_of(part, level + 1)
    return out


def brute(rows, min_docs):
    """(doc_id, n_lines, n_dropped, text left) line by line."""
    def mask(line):
        return tuple(FIELD if re.search("[0-9]", t) else t for t in re.findall(r"[^\x20\x09-\x0D]+", line))

    leaves = defaultdict(set)
    for _, text in rows:
        for m in map(mask, (text or "").split("\n")):
            if m:
                leaves[len(m), m[:LEAD]].add(m)
    template = {}
    for found in leaves.values():
        template |= {m: m for m in found} | templates_of(found)
    texts = defaultdict(set)
    for _, text in rows:
        for m in map(mask, (text or "").split("\n")):
            if m:
                texts[template[m]].add(text or "")
    asked = lambda m: min(LONG_DOCS, min_docs) if len(m) >= LONG_WORDS else min_docs
    for d, text in rows:
        parts = (text or "").split("\n")
        left = [p for p in parts if not (m := mask(p)) or len(texts[template[m]]) < asked(m)]
        yield d, len(parts), len(parts) - len(left), "\n".join(left)


def test_matches_brute_force(spark):
    rng, rows = random.Random(3), []
    shared = ["All rights reserved.", "Page {} of {}", "Posted by {} at {}:{} in the news section today", "Copyright (c) {} the owners of this page and more", "  the   same\tline  ",
              "Read more about {} in the sports section", "Read more about {} on our weekly blog", "Read more about {} at tonight's live show",
              "Read more about {} " + "and what the people of this town " * 8]
    for i in range(300):
        names = ["ann", "bob", "eve é", "12", f"user{i}"]
        lines = [" ".join(rng.choice("abcdefgh") * 3 for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(0, 6))]
        for s in shared:
            if rng.random() < 0.3:
                lines.insert(rng.randrange(len(lines) + 1), re.sub(r"\{\}", lambda _: rng.choice(names), s))
        rows.append((i if i % 60 else None, "\n".join(lines) if i % 41 else None, "x", 1, "y"))
    rows += [(5, "All rights reserved.", "x", 1, "y")] * 3 + [(400, "w " * 50_000 + "\nAll rights reserved.", "", 0, ""), (401, "", "", 0, ""), (402, "\n\n", "", 0, "")]
    out = line_dedup(spark.createDataFrame(rows, SCHEMA), min_docs=8).collect()
    want = list(brute([r[:2] for r in rows], 8))
    assert sorted([(r.row.doc_id, r.n_lines, r.n_dropped, r.text) for r in out], key=str) == sorted(want, key=str)
    assert sum(w[2] for w in want) > 100
    assert all(r.row.line is not None for r in out)


def test_variable_fields_are_generalised(spark):
    rows = [(i, f"own words number {i} here {'x' * i}\nPosted this week by {n} in the main section of our site") for i, n in enumerate("ann bob cid dan eve fay gus hal ivy jon".split())]
    out = line_dedup(spark.createDataFrame(rows, "doc_id long, text string"), min_docs=10).collect()
    assert all(r.n_dropped == 1 and "Posted" not in r.text for r in out)


def test_formats_that_share_a_leaf_are_told_apart(spark):
    names = [a + b for a in "bcdfg" for b in ("am", "em", "im", "om")]
    formats = ["Read more about {} in the sports section", "Read more about {} on our weekly blog", "Read more about {} at tonight's live show"]
    rows = [(len(names) * f + i, form.format(n)) for f, form in enumerate(formats) for i, n in enumerate(names)]
    rows += [(900, "Read more about ships than you ever could")]
    out = line_dedup(spark.createDataFrame(rows, "doc_id long, text string"), min_docs=10).collect()
    assert [r.row.doc_id for r in out if not r.n_dropped] == [900]


def test_long_lines_ask_fewer_texts_and_copies_are_one_text(spark):
    passage, pair = " ".join(f"w{'abcdefghij'[i % 10]}{'klmnop'[i // 10]}" for i in range(60)), " ".join(["tide"] * 55 + ["left"] * 5)
    copied = " ".join(["only", "here", *["copy"] * 60])
    rows = [(i, f"start {w}\n{passage}\nshort line in three") for i, w in enumerate(("one", "two", "six"))]
    rows += [(10 + i, f"begin {w}\n{pair}") for i, w in enumerate(("one", "two"))] + [(20 + i, copied) for i in range(30)]
    out = {r.row.doc_id: r for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [out[i].text for i in range(3)] == [f"start {w}\nshort line in three" for w in ("one", "two", "six")]
    assert all(r.n_dropped == 0 for i, r in out.items() if i >= 10)


def test_long_lines_and_texts_of_many_lines_take_linear_time(spark):
    took = []
    for n in (5_000, 20_000):
        tokens = ["word"] * n
        rows = [(i, " ".join([*tokens[:-1], name])) for i, name in enumerate("abcdefghijkl")]
        rows += [(100 + i, "\n".join(["All rights reserved."] + [f"line of {x}" for x in ("one", "two")] * (n // 2 + i))) for i in range(12)]
        df, began = spark.createDataFrame(rows, "doc_id long, text string").repartition(4), time.time()
        out = line_dedup(df, min_docs=10).collect()
        assert all(r.text == "" and r.n_dropped == r.n_lines for r in out)
        took.append(time.time() - began)
    assert took[1] < 6 * took[0] + 5


def test_empty_table(spark):
    assert line_dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def test_only_lines_of_full_leaves_are_written(spark, monkeypatch):
    written = []
    monkeypatch.setattr(line_dedup_module, "stored", lambda df, tag: written.append((tag, stored(df, tag))) or written[-1][1])
    monkeypatch.setattr(line_dedup_module, "discard", lambda df: None)
    rows = [(i, f"own{chr(97 + i)} words stand here\nSeen at {i}:00 by  all of us\n\t \n7 {'z' * i} end") for i in range(12)]
    out = line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all((r.n_lines, r.n_dropped) == (4, 1) and "Seen" not in r.text for r in out)
    lines = [r.masked for tag, df in written if tag == "lines" and "masked" in df.columns for r in df.select("masked").collect()]
    assert lines == ["Seen at <*> by all of us"] * 12
