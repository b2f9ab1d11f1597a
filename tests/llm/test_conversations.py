import hashlib
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from lectern.llm.conversations import damaged, repair

SCHEMA = "conv_id long, turn long, role string, text string, key string, copies int"
AFTER = {"": "u", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}


def cheapest(rows):
    """(cost, audit, lines) by extending every way edit by edit; rows are (role, text, fault)."""
    def inserted(ways):
        for _ in range(3):
            for state, (cost, audit, lines) in list(ways.items()):
                to = AFTER[state]
                way = (cost + 2, audit + "I", [*lines, NAMES[to] + ":"])
                ways[to] = min(ways.get(to, way), way)
        return ways

    ways = {"": (0, "", [])}
    for role, text, fault in rows:
        found = {}
        for state, (cost, audit, lines) in inserted(ways).items():
            steps = [(state, 3, "D", [])]
            if fault in ("ok", "truncated"):
                more = int(fault == "truncated")
                if role[:1] == AFTER[state] or (state == "" and role[:1] == "s"):
                    steps.append((role[:1], more, "K", [f"{role}:{text}"]))
                steps.append((AFTER[state], 2 + more, "R", [f"{NAMES[AFTER[state]]}:{text}"]))
            for to, c, letter, more_lines in steps:
                way = (cost + c, audit + letter, lines + more_lines)
                found[to] = min(found.get(to, way), way)
        ways = found
    return min(way for state, way in inserted(ways).items() if state in ("", "a"))


def brute(rows):
    """{conv: (gaps, blank, duplicate, truncated, illegal, cost, audit, digest)} of (conv, turn, role, text, copies)."""
    convs = {}
    for conv, turn, role, text, copies in rows:
        convs.setdefault(conv, []).extend([(turn is not None, turn or 0, role if role is not None else " ", text if text is not None else " ")] * copies)
    found = {}
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[0], r[1], r[2].encode(), r[3].encode()))
        seen, faults = set(), []
        for _, _, role, text in own:
            if not re.search(r"[^\x20\x09-\x0D]", text):
                faults.append("blank")
            elif (role, text) in seen:
                faults.append("duplicate")
            else:
                faults.append("ok" if re.search(r"[.!?][\x20\x09-\x0D]*\Z", text) else "truncated")
            seen.add((role, text))
        turns = {t for known, t, *_ in own if known}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, lines = cheapest([(r[2], r[3], f) for r, f in zip(own, faults)])
        n = Counter(faults)
        found[conv] = (gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return found


def run(spark, rows, **options):
    df = spark.createDataFrame([(c, t, r, x, "k", n) for c, t, r, x, n in rows], SCHEMA)
    report, lines = repair(df, copies=df["copies"], **options)
    out = {r.conv: tuple(r)[1:] for r in report.collect()}
    assert len(out) == report.count()
    for conv, group in lines.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("part", "block", "place", F.concat("role", F.lit(":"), "text").alias("line")))).alias("l")).collect():
        assert hashlib.sha256("\n".join(x.line for x in group).encode()).hexdigest() == out[conv][-1]
    return out


def test_random_conversations_match_brute_force(spark):
    rng = random.Random(5)
    texts = ["Yes.", "No", "So?\n", "", " \t", "Well !", "é.", None]
    roles = ["user", "user", "assistant", "assistant", "system", "tool", "", None, "U"]
    rows = [(c if c else None, rng.choice([None, *range(9)]), rng.choice(roles), rng.choice(texts), rng.choice([0, 1, 1, 1, 2, 5])) for c in range(300) for _ in range(rng.randrange(1, 8))]
    assert run(spark, rows) == brute(rows)


def test_nothing_left_and_a_lone_system_turn(spark):
    rows = [(1, 1, "user", "Hi.", 0), (1, 2, "assistant", "Hi.", 0), (2, 1, "system", "Be kind.", 1), (3, 7, "assistant", "A.", 1)]
    found = run(spark, rows)
    assert found == brute(rows)
    assert found[1] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_long_conversations_span_blocks_and_partitions(spark):
    rng = random.Random(8)
    roles, texts = ["user", "assistant", "system", "user"], ["a.", "b", "", "c?"]
    hot = [(1, t, rng.choice(roles), rng.choice([*texts, f"own {t}.", f"cut {t}"]), rng.choice([1, 1, 1, 0, 3])) for t in range(3000)]
    rest = [(c, t, rng.choice(roles), f"{t} {rng.choice(texts)}", 1) for c in range(2, 400) for t in range(rng.randrange(1, 6))]
    want = brute(hot + rest)
    assert run(spark, hot + rest) == want
    assert run(spark, hot + rest, fan=2) == want


def test_equal_rows_are_counted_and_long_texts_kept(spark):
    rows = [(1, 1, "user", "same.", 1)] * 500 + [(1, 2, "assistant", "é" * 2_000_000 + ".", 1), (2, None, "user", "x.", 4)]
    assert run(spark, rows) == brute(rows)


def test_damage_follows_the_checksum(spark):
    from zlib import crc32

    rows = [(c, t, "assistant", "a. b!", "k", 1) for c in range(40) for t in range(3)] + [(None, 1, None, None, "k", 1), (1, None, "user", "x?", "k", 1)]
    df, copies = damaged(spark.createDataFrame(rows, SCHEMA))
    for r in df.select("*", copies.alias("n")).collect():
        hit = crc32(f"{' ' if r.conv_id is None else r.conv_id}:{' ' if r.turn is None else r.turn}".encode()) % 20
        assert r.n == {0: 0, 3: 2}.get(hit, 1)
        if r.conv_id is not None and r.turn is not None:
            assert (r.role, r.text) == ("user" if hit == 4 else "assistant", {1: "", 2: "a b"}.get(hit, "a. b!"))


def test_empty_table(spark):
    assert run(spark, []) == {}
