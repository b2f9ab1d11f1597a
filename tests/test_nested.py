import json

from pyspark.sql import functions as F

from lectern.operators.nested import harvested, nested_items


def walked(node, name, take, depth=0, limit=8):
    """The walk in plain Python; names in their own order."""
    if depth > limit or node is None:
        return
    if isinstance(node, str):
        if f'"{name}"' in node:
            try:
                inner = json.loads(node)
            except ValueError:
                return
            if not take:
                yield from walked(inner, name, take, depth + 1, limit)
            elif isinstance(inner, list):
                yield from inner
            elif isinstance(inner, dict) and isinstance(inner.get(name), list):
                yield from inner[name]
    elif isinstance(node, dict) and isinstance(node.get(name), list):
        yield from node[name]
    elif isinstance(node, (dict, list)):
        for x in [node[k] for k in sorted(node)] if isinstance(node, dict) else node:
            yield from walked(x, name, take, depth + 1, limit)


def found(spark, values, name="books", take=False, depth=8):
    texts = [(i, v if isinstance(v, str) else json.dumps(v)) for i, v in enumerate(values)]
    rows = spark.createDataFrame(texts, "line int, text string").select("line", F.try_parse_json("text").alias("value"))
    out = nested_items(rows, name, take_strings=take, depth=depth).select("line", "path", F.to_json("item").alias("item")).collect()
    return [(r.line, json.loads(r.item)) for r in sorted(out, key=lambda r: (r.line, r.path))]


def deep(n, inner):
    for i in range(n):
        inner = {"x": inner} if i % 2 else [inner]
    return inner


VALUES = [
    {"a": {"books": [{"id": 1}, {"id": 2, "books": [{"id": 3}]}]}, "b": [{"books": [4, None, "s"]}, {"books": {"id": 5}}]},
    [], {}, "", "not json", "[1, 2", None, 7, {"books": []}, {"books": None},
    {"t": json.dumps({"books": [{"id": 6}]}), "u": json.dumps([{"id": 7}, {"books": [{"id": 8}]}]), "v": 'cut {"books": ['},
    {"t": json.dumps({"q": json.dumps({"books": [{"id": 9}]})})},
    {"w": json.dumps('{"books": [{"id": 10}]}')},
    deep(8, {"books": [11]}), deep(9, {"books": [12]}), deep(7, json.dumps({"books": [13]})), deep(8, json.dumps({"books": [14]})),
    [{"books": [{"id": 15}]}, [[[{"b": {"books": [{"id": 16}]}}]]]], {"ü'": {"books": [{"id": 17}]}},
]


def test_items_match_a_plain_walk(spark):
    for take in (False, True):
        parsed = []
        for i, v in enumerate(VALUES):
            try:
                parsed.append((i, json.loads(v if isinstance(v, str) else json.dumps(v))))
            except ValueError:
                continue
        want = [(i, x) for i, v in parsed for x in walked(v, "books", take)]
        assert found(spark, VALUES, take=take) == want


def test_depth_and_plan(spark):
    assert found(spark, [deep(3, {"books": [1]})], depth=2) == []
    assert found(spark, [deep(2, {"books": [1]})], depth=2) == [(0, 1)]
    rows = spark.range(3).select(F.try_parse_json(F.lit('{"books": [1]}')).alias("value"))
    plan = nested_items(rows, "books")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_first_of_each_id_counts(spark):
    values = [{"books": [{"id": 1, "n": "a"}, {"id": "1", "n": "b"}, {"n": "none"}, 5]}, {"x": {"books": [{"id": 1, "n": "c"}, {"id": 2, "n": "d"}, {"id": None}]}}]
    rows = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)], "line int, text string").select("line", F.try_parse_json("text").alias("value"))
    got = harvested(nested_items(rows, "books"), ["line"]).collect()
    assert {(r.id, json.loads(r.item)["n"], r.line) for r in got} == {("1", "a", 0), ("2", "d", 1)}


def test_empty_table(spark):
    assert found(spark, []) == []


def test_a_deeper_walk_is_no_longer_plan(spark):
    rows = spark.range(3).select("id", F.try_parse_json(F.lit('{"a": [{"b": {"books": [{"id": 1}, {"id": 2}]}}, {"books": [3]}]}')).alias("value"))
    walks = [nested_items(rows, "books", depth=d) for d in (1, 4, 40)]
    steps = [w._jdf.queryExecution().optimizedPlan().toString().count("Project") for w in walks]
    assert steps[0] == steps[1] == steps[2] and [w.count() for w in walks] == [0, 9, 9]
