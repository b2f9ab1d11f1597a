"""Named arrays somewhere inside JSON values, found over VARIANT without a Python worker.

A walk keeps two arrays a row: the nodes of the level it is on, and the items found so far. It is one fold over the
levels, so a table is scanned once and nothing is shuffled, whatever the depth.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import bound

DEPTH = 8

_LIST, _MAP = "array<variant>", "map<string,variant>"


def _children(node: Column) -> Column:
    """What an array or an object holds, in the order of places or of names; nothing for other values."""
    held = F.coalesce(F.try_variant_get(node, "$", _LIST), F.map_values(F.try_variant_get(node, "$", _MAP)))
    return F.coalesce(held, F.array().cast(_LIST))


def _named(node: Column, name: str) -> Column:
    """The array of that name which an object has itself, else null."""
    return F.try_variant_get(node, f"$['{name}']", _LIST)


def _spelled(node: Column, name: str) -> Column:
    """A string that holds the quoted name, parsed; null for all else, and for text that isn't JSON."""
    plain = F.try_variant_get(node, "$", _LIST).isNull() & F.try_variant_get(node, "$", _MAP).isNull()
    text = F.when(plain, F.try_variant_get(node, "$", "string"))
    return F.try_parse_json(F.when(F.contains(text, F.lit(f'"{name}"')), text))


def nested_items(rows: DataFrame, name: str, column: str = "value", keep: list[str] | None = None, depth: int = DEPTH, take_strings: bool = False) -> DataFrame:
    """(keep, path, item): the elements, as VARIANT, of every array called `name` in a column of VARIANT (SRC-11).

    Objects and arrays are walked down to `depth`; a node that has the array isn't walked further. A string that
    holds the name is parsed: the walk goes on in it one level deeper, or with take_strings only its own array is
    taken, be it the value itself or its array of that name. path tells items of a row apart and sorts as the walk
    goes, names in their own order. Null rows, other values and text that isn't JSON give nothing.
    """
    keep = [c for c in rows.columns if c != column] if keep is None else keep
    node_type = "array<struct<path:array<int>,node:variant>>"
    start = F.when(F.col(column).isNotNull(), F.array(F.struct(F.array().cast("array<int>").alias("path"), F.col(column).alias("node"))))
    inside = lambda path, nodes: F.transform(nodes, lambda c, i: F.struct(F.concat(path, F.array(i)).alias("path"), c.alias("node")))
    none = F.array().cast(node_type)
    opened = lambda nodes: F.transform(nodes, lambda n: F.struct(n["path"].alias("path"), n["node"].alias("node"), _named(n["node"], name).alias("own"), _spelled(n["node"], name).alias("text")))
    own = lambda n: F.coalesce(inside(n["path"], n["own"]), none)
    spelled = lambda n: F.coalesce(inside(n["path"], F.coalesce(F.try_variant_get(n["text"], "$", _LIST), _named(n["text"], name))), none)
    items = (lambda n: F.concat(own(n), spelled(n))) if take_strings else own
    below = lambda n: F.when(n["own"].isNotNull(), none).when(n["text"].isNotNull(), none if take_strings else inside(n["path"], F.array(n["text"]))).otherwise(inside(n["path"], _children(n["node"])))
    state = lambda level, found: F.struct(level.cast(node_type).alias("level"), found.cast(node_type).alias("found"))
    deeper = lambda a, at, nodes: state(F.when(at < depth, F.flatten(F.transform(nodes, below))).otherwise(none), F.concat(a["found"], F.flatten(F.transform(nodes, items))))
    # a level that holds no more nodes costs next to nothing, and a fold is one expression, however deep
    step = lambda a, at: F.when(F.size(a["level"]) == 0, a).otherwise(bound(opened(a["level"]), lambda nodes: deeper(a, at, nodes)))
    found = F.aggregate(F.sequence(F.lit(0), F.lit(depth)), state(F.coalesce(start, F.array()), none), step, lambda a: a["found"])
    return rows.select(*keep, F.explode(found).alias("_item")).select(*keep, "_item.path", F.col("_item.node").alias("item"))


def harvested(items: DataFrame, order: list[str]) -> DataFrame:
    """(id, item as JSON text, order): of the items with an id, the first of each by `order` and path (AGG-13)."""
    known = items.select(*order, "path", F.try_variant_get("item", "$.id", "string").alias("id"), F.to_json("item").alias("item")).filter("id is not null")
    place = F.struct(*order, "path")
    return known.groupBy("id").agg(F.min_by(F.struct("item", *order), place).alias("r")).select("id", "r.*")
