"""Spans of a text: found by rules in UTF-8 bytes, told in code points, put in order and digested."""

from __future__ import annotations

from bisect import bisect_left
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SPANS = "array<struct<kind:string,start:int,end:int,base:boolean,method:boolean>>"
SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("method", pa.bool_())]))


def in_code_points(data: bytes, spans: list[tuple]) -> list[tuple]:
    """Spans (kind, start, end, ...) with byte offsets turned into code points."""
    if not spans or data.isascii():
        return spans
    places, at, points = {}, 0, 0
    for offset in sorted({x for s in spans for x in s[1:3]}):
        points += len(data[at:offset].decode("utf-8", "surrogatepass"))
        places[offset] = points
        at = offset
    return [(s[0], places[s[1]], places[s[2]], *s[3:]) for s in spans]


def ordered(spans: list[tuple], kinds: tuple[str, ...]) -> list[tuple]:
    return sorted(spans, key=lambda s: (s[1], kinds.index(s[0]), s[2]))


class Taken:
    """Stretches of a text that spans (kind, start, end, ...) take up."""

    def __init__(self, spans: list[tuple]):
        some = sorted(s[1:3] for s in spans)
        self.starts, self.reach = [a for a, _ in some], list(accumulate((b for _, b in some), max))

    def meets(self, start: int, end: int) -> bool:
        i = bisect_left(self.starts, end) - 1
        return i >= 0 and self.reach[i] > start


def spelled(spans: Column) -> Column:
    """kind:start:end of each, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def base_only(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["base"])


def count_of(spans: Column, kind: str) -> Column:
    """Base spans of a kind."""
    return F.size(F.filter(spans, lambda s: s["base"] & (s["kind"] == kind))).cast("long")


def by_method(spans: Column) -> Column:
    """Those that the method itself reports, rule or not."""
    return F.filter(spans, lambda s: s["method"])
