"""Line deduplication by a log-template tree of fixed depth.

A line's tokens with a digit are variable fields. Its leaf is reached by the number of tokens and the first
LEAD of them. In a leaf, a position that has one token in more than half of the distinct lines is constant,
any other a variable field: that is the leaf's template. Lines that agree with it in at least SIMILAR of their
positions take the template. The others are dealt out by the token at one position, and each part is a node
that gets a template in the same way, SPLITS levels down: so formats that share a leaf are told apart. Formats
vary together, hence the position is the first of those whose number of different tokens most positions have
(of two such numbers the smaller). A line that fits nowhere is a template by itself.

Templates recur, and their lines are dropped, if they stand in MIN_DOCS different texts, or in LONG_DOCS if they
have LONG_WORDS tokens or more: long lines don't meet by chance. Exact copies of a document are one text; their
lines are theirs, and copies are the concern of exact_dedup.

All of it is grouped counts, so neither the order of lines nor the deal of rows changes a template, and a leaf
that holds a large part of all lines is counted in parts like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import discard, sized_join, stored

LEAD, SIMILAR, SPLITS = 3, 0.75, 3
MIN_DOCS, LONG_WORDS, LONG_DOCS = 10, 50, 3
FIELD = "<*>"


def _spaced(line: str) -> Column:
    """A line's tokens with single blanks."""
    text = F.col(line)
    loose = text.startswith(" ") | text.endswith(" ")
    for mark in ("  ", "\t", "\n", "\x0b", "\x0c", "\r"):
        loose = loose | text.contains(mark)
    return F.when(loose, F.trim(F.regexp_replace(line, r"[\x20\x09-\x0D]+", " "))).otherwise(text)


def _fields(spaced: str) -> Column:
    """Tokens with single blanks, those with a digit replaced by FIELD."""
    return F.when(F.col(spaced).rlike("[0-9]"), F.regexp_replace(spaced, r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*", FIELD)).otherwise(F.col(spaced))


def _row_key(id_: Column, text: Column) -> list[Column]:
    return [F.coalesce(id_.cast("string"), F.lit("-")).alias("k1"), F.xxhash64(text).alias("k2")]


def _asked(n: Column, min_docs: int) -> Column:
    """In how many texts a template of n tokens must stand."""
    return F.when(n >= LONG_WORDS, F.lit(min(LONG_DOCS, min_docs))).otherwise(F.lit(min_docs))


def _shapes(lines: DataFrame) -> DataFrame:
    """(node, constant, place) of the nodes with two lines or more: the token of each constant position, and the position to split at."""
    shared = lines.groupBy("node").count().filter(F.col("count") > 1).select("node")
    tokens = sized_join(lines, shared, "node").select("node", F.posexplode(F.split("masked", " ")).alias("place", "token"))
    counts = tokens.groupBy("node", "place", "token").count()
    places = counts.groupBy("node", "place").agg(F.sum("count").alias("lines"), F.count("*").alias("kinds"), F.max("count").alias("most"), F.max_by("token", "count").alias("token"))
    places = places.withColumn("token", F.when(F.expr("2 * most > lines"), F.col("token")))
    alike = places.groupBy("node", "kinds").agg(F.count("*").alias("same"), F.min("place").alias("place"), F.collect_list(F.struct("place", "token")).alias("c"))
    best = F.min(F.when(F.col("kinds") > 1, F.struct((-F.col("same")).alias("same"), "kinds", "place")))
    whole = alike.groupBy("node").agg(F.sort_array(F.flatten(F.collect_list("c"))).alias("c"), best.alias("best"))
    return whole.select("node", F.transform("c", lambda c: c["token"]).alias("constant"), F.col("best.place").alias("place"))


def _tree(distinct: DataFrame, similar: float, splits: int) -> tuple[DataFrame, list[DataFrame]]:
    """(leaf, masked, template) of the lines that take a template, and the tables it is read from; distinct holds (leaf, n, masked)."""
    lines, levels = distinct.withColumn("node", F.col("leaf")), []
    for _ in range(splits + 1):
        shapes = stored(_shapes(lines), "templates")
        tokens = F.split("masked", " ")
        agree = F.size(F.filter(F.zip_with(tokens, "constant", lambda t, c: t == c), lambda same: same))
        fits = agree >= similar * F.col("n")
        template = F.when(fits, F.array_join(F.transform("constant", lambda c: F.coalesce(c, F.lit(FIELD))), " "))
        below = F.when(~fits, F.concat_ws(" ", "node", F.col("place").cast("string"), F.get(tokens, F.col("place"))))
        levels.append(stored(sized_join(lines, shapes, "node").select("leaf", "n", "masked", template.alias("template"), below.alias("node")), "templates"))
        discard(shapes)
        lines = levels[-1].filter("template IS NULL").drop("template")
        if lines.isEmpty():
            break
    taken = levels[0]
    for level in levels[1:]:
        taken = taken.unionByName(level)
    return taken.filter("template IS NOT NULL").select("leaf", "masked", "template"), levels


def line_templates(docs: DataFrame, id_col: str, text_col: str, lead: int = LEAD, similar: float = SIMILAR, min_docs: int = MIN_DOCS, splits: int = SPLITS) -> DataFrame:
    """(k1, k2, at, n, template) for the lines whose leaf has lines enough; k1 and k2 stand for the row, n is the number of tokens, the template is a digest."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    rows = docs.select(*_row_key(docs[id_col], text), F.posexplode(F.split(text, "\n")).alias("at", "line"))
    # a leaf is told by a line's first tokens: lines are cut twice, and only those of full leaves are masked as a whole and written
    rows = rows.withColumn("spaced", _spaced("line")).drop("line").filter("spaced <> ''")
    rows = rows.withColumns({"n": F.octet_length("spaced") - F.octet_length(F.replace("spaced", F.lit(" "), F.lit(""))) + 1, "opening": F.substring_index("spaced", " ", lead)})
    rows = rows.withColumn("leaf", F.concat_ws(" ", F.col("n").cast("string"), _fields("opening"))).drop("opening")
    full = rows.groupBy("leaf").agg(F.count("*").alias("lines"), F.min("n").alias("n")).filter(F.col("lines") >= _asked(F.col("n"), min_docs)).select("leaf")
    full = stored(full, "leaves")
    rows = stored(sized_join(rows, full, "leaf").select("k1", "k2", "at", "leaf", "n", _fields("spaced").alias("masked")), "lines")
    discard(full)

    distinct = stored(rows.select("leaf", "n", "masked").distinct(), "templates")
    taken, levels = _tree(distinct, similar, splits)
    out = sized_join(rows, taken, ["leaf", "masked"], "left")
    found = stored(out.select("k1", "k2", "at", "n", F.unhex(F.sha2(F.coalesce("template", "masked"), 256)).alias("template")), "lines")
    for done in (rows, distinct, *levels):
        discard(done)
    return found


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, min_docs: int = MIN_DOCS) -> DataFrame:
    """Every row of docs as struct `row` (of the columns in keep, or all), with n_lines, n_dropped and the text that is left.

    Null texts are empty: one blank line. Blank lines are kept. Rows of equal texts count as one text.
    An empty table gives no rows.
    """
    keep = docs.columns if keep is None else keep
    lines = line_templates(docs, id_col, text_col, min_docs=min_docs)
    texts = lines.select("template", "n", "k2").distinct().groupBy("template", "n").count()
    recurring = texts.filter(F.col("count") >= _asked(F.col("n"), min_docs)).select("template")
    dropped = sized_join(lines, recurring, "template").groupBy("k1", "k2").agg(F.collect_set("at").alias("dropped"))
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    rows = docs.select(F.struct(*[docs[c] for c in keep]).alias("row"), text.alias("text"), *_row_key(docs[id_col], text))
    found = sized_join(rows, dropped, ["k1", "k2"], "left")
    parts = F.split("text", "\n")
    # the places that stay, and then their lines: both arrays are bound once, so the time is linear in the lines
    stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), "dropped")
    lines_left = F.transform(F.array(F.struct(parts.alias("parts"), stay.alias("stay"))), lambda s: F.array_join(F.transform(s["stay"], lambda i: F.get(s["parts"], i)), "\n"))
    left = F.when(F.col("dropped").isNull(), F.col("text")).otherwise(F.get(lines_left, F.lit(0)))
    return found.select("row", F.size(parts).cast("long").alias("n_lines"), F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"), left.alias("text"))
