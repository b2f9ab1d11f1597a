"""Where a story begins, scene boundaries, anchors and keyword context."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.text import PARAGRAPH, SPACE, bound, letters_only, marked, raw_words, rounded, words
from lectern.operators.chapters import winning
from lectern.operators.structure import n_words, some_words
from lectern.sources.shared import scratch

# Front matter, headings of scenes, words that research extracts look for.
FRONT_KINDS = ("preface", "foreword", "introduction", "afterword", "conclusion")
FRONT_TITLE = r"(?i)^(contents|table of contents|title page|copyright|dedication|list of|illustrations?|preface|foreword|introduction|editor'?s note|translator'?s|publisher'?s note|frontispiece)(?![A-Za-z0-9_])"
SCENE_HEADING = r"(?i)^(chapter|letter|part|book|stave|canto|act|scene|prologue|epilogue)(?![A-Za-z0-9_])"
KEYWORDS = (
    "fixation", "saccade", "eye movement", "peripheral", "span of vision", "vocalization", "subvocalization", "inner speech", "retina", "fovea",
    "attention", "focus", "concentrate", "concentration", "distracted", "distraction", "mind-wandering", "fatigue", "mental energy", "will power", "volition", "flow state",
    "memory", "retention", "recall", "forgetting", "curve of forgetting", "repetition", "drill", "practice", "habit", "association", "comprehension",
    "skim", "scan", "review", "summarize", "note-taking", "underlining", "cramming", "pacing", "rhythm",
    "speed", "rate", "rapid", "slow", "word per minute", "wpm", "rsvp", "serial visual", "flashing",
    "training", "apparatus", "display", "textual matter", "embodiment",
)

CONTEXT_HEADER = r"^(#+ |Title:|Source:|US[0-9]+)|Project Gutenberg"
MIN_GAP, DEEP = 120, 0.4
#: Letters of an anchor by which it meets texts, and logarithms of the least and most bits of the filter for those.
GRAM, LEAST_BITS, MOST_BITS = 8, 16, 28
TARGET_SCENES, MOST_SCENES, WORDS_A_SCENE, PASSAGE = 14, 18, 4000, 900


def spaced(starts: Column, gap: int = MIN_GAP) -> Column:
    """Of sorted starts those at least `gap` after the last one kept (WIN-11), in time linear in them; null of null.

    What is kept decides what is next, so each list is gone through once with one number in hand.
    """

    @F.arrow_udf("array<long>")
    def kept(lists: pa.Array) -> pa.Array:
        ends, values = lists.offsets.to_pylist(), lists.values.to_pylist()
        there = lists.is_valid().to_pylist()
        offsets, found = [0], []
        for ok, begin, end in zip(there, ends, ends[1:]):
            last = None
            for at in values[begin:end] if ok else ():
                if last is None or at - last >= gap:
                    last = at
                    found.append(at)
            offsets.append(len(found))
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(found, pa.int64()), mask=pa.array([not ok for ok in there]))

    return kept(starts.cast("array<long>"))


def scene_headings(lines: DataFrame, key: str = "book_id") -> DataFrame:
    """(key, starts): token ids of scene headings, too near ones dropped; null without any."""
    found = lines.filter((F.col("trimmed") != "") & (F.length("trimmed") <= 64) & F.col("trimmed").rlike(SCENE_HEADING))
    return found.groupBy(key).agg(spaced(F.array_sort(F.collect_list(F.col("word_index").cast("long")))).alias("starts"))


def scene_starts(starts: Column, total: Column) -> Column:
    """Headings where there are 2 to MOST_SCENES, a sample of more, equal parts for fewer; increasing (TXT-14, WIN-19, WIN-20, WIN-22)."""
    n = F.size(starts)
    parts = F.least(F.lit(TARGET_SCENES), F.greatest(F.lit(2), rounded(total / WORDS_A_SCENE))).cast("int")
    upto = lambda k: F.sequence(F.lit(0), k - 1)
    sampled = F.transform(upto(F.lit(TARGET_SCENES)), lambda i: F.element_at(starts, (F.floor(i * n / TARGET_SCENES) + 1).cast("int")))
    equal = F.transform(upto(parts), lambda i: F.floor(i * total / parts).cast("long"))
    found = F.when((n >= 2) & (n <= MOST_SCENES), starts).when(n > MOST_SCENES, sampled).otherwise(equal)
    return F.filter(found, lambda x, i: (i == 0) | (x > F.try_element_at(found, i)))


def scenes(books: DataFrame, lines: DataFrame, key: str = "book_id", text: str = "text") -> DataFrame:
    """Scenes of each text: number, start, end, and the size of the passage that stands for it (TXT-15).

    A null text is one without words, as an empty one: one scene from 0 to 0.
    """
    total = F.coalesce(F.size(words(F.col(text))), F.lit(0)).cast("long")
    sized = books.select(key, F.when(F.col(text).isNull(), F.lit(0)).otherwise(total).alias("total")).join(scene_headings(lines, key), key, "left")
    starts = sized.withColumn("scene_starts", scene_starts(F.coalesce("starts", F.array().cast("array<long>")), F.col("total")))
    rows = starts.select(key, "total", "scene_starts", F.posexplode("scene_starts").alias("scene", "start_index"))
    end = F.coalesce(F.try_element_at("scene_starts", F.col("scene") + 2), F.col("total"))
    return rows.select(key, F.col("scene").cast("long").alias("scene"), "start_index", end.alias("end_index"), F.least(end - F.col("start_index"), F.lit(PASSAGE)).cast("long").alias("passage_words"))


def is_front(kind: Column, title: Column) -> Column:
    return kind.isin(*FRONT_KINDS) | title.rlike(FRONT_TITLE)


def _body(found: DataFrame, key: str) -> DataFrame:
    """(key, h, n_chapters): the headings of each book's winning dialect in order, with the next one's place and whether the key was seen before."""
    order, same = Window.partitionBy(key).orderBy("word_index", "line"), Window.partitionBy(key, "key").orderBy("word_index", "line")
    h = winning(found, key).withColumns({"i": F.row_number().over(order) - 1, "next": F.lead("word_index").over(order), "again": F.row_number().over(same) > 1, "front": is_front(F.col("kind"), F.col("title"))})
    return h.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("i", "word_index", "next", "again", "front", "title", "dialect"))).alias("h"), F.first("n_chapters").cast("long").alias("n_headings"))


def _chosen(h: Column, total: Column) -> tuple[Column, Column]:
    """Of a book's headings the one at which its body begins, past a page of contents (TXT-09, WIN-12, WIN-13); whether there are contents alone.

    A page of contents is told by two first gaps under MIN_GAP; the body then begins at the first heading whose
    key was seen before and which a chapter's worth of words follows. Front matter is passed over (FLT-14).
    """
    gap = lambda x: F.coalesce(x["next"], total) - x["word_index"]
    near = lambda i: gap(F.get(h, F.lit(i))) < MIN_GAP
    contents = (F.size(h) >= 3) & near(0) & near(1)
    repeats = F.filter(h, lambda x: x["again"])
    body = F.get(F.filter(repeats, lambda x: gap(x) >= MIN_GAP), F.lit(0))
    begin = F.when(~contents, 0).otherwise(F.coalesce(body["i"], F.get(repeats, F.lit(0))["i"], F.lit(0)))
    plain = F.get(F.filter(h, lambda x: (x["i"] >= begin) & ~x["front"]), F.lit(0))
    return F.coalesce(plain, F.get(h, begin)), contents & body.isNull()


def prose_start(text: Column) -> Column:
    """Token id of the first paragraph that reads like prose, or null (TXT-10, FLT-13)."""
    raw = raw_words(text)
    joined = F.array_join(F.transform(raw, lambda w: F.when(w == PARAGRAPH, F.lit("\n")).otherwise(w)), " ")
    paragraphs = F.transform(F.filter(F.split(joined, "\n"), lambda p: F.trim(p) != ""), lambda p: F.split(F.trim(p), " "))
    caps = lambda w: w.rlike("[A-Z]") & (w == F.upper(w)) & (F.length(w) > 1)
    share = lambda p, test: F.size(F.filter(p, test)) / F.size(p)
    stops = lambda p: F.regexp_count(F.array_join(p, " "), F.lit(rf"[.!?][\"'”’)]?([{SPACE}]|\z)"))
    prose = lambda p: (F.size(p) >= 35) & (share(p, caps) <= 0.25) & ~F.array_join(p, " ").rlike(r"(?i)\.(jpg|jpeg|png|gif)(?![A-Za-z0-9_])") & (stops(p) >= 2) & (share(p, lambda w: w.rlike("^[a-z]")) > 0.45)
    step = lambda a, p: F.struct(F.coalesce(a["found"], F.when(prose(p), a["at"])).alias("found"), (a["at"] + F.size(p)).alias("at"))
    return F.aggregate(paragraphs, F.struct(F.lit(None).cast("int").alias("found"), F.lit(0).alias("at")), step)["found"]


def story_starts(books: DataFrame, found: DataFrame, key: str = "book_id", text: str = "text") -> DataFrame:
    """Start, confidence, method and the first 14 words of every book (TXT-09, SRT-11, AGG-18).

    A book's headings meet it once, as one sorted array; all the rest is told from that array. Prose is looked for only
    in books without headings.
    """
    met = books.select(key, F.col(text).alias("text")).join(_body(found, key), key, "left")
    rows = met.withColumns({"total": n_words(F.col("text")), "prose": F.when(F.col("h").isNull(), prose_start(F.col("text")))})
    chosen, contents_only = _chosen(F.col("h"), F.col("total"))
    rows = rows.withColumns({"c": chosen, "toc": contents_only}).withColumn("gap", F.coalesce(F.col("c.next"), F.col("total")) - F.col("c.word_index"))
    deep = F.col("c.word_index") > F.col("total") * DEEP
    low = deep | F.col("toc") | (F.col("gap") < MIN_GAP)
    known = F.col("c").isNotNull()
    by = lambda a, b: F.when(F.col("prose").isNotNull(), a).otherwise(b)
    confidence = F.when(known, F.when(low, "low").otherwise("high")).otherwise(by("prose", "none"))
    suffix = F.when(F.col("toc"), ":toc-only").when(deep, ":deep").otherwise("")
    method = F.when(known, F.concat(F.lit("chapters:"), "c.dialect", suffix)).otherwise(by("prose-fallback", "none"))
    start = F.coalesce(F.col("c.word_index").cast("long"), F.col("prose").cast("long"), F.lit(0))
    return rows.select(key, start.alias("start"), confidence.alias("confidence"), method.alias("method"), F.col("c.title").alias("heading"), F.coalesce("n_headings", F.lit(0)).cast("long").alias("n_headings"), F.col("total").cast("long").alias("total"), some_words(F.col("text"), start, 14).alias("preview"))


def anchor_index(w: Column, anchor: Column) -> Column:
    """Token id at which a phrase begins, compared by letters and digits alone; null if it doesn't occur (TXT-11)."""
    needle = letters_only(anchor)
    place = lambda parts: F.when(needle == "", -1).otherwise(F.instr(F.array_join(parts, ""), needle) - 1)
    # letters and place are told once; words are counted only where there is a place
    step = lambda at: lambda a, p: F.struct((a["end"] + F.length(p)).alias("end"), (a["n"] + F.when(a["end"] + F.length(p) <= at, 1).otherwise(0)).alias("n"))
    counted = lambda parts, at: F.aggregate(parts, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), step(at), lambda a: a["n"])
    return bound(F.transform(w, letters_only), lambda parts: bound(place(parts), lambda at: F.when(at >= 0, counted(parts, at))))


def _grams(letters: str, n: int) -> np.ndarray:
    """Codes of the runs of n letters (at most 8) of a text of ASCII letters and digits."""
    c = np.frombuffer(letters.encode(), np.uint8).astype(np.uint64)
    if len(c) < n:
        return np.empty(0, np.uint64)
    code = np.zeros(len(c) - n + 1, np.uint64)
    for i in range(n):
        code |= c[i : i + len(code)] << np.uint64(8 * i)
    return code


def _bits(codes: np.ndarray, log: int) -> np.ndarray:
    return ((codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - log)).astype(np.int64)


class _Filter:
    """Bits of a set of runs (a column of longs): 16 to a run, but 2**MOST_BITS at most. What it lets through too much, joins drop."""

    def __init__(self, runs: DataFrame):
        spark = runs.sparkSession
        self.log = log = min(max((16 * runs.count()).bit_length(), LEAST_BITS), MOST_BITS)

        def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = np.unique(_bits(batch[0].to_numpy().view(np.uint64), log))
                yield pa.RecordBatch.from_arrays([pa.array(at)], names=["bit"])

        bits = runs.mapInArrow(slices, "bit long").select(F.bitmap_bucket_number(F.col("bit") + 1).alias("b"), F.bitmap_bit_position(F.col("bit") + 1).alias("p"))
        there = np.zeros(max(1 << log, 1 << 15), bool)
        for r in bits.groupBy("b").agg(F.bitmap_construct_agg("p").alias("bits")).collect():  # at most 2**MOST_BITS bits
            there[(r.b - 1) * 32768 : r.b * 32768] = np.unpackbits(np.frombuffer(bytes(r.bits), np.uint8), bitorder="little")
        self.shared = spark.sparkContext.broadcast(np.packbits(there))

    def keep(self, codes: np.ndarray) -> np.ndarray:
        """Those of the codes that may be in the set, each once."""
        at = _bits(codes, self.log)
        return np.unique(codes[(self.shared.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0])


def _needle_runs(n: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(_grams(x, n)).view(np.int64) for x in batch["needle"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.int64()))], names=[*batch.schema.names, "runs"])

    return cut


def _letters(texts: pa.Array) -> list[str]:
    other = bytes(set(range(128)) - set(b"abcdefghijklmnopqrstuvwxyz0123456789"))
    return [x.encode("ascii", "ignore").translate(None, other).decode() for x in texts.to_pylist()]


def _run_counts(n: int, wanted: _Filter):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = [wanted.keep(_grams(x, n)) for x in _letters(batch["low"])]
            run, texts = np.unique(np.concatenate(runs) if runs else np.zeros(0, np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(run.view(np.int64)), pa.array(texts, pa.int64())], names=["run", "texts"])

    return count


def _text_runs(n: int, wanted: _Filter):
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters = _letters(batch["low"])
            found = [wanted.keep(_grams(x, n)).view(np.int64) for x in letters]
            kept = pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(letters), pa.array(found, pa.list_(pa.int64()))], names=[*batch.schema.names[:2], "letters", "runs"])
            yield kept.filter(pa.array([len(f) > 0 for f in found], pa.bool_()))

    return pick


def _rarest_runs(needles: DataFrame, texts: DataFrame, n: int) -> DataFrame:
    """needles (item_id, anchor, needle) with the run of n letters that fewest of the texts (low) have."""
    schema = ", ".join(f"`{c}` {t}" for c, t in needles.dtypes)
    runs = needles.mapInArrow(_needle_runs(n), f"{schema}, runs array<long>").select("*", F.explode("runs").alias("run"))
    often = texts.select("low").mapInArrow(_run_counts(n, _Filter(runs.select("run").distinct())), "run long, texts long").groupBy("run").agg(F.sum("texts").alias("texts"))
    rarest = F.min_by("run", F.struct(F.coalesce("texts", F.lit(0)), F.xxhash64("run")))
    return runs.join(often, "run", "left").groupBy("item_id", "anchor", "needle").agg(rarest.alias("run"))


def resolved_anchors(docs: DataFrame, anchors: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document in which an anchor (item_id, anchor) begins, and where.

    An anchor and each text that holds it share every run of GRAM letters of the anchor, so the two meet in an
    equi-join on one of them: the run that fewest texts have, counted over all texts first. So a phrase that many anchors
    or many texts share is not what they meet by, as long as an anchor has a rarer part. The place is looked for only in
    pairs that met. Anchors of fewer letters meet texts by as many letters as the shortest has. Null and blank texts hold
    nothing; null anchors and those without letters are in none. An anchor that an item repeats counts once.
    """
    mark = F.when(F.col(text).contains(PARAGRAPH), F.regexp_replace(marked(F.col(text)), rf"(?<![^{SPACE}])\[P\](?![^{SPACE}])", " ")).otherwise(F.col(text))
    w = docs.select(key, F.col(text).alias("text"), F.lower(mark).alias("low")).filter("low <> ''")
    asked = anchors.select("item_id", "anchor", letters_only(F.col("anchor")).alias("needle")).filter("needle <> ''")
    shortest = asked.agg(F.min(F.length("needle"))).first()[0] or GRAM
    spark, out = docs.sparkSession, None
    for n, some in ((GRAM, asked.filter(F.length("needle") >= GRAM)), *([(shortest, asked.filter(F.length("needle") < GRAM))] if shortest < GRAM else [])):
        path = scratch(spark, "anchors")  # read twice: for the filter and for the join
        _rarest_runs(some, w, n).write.parquet(path)
        chosen = spark.read.parquet(path)
        texts = w.mapInArrow(_text_runs(n, _Filter(chosen.select("run").distinct())), f"`{key}` {dict(w.dtypes)[key]}, text string, letters string, runs array<long>")
        met = texts.select(key, "text", "letters", F.explode("runs").alias("run")).join(chosen, "run").filter(F.col("letters").contains(F.col("needle")))
        hits = met.select("item_id", key, anchor_index(words(F.col("text")), F.col("anchor")).cast("long").alias("token"))
        out = hits if out is None else out.unionByName(hits)
    return out


def _near_lines(pattern: str, reach: int):
    """Of batches (key, low, text) the lines as keyword_context gives them; low is the text in small letters."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, cut = (pc.split_pattern(batch[c], "\n") for c in ("low", "text"))
            raw, n = cut.flatten(), pc.list_value_length(cut).to_numpy(zero_copy_only=False)
            doc, start = np.repeat(np.arange(len(n)), n), np.repeat(np.cumsum(n) - n, n)
            at, plain = np.arange(len(doc)), pc.utf8_trim(raw, " ")
            hit = pc.and_(pc.greater(pc.utf8_length(plain), 20), pc.match_substring_regex(low.flatten(), pattern)).to_numpy(zero_copy_only=False)
            shown = hit.copy()
            for k in range(1, min(reach, len(doc) - 1) + 1):
                same = doc[k:] == doc[:-k]
                shown[k:] |= hit[:-k] & same
                shown[:-k] |= hit[k:] & same
            header = pc.match_substring_regex(raw, CONTEXT_HEADER).to_numpy(zero_copy_only=False)
            head = np.maximum.accumulate(np.where(header, at, -1))
            rows = np.flatnonzero(shown)
            mine = head[rows] >= start[rows]
            title = pc.fill_null(plain.take(pa.array(head[rows], mask=~mine)), "Unknown Source")
            line, of = (at - start)[rows], doc[rows]
            first = np.concatenate(([True], of[1:] != of[:-1]))[: len(rows)]
            gap = pa.array(np.diff(line, prepend=0) > 1, mask=first)
            yield pa.RecordBatch.from_arrays(
                [batch[0].take(pa.array(of)), pa.array(line, pa.int64()), plain.take(pa.array(rows)), pa.array(hit[rows].astype(np.int32)), title, gap],
                names=[batch.schema.names[0], "line", "text", "hit", "source_header", "after_gap"],
            )

    return near


def keyword_context(docs: DataFrame, reach: int = 2, keywords: tuple[str, ...] = KEYWORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Lines that hold a keyword and those around them, with separators where lines were left out (TXT-18, WIN-07..09).

    All is told from each text's own lines, by one automaton for all keywords: lines that aren't shown are neither shuffled nor sorted.
    """
    pattern = "|".join(k.replace("-", "\\-") for k in sorted(keywords))
    cut = docs.select(key, F.col(text).alias("text")).filter("text is not null").repartition(key).select(key, F.lower("text").alias("low"), "text")
    return cut.mapInArrow(_near_lines(pattern, reach), f"`{key}` {dict(docs.dtypes)[key]}, line long, text string, hit int, source_header string, after_gap boolean")
