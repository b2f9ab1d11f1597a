"""What belongs in a collection: boilerplate, metadata and content gates with reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import BLANK, SPACE, bound, trimmed

# Topics and title words of reference works, marks of library boilerplate.
TOPICS = (
    "dictionaries", "encyclopedias", "indexes", "periodicals", "directories", "catalogs", "bibliography", "census", "statistics", "reference", "concordances", "terminology", "glossaries",
)
TITLE = r"(?i)(?<![A-Za-z0-9_])(dictionar|thesaur|encyclop|word list|language list|word book|factbook|gazetteer|almanac|concordance|bibliograph|glossar|index (?:of|to)|linked index|catalogue of|catalog of|genome|human chromosome)(?![A-Za-z0-9_])"
# Between a mark's asterisks and its words lie blanks alone: asterisks that end the line before are the text's.
START_MARK = rf"(?i)\*\*\*[{BLANK}]*START OF (?:THE|THIS) PROJECT GUTENBERG[^*]*\*\*\*"
SMALL_PRINT = rf"(?i)\*[{BLANK}]*END[^\n]*SMALL PRINT[^\n]*"
END_MARK = rf"(?i)\*\*\*[{BLANK}]*END OF (?:THE|THIS) PROJECT GUTENBERG[^*]*\*\*\*"
OLD_END = rf"(?i)\n[{SPACE}]*End of (?:the |this )?Project Gutenberg[^\n]*"
CREDIT = rf"(?i)(produced by|prepared by|transcrib|proofread|distributed proofreading|pgdp\.net|gutenberg\.org|project gutenberg|updated editions|this e-?(?:text|book) was|html version|original illustrations|see [^{SPACE}]+-h\.(?:htm|zip))"
LINK = rf"(?i)^[{SPACE}]*\(?https?://"
JOINING = rf"(?i)^[{SPACE}]*(?:or|and)[{SPACE}]*\z"
TRADEMARK = "(?i)project gutenberg"

SHORTEST, TERMINAL, CLAUSE, DIGITS, BROKEN = 2000, 1.2, 8, 0.15, 20


def _after(text: Column, pattern: str) -> Column:
    """What follows the first match, or null."""
    return F.when(text.rlike(pattern), F.element_at(F.split(text, pattern, 2), 2))


def _before(text: Column, pattern: str) -> Column:
    return F.when(text.rlike(pattern), F.element_at(F.split(text, pattern, 2), 1))


def _skipped(line: Column) -> Column:
    return (trimmed(line) == "") | line.rlike(CREDIT) | line.rlike(LINK) | line.rlike(JOINING)


def _without_credits(lines: Column) -> Column:
    """Lines from the first on that is no credit; none behind it is looked at."""
    step = lambda a, line: F.when(a["found"] | ~_skipped(line), F.struct(F.lit(True).alias("found"), a["n"].alias("n"))).otherwise(F.struct(F.lit(False).alias("found"), (a["n"] + 1).alias("n")))
    n = F.aggregate(lines, F.struct(F.lit(False).alias("found"), F.lit(0).alias("n")), step, lambda a: a["n"])
    return bound(n, lambda n: F.slice(lines, n + 1, F.size(lines)))


def strip_boilerplate(text: Column) -> Column:
    """The text between library marks, without leading credits and trademark lines (TXT-08). Each step's text is bound, so that none is told twice."""
    kept = lambda lines: bound(_without_credits(lines), lambda k: F.array_join(F.filter(k, lambda line: ~line.rlike(TRADEMARK)), "\n"))
    core = lambda t: trimmed(bound(F.split(t, "\n"), kept))
    ended = lambda t: bound(F.coalesce(_before(t, END_MARK), _before(t, OLD_END), t), core)
    begun = lambda t: bound(F.coalesce(_after(t, START_MARK), _after(t, SMALL_PRINT), t), ended)
    return bound(F.regexp_replace(text, "\r\n", "\n"), begun)


def metadata_reason(media: Column, languages: Column, copyright: Column, text_url: Column, topics: Column, title: Column) -> Column:
    """Why a catalog entry is left out, the first reason that applies; null admits it (FLT-03).

    No list of languages, or one without "en" whatever nulls it holds, isn't English. An unknown medium counts as text.
    """
    joined = F.lower(F.array_join(topics, " | "))
    out = F.when((media != "") & (media != "Text"), F.concat(F.lit("not text ("), media, F.lit(")")))
    out = out.when(~F.coalesce(F.array_contains(languages, "en"), F.lit(False)), "not English")
    out = out.when(copyright, "still copyrighted").when(copyright.isNull(), "copyright unknown")
    out = out.when(text_url.isNull() | (text_url == ""), "no plain-text file")
    for t in TOPICS:
        out = out.when(joined.contains(t), f"reference material ({t})")
    return out.when(title.rlike(TITLE), F.concat(F.lit("reference title ("), F.lower(F.regexp_extract(title, TITLE, 1)), F.lit(")")))


def densities(text: Column) -> Column:
    """Marks of a text: terminal and clause marks for each 1000 characters, digits among what isn't blank, broken characters (AGG-11).

    A null text is empty; what would be divided by 0 is null.
    """
    text = F.coalesce(text, F.lit(""))
    n = F.length(text)
    solid = F.length(F.regexp_replace(text, f"[{SPACE}]", ""))
    per = lambda p: F.try_divide(F.regexp_count(text, F.lit(p)) * 1000.0, n)
    return F.struct(n.alias("n_chars"), per("[.!?]").alias("terminal"), per("[,;:]").alias("clause"), F.try_divide(F.regexp_count(text, F.lit("[0-9]")), solid).alias("digits"), F.regexp_count(text, F.lit("�")).alias("broken"))


def content_reason(d: Column) -> Column:
    """Why a text isn't prose, from its densities, with the measured figure where one number decides; null admits it (FLT-04)."""
    share = F.floor(d["digits"] * 100 + 0.5).cast("string")
    return (
        F.when(d["n_chars"] < SHORTEST, F.concat(F.lit("too short ("), d["n_chars"].cast("string"), F.lit(" chars)")))
        .when((d["terminal"] < TERMINAL) & (d["clause"] < CLAUSE), F.lit("not prose (few marks)"))
        .when(d["digits"] > DIGITS, F.concat(F.lit("data-heavy ("), share, F.lit("% digits)")))
        .when(d["broken"] > BROKEN, F.concat(F.lit("broken encoding ("), d["broken"].cast("string"), F.lit(" replacement chars)")))
    )


def histogram(rejects: DataFrame, reason: str = "reason") -> DataFrame:
    """Rejects by reason without its detail, and the share of all of them (AGG-07, AGG-08)."""
    plain = rejects.filter(F.col(reason).isNotNull()).withColumn("reason", F.regexp_replace(reason, r" \(.*\)$", ""))
    counts = plain.groupBy("reason").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("all"))  # one row
    return counts.crossJoin(F.broadcast(total)).select("reason", "n", F.floor(1000.0 * F.col("n") / F.col("all") + 0.5).cast("long").alias("per_mille"))


def routed(rows: DataFrame, reason: str = "reason") -> tuple[DataFrame, DataFrame]:
    """Admitted rows, and rejects for the dead-letter table (SNK-04)."""
    return rows.filter(F.col(reason).isNull()).drop(reason), rows.filter(F.col(reason).isNotNull())


MIRROR_LEAST = 500


def worth_mirroring(text: Column) -> Column:
    """Whether enough is left of a text without its boilerplate (FLT-05); a null text isn't."""
    return F.coalesce(F.length(strip_boilerplate(text)) >= MIRROR_LEAST, F.lit(False))
