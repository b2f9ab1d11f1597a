"""Column expressions for showing a text: sizes, fits, motion and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COMPACT, MARGIN = 0.8, 14


def font_size(base: Column, fit: Column) -> Column:
    """The compact fit is a fifth smaller (FN-06)."""
    return F.when(fit == "compact", base * COMPACT).otherwise(base)


def fit_scale(available: Column, longer_half: Column) -> Column:
    """How far a word shrinks to fit beside its focal letter, half at most (FN-07)."""
    room = available - MARGIN
    return F.when(longer_half > room, F.greatest(F.lit(0.5), room / longer_half)).otherwise(F.lit(1.0))


def word_width(word: Column, size: float) -> Column:
    return F.length(word) * F.lit(size) * 0.5


def strip_geometry(tokens: DataFrame, size: float, gap: float, key: str = "doc_id") -> DataFrame:
    """Left edge and centre of each token on one line (WIN-16)."""
    before = Window.partitionBy(key).orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    wide = tokens.withColumn("width", word_width(F.col("word"), size))
    wide = wide.withColumn("left", F.coalesce(F.sum(F.col("width") + gap).over(before), F.lit(0.0)))
    return wide.withColumn("centre", F.col("left") + F.col("width") / 2)


def strip_end(words: Column, size: float, gap: float) -> Column:
    """Centre of the last of a text's words on one line, and the width of all without gaps (WIN-16)."""
    step = lambda a, x: F.struct((a["left"] + (word_width(x, size) + gap)).alias("left"), (a["left"] + word_width(x, size) / 2).alias("centre"), (a["width"] + word_width(x, size)).alias("width"))
    return F.aggregate(words, F.struct(F.lit(0.0).alias("left"), F.lit(0.0).alias("centre"), F.lit(0.0).alias("width")), step)


def trailing_velocity(samples: DataFrame, keys: list[str], t: str, x: str, span: int = 90, tie: str | None = None) -> DataFrame:
    """Change of x for each unit of t over the samples of the last `span` units (WIN-17). Of samples at one t the one with the least `tie` is first."""
    frame = Window.partitionBy(*keys).orderBy(t).rangeBetween(-span, 0)
    first = F.min_by(F.struct(t, x), F.struct(t, tie) if tie else F.struct(t)).over(frame)
    return samples.withColumn("_first", first).withColumn("velocity", _slope(t, x)).drop("_first")


def _slope(t: str, x: str) -> Column:
    dt = F.col(t) - F.col(f"_first.{t}")
    return F.when(dt > 0, (F.col(x) - F.col(f"_first.{x}")) / dt).otherwise(0.0)


def ease_out(p: Column) -> Column:
    return 1 - F.pow(1 - p, 3)


def coasted(velocity: Column, dt: Column, friction: float = 0.0035, most: float = 0.4, longest: int = 64) -> Column:
    """Velocity after dt milliseconds of friction (FN-29)."""
    return F.least(F.greatest(velocity, F.lit(-most)), F.lit(most)) * F.exp(-friction * F.least(dt, F.lit(longest)))


def clamped_pace(wpm: Column) -> Column:
    """100 to 1000 words a minute in steps of 50 (FN-25)."""
    return F.greatest(F.lit(100), F.least(F.lit(1000), (F.floor(wpm / 50 + 0.5) * 50))).cast("int")


def decoded(text: Column) -> Column:
    """Text without the usual character entities (FN-21)."""
    for name, plain in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&mdash;", "—"), ("&nbsp;", " "), ("&amp;", "&")):
        text = F.replace(text, F.lit(name), F.lit(plain))
    return text


def short_text(text: Column, most: int) -> Column:
    return F.left(text, F.lit(most))


def cover_address(id_: Column, host: str) -> Column:
    return F.concat(F.lit(f"{host}/"), id_, F.lit(".webp"))


def proxied(url: Column, host: str, prefix: str) -> Column:
    """An address of a host by way of one's own prefix (PRJ-07)."""
    return F.regexp_replace(url, rf"^https?://(www\.)?{host.replace('.', chr(92) + '.')}", prefix)


def span_percent(index: Column, start: Column, end: Column, tokens: Column) -> Column:
    """How much of the readable span is read, 0 to 100; a span without width counts as one word, a text without tokens gives 0 (PRJ-13)."""
    size = F.greatest(F.lit(1), end - start)
    return F.when(tokens > 0, F.greatest(F.lit(0.0), F.least(F.lit(100.0), (index - start) * 100.0 / size))).otherwise(0.0)


def thousands(n: Column) -> Column:
    """A whole number with commas (FN-28)."""
    return F.format_number(n.cast("long"), 0)


def padded(id_: Column, width: int = 6) -> Column:
    """An id with blanks before it, never cut (FN-28)."""
    text = id_.cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit(" "))
