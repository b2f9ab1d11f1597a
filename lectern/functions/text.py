"""Column expressions over words and texts.

Sizes and pauses are carried as whole tenths and milliseconds. White space is that of the ECMAScript trim and
split, which has more members than Java's; "end" in a pattern is the absolute end of the string.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space, for use inside a character class of Java or RE2.
SPACE = r"\t-\r \x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}"
#: White space within a line.
BLANK = SPACE.replace(r"\t-\r ", r"\t\x0b\f ").replace(r"\x{2028}\x{2029}", "")
#: Its members, to be trimmed off without a pattern.
SPACES = "\t\n\x0b\f\r \xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"
#: The same class for long texts, in Java: most characters are told by one range, before the members are gone through.
_SPACE = rf"[^!-\x{{9f}}\x{{a1}}-\x{{167f}}]&&[{SPACE}]"
PARAGRAPH = "[P]"


def bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), where value is told once however often `then` names it."""
    return F.element_at(F.transform(F.array(value), then), 1)


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def parts(text: Column) -> Column:
    """A text cut at its runs of white space; where it is all ASCII, by a pattern that need not know the others."""
    return F.when(F.octet_length(text) == F.length(text), F.split(text, r"[\t-\r ]+")).otherwise(F.split(text, f"[{_SPACE}]+"))


def unix_lines(text: Column) -> Column:
    return F.regexp_replace(text, r"\r\n?", "\n")


def marked(text: Column) -> Column:
    """Each run of blank lines becomes a paragraph mark."""
    return F.regexp_replace(unix_lines(text), r"\n[ \t]*\n+", f" {PARAGRAPH} ")


def raw_words(text: Column) -> Column:
    """Words and paragraph marks; a blank text is one empty word."""
    return bound(trimmed(marked(text)), parts)


def words(text: Column) -> Column:
    """Words alone: their positions are token ids."""
    return F.filter(raw_words(text), lambda w: w != PARAGRAPH)


def words_in_line(line: Column) -> Column:
    return bound(trimmed(line), lambda t: F.when(t == "", 0).otherwise(F.size(parts(t))))


def ends_sentence(word: Column) -> Column:
    return F.right(word, F.lit(1)).isin(".", "!", "?")


def clean_word(word: Column) -> Column:
    return F.translate(word, ".,!?;:", "")


def dwell_tenths(word: Column) -> Column:
    """How long a word is shown, in tenths of the base time: a sentence end and a comma replace what length adds."""
    last, n = F.right(word, F.lit(1)), F.length(word)
    long = F.when(n > 12, 15).when(n > 8, 12).otherwise(10)
    return F.when(word == PARAGRAPH, 50).when(ends_sentence(word), 30).when(last == ",", 20).when(last.isin(";", ":"), long + 5).otherwise(long)


def delay_units(word: Column, starts_sentence: Column, wpm: int = 300) -> Column:
    """A word's time in sentence mode, in wpm-ths of a millisecond: whole, so that sums of any length are exact.

    The first word of a sentence takes 1.8 times as long and 500 ms more.
    """
    tenths = dwell_tenths(word).cast("long")
    return F.when(starts_sentence, tenths * 10_800 + 500 * wpm).otherwise(tenths * 6_000)


def delay_ms(word: Column, starts_sentence: Column, wpm: int = 300) -> Column:
    """Milliseconds of a word in sentence mode, with their fraction."""
    return delay_units(word, starts_sentence, wpm) / F.lit(float(wpm))


def focal_index(word: Column, mode: str = "shrink") -> Column:
    """Which letter is coloured: about a third in, or the middle; centerBig takes the middle of words of 11 or more."""
    n = F.length(word)
    third = F.when(n <= 1, 0).when(n <= 5, 1).when(n <= 9, 2).when(n <= 13, 3).otherwise(F.floor(n * 3 / 10))
    middle = F.floor(n / 2)
    found = {"centerAll": middle, "centerBig": F.when(n >= 11, middle).otherwise(third)}.get(mode, third)
    return found.cast("int")


def split_word(word: Column, mode: str = "shrink") -> Column:
    at = focal_index(word, mode)
    return F.struct(F.left(word, at).alias("before"), F.substring(word, at + 1, F.lit(1)).alias("focal"), F.substring(word, at + 2, F.length(word)).alias("after"))


def title_case(text: Column) -> Column:
    """Lower case, with a capital for each ASCII letter that follows no ASCII letter, digit or underscore."""
    chars = F.split(F.lower(text), "")
    letter = lambda c: c.rlike("^[A-Za-z0-9_]$")
    cased = F.transform(chars, lambda c, i: F.when(letter(c) & ((i == 0) | ~F.coalesce(letter(F.try_element_at(chars, i)), F.lit(False))), F.upper(c)).otherwise(c))
    return trimmed(F.array_join(cased, ""))


def heading_title(text: Column) -> Column:
    """Single blanks, and no full stops, brackets or blanks at the end."""
    return F.regexp_replace(trimmed(F.regexp_replace(text, rf"[{SPACE}]+", " ")), rf"[.\]{SPACE}]+\z", "")


def roman_value(numeral: Column) -> Column:
    """Value of a roman numeral by subtraction, without checking it; other letters count nothing."""
    chars = F.split(F.lower(numeral), "")
    value = lambda c: F.when(c == "i", 1).when(c == "v", 5).when(c == "x", 10).when(c == "l", 50).when(c == "c", 100).when(c == "d", 500).when(c == "m", 1000).otherwise(0)
    each = F.transform(chars, lambda c, i: F.when(value(c) < F.coalesce(value(F.try_element_at(chars, i + 2)), F.lit(0)), -value(c)).otherwise(value(c)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x)


def number_key(numeral: Column) -> Column:
    return F.when(numeral.rlike(r"^[0-9]+\z"), numeral.cast("int")).otherwise(roman_value(numeral)).cast("string")


def letters_only(text: Column) -> Column:
    """Lower-case ASCII letters and digits, all else dropped: anchors are compared like this."""
    return F.regexp_replace(F.lower(text), "[^a-z0-9]+", "")


def rolling_hash(text: Column) -> Column:
    """h = 31 h + code, modulo 2^32, over the characters."""
    return F.when(text == "", F.lit(0).cast("long")).otherwise(F.aggregate(F.split(text, ""), F.lit(0).cast("long"), lambda h, c: (h * 31 + F.ascii(c)) % 4294967296))


def rounded(x: Column) -> Column:
    """Half up, as ECMAScript rounds."""
    return F.floor(x + 0.5).cast("long")


def read_time_label(n_words: Column, wpm: Column) -> Column:
    """null without words; "< 1 min"; "N min"; "H hr", with minutes only from 5 on."""
    minutes = rounded(n_words / F.greatest(wpm, F.lit(1)))
    hours, rest = F.floor(minutes / 60), minutes % 60
    hour_text = F.concat(hours.cast("string"), F.lit(" hr"))
    long = F.when(rest >= 5, F.concat(hour_text, F.lit(" "), rest.cast("string"), F.lit(" min"))).otherwise(hour_text)
    return F.when(n_words.isNull() | (n_words == 0), F.lit(None)).when(minutes < 1, "< 1 min").when(minutes < 60, F.concat(minutes.cast("string"), F.lit(" min"))).otherwise(long)


def duration_label(minutes: Column) -> Column:
    whole = rounded(minutes)
    hours, rest = F.floor(whole / 60), whole % 60
    return F.when(minutes < 1, "< 1m").when(whole < 60, F.concat(whole.cast("string"), F.lit("m"))).otherwise(F.concat(hours.cast("string"), F.lit("h"), F.when(rest > 0, F.concat(F.lit(" "), rest.cast("string"), F.lit("m"))).otherwise("")))


def display_author(name: Column) -> Column:
    """"Last, First" in speaking order if there are exactly two parts; Unknown if missing."""
    parts = F.transform(F.split(name, ","), trimmed)
    turned = (F.size(parts) == 2) & (parts[1] != "")
    return F.when(name.isNull() | (name == ""), "Unknown").when(turned, F.concat_ws(" ", parts[1], parts[0])).otherwise(name)


def display_title(title: Column) -> Column:
    """A title without library field marks and with single blanks."""
    plain = F.regexp_replace(title, rf"(?i)[{SPACE}]*:[{SPACE}]*\$[a-z](?![A-Za-z0-9_])[{SPACE}]*", ": ")
    plain = F.regexp_replace(plain, rf"(?i)[{SPACE}]+\$[a-z](?![A-Za-z0-9_])[{SPACE}]*", " ")
    return trimmed(F.regexp_replace(plain, rf"[{SPACE}]+", " "))


def title_key(title: Column) -> Column:
    return F.regexp_replace(F.lower(trimmed(title)), rf"[{SPACE}]+", " ")


def is_html(text: Column) -> Column:
    return text.rlike(rf"(?i)^[{SPACE}]*<(!doctype|html)")
