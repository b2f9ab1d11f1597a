"""Secrets in texts: rules, and strings that a dictionary-primed compressor finds new.

Candidates are all strings without white space that have a sensitive word in their surroundings, the AROUND bytes on
either side, or stand in the body of a PEM private key. A leading NAME= is no part of one but stands before it; quotes
and marks around it are none either. Its novelty is the number of bytes that it adds to the zstandard frame of its
surroundings, with a dictionary as history: identifiers and code words from a rule, and the words that stand in most
documents of the corpus. One frame tells that to a few bytes only, so it is the mean over FRAMES surroundings of
different reach. Words, names, paths and numbers repeat what the compressor has seen or have few symbols, and add little;
random strings add about a byte for each of their own. What adds more than needed() is reported: a share of its bytes,
and for short strings so many bytes besides, more of them for what is spelled as words. What the rules find is measured
in the same way.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator, Sequence
from itertools import groupby, product

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import small_batches
from lectern.llm.spans import SPAN_TYPE, SPANS, Taken, in_code_points, ordered

KINDS = ("assign", "access", "hex", "novel")
#: Bytes that a candidate adds for each of its own; for a short one a smaller share, but so many bytes besides.
NOVELTY, SHORT_NOVELTY, SHORT_BYTES = 0.72, 0.52, 4.0
#: Up to this length a string spelled as words needs WORD_BYTES more for each byte that it lacks.
WORD_LENGTH, WORD_BYTES = 24, 0.25
#: Bytes before and behind a candidate that are its surroundings, and how many reaches within are measured.
AROUND, FRAMES = 256, 8
#: What shorter strings add is always less than needed.
LEAST = 6
#: Bytes of a line of a private key.
SHORTEST = 20
#: Words of the corpus in the dictionary: runs of letters, shorter than any candidate.
WORDS = 4000

# The rules of the task, for lower-cased text where letters may be in either case.
_ASSIGN = re.compile(rb"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([a-z0-9+/_.=-]+)")
_ASSIGN_WORDS = (b"passw", b"secret", b"token", b"api")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]{24,}")  # a run of hex digits ends where a longer one would

# the short ones stand by themselves, else random letters would hold them
_SENSITIVE = re.compile(rb"passw|passphrase|secret|token|api[_ -]?key|credential|bearer|private[_ -]?key|signature|access[_ -]?key|(?<![a-z0-9+/])(?:pwd|o?auth(?:orization|entication)?)(?![a-z])")
_RUN = re.compile(rb"[^\x20\x09-\x0D]+")
_PLAIN = re.compile(rb"[A-Za-z0-9+/_=~.\x80-\xff-]+")
_BARE = re.compile(rb"[A-Za-z0-9\x80-\xff](?:.*[A-Za-z0-9=\x80-\xff])?", re.S)
_WORD = re.compile(rb"[A-Za-z\x80-\xff]?[a-z\x80-\xff]*+(?:[._/:-]++[A-Za-z\x80-\xff]?[a-z\x80-\xff]*+)*+\Z")
_MAIL = re.compile(rb"@[A-Za-z0-9-]+\.")
#: Signs that random strings hold and code has no structure by; one with others is a string only if none of its parts is.
_LOOSE = re.compile(rb"[A-Za-z0-9+/_=~.\x80-\xff!@#$%^*|-]+\Z|[A-Za-z0-9+/_~.\x80-\xff!@#$%^*&|-]+\Z")
_NAME = re.compile(rb"[^=]++=++")
_NAMED = re.compile(rb"[a-z0-9_.-]++[\"']?[=:]++[\"'({\[]*+")
_PEM = re.compile(rb"-----(BEGIN|END)[^\n-]*-----")
#: Headers and base64 lines of a PEM body whose END line is missing.
_PEM_LINES = re.compile(rb"(?:[A-Za-z-]*+:[^\n]*+\n|[A-Za-z0-9+/=\s\\\"',]++)*+")


def _pem_bodies(data: bytes) -> list[tuple[int, int]]:
    """What stands from the BEGIN line of each private key on."""
    marks = [(m.start(), m.end(), m[0]) for m in _PEM.finditer(data)] if b"PRIVATE KEY" in data else []
    out = []
    for (_, start, mark), (end, _, follower) in zip(marks, [*marks[1:], (len(data), 0, b"")]):
        if mark.startswith(b"-----BEGIN") and b"PRIVATE KEY" in mark:
            out.append((start, end if follower.startswith(b"-----END") else _PEM_LINES.match(data, start, end).end()))
    return out


def corpus_words(df: DataFrame, text: Column, most: int = WORDS) -> list[str]:
    """The runs of 4 to SHORTEST - 1 ASCII letters that stand in most rows of df, most frequent first; ties by code point.

    Counted over all rows; `most` words reach the driver. Null texts have none.
    """
    found = df.select(F.explode(F.array_distinct(F.regexp_extract_all(text.cast("string"), F.lit("[A-Za-z]{4,}+"), F.lit(0)))).alias("word"))
    counts = found.filter(F.length("word") < SHORTEST).groupBy("word").count()
    return [r.word for r in counts.orderBy(F.desc("count"), "word").limit(most).collect()]


def _dictionary(words: Sequence[str]) -> zstandard.ZstdCompressionDict:
    """The corpus's words, identifiers in the usual spellings, from a rule, and code words."""
    verbs = "get set is has make load save read write open close send parse build create update delete find fetch check validate encode decode encrypt decrypt sign verify".split()
    nouns = "user name password secret token key value config client server request response session account access refresh public private file path data index count size message header body error result default environment database connection string".split()
    names = [f"{v}_{n}" for v, n in product(verbs, nouns)] + [f"{v}{n.title()}" for v, n in product(verbs, nouns)] + [f"{a}_{b}" for a, b in product(nouns, nouns)] + [f"{a}-{b}".upper() for a, b in product(nouns[:16], nouns[:16])]
    code = "import from return function class const let var public static void string export default if else for while true false null none self this def lambda async await try except finally throw catch new https://www. http:// .com .org .html .json .yaml application/json Content-Type Authorization: Bearer example changeme placeholder your_api_key_here xxxxxxxxxxxxxxxx 0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return zstandard.ZstdCompressionDict(" ".join([*reversed(words), *names, code]).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def needed(candidate: bytes) -> float:
    """Bytes that a candidate must add to be reported."""
    n = len(candidate)
    more = WORD_BYTES * (WORD_LENGTH - n) if n < WORD_LENGTH and _WORD.match(candidate) else 0
    return max(NOVELTY * n, SHORT_NOVELTY * n + SHORT_BYTES) + more


class Scanner:
    def __init__(self, words: Sequence[str] = ()) -> None:
        known = _dictionary(words)
        self.known = known.as_bytes()
        self.packer = zstandard.ZstdCompressor(level=19, dict_data=known, write_checksum=False, write_content_size=False, write_dict_id=False)

    def novelty(self, before: bytes, candidate: bytes, behind: bytes = b"") -> float:
        """Bytes that the candidate adds between `before` and `behind`, over several reaches of them."""
        total, frames = 0, FRAMES if len(candidate) < AROUND else 1  # a few bytes more or less don't tell on a long one
        for i in range(FRAMES - frames, FRAMES):
            reach = AROUND * (i + 3) // (FRAMES + 2)
            a, z = before[max(0, len(before) - reach) :], behind[:reach]
            total += len(self.packer.compress(a + candidate + z)) - len(self.packer.compress(a + z))
        return total / frames

    def spans(self, text: str | None) -> list[tuple[str, int, int, bool]]:
        """Kind, start, end and whether a rule found it."""
        return [s[:4] for s in self.judged(text)]

    def judged(self, text: str | None) -> list[tuple[str, int, int, bool, bool]]:
        """Kind, start, end, whether a rule found it, and whether it is novel."""
        data = (text or "").encode("utf-8", "surrogatepass")
        low, found = data.lower(), []  # the rules' matches, with their values
        if any(w in low for w in _ASSIGN_WORDS):
            found += [("assign", m.start(), m.end(), m.start(1), m.end(1)) for m in _ASSIGN.finditer(low) if m.end(1) - m.start(1) >= 6]
        if max(map(len, data.split()), default=0) >= 20:  # what follows has no white space
            found += [("access", *m.span(), *m.span()) for m in _ACCESS.finditer(data) if m.end() - m.start() >= 20]
            found += [("hex", *m.span(), *m.span()) for m in _HEX.finditer(data)]
        added = [("novel", a, b, False, True) for a, b in self.novel(data, low, Taken(found))]
        rules = [(kind, a, b, True, self.is_novel(data, [(x, y)])) for kind, a, b, x, y in found]
        return ordered(in_code_points(data, rules + added), KINDS)

    def is_novel(self, data: bytes, parts: list[tuple[int, int]]) -> bool:
        a, b = parts[0][0], parts[-1][1]
        candidate = b"".join(data[x:y] for x, y in parts)
        before, behind = data[max(0, a - AROUND) : a], data[b : b + AROUND]
        if len(candidate) < LEAST or candidate in self.known or candidate in before or candidate in behind:
            return False  # a repeat costs fewer bytes than the least that is needed
        return self.novelty(before, candidate, behind) >= needed(candidate)

    def novel(self, data: bytes, low: bytes, taken: Taken) -> Iterator[tuple[int, int]]:
        """Novel candidates beside those of the rules; those of one private key are measured together."""
        for body, some in groupby(self.runs(data, low), lambda c: c[2]):
            if body is not None:
                lines = [(x, y) for a, b, *_ in some for m in _PLAIN.finditer(data, a, b) for _, x, y in _values(m, SHORTEST) if not taken.meets(x, y)]
                if lines and self.is_novel(data, lines):
                    yield from lines
                continue
            for a, b, _, near in some:
                yield from self.within(data, low, a, b, near, taken)

    def within(self, data: bytes, low: bytes, a: int, b: int, near: Callable[[int, int, int], bool], taken: Taken) -> Iterator[tuple[int, int]]:
        """The novel string of a run without white space: its parts between signs, or all of it where these make no structure."""
        whole = []
        for m in _BARE.finditer(data, a, b):
            named = _NAMED.match(low, m.start(), m.end())
            x = named.end() if named else m.start()
            if m.end() - x >= LEAST and near(a, x, m.end()) and not _PLAIN.fullmatch(data, x, m.end()) and not _MAIL.search(data, x, m.end()):
                whole.append((x, m.end()))
        loose = [w for w in whole if _LOOSE.match(data[w[0] : w[1]])]
        parts = [(x, y) for m in _PLAIN.finditer(data, a, b) for start, x, y in _values(m, LEAST) if near(start, x, y)]
        for some in (loose, parts, [w for w in whole if w not in loose]):
            found = [(x, y) for x, y in some if not taken.meets(x, y) and self.is_novel(data, [(x, y)])]
            if found:
                yield from found
                return

    @staticmethod
    def runs(data: bytes, low: bytes) -> Iterator[tuple]:
        """Start and end of the strings in sensitive surroundings, the private key, if any, in whose body each stands, and what tells
        whether a sensitive word stands between a string's context or AROUND before it and its start, or behind its end."""
        words = [m.span() for m in _SENSITIVE.finditer(low)]
        bodies, body = _pem_bodies(data), 0
        if not words and not bodies:
            return
        ends, starts = [b for _, b in words], [a for a, _ in words]
        closed, closing = 0, [m.end() for m in _PEM.finditer(data) if m[1] == b"END"][::-1] if bodies else []
        for m in _RUN.finditer(data):
            a, b = m.span()
            while closing and closing[-1] <= a:
                closed = closing.pop()  # what a key's last line says is no context of what follows
            while body < len(bodies) and bodies[body][1] <= a:
                body += 1
            if body < len(bodies) and bodies[body][0] <= a:
                yield a, b, body, None
                continue

            def near(context: int, x: int, y: int, closed: int = closed) -> bool:
                i = bisect_right(ends, x) - 1
                before = i >= 0 and starts[i] >= max(closed, min(x - AROUND, context))
                i = bisect_left(starts, y)
                return before or i < len(starts) and starts[i] < y + AROUND

            i = bisect_right(ends, b) - 1  # the last word that ends in the run or before it
            if i >= 0 and starts[i] >= max(closed, a - AROUND) or near(a, b, b):
                yield a, b, None, near


def _values(m: re.Match, least: int) -> Iterator[tuple[int, int, int]]:
    """Start of the context, start and end of each value in a candidate.

    The first NAME= is split off where a value of `least` bytes is left; a later one, if its name is sensitive or
    long. A name of SHORTEST bytes may be a secret as well as a name, and is a value too.
    """
    data = m.string
    end = m.start() + len(m[0].rstrip(b".-"))
    context = at = m.start()
    while (name := _NAME.match(data, at, end)) and end - name.end() >= least:
        long = len(name[0]) >= SHORTEST
        if at > m.start() and not long and not _SENSITIVE.search(name[0].lower()):
            break
        if long:
            yield context, at, name.end()
        context, at = at, name.end()
    if end - at >= least:
        yield context, at, end


def secret_spans(df: DataFrame, text: Column, words: Sequence[str] = ()) -> Column:
    """Spans of the whole text in code points, by start and kind.

    base marks those of the rules; method those that are novel, be they added or found by the rules as well. words go
    into the compressor's dictionary (corpus_words). Null and empty texts have none. Added spans never overlap those of
    the rules.
    """
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(list(words))

    @F.arrow_udf(SPANS)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = Scanner(shared.value)
        for batch in batches:
            yield pa.array([[dict(zip(("kind", "start", "end", "base", "method"), s)) for s in scanner.judged(t)] for t in batch.to_pylist()], SPAN_TYPE)

    return scan(text.cast("string"))
