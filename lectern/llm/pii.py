"""Personal data in texts: rules, and spans that a character BiLSTM-CRF adds.

The tagger learns from invented labelled spans, in the rules' formats and in others that they miss (telephone
numbers without a country code or with 00 before it, cards with dots, addresses of machines with [.], e-mail addresses with blanks
or a spelled-out at sign or dot), beside numbers and words that are no personal data. Every form it learns has a digit or an at sign, which may be spelled out. A character's tag scores come from the window in whose core it stands, and the best
path is found over each run of adjoining cores, so a span may have any length and lie anywhere. A window without digit or
at sign can't hold a span by itself; it is decoded where a span runs into it.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import small_batches
from lectern.llm.spans import SPAN_TYPE, SPANS, Taken, in_code_points, ordered
from lectern.llm.tagger import Tagger, char_classes

KINDS = ("email", "ip", "card", "phone")
#: Characters in a window, in its core, and before its core.
WINDOW, CORE = 96, 48
LEAD = (WINDOW - CORE) // 2
#: Cores of a long run that are decoded at once (with one more on either side), and windows whose scores are held at once.
STRETCH, HELD = 4, 4096
#: Least mean posterior of an added span's tags.
SURE = 0.9
EXAMPLES, STEPS = 5000, 520

# The rules of the task.
_LOCAL = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_HOST = re.compile(rb"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(rb"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")  # from the start of a run of digits: in linear time
_CARD = re.compile(rb"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")
#: A dot in words, and an at sign in words; with blanks alone around it, only before a host.
_DOT = r"(?: ?[\[(] ?[dD][oO][tT] ?[\])] ?| [dD][oO][tT] )"
_AT = rf"(?:[\[(] ?[aA][tT] ?[\])]| [aA][tT] (?=[A-Za-z0-9-]+(?:\.|{_DOT})[A-Za-z0-9]))"
_SIGN = re.compile(rf"[0-9@]+|{_AT}")
#: What an added span of a kind must at least have.
_LEAST = {"email": re.compile(rf"(?=.*(?:[0-9@]|{_AT}))(?=[^a-z]*+[a-z].*?(?:\.|{_DOT})).{{6,}}", re.S), "ip": re.compile(r"(?:[^0-9]*[0-9]){4}"), "card": re.compile(r"(?:[^0-9]*[0-9]){14}"), "phone": re.compile(r"(?:[^0-9]*[0-9]){9}")}


def luhn(digits: bytes) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = (c - 48) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _emails(data: bytes) -> Iterator[tuple[int, int]]:
    """Leftmost matches: from each at sign back over the local part, on from the last match."""
    end, at = 0, data.find(b"@")
    while at >= 0:
        start = at
        while start > end and data[start - 1] in _LOCAL:
            start -= 1
        m = _HOST.match(data, at) if start < at else None
        if m:
            yield start, m.end()
            end = m.end()
        at = data.find(b"@", max(at + 1, end))


def rule_spans(data: bytes) -> tuple[list[tuple[str, int, int, bool]], list[tuple[str, int, int, bool]]]:
    """Spans of the rules in bytes, and matches that they dropped."""
    found, dropped = [("email", a, b, True) for a, b in _emails(data)], []
    if not re.search(rb"[0-9]", data):
        return found, dropped
    for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
        for m in pattern.finditer(data):
            digits = re.sub(rb"[^0-9]", b"", m[0])
            fits = {"ip": lambda: all(len(p.lstrip(b"0")) <= 3 and int(p) <= 255 for p in m[0].split(b".")), "card": lambda: 14 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 10 <= len(digits) <= 15}[kind]()
            if fits:
                found.append((kind, m.start(), m.end(), True))
            elif kind != "card" or len(digits) >= 12:
                dropped.append((kind, m.start(), m.end(), False))
    return found, dropped


class _Inventor:
    """Windows of invented text with labelled spans."""

    def __init__(self, seed: int):
        self.rng = np.random.default_rng(seed)

    def digits(self, n: int) -> str:
        return "".join(map(str, self.rng.integers(0, 10, n)))

    def pick(self, some):
        return some[int(self.rng.integers(len(some)))]

    def word(self, letters: str = "aaabcdeeeefghiiiklmnnnoooprrsssttttuuvwyzéèáíóüöäñßç") -> str:
        return "".join(self.pick(letters) for _ in range(int(self.rng.integers(1, 11))))

    def prose(self) -> str:
        w = self.word()
        return (w.title() if self.rng.random() < 0.15 else w) + self.pick(["", "", "", "", "", ",", ".", ";", ":", ".\n"])

    def card(self) -> str:
        n = int(self.pick([14, 14, 14, 13]))
        body = "4" + (self.digits(n) if self.rng.random() < 0.85 else self.digits(1) * n)  # those of examples repeat a digit
        return next(x for i in range(10) if luhn((x := body + str(i)).encode()))

    def span(self, kind: str) -> str:
        name, host = self.word("abcdefghiklmnoprstuvy") + self.pick(["", ".", "_"]) + self.pick([self.digits(2), self.word("abcdehilmnorst")]), f"{self.word('abcdefmailnostr')}{self.pick(['', self.digits(1)])}.{self.pick(['com', 'org', 'net', 'example.com', 'de', 'fr', 'es'])}"
        d = self.digits
        if kind == "email":
            apart = host.replace(".", self.pick([" [dot] ", "[dot]", "(dot)", " dot "]))
            return self.pick([f"{name}@{host}", f"{name}@{host}", f"{name}@{host}", f"{name} [at] {host}", f"{name}(at){host}", f"{name} @ {host}", f"{name} [at] {apart}", f"{name}(at){apart}"])
        if kind == "ip":
            parts = [str(self.rng.integers(1, 256)) for _ in range(4)]
            return self.pick([".".join(parts), ".".join(parts), ".".join(parts), ".".join(parts[:3]) + "[.]" + parts[3], "[.]".join(parts)])
        if kind == "card":
            c = self.card()
            return self.pick([c, c, " ".join(c[i : i + 4] for i in range(0, len(c), 4)), "-".join(c[i : i + 4] for i in range(0, len(c), 4)), *[".".join(c[i : i + 4] for i in range(0, len(c), 4))] * 3])
        return self.pick([f"+{d(1)} ({d(3)}) {d(3)}-{d(4)}", f"+1 ({d(3)}) 555-{d(4)}", f"+{d(2)} {d(3)} {d(3)} {d(4)}", f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"{d(3)}.{d(3)}.{d(4)}", f"0{d(2)} {d(8)}", f"0{d(3)} {d(3)} {d(4)}", f"00{d(2)} {d(3)} {d(3)} {d(4)}", f"00{d(2)}-{d(2)}-{d(7)}"])

    def decoy(self) -> str:
        d, n = self.digits, int(self.rng.integers(1, 9))
        hexes = "".join(self.pick("0123456789abcdef") for _ in range(int(self.pick([18, 32, 40]))))
        return self.pick([d(n), d(4), d(2), f"{d(1)}.{d(2)}", f"{d(1)}.{d(1)}.{d(2)}", f"v{d(1)}.{d(2)}", f"{d(4)}-{d(2)}-{d(2)}", f"{d(2)}:{d(2)}", f"{d(3)},{d(3)}", f"{d(2)}/{d(2)}/{d(4)}", f"({d(4)})", f"password={hexes}", f'token = "{hexes}"', "AKIA" + "".join(self.pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16)), f"id {d(12)}", f"{self.word()}{d(2)}", f"https://{self.word()}.com/{d(5)}", f"@{self.word()}", f"{d(5)} {d(6)}", f"{d(3)}%", f"{self.word()} at {self.word()}", f"{self.word()} at {self.word()}.\n", f"{d(2)} dot {self.word()}", f"[{d(1)}]", f"{self.word()} [at] {self.word()}{self.pick(['', '.'])}", f"{self.word()} (at) {self.word()}.", f"0{d(3)} {d(2)}", f"ISBN {d(3)}-{d(1)}-{d(4)}-{d(4)}-{d(1)}"])

    def window(self) -> tuple[str, np.ndarray]:
        text, tags = "", []
        while len(text) < 2 * WINDOW:
            r = self.rng.random()
            kind = self.pick(KINDS) if r < 0.16 else None
            part = self.span(kind) if kind else self.decoy() if r < 0.3 else self.prose()
            mark = KINDS.index(kind) * 2 + 1 if kind else 0
            tags += ([mark, *[mark + 1] * (len(part) - 1)] if kind else [0] * len(part)) + [0]
            text += part + self.pick(" " * 9 + "\n")
        start = int(self.rng.integers(0, len(text) - WINDOW))
        own = np.array(tags[start : start + WINDOW])
        if own[0] and own[0] % 2 == 0:
            own[0] -= 1  # the window cuts a span
        return text[start : start + WINDOW], own


@cache
def trained(seed: int = 3) -> Tagger:
    """The tagger, trained anew from the same invented windows in each process that asks."""
    make = _Inventor(seed)
    rows = [make.window() for _ in range(EXAMPLES)]
    tagger = Tagger(KINDS)
    tagger.train(np.stack([char_classes(t) for t, _ in rows]), np.stack([t for _, t in rows]), STEPS)
    return tagger


def _cores(text: str) -> list[int]:
    """Numbers of the cores whose windows have a digit or an at sign, be it in words."""
    return sorted({c for m in _SIGN.finditer(text) for c in range(max(0, m.start() - WINDOW + LEAD) // CORE, (m.end() + LEAD) // CORE + 1) if c * CORE < len(text)})


def _window(text: str, core: int) -> str:
    return (" " * max(0, LEAD - core * CORE) + text[max(0, core * CORE - LEAD) : core * CORE - LEAD + WINDOW]).ljust(WINDOW)


def windows_of(text: str) -> list[tuple[int, str]]:
    """Start of the core and text of each window with a digit or an at sign, be it in words."""
    return [(c * CORE, _window(text, c)) for c in _cores(text)]


def _runs(cores: Iterable[int]) -> list[tuple[int, int]]:
    """First core of each run of adjoining ones, and that after its last."""
    out: list[tuple[int, int]] = []
    for c in sorted(cores):
        out[-1:] = [(out[-1][0], c + 1)] if out and out[-1][1] == c else [*out[-1:], (c, c + 1)]
    return out


def _best_tags(tagger: Tagger, scores: list[dict[int, np.ndarray]], places: Iterable[int]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Text, core, tags and their posteriors, from the scores of the cores of each text in places."""
    parts: dict[int, list[tuple[int, int, int, int]]] = {}
    for i in places:
        for first, last in _runs(scores[i]):
            for a in range(first, last, STRETCH):
                b = min(a + STRETCH, last)
                low, high = max(first, a - 1), min(last, b + 1)
                parts.setdefault(high - low, []).append((i, low, a, b))
    for size, some in parts.items():
        for at in range(0, len(some), 512):
            part = some[at : at + 512]
            tags, sure = tagger.best(np.stack([np.concatenate([scores[i][c] for c in range(low, low + size)]) for i, low, _, _ in part], 1))
            for (i, low, a, b), row, p in zip(part, tags, sure):
                for c in range(a, b):
                    yield i, c, row[(c - low) * CORE : (c - low + 1) * CORE], p[(c - low) * CORE : (c - low + 1) * CORE]


def _sure_spans(text: str, found: dict[int, tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[str, int, int]]:
    for first, last in _runs(found):
        tags, sure = (np.concatenate([found[c][k] for c in range(first, last)]) for k in (0, 1))
        kind = (tags + 1) // 2
        turns = np.flatnonzero((np.diff(kind, prepend=0) != 0) | (tags % 2 == 1))
        for j, end in zip(turns, [*turns[1:], len(tags)]):
            if kind[j] and sure[j:end].mean() >= SURE:
                yield KINDS[kind[j] - 1], first * CORE + int(j), min(first * CORE + int(end), len(text))


def _group_spans(tagger: Tagger, texts: list[str], cores: list[list[int]]) -> list[list[tuple[str, int, int]]]:
    scores: list[dict[int, np.ndarray]] = [{} for _ in texts]
    found: list[dict[int, tuple[np.ndarray, np.ndarray]]] = [{} for _ in texts]
    wanted, reach = [(i, c) for i, some in enumerate(cores) for c in some], 1
    while wanted:
        for at in range(0, len(wanted), 512):
            some = wanted[at : at + 512]
            s = tagger.scores(np.stack([char_classes(_window(texts[i], c)) for i, c in some]))
            for r, (i, c) in enumerate(some):
                scores[i][c] = s[LEAD : LEAD + CORE, r].copy()
        places = sorted({i for i, _ in wanted})
        for i, c, tags, sure in _best_tags(tagger, scores, places):
            found[i][c] = tags, sure
        more = set()  # cores into which a span runs on
        for i in places:
            for first, last in _runs(found[i]):
                more |= {(i, c) for c in range(max(0, first - reach), first) if found[i][first][0][0]}
                more |= {(i, c) for c in range(last, last + reach) if found[i][last - 1][0][-1] and c * CORE < len(texts[i])}
        wanted, reach = sorted((i, c) for i, c in more if c not in scores[i]), 2 * reach
    return [list(_sure_spans(t, f)) for t, f in zip(texts, found)]


def tagged_spans(tagger: Tagger, texts: list[str]) -> list[list[tuple[str, int, int]]]:
    """Sure spans (kind, start, end) of each text."""
    out, group, held = [], [], 0
    for t in texts:
        group.append((t, _cores(t)))
        held += len(group[-1][1])
        if held >= HELD:
            out += _group_spans(tagger, *map(list, zip(*group)))
            group, held = [], 0
    return out + (_group_spans(tagger, *map(list, zip(*group))) if group else [])


def pii_spans(df: DataFrame, text: Column) -> Column:
    """Spans of the whole text in code points, by start and kind.

    base marks those of the rules; method those where the tagger is sure of the kind, be they its own additions or
    spans of the rules that it finds as well. Null and empty texts have none. Added spans meet neither those of the rules nor matches of their
    kind that the rules dropped, and have the kind's digits or letters.
    """
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(trained())

    @F.arrow_udf(SPANS)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tagger = shared.value
        for batch in batches:
            texts = [t or "" for t in batch.to_pylist()]
            out = []
            for t, more in zip(texts, tagged_spans(tagger, texts)):
                data = t.encode("utf-8", "surrogatepass")
                base, dropped = rule_spans(data)
                base, dropped = in_code_points(data, base), in_code_points(data, dropped)
                sure = {k: Taken([m for m in more if m[0] == k]) for k in KINDS}
                taken = {k: Taken(base + [d for d in dropped if d[0] == k]) for k in KINDS}
                extra = [(k, a, b, False, True) for k, a, b in more if not taken[k].meets(a, b) and _LEAST[k].match(t, a, b)]
                rules = [(k, a, b, True, sure[k].meets(a, b)) for k, a, b, _ in base]
                out.append([dict(zip(("kind", "start", "end", "base", "method"), s)) for s in ordered(rules + extra, KINDS)])
            yield pa.array(out, SPAN_TYPE)

    return scan(text.cast("string"))
