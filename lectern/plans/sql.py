"""Pieces of DuckDB SQL that several counterparts share."""

from __future__ import annotations

from lectern.functions.text import SPACE

TRIM = lambda x: f"regexp_replace({x}, '^[{SPACE}]+|[{SPACE}]+$', '', 'g')"
UNIX = lambda x: f"regexp_replace({x}, '\\r\\n?', chr(10), 'g')"
COLLAPSED = lambda x: f"regexp_replace({x}, '[{SPACE}]+', ' ', 'g')"
WORDS = lambda x: f"string_split_regex({TRIM(f"regexp_replace({UNIX(x)}, '\\n[ \\t]*\\n+', ' [P] ', 'g')")}, '[{SPACE}]+')"
TENTHS = (
    "CASE WHEN word = '[P]' THEN 50 WHEN right(word, 1) IN ('.', '!', '?') THEN 30 WHEN right(word, 1) = ',' THEN 20 "
    "ELSE (CASE WHEN length(word) > 12 THEN 15 WHEN length(word) > 8 THEN 12 ELSE 10 END) + CASE WHEN right(word, 1) IN (';', ':') THEN 5 ELSE 0 END END"
)


def tokens(source: str, key: str = "doc_id") -> str:
    """CTEs up to tok(key, id, word, sentence, paragraph, sentence_start, sentence_end, paragraph_end)."""
    return f"""
raw_w AS (SELECT {key}, {WORDS("text")} AS w FROM {source}),
raw_t AS (SELECT {key}, unnest(range(1, len(w) + 1)) AS pos, unnest(w) AS word FROM raw_w),
next_t AS (SELECT *, lead(word) OVER (PARTITION BY {key} ORDER BY pos) AS following FROM raw_t),
flag_t AS (
    SELECT {key}, row_number() OVER (PARTITION BY {key} ORDER BY pos) - 1 AS id, word, following IS NULL OR following = '[P]' AS paragraph_end,
        following IS NULL OR following = '[P]' OR right(word, 1) IN ('.', '!', '?') AS sentence_end
    FROM next_t WHERE word <> '[P]'
),
tok AS (
    SELECT *, CAST(coalesce(sum(CAST(sentence_end AS INT)) OVER b, 0) AS BIGINT) AS sentence, CAST(coalesce(sum(CAST(paragraph_end AS INT)) OVER b, 0) AS BIGINT) AS paragraph,
        coalesce(lag(sentence_end) OVER (PARTITION BY {key} ORDER BY id), true) AS sentence_start
    FROM flag_t WINDOW b AS (PARTITION BY {key} ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
)"""


def books(front: str = "", back: str = "") -> str:
    quoted = lambda s: " || chr(10) || ".join(f"'{p}'" for p in s.split("\n"))
    return f"""
part_n AS (SELECT source || '-' || CAST(doc_id // 1000 AS VARCHAR) AS book_id, doc_id, text, row_number() OVER (PARTITION BY source, doc_id // 1000 ORDER BY doc_id) AS n FROM documents),
book AS (
    SELECT book_id, {quoted(front)} || string_agg('CHAPTER ' || CAST(n AS VARCHAR) || chr(10) || chr(10) || text, chr(10) || chr(10) ORDER BY doc_id) || {quoted(back)} AS text
    FROM part_n GROUP BY book_id
)"""


def title_case(x: str) -> str:
    chars = f"string_split(lower({x}), '')"
    return f"array_to_string(list_transform({chars}, lambda c, i: CASE WHEN regexp_matches(c, '^[a-z0-9_]$') AND (i = 1 OR NOT regexp_matches({chars}[i - 1], '^[a-z0-9_]$')) THEN upper(c) ELSE c END), '')"


def roman(x: str) -> str:
    chars = f"string_split(lower({x}), '')"
    value = lambda c: f"coalesce([1, 5, 10, 50, 100, 500, 1000][list_position(['i', 'v', 'x', 'l', 'c', 'd', 'm'], {c})], 0)"
    return f"list_sum(list_transform({chars}, lambda c, i: CASE WHEN {value('c')} < {value(f'{chars}[i + 1]')} THEN -{value('c')} ELSE {value('c')} END))"


def number_key(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, '^[0-9]+$') THEN CAST(TRY_CAST({x} AS INT) AS VARCHAR) ELSE CAST(CAST({roman(x)} AS INT) AS VARCHAR) END"
