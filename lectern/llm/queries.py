"""One query for each operator of this package, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import new_path, read_table, stored
from lectern.llm.conversations import damaged, repair
from lectern.llm.exact_dedup import exact_dedup
from lectern.llm.fingerprints import edit_fingerprints
from lectern.llm.language_id import fit, language_of
from lectern.llm.line_dedup import line_dedup
from lectern.llm.merkle import folded, leaf, manifest, siblings
from lectern.llm.mixing import copies_in_order, mix
from lectern.llm.near_dedup import near_dedup
from lectern.llm.phrases import phrase_dedup
from lectern.llm.pii import pii_spans
from lectern.llm.secrets import corpus_words, secret_spans
from lectern.llm.sentence_pieces import decode, encode
from lectern.llm.spans import base_only, by_method, count_of, spelled
from lectern.llm.warc import read_warc, write_warc

OP2_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages
), h AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS hex, max(page_id) OVER (PARTITION BY html) AS head FROM p
), v AS (SELECT *, list_transform(range(0, 8), lambda i: CAST('0x' || substr(hex, CAST(i * 5 + 1 AS INT), 5) AS INT)) AS quints FROM h
)
SELECT page_id, payload_bytes,
    array_to_string(list_transform(quints, lambda x: array_to_string(list_transform([15, 10, 5, 0], lambda b: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((x >> b) & 31 AS INT) + 1, 1)), '')), '') AS payload_digest,
    CASE WHEN page_id = head OR head IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> head THEN head END AS refers_to
FROM v
"""

OP3_SQL = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
        ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END AS shingles FROM w
), one AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets
), link AS (
    SELECT a.doc_id AS x, b.doc_id AS y FROM one a JOIN one b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach AS (SELECT x, y FROM link UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x
), least AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, least(doc_id, coalesce(y, doc_id)) AS component_id, doc_id <= coalesce(y, doc_id) AS kept
FROM sets LEFT JOIN least ON x = doc_id
"""

OP4_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(norm) AS text_sha256
FROM d
"""


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup(read_table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select(F.col("row.doc_id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")

OP6_SQL = r"""
WITH d AS (
    SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS place, md5(text) AS text_md5, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents
), s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r FROM d GROUP BY source
), w AS (SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][CAST(r % 3 + 1 AS INT)] AS weight, [1.0::DOUBLE, 0.0::DOUBLE, -1.0::DOUBLE][CAST(r % 3 + 1 AS INT)] AS slope, sum(source_size) OVER () AS all_size FROM s
), f AS (
    SELECT *, sum(source_size) OVER o - source_size AS size_before, sum(weight) OVER o - weight AS weight_before, sum(weight) OVER () AS all_weight
    FROM w WINDOW o AS (ORDER BY source_size / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)
), c AS (
    SELECT *, 2.0::DOUBLE * source_size <= (1.5::DOUBLE * all_size - 2.0::DOUBLE * size_before) * weight / (all_weight - weight_before) AS capped FROM f
), l AS (SELECT coalesce(sum(source_size) FILTER (capped), 0) AS capped_size, coalesce(sum(weight) FILTER (NOT capped), 0) AS open_weight FROM c
), t AS (
    SELECT source, source_size, slope, CASE WHEN capped THEN 2.0::DOUBLE * source_size ELSE (1.5::DOUBLE * all_size - 2.0::DOUBLE * capped_size) * weight / open_weight END AS target FROM c, l
), p AS (
    SELECT d.*, t.source_size, t.slope, t.target, CAST(sum(size) OVER (PARTITION BY d.source ORDER BY place, doc_id NULLS LAST, size, text_md5 ROWS UNBOUNDED PRECEDING) - size AS BIGINT) AS first
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), k AS (
    SELECT *, least(greatest(CAST(floor(target) AS BIGINT) - first, 0), size) AS one, least(greatest(CAST(floor(target) AS BIGINT) - first - source_size, 0), size) AS two FROM p
)
SELECT doc_id, size, source_size, target, CAST(one + two AS BIGINT) AS taken,
    CASE WHEN one > 0 THEN round(least(1.0::DOUBLE, 2 * (first / target) / (1 - slope / 2 + sqrt((1 - slope / 2) * (1 - slope / 2) + 2 * slope * (first / target)))), 9) END AS position,
    CASE WHEN two > 0 THEN round(least(1.0::DOUBLE, 2 * ((first + source_size) / target) / (1 - slope / 2 + sqrt((1 - slope / 2) * (1 - slope / 2) + 2 * slope * ((first + source_size) / target)))), 9) END AS again
FROM k
"""

#: One level of the tree: lines d of nodes that share (n, lead, node), the tokens' counts, the template, and who fits it.
_OP10_LEVEL = """
), e{r} AS (SELECT n, lead, node, unnest(range(1, n + 1)) AS place, unnest(m) AS token FROM d{r}
), c{r} AS (SELECT n, lead, node, place, token, count(*) AS same FROM e{r} GROUP BY n, lead, node, place, token
), p{r} AS (
    SELECT n, lead, node, place, count(*) AS kinds, CASE WHEN 2 * max(same) > sum(same) THEN arg_max(token, same) END AS token
    FROM c{r} GROUP BY n, lead, node, place HAVING sum(same) > 1
), q{r} AS (SELECT n, lead, node, kinds, count(*) AS same, min(place) AS place FROM p{r} WHERE kinds > 1 GROUP BY n, lead, node, kinds
), h{r} AS (SELECT n, lead, node, place FROM q{r} QUALIFY row_number() OVER (PARTITION BY n, lead, node ORDER BY same DESC, kinds) = 1
), s{r} AS (SELECT n, lead, node, list(token ORDER BY place) AS shape FROM p{r} GROUP BY n, lead, node
), j{r} AS (
    SELECT d.*, h.place, shape, len(list_filter(range(1, d.n + 1), lambda i: coalesce(m[i] = shape[i], false))) >= 0.75 * d.n AS fits
    FROM d{r} d JOIN s{r} s ON d.n = s.n AND d.lead = s.lead AND d.node = s.node JOIN h{r} h ON d.n = h.n AND d.lead = h.lead AND d.node = h.node
), d{next} AS (SELECT n, lead, m, concat(node, ' ', place, ' ', m[place]) AS node FROM j{r} WHERE NOT fits"""

OP10_SQL = (
    r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), l AS (SELECT doc_id, text, unnest(range(1, len(parts) + 1)) AS pos, unnest(parts) AS line FROM t
), k AS (
    SELECT doc_id, text, pos, list_transform(regexp_extract_all(line, '[^\x20\x09-\x0D]+'), lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END) AS m FROM l
), m AS (SELECT doc_id, text, pos, m, len(m) AS n, array_to_string(m[1:3], ' ') AS lead FROM k WHERE len(m) > 0
), d0 AS (SELECT DISTINCT n, lead, m, '' AS node FROM m"""
    + "".join(_OP10_LEVEL.format(r=r, next=r + 1) for r in range(4))
    + """
), a AS (SELECT n, lead, m, list_transform(shape, lambda x: coalesce(x, '<*>')) AS template FROM ("""
    + " UNION ALL ".join(f"SELECT n, lead, m, shape FROM j{r} WHERE fits" for r in range(4))
    + """)
), g AS (SELECT m.doc_id, m.text, m.pos, m.n, coalesce(a.template, m.m) AS template FROM m LEFT JOIN a ON m.n = a.n AND m.lead = a.lead AND m.m = a.m
), r AS (SELECT template FROM g GROUP BY template, n HAVING count(DISTINCT text) >= CASE WHEN n >= 50 THEN 3 ELSE 10 END
), x AS (SELECT g.doc_id, g.pos FROM g JOIN r ON g.template = r.template
), y AS (SELECT doc_id, list(pos) AS dropped FROM x GROUP BY doc_id)
SELECT t.doc_id, CAST(len(parts) AS BIGINT) AS n_lines, CAST(coalesce(len(dropped), 0) AS BIGINT) AS n_dropped,
    sha256(array_to_string(list_transform(list_filter(range(1, len(parts) + 1), lambda i: NOT list_contains(coalesce(dropped, []), i)), lambda i: parts[i]), chr(10))) AS clean_sha256
FROM t LEFT JOIN y ON t.doc_id = y.doc_id
"""
)

#: One row whose t is the table of CRC-32 (reversed polynomial 0xEDB88320), and the checksum of ASCII text by it.
_CRC_TABLE = "crc AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t)"
_CRC = lambda x: f"xor(list_reduce(list_transform(string_split({x}, ''), lambda z: CAST(ascii(z) AS BIGINT)), lambda c, z: xor(c >> 8, t[xor(c, z) % 256 + 1]), 4294967295), 4294967295)"


def _leaf_sql(text: str) -> str:
    field = lambda x: f"CASE WHEN {x} IS NULL THEN '-' ELSE concat(strlen(CAST({x} AS VARCHAR)), ':', {x}) END"
    return f"sha256(concat({', '.join(field(x) for x in ('doc_id', 'source', 'lang', 'n_chars', text))}))"


OP11_SQL = rf"""
WITH RECURSIVE {_CRC_TABLE}, c AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_CRC("concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS hit FROM conversations, crc
), d AS (
    SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role, CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(CASE hit WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM c
), n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos FROM d
), f AS (
    SELECT *, left(role, 1) AS initial, CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
        WHEN NOT regexp_matches(text, '[.!?][ 	-
]*$') THEN 'truncated' ELSE 'ok' END AS fault,
        lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS previous FROM n
), g AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (previous IS NOT NULL AND concat(previous, initial) NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id
), ins(i, j, cost, audit, lines) AS (
    VALUES (0, 0, 0, '', []), (0, 2, 2, 'I', ['user:']), (0, 3, 4, 'II', ['user:', 'assistant:']), (1, 1, 0, '', []), (1, 2, 2, 'I', ['user:']), (1, 3, 4, 'II', ['user:', 'assistant:']),
        (2, 2, 0, '', []), (2, 3, 2, 'I', ['assistant:']), (3, 3, 0, '', []), (3, 2, 2, 'I', ['user:'])
), ed(i, initial, j, letter, cost) AS (
    VALUES (0, NULL, 0, 'D', 3), (1, NULL, 1, 'D', 3), (2, NULL, 2, 'D', 3), (3, NULL, 3, 'D', 3), (0, 's', 1, 'K', 0), (0, 'u', 2, 'K', 0), (1, 'u', 2, 'K', 0), (3, 'u', 2, 'K', 0), (2, 'a', 3, 'K', 0),
        (0, NULL, 2, 'R', 2), (1, NULL, 2, 'R', 2), (3, NULL, 2, 'R', 2), (2, NULL, 3, 'R', 2)
), best AS (
    SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS pos, 0 AS state, {{'cost': CAST(0 AS BIGINT), 'audit': '', 'lines': CAST([] AS VARCHAR[])}} AS way FROM conversations
    UNION ALL
    SELECT b.conv_id, f.pos, ed.j, min({{
        'cost': CAST(way.cost + ins.cost + ed.cost + CASE WHEN letter <> 'D' AND fault = 'truncated' THEN 1 ELSE 0 END AS BIGINT), 'audit': concat(way.audit, ins.audit, letter),
        'lines': list_concat(way.lines, ins.lines, CASE letter WHEN 'D' THEN [] WHEN 'K' THEN [concat(role, ':', text)] ELSE [concat(CASE ed.j WHEN 2 THEN 'user:' ELSE 'assistant:' END, text)] END)}})
    FROM best b JOIN f ON b.conv_id IS NOT DISTINCT FROM f.conv_id AND f.pos = b.pos + 1 JOIN ins ON ins.i = state JOIN ed ON ed.i = ins.j AND coalesce(ed.initial = f.initial, true) AND (letter = 'D' OR fault IN ('ok', 'truncated'))
    GROUP BY b.conv_id, f.pos, ed.j
), ends AS (
    SELECT b.conv_id, min({{'cost': way.cost + ins.cost, 'audit': concat(way.audit, ins.audit), 'lines': list_concat(way.lines, ins.lines)}}) AS way
    FROM best b LEFT JOIN g ON b.conv_id IS NOT DISTINCT FROM g.conv_id JOIN ins ON ins.i = state AND ins.j IN (0, 3) WHERE pos = coalesce(n, 0) GROUP BY b.conv_id
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
    CAST(way.cost AS BIGINT) AS cost, way.audit AS audit, sha256(array_to_string(way.lines, chr(10))) AS repaired_sha256
FROM ends e LEFT JOIN g ON e.conv_id IS NOT DISTINCT FROM g.conv_id
"""


OP12_SQL = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), w AS (SELECT r, i, array_to_string(words[i:i + 34], ' ') AS window_text FROM (SELECT r, words, unnest(range(1, len(words) - 33)) AS i FROM t)
), c AS (SELECT r, i FROM w QUALIFY count(*) OVER (PARTITION BY window_text) > 1
), g AS (SELECT DISTINCT r, i + o AS j FROM c, (SELECT unnest(range(35)) AS o)
), k AS (
    SELECT x.r, string_agg(word, ' ' ORDER BY x.j) AS kept, count(*) AS n
    FROM (SELECT r, unnest(range(1, len(words) + 1)) AS j, unnest(words) AS word FROM t) x ANTI JOIN g ON x.r = g.r AND x.j = g.j GROUP BY x.r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM t LEFT JOIN k ON t.r = k.r
"""


_ABOVE = "list_transform(range(0, len(nodes), 3), lambda i: sha256(array_to_string(nodes[i + 1:i + 3], '')))"

OP13_SQL = f"""
WITH RECURSIVE {_CRC_TABLE}, e AS (
    SELECT doc_id, source, {_leaf_sql("text")} AS leaf, CASE WHEN {_CRC("CAST(doc_id AS VARCHAR)")} % 2 = 0 THEN {_leaf_sql("replace(text, chr(10), '')")} END AS tampered FROM documents, crc
), d AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p FROM e
), lv AS (
    SELECT source, 0 AS l, list(leaf ORDER BY p) AS nodes FROM d GROUP BY source
    UNION ALL SELECT source, l + 1, {_ABOVE} FROM lv WHERE len(nodes) > 1
), sub AS (SELECT source, nodes[1] AS subroot, l AS height, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS p FROM lv WHERE len(nodes) = 1
), up AS (
    SELECT 0 AS l, list(subroot ORDER BY p) AS nodes FROM sub
    UNION ALL SELECT l + 1, {_ABOVE} FROM up WHERE len(nodes) > 1
), node AS (
    SELECT d.source, d.p, l AS s, nodes, CAST(d.p // CAST(3 ** l AS BIGINT) AS BIGINT) AS i FROM d JOIN lv ON d.source IS NOT DISTINCT FROM lv.source WHERE len(nodes) > 1
    UNION ALL SELECT d.source, d.p, height + l, nodes, CAST(sub.p // CAST(3 ** l AS BIGINT) AS BIGINT) FROM d JOIN sub ON d.source IS NOT DISTINCT FROM sub.source, up WHERE len(nodes) > 1
), step AS (
    SELECT source, p, s, array_to_string(nodes[i // 3 * 3 + 1:i], '') AS ahead, array_to_string(nodes[i + 2:i // 3 * 3 + 3], '') AS behind FROM node
), fold AS (
    SELECT source, p, 0 AS s, coalesce(tampered, leaf) AS node FROM d
    UNION ALL SELECT f.source, f.p, f.s + 1, sha256(concat(ahead, node, behind)) FROM fold f JOIN step ON f.source IS NOT DISTINCT FROM step.source AND f.p = step.p AND f.s = step.s
), proof AS (SELECT source, p, sha256(string_agg(concat(ahead, behind), '' ORDER BY s)) AS proof_sha256 FROM step GROUP BY source, p
), last AS (SELECT source, p, arg_max(node, s) AS folded_root FROM fold GROUP BY source, p
), top AS (SELECT nodes[1] AS root FROM up WHERE len(nodes) = 1)
SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM d JOIN sub ON d.source IS NOT DISTINCT FROM sub.source JOIN last ON d.source IS NOT DISTINCT FROM last.source AND d.p = last.p
LEFT JOIN proof ON d.source IS NOT DISTINCT FROM proof.source AND d.p = proof.p, top
"""


def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = edit_fingerprints(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "warc")
    write_warc(read_table(spark, sf_dir, "pages"), folder)
    return read_warc(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(read_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the training order takes of each document, and when: from the copies in that order."""
    mixed = stored(mix(read_table(spark, sf_dir, "documents"), keep=["doc_id"]), "mixed")
    ordered = copies_in_order(mixed, ["place"])
    copies = ordered.groupBy("place").agg(F.sum("words").alias("taken"), F.min("position").alias("position"), F.when(F.count("*") > 1, F.max("position")).alias("again"))
    docs = mixed.select(F.col("row.doc_id").alias("doc_id"), "place", "size", "source_size", "target")
    time = lambda c: F.round(c, 9).alias(c)
    return docs.join(copies, "place", "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), time("position"), time("again"))


def model_file(spark: SparkSession) -> str:
    """The SentencePiece vocabulary to use."""
    return spark.conf.get("lectern.llm.sentencepiece_model", "/opt/tokenizers/piece_bpe_32k.model")


def op7_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of each document's pieces, and whether they decode to the text (marks count as blanks)."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("plain", F.sha2(F.replace(F.coalesce("text", F.lit("")), F.lit("\u2581"), F.lit(" ")), 256))
    found = encode(docs, model_file(spark), keep=["doc_id", "plain"])
    found = found.select("row.*", "ids", "n_chunks", decode("ids", spark, model_file(spark)).alias("decoded"))
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), "n_chunks", (F.sha2("decoded", 256) == F.col("plain")).alias("round_trip"))


def _span_digest(docs: DataFrame, spans: Column, kinds: tuple[str, ...]) -> DataFrame:
    found = docs.select("doc_id", spans.alias("s"))
    return found.select("doc_id", *[count_of(F.col("s"), k).alias(f"n_{k}") for k in kinds], F.sha2(spelled(base_only(F.col("s"))), 256).alias("base_sha256"), spelled(F.col("s")).alias("spans"), spelled(by_method(F.col("s"))).alias("method_spans"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return _span_digest(docs, pii_spans(docs, F.col("text")), ("email", "ip", "card", "phone"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return _span_digest(docs, secret_spans(docs, F.col("text"), corpus_words(docs, F.col("text"))), ("assign", "access", "hex"))


def _held_out() -> Column:
    """Never true or false by another column than doc_id; null ids are neither learned from nor held out."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = fit(docs.filter(~_held_out()).select(F.col("doc_id").alias("id"), "text", "lang"))
    found = docs.select("doc_id", F.coalesce(_held_out(), F.lit(False)).alias("held_out"), language_of(docs, F.col("text"), model).alias("l"))
    return found.select("doc_id", "held_out", F.col("l.lang").alias("lang_pred"), F.col("l.score").alias("score"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup(read_table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select("row.doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("clean_sha256"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, copies = damaged(read_table(spark, sf_dir, "conversations"))
    report, _ = repair(rows, copies=copies)
    return report.withColumnRenamed("conv", "conv_id")


def op12_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrase_dedup(read_table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select("row.doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars"]
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, leaf(*map(F.col, fields), F.replace("text", F.lit("\n"), F.lit(""))))
    docs = docs.withColumn("tampered", tampered)
    found = manifest(docs, leaf(*map(F.col, fields), F.col("text")), keep=["doc_id", "tampered"])
    found = found.select("row.*", "leaf", "subroot", "root", F.sha2(siblings(F.col("proof")), 256).alias("proof_sha256"), folded(F.coalesce("row.tampered", "leaf"), F.col("proof")).alias("folded_root"))
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_order_minhash": op1_order_minhash,
    "op2_warc": op2_warc,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_pii": op5_pii,
    "op6_mix_sources": op6_mix_sources,
    "op7_sentence_pieces": op7_sentence_pieces,
    "op8_secrets": op8_secrets,
    "op9_language_id": op9_language_id,
    "op10_line_dedup": op10_line_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_phrase_dedup": op12_phrase_dedup,
    "op13_merkle_manifest": op13_merkle_manifest,
}
ORACLE_SQL: dict[str, str] = {
    "op2_warc": OP2_SQL,
    "op3_minhash_near_dedup": OP3_SQL,
    "op4_exact_dedup": OP4_SQL,
    "op6_mix_sources": OP6_SQL,
    "op10_line_dedup": OP10_SQL,
    "op11_conversation_repair": OP11_SQL,
    "op12_phrase_dedup": OP12_SQL,
    "op13_merkle_manifest": OP13_SQL,
}
