"""The registered queries of this subpackage, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat import format_chats
from .decontam import find_contamination
from .html_extract import extract_main_text
from .langid import identify
from .mixing import mix_report
from .neardup import near_duplicates
from .quality import quality_rules
from .shared import table
from .token_store import token_store
from .toxicity import score_toxicity
from .warc import warc_roundtrip


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rounded = [F.round(c, 6).alias(c) for c in ("target", "first_position")]
    return mix_report(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", rounded[0], "taken", rounded[1])


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).drop("failed_rules")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_roundtrip(spark, table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_token_store": op2_token_store,
    "op3_toxicity": op3_toxicity,
    "op4_decontamination": op4_decontamination,
    "op5_mixing": op5_mixing,
    "op6_language_id": op6_language_id,
    "op7_chat_formatting": op7_chat_formatting,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_quality_rules": op9_quality_rules,
    "op10_warc": op10_warc,
}

#: The fences of the quality rules in SQL: metric, percentile, lower fence too.
_FENCES = (("word_len_milli", 90, True), ("symbol_milli", 75, False), ("dup_line_milli", 98, False), ("repeat_milli", 98, False))


def _quality_sql() -> str:
    level_of = "CASE metric " + " ".join(f"WHEN '{m}' THEN {percent}" for m, percent, _ in _FENCES) + " END"

    def level(name: str, keys: str) -> str:
        by = f"{keys}, " if keys else ""
        # the least bucket at which the running count reaches the percentile
        qs = ", ".join(f"min(bucket) FILTER (WHERE seen >= ceil(total * ({q}) / 100e0)) AS {part}" for part, q in (("mid", "50"), ("hi", level_of), ("lo", f"100 - {level_of}")))
        return (
            f"{name}_m AS (SELECT {by}metric, bucket, sum(n)::BIGINT AS n FROM cells GROUP BY {by}metric, bucket), "
            f"{name}_c AS (SELECT *, sum(n) OVER (PARTITION BY {by}metric ORDER BY bucket) AS seen, sum(n) OVER (PARTITION BY {by}metric) AS total FROM {name}_m), "
            f"{name} AS (SELECT {by}metric, any_value(total)::DOUBLE AS total, {qs} FROM {name}_c GROUP BY {by}metric)"
        )

    lean = lambda own, prior: ", ".join(f"({own}.total * {own}.{c} + 200e0 * {prior}.{c}) / ({own}.total + 200e0) AS {c}" for c in ("mid", "hi", "lo"))
    fences = ", ".join(f"max(mid + 4e0 * (hi - mid)) FILTER (WHERE metric = '{m}') AS {m}_hi" + (f", max(mid - 4e0 * (mid - lo)) FILTER (WHERE metric = '{m}') AS {m}_lo" if low else "") for m, _, low in _FENCES)
    bucket = lambda v: f"CASE WHEN {v} < 128 THEN {v} ELSE ({v} >> (length(bin({v})) - 7)) << (length(bin({v})) - 7) END"
    within = " AND ".join(f"({bucket(f'r.{m}')}) <= t.{m}_hi" + (f" AND ({bucket(f'r.{m}')}) >= t.{m}_lo" if low else "") for m, _, low in _FENCES)
    bound = lambda n: f"floor(greatest({n} - 2e0 * sqrt({n}), 0) * 1000e0)::BIGINT"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws, string_split(t, chr(10)) AS ls FROM d),
spots AS (SELECT rid, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5),
grams AS (SELECT rid, i, array_to_string(ws[i:i + 4], ' ') AS g FROM spots JOIN w USING (rid)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS k FROM grams) WHERE k > 1),
rep AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY rid),
lines AS (SELECT rid, count(*) AS n, count(DISTINCT x) AS k FROM (SELECT rid, unnest(ls) AS x FROM w) WHERE regexp_matches(x, '[^\\x20\\x09-\\x0D]') GROUP BY rid),
b AS (
  SELECT w.rid, doc_id, lang, source, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
    CASE WHEN len(ws) = 0 THEN 0 ELSE length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) END AS n_symbols,
    coalesce(lines.n, 0) AS n_lines, coalesce(lines.n - lines.k, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
  FROM w LEFT JOIN lines USING (rid) LEFT JOIN rep USING (rid)),
r AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    word_chars * 1000 // greatest(n_words, 1) AS word_len_milli, {bound("n_symbols")} // greatest(word_chars, 1) AS symbol_milli,
    {bound("n_dup_lines")} // greatest(n_lines, 1) AS dup_line_milli, {bound("n_repeat_words")} // greatest(n_words, 1) AS repeat_milli FROM b),
u AS (SELECT lang, source, unnest([{", ".join(f"{{'metric': '{m}', 'v': {m}}}" for m, *_ in _FENCES)}]) AS e FROM r WHERE NOT base_failed),
cells AS (
  SELECT lang, source, e.metric AS metric, {bucket('e.v')} AS bucket, count(*) AS n
  FROM u GROUP BY ALL),
{level("g", "lang, source")}, {level("l", "lang")}, {level("a", "")},
h AS (SELECT l.lang, l.metric, {lean("l", "a")} FROM l JOIN a ON l.metric = a.metric),
j AS (SELECT g.lang, g.source, g.metric, {lean("g", "h")} FROM g JOIN h ON g.lang IS NOT DISTINCT FROM h.lang AND g.metric = h.metric),
t AS (SELECT lang, source, {fences} FROM j GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce({within}, true) AS kept
FROM r LEFT JOIN t ON r.lang IS NOT DISTINCT FROM t.lang AND r.source IS NOT DISTINCT FROM t.source
"""


_WARC_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h, coalesce(html, '') AS body FROM pages),
k AS (SELECT *, max(page_id) OVER (PARTITION BY body) AS keeper FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
    ((('0x' || h[(i // 4) * 5 + 1:(i // 4) * 5 + 5])::INT >> (15 - 5 * (i % 4))::INT) & 31) + 1]), '') AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS NOT DISTINCT FROM keeper THEN NULL ELSE keeper END AS refers_to
FROM k
"""

_MIXING_SQL = """
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
o AS (SELECT *, (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 AS slot, 3.0::DOUBLE * source_size AS cap FROM s),
w AS (SELECT *, [5, 2, 1][slot + 1]::DOUBLE AS weight, [-0.5, 0, 0.5][slot + 1]::DOUBLE AS slope, cap / [5, 2, 1][slot + 1] AS full_at FROM o),
t AS (
  SELECT *, (sum(source_size) OVER ()::DOUBLE - coalesce(sum(cap) OVER f, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER f, 0)) AS try
  FROM w WINDOW f AS (ORDER BY full_at, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT max(try) FILTER (WHERE try <= full_at) AS level FROM t),
p AS (SELECT t.*, least(coalesce(level, full_at) * weight, cap) AS target FROM t, l),
q AS (
  SELECT d.*, p.source_size, p.target, p.slope, coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS base
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source),
c AS (
  SELECT *, list_filter([base::DOUBLE + size / 2.0, (base + source_size)::DOUBLE + size / 2.0, (base + 2 * source_size)::DOUBLE + size / 2.0], lambda m: size > 0 AND m <= target) AS ms FROM q),
e AS (SELECT *, list_min(ms) / greatest(target, 1e-12) AS x FROM c)
SELECT doc_id, size, source_size, round(target, 6) AS target, (len(ms) * size)::BIGINT AS taken,
  round(CASE WHEN slope = 0 THEN x ELSE 2 * x / greatest((1 - slope) + sqrt(greatest((1 - slope) * (1 - slope) + 4 * slope * x, 0)), 1e-12) END, 6) AS first_position
FROM e
"""

_CHAT_SQL = """
WITH t AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS FIRST, text NULLS FIRST) AS pos FROM conversations),
k AS (SELECT *, coalesce('=' || role, '-') || chr(31) || coalesce('=' || text, '-') || chr(30) AS mark FROM t),
p AS (SELECT conv_id, pos, string_agg(mark, '') OVER (PARTITION BY conv_id ORDER BY pos) AS prefix, count(*) OVER (PARTITION BY conv_id) AS n FROM k),
whole AS (SELECT min(conv_id) AS conv_id, n, prefix, count(*) AS n_copies FROM p WHERE pos = n GROUP BY n, prefix),
longer AS (SELECT DISTINCT pos, prefix FROM p WHERE pos < n),
kept AS (SELECT * FROM whole w WHERE NOT EXISTS (SELECT 1 FROM longer l WHERE l.pos = w.n AND l.prefix = w.prefix))
SELECT k.conv_id, (k.pos - 1) // 64 AS part, max(kept.n)::BIGINT AS n_turns, max(kept.n_copies)::BIGINT AS n_copies, min(k.pos) AS first_turn, max(k.pos) AS last_turn,
  string_agg('<|im_start|>' || coalesce(k.role, 'unknown') || chr(10) || coalesce(k.text, '') || '<|im_end|>' || chr(10), '' ORDER BY k.pos) AS text
FROM k JOIN kept ON k.conv_id IS NOT DISTINCT FROM kept.conv_id GROUP BY k.conv_id, part
"""

ORACLES: dict[str, str] = {"op5_mixing": _MIXING_SQL, "op7_chat_formatting": _CHAT_SQL, "op9_quality_rules": _quality_sql(), "op10_warc": _WARC_SQL}
