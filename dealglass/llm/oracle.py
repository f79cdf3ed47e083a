"""DuckDB SQL of the text queries that SQL can express, on whole tables."""

from __future__ import annotations

import re

from dealglass.llm import decontaminate as dc
from dealglass.llm import licenses as lic
from dealglass.llm import quality_rules as qr

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _canonical(text: str) -> str:
    """Canonical lines of a text, as a list."""
    kept = (f"list_filter(string_split(translate({text}, '{UPPER}', '{LOWER}'), chr(10)), "
            f"lambda x: NOT regexp_matches(x, {_text(lic.COPYRIGHT)}))")
    out = f"regexp_replace(array_to_string({kept}, chr(10)), {_text(lic.PUNCTUATION)}, ' ', 'g')"
    for found, put in lic.SPELLINGS:
        put = re.sub(r"\$(\d)", r"\\\1", put)
        out = f"regexp_replace({out}, {_text(found)}, {_text(put)}, 'g')"
    return f"list_transform(string_split({out}, chr(10)), lambda x: trim(x, ' '))"


_KNOWN = ", ".join(f"({_text(a)}, {_text(b)})" for a, b in lic.KNOWN)
LICENSES = f"""
WITH known AS (
  SELECT sha256(array_to_string(list_filter({_canonical('t')}, lambda x: x <> ''), ' ')) AS digest,
         min(license_id) AS license_id
  FROM (VALUES {_KNOWN}) AS k(license_id, t) GROUP BY 1
), d AS (
  SELECT row_number() OVER () AS r, doc_id, {_canonical('text')} AS lines FROM documents
), w AS (
  SELECT r, doc_id, lines,
         array_to_string(list_filter(lines, lambda x: x <> ''), ' ') AS whole FROM d
), units AS (
  SELECT r, whole AS unit FROM w
  UNION SELECT r, unnest(lines) FROM w
  UNION SELECT r, trim(unnest(string_split(array_to_string(list_transform(lines,
    lambda x: CASE WHEN x = '' THEN chr(10) ELSE x END), ' '), chr(10))), ' ') FROM w
), hits AS (
  SELECT r, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS licenses,
         count(DISTINCT license_id) AS n
  FROM units JOIN known ON digest = sha256(unit) WHERE unit <> '' GROUP BY r
)
SELECT doc_id, sha256(whole) AS text_digest, license_id AS text_license,
       coalesce(n, 0) AS n_licenses, coalesce(licenses, '') AS licenses
FROM w LEFT JOIN known ON digest = sha256(whole) LEFT JOIN hits USING (r)
"""

_TOKENS = (f"coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), "
           f"{_text(dc.WORD)}), [])")
DECONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TOKENS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_TOKENS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, w[i : i + least({dc.WIDTH}, len(w)) - 1] AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {dc.WIDTH - 1}, 1) + 1)) AS i
        FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT len(win) AS n FROM win),
grams AS (
  SELECT r, i, n, w[i : i + n - 1] AS win
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)
), occ AS (SELECT DISTINCT r, i, n, item FROM grams JOIN win USING (win)),
hit AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM occ)) GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item FROM occ WHERE item IS NOT NULL) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND {dc.MIN_SHARE} * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""

_WORDS = r"coalesce(regexp_extract_all({}, '[^\x20\x09-\x0D]+'), [])"
_FURNITURE = " OR ".join(f"contains(lower(x), {_text(p)})" for p in qr.BOILERPLATE)
QUALITY_RULES = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, text, {_WORDS.format('text')} AS w FROM documents
), lines AS (
  SELECT r, pos, x, {_WORDS.format('x')} AS w
  FROM (SELECT r, unnest(l) AS x, generate_subscripts(l, 1) AS pos
        FROM (SELECT r, string_split(text, chr(10)) AS l FROM d))
), judged AS (
  SELECT r, pos, x, len(w) AS n, len(w) > 0 AND (
    len(x) - len(replace(x, '|', '')) >= {qr.BARS}
    OR (len(x) - len(replace(x, '!!', ''))) / 2 * 4 > len(w)
    OR len(regexp_extract_all(x, {_text(qr.SYMBOLS)})) * 4 > len(w)
    OR (len(w) > {qr.LONG_RUN} AND NOT regexp_matches(x, {_text(qr.PUNCTUATION)}))
    OR (len(w) >= {qr.STUTTER_WORDS} AND len(list_distinct(w)) * 4 <= len(w))
    OR (len(w) <= {qr.LONG_RUN} AND ({_FURNITURE}))) AS fails
  FROM lines
), by_line AS (
  SELECT r, count(*) FILTER (WHERE n > 0) - count(DISTINCT x) FILTER (WHERE n > 0) AS n_dup_lines,
         coalesce(sum(n) FILTER (WHERE fails), 0) AS n_lost_words,
         md5(coalesce(string_agg(x, chr(10) ORDER BY pos) FILTER (WHERE NOT fails), ''))
           AS cleaned_md5
  FROM judged GROUP BY r
), wins AS (
  SELECT r, i, w[i : i + 7] AS win
  FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)
), twice AS (
  SELECT r, i FROM wins
  JOIN (SELECT r, win FROM wins GROUP BY r, win HAVING count(*) > 1) USING (r, win)
), rep AS (
  SELECT r, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY r
), counts AS (
  SELECT doc_id, len(w) AS n_words, len(array_to_string(w, '')) AS word_chars,
         coalesce(len(regexp_extract_all(text, {_text(qr.SYMBOLS)})), 0) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         CAST(coalesce(n_lost_words, 0) AS BIGINT) AS n_lost_words, cleaned_md5
  FROM d LEFT JOIN by_line USING (r) LEFT JOIN rep USING (r)
), base AS (
  SELECT *, n_words < {qr.MIN_WORDS}
    OR 100 * n_repeat_words > {qr.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM counts
)
SELECT *, NOT base_failed AND 100 * n_lost_words <= {qr.MAX_LOST_PERCENT} * n_words
  AND n_words - n_lost_words >= {qr.MIN_WORDS} AS kept FROM base
"""

TEXT_SQL: dict[str, str] = {
    "op1_license_scan": LICENSES,
    "op2_decontamination": DECONTAMINATION,
    "op6_quality_rules": QUALITY_RULES,
}
