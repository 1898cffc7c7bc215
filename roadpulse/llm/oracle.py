"""SQL for the queries that it can express, for an engine with list functions and MD5."""

from __future__ import annotations

from roadpulse.llm import licenses, mixing

_LICENSES = """
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '{word}') AS w
  FROM documents),
t(template, label, base, n_grams, place, w0, w1, w2) AS (VALUES {templates}),
g AS (
  SELECT rid, i AS pos, w[i + 1] AS a, w[i + 2] AS b, w[i + 3] AS c
  FROM (SELECT rid, w, unnest(range(0, len(w) - 2)) AS i FROM d WHERE len(w) >= 3)),
votes AS (
  SELECT rid, template, label, base, n_grams, place, pos, pos - place AS diagonal
  FROM g JOIN t ON a = w0 AND b = w1 AND c = w2),
starts AS (
  SELECT *, CASE WHEN base THEN diagonal WHEN lag(diagonal) OVER w IS NULL
    OR diagonal - lag(diagonal) OVER w > {slack} THEN 1 ELSE 0 END AS st
  FROM votes WINDOW w AS (PARTITION BY rid, template ORDER BY diagonal, pos)),
bands AS (
  SELECT *, CASE WHEN base THEN diagonal ELSE
    sum(st) OVER (PARTITION BY rid, template ORDER BY diagonal, pos ROWS UNBOUNDED PRECEDING) END AS band
  FROM starts),
spans AS (
  SELECT rid, template, label, base, n_grams, band, count(DISTINCT place) AS held,
    min(pos) AS start, max(pos) + 3 AS stop
  FROM bands GROUP BY ALL),
v AS (
  SELECT *, held / n_grams AS share, CASE WHEN base THEN held = n_grams
    ELSE held / n_grams >= {share} AND stop - start <= (n_grams + 2) * {longest} END AS ok
  FROM spans),
kept AS (
  SELECT * FROM v s WHERE ok AND (base OR NOT EXISTS (
    SELECT 1 FROM v o WHERE o.ok AND o.rid = s.rid AND o.start < s.stop AND s.start < o.stop
      AND o.share > s.share AND o.label <> s.label))),
found AS (
  SELECT rid, count(*) FILTER (WHERE base) AS n_base, min(start) FILTER (WHERE base) AS first_word,
    max(start) FILTER (WHERE base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM kept GROUP BY rid),
scores AS (SELECT rid, max(share) AS score FROM v GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
  first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN found USING (rid) LEFT JOIN scores USING (rid)
"""

_MIXING = """
WITH sizes AS (
  SELECT source, sum(length(coalesce(text, '')) + 1) AS size FROM documents GROUP BY source),
rates AS (
  SELECT source, pow(size, 0.5) * (SELECT sum(size) FROM sizes)
    / ((SELECT sum(pow(size, 0.5)) FROM sizes) * size) AS rate FROM sizes),
parts AS (SELECT source, greatest(1, ceil(rate / {part}))::BIGINT AS parts, rate FROM rates),
chances AS (
  SELECT source, parts, k, rate / parts AS l, exp(k * ln(rate / parts) - rate / parts - lgamma(k + 1)) AS p
  FROM parts, range(0, {table}) r(k)),
cdf AS (SELECT source, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM chances),
d AS (SELECT row_number() OVER () AS rid, * FROM documents),
u AS (
  SELECT rid, d.source, ('0x' || substr(md5(concat_ws('|', '17', j, coalesce(doc_id::VARCHAR, ''))), 1, 13))::BIGINT
    / 4503599627370496.0::DOUBLE AS x
  FROM d JOIN parts ON d.source IS NOT DISTINCT FROM parts.source, range(1, parts + 1) s(j)),
copies AS (
  SELECT rid, count(*) AS n FROM u JOIN cdf ON u.source IS NOT DISTINCT FROM cdf.source AND c <= x GROUP BY rid)
SELECT doc_id, text, lang, source, n_chars, i::INTEGER AS copy,
  ('0x' || substr(md5(concat_ws('|', '17', 'order', i, coalesce(doc_id::VARCHAR, ''))), 1, 13))::BIGINT AS shuffle_key
FROM (SELECT d.*, unnest(range(1, n + 1)) AS i FROM d JOIN copies USING (rid))
"""


def _value(x) -> str:
    return str(x).lower() if isinstance(x, (bool, int)) else "'" + x.replace("'", "''") + "'"


def oracle_sql() -> dict[str, str]:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    templates = ", ".join(f"({', '.join(map(_value, row))})" for row in licenses.template_grams())
    return {
        "op4_licenses": _LICENSES.format(
            upper=upper, lower=upper.lower(), word=licenses.WORD, templates=templates,
            slack=licenses.SLACK, share=licenses.SHARE, longest=licenses.LONGEST,
        ),
        "op7_mixing": _MIXING.format(part=mixing.PART, table=mixing.TABLE),
    }
