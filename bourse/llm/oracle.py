"""SQL that DuckDB runs for the operators that SQL can express on whole tables.

The other operators (byte tokenization, shingle joins, guess costs, hashes of vectors, suffix order, models, n-gram
coverage, piece lattices) are compared with brute-force versions in the tests.
"""

from __future__ import annotations

from bourse.llm import mixing, negatives, urls

_RULES = sorted(urls.RULES, key=lambda r: (-len(r[1] + r[2]), -len(r[1])))


def _case(column: int) -> str:
    whens = " ".join(
        f"WHEN (host = '{r[1]}' OR ends_with(host, '.{r[1]}')) AND starts_with(path, '{r[2]}') THEN '{(r[1] + r[2], r[0])[column]}'"
        for r in _RULES)
    return f"CASE {whens} END"


URL_FILTERS = rf"""
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages
), split AS (
  SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), '{urls.UPPER}', '{urls.LOWER}'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM cut
), judged AS (
  SELECT *, {_case(0)} AS rule, {_case(1)} AS by_rule,
         regexp_replace(host, '^(www|m)\.', '') || regexp_replace(regexp_replace(path, '/$', ''), '\.html$', '') AS canonical
  FROM split
), listed AS (
  SELECT DISTINCT canonical FROM judged
  WHERE regexp_matches(host, '(^|[.-])({urls.LISTED_NAMES})([.-]|$)') AND canonical <> ''
)
SELECT page_id, host, path, rule,
       CASE WHEN by_rule IS NOT NULL THEN by_rule
            WHEN canonical IN (SELECT canonical FROM listed) THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""

SOURCE_MIXING = rf"""
WITH sizes AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{mixing.WORD}')), 0) AS BIGINT) AS size FROM documents
), totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source
), weighted AS (
  SELECT *, [{', '.join(map(str, mixing.WEIGHTS))}][1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % {len(mixing.WEIGHTS)}] AS weight,
         {mixing.MOST} * source_size AS full_size
  FROM totals
), leveled AS (
  SELECT *, full_size / weight AS full_at,
         (sum(source_size) OVER () - coalesce(sum(full_size) OVER before, 0))
         / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM weighted
  WINDOW before AS (ORDER BY full_size / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size,
         CASE WHEN level <= full_at
              THEN min_by(CASE WHEN level <= full_at THEN level END, CASE WHEN level <= full_at THEN full_at END) OVER () * weight
              ELSE CAST(full_size AS DOUBLE) END AS target
  FROM leveled
), plan AS (
  SELECT *, CAST(CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS BIGINT) AS copies FROM targets
), rests AS (
  SELECT *, target - copies * source_size AS rest FROM plan
), by_size AS (
  SELECT source, size, CAST(size AS HUGEINT) * count(*) AS words, CAST(size AS HUGEINT) * size * count(*) AS squares
  FROM sizes WHERE size > 0 GROUP BY source, size
), sums AS (
  SELECT source, size,
         CAST(coalesce(sum(words) OVER (PARTITION BY source ORDER BY size DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS sure,
         CAST(sum(squares) OVER (PARTITION BY source ORDER BY size DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS squares
  FROM by_size
), scales AS (
  SELECT s.source, max_by((rest - sure) / squares, size) AS scale
  FROM sums s JOIN rests r ON s.source IS NOT DISTINCT FROM r.source
  WHERE (rest - sure) / squares >= 0 AND (rest - sure) / squares * size <= 1
  GROUP BY s.source
), drawn AS (
  SELECT z.doc_id, z.source, z.size, r.source_size, r.target, r.copies, r.rest,
         least(1.0::DOUBLE, coalesce(c.scale, 0.0::DOUBLE) * z.size) AS p,
         (CAST(('0x' || substr(md5(coalesce(CAST(z.doc_id AS VARCHAR), 'null') || '|{mixing.SEED}'), 1, 13)) AS BIGINT)::DOUBLE + 0.5::DOUBLE) / {1 << 52}::DOUBLE AS u
  FROM sizes z JOIN rests r ON z.source IS NOT DISTINCT FROM r.source
  LEFT JOIN scales c ON z.source IS NOT DISTINCT FROM c.source
), ranked AS (
  SELECT *, (copies + CASE WHEN p >= 1 THEN 1 ELSE 0 END) * size AS certain,
         CASE WHEN p >= 1 OR p <= 0 OR size <= 0 THEN 0 ELSE size END AS pool,
         CASE WHEN p < 1 AND p > 0 AND size > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS q
  FROM drawn
), placed AS (
  SELECT *, sum(CASE WHEN p >= 1 THEN size ELSE 0 END) OVER (PARTITION BY source) AS sure_words,
         coalesce(sum(pool) OVER (PARTITION BY source ORDER BY q NULLS FIRST, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM ranked
)
SELECT doc_id, size, source_size, target,
       CAST(certain + CASE WHEN pool > 0 AND start + size / 2 <= rest - sure_words THEN size ELSE 0 END AS BIGINT) AS taken
FROM placed
"""

ORACLE: dict[str, str] = {"op4_source_mixing": SOURCE_MIXING, "op6_url_filters": URL_FILTERS,
                          "op12_hard_negatives": negatives.ORACLE}
