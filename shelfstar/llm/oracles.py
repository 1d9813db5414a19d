"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from .line_quality import LEAST_LEFT, MAX_DOCUMENTS
from .mixing import SEED
from .url_reputation import LEAST_GOOD, STRONGEST, WEAKEST, Z

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _strength(parents: str, children: str, on: str) -> str:
    return f"""(SELECT coalesce(CASE WHEN pages > units AND (spread - units * (chance / pages)) / (pages - units) / (chance / pages) > 0 THEN
        least(greatest((1 - (spread - units * (chance / pages)) / (pages - units) / (chance / pages)) / ((spread - units * (chance / pages)) / (pages - units) / (chance / pages)), {WEAKEST}), {STRONGEST})
        ELSE {STRONGEST} END, {STRONGEST}) AS k
      FROM (SELECT sum(c.n * (c.s / c.n - m) * (c.s / c.n - m)) AS spread, sum(c.n * m * (1 - m)) AS chance, sum(c.n) AS pages, count(*) AS units
            FROM {children} c JOIN (SELECT *, (s + 1) / (n + 2) AS m FROM {parents}) p ON {on} WHERE c.n > 0))"""


_URLS = f"""
WITH cut AS (
  SELECT page_id, url, CASE WHEN coalesce(instr(url, '://'), 0) > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), numbered AS (
  SELECT host, try_cast(nullif(regexp_extract(path, '^/[^/]*/([0-9]{{1,18}})(?:[./]|$)', 1), '') AS BIGINT) AS doc_id FROM parts
), graded AS (
  SELECT doc_id, min(quality) AS good FROM labels WHERE quality IN (0, 1) GROUP BY doc_id
), outcomes AS (
  SELECT host, count(*) AS n, sum(good) AS s FROM numbered JOIN graded USING (doc_id) GROUP BY host
), hosts AS (
  SELECT host, coalesce(n, 0) AS n, coalesce(s, 0) AS s, string_split(host, '.')[-1] AS suffix,
    array_to_string(string_split(host, '.')[-2:], '.') AS domain
  FROM (SELECT DISTINCT host FROM parts) LEFT JOIN outcomes USING (host)
), domains AS (SELECT domain, suffix, sum(n) AS n, sum(s) AS s FROM hosts GROUP BY ALL
), suffixes AS (SELECT suffix, sum(n) AS n, sum(s) AS s FROM domains GROUP BY ALL
), everything AS (SELECT coalesce(sum(n), 0) AS n, coalesce(sum(s), 0) AS s FROM suffixes
), figures AS (
  SELECT {_strength('everything', 'suffixes', 'true')} AS ks, {_strength('suffixes', 'domains', 'c.suffix = p.suffix')} AS kd,
    {_strength('domains', 'hosts', 'c.domain = p.domain')} AS kh, (SELECT (s + 1) / (n + 2) FROM everything) AS m
), by_suffix AS (SELECT suffix, (s + ks * m) / (n + ks) AS ms FROM suffixes, figures
), by_domain AS (SELECT domain, (s + kd * ms) / (n + kd) AS md FROM domains JOIN by_suffix USING (suffix), figures
), by_host AS (SELECT host, n, kh, (s + kh * md) / (n + kh) AS mean FROM hosts JOIN by_domain USING (domain), figures
), bounds AS (SELECT host, mean + {Z} * sqrt(mean * (1 - mean) / (n + kh + 1)) AS bound FROM by_host
), ruled AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM parts
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN bound < {LEAST_GOOD} THEN 'block' ELSE 'allow' END AS verdict
FROM ruled JOIN bounds USING (host)
"""

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

_MIX = f"""
WITH base AS (
  SELECT doc_id, source, coalesce('s' || source, 'n') AS named, len({_WORDS.format("coalesce(text, '')")}) AS size,
    CAST('0x' || substr(md5('{SEED}|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS draw
  FROM documents
), sources AS (
  SELECT named, any_value(source) AS source, CAST(sum(size) AS HUGEINT) AS source_size FROM base GROUP BY named
), weighed AS (
  SELECT named, source_size, CAST([5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS HUGEINT) AS w, 3 * source_size AS cap FROM sources
), filling AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0) AS words_left, sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS parts_left
  FROM weighed WINDOW before AS (ORDER BY cap / w, named ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT words_left, parts_left FROM filling WHERE cap * parts_left >= w * words_left ORDER BY cap / w, named LIMIT 1
), targets AS (
  SELECT named, CAST(source_size AS BIGINT) AS source_size,
    CASE WHEN cap * parts_left < w * words_left THEN CAST(cap AS DOUBLE) ELSE CAST(w * words_left AS DOUBLE) / CAST(parts_left AS DOUBLE) END AS target
  FROM weighed, (SELECT words_left, parts_left FROM level)
), placed AS (
  SELECT base.*, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs,
    coalesce(sum(size) OVER (PARTITION BY named ORDER BY draw, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size / 2 AS middle
  FROM base JOIN targets USING (named)
), lasts AS (
  SELECT named, max(draw) AS last FROM placed WHERE middle <= target - epochs * source_size GROUP BY named
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(size * (epochs + CASE WHEN draw <= coalesce(last, -1) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM placed LEFT JOIN lasts USING (named)
"""

_QUALITY = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text, coalesce('s' || source, 'n') AS host FROM documents
), split AS (
  SELECT row, doc_id, text, host, {_WORDS.format('text')} AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM docs
), windows AS (
  SELECT row, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS shingle
  FROM (SELECT row, words, unnest(range(1, len(words) - 1)) AS i FROM split)
), repeated AS (
  SELECT row, i FROM windows QUALIFY count(*) OVER (PARTITION BY row, shingle) > 1
), held AS (
  SELECT row, count(DISTINCT i + k) AS n_repeat_words FROM repeated, (SELECT unnest([0, 1, 2]) AS k) GROUP BY row
), lines AS (
  SELECT row, host, text, translate(array_to_string({_WORDS.format('x')}, ' '), '{_UPPER}', '{_LOWER}') AS line, len({_WORDS.format('x')}) AS n
  FROM (SELECT row, host, text, unnest(lines) AS x FROM split)
), frequent AS (
  SELECT host, line FROM lines GROUP BY host, line HAVING count(DISTINCT text) > {MAX_DOCUMENTS}
), removed AS (
  SELECT row, sum(n) AS n_removed_words FROM lines SEMI JOIN frequent USING (host, line) GROUP BY row
), counted AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(n_removed_words, 0) AS BIGINT) AS n_removed_words
  FROM split LEFT JOIN held USING (row) LEFT JOIN removed USING (row)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  n_removed_words, NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT (n_words - n_removed_words < {LEAST_LEFT} * n_words) AS kept
FROM counted
"""

ORACLES: dict[str, str] = {"op3_url_filter": _URLS, "op5_source_mix": _MIX, "op8_quality_rules": _QUALITY}
