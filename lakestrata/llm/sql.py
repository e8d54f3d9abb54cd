"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

from collections.abc import Sequence

from lakestrata.llm import chat, quality_rules, url_filters
from lakestrata.llm.url_filters import LOWER, UPPER, Rule


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _lower(value: str) -> str:
    return f"translate({value}, '{UPPER}', '{LOWER}')"


def _ruled(rules: Sequence[Rule], give: str) -> str:
    """The site or verdict of the fitting rule."""
    ranked = sorted(rules, key=lambda r: (-len(r.site), -len(r.site.partition("/")[0]), r.verdict != "block", r.site))
    cases = []
    for rule in ranked:
        site, slash, rest = rule.site.partition("/")
        fits = f"(host = {_quoted(site)} OR ends_with(host, {_quoted('.' + site)})) AND starts_with(path, {_quoted(slash + rest)})"
        cases.append(f"WHEN {fits} THEN {_quoted(getattr(rule, give))}")
    return f"CASE {' '.join(cases)} END"


def _node(url: str) -> str:
    rest = f"regexp_extract({url}, '(?s)://([^#]*)', 1)"
    host = _lower(f"regexp_extract({rest}, '^[^/?]*', 0)")
    tail = f"regexp_extract({rest}, '(?s)^[^/?]*(.*)$', 1)"
    tail = f"CASE WHEN {tail} = '' THEN '/' WHEN starts_with({tail}, '?') THEN '/' || {tail} ELSE {tail} END"
    return f"CASE WHEN {host} <> '' THEN {host} || {tail} END"


def url_filters_sql(rules: Sequence[Rule]) -> str:
    u = url_filters
    href = "||".join(f"regexp_extract(tag, {_quoted(u.HREF)}, {k})" for k in (1, 2, 3))
    target = f"""CASE WHEN regexp_matches(tag, {_quoted(u.CANONICAL)}) AND {href} <> '' THEN {href}
        WHEN regexp_matches(tag, {_quoted(u.REFRESH)}) AND regexp_matches(tag, {_quoted(u.TARGET)})
        THEN regexp_extract(tag, {_quoted(u.TARGET)}, 1) END"""
    folder = "regexp_extract(url, '^[^:/?#]*://[^/?#]*(?:/[^?#]*/|/)?', 0)"
    return f"""
WITH RECURSIVE tags AS (
  SELECT url, unnest(regexp_extract_all(html, {_quoted(u.TAG)})) AS tag FROM pages),
links AS (
  SELECT url, trim(replace({target}, '&amp;', '&')) AS href FROM tags WHERE {target} IS NOT NULL),
edges AS (
  SELECT {_node("url")} AS a, {_node("full_url")} AS b FROM (
    SELECT url, CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN href
      WHEN starts_with(href, '//') THEN regexp_extract(url, '^([^:/?#]*):', 1) || ':' || href
      WHEN starts_with(href, '/') THEN regexp_extract(url, '^[^:/?#]*://[^/?#]*', 0) || href
      WHEN starts_with(href, '?') THEN regexp_extract(url, '^[^?#]*', 0) || href
      WHEN href = '' OR starts_with(href, '#') THEN url
      ELSE {folder} || CASE WHEN ends_with({folder}, '/') THEN '' ELSE '/' END || href END AS full_url FROM links)),
both_ways AS (
  SELECT a, b FROM edges WHERE a <> b UNION SELECT b, a FROM edges WHERE a <> b),
reach AS (
  SELECT a AS node, a AS other FROM both_ways UNION SELECT r.node, e.b FROM reach r JOIN both_ways e ON e.a = r.other),
ruled AS (
  SELECT node, {_ruled(rules, "verdict")} AS verdict FROM (
    SELECT node, regexp_extract(other, '^[^/]*', 0) AS host, regexp_extract(other, '(?s)^[^/]*([^?]*)', 1) AS path FROM reach)),
passed AS (
  SELECT node, CASE WHEN bool_or(verdict = 'allow') THEN 'allow' WHEN bool_or(verdict = 'block') THEN 'block' END AS passed_on
  FROM ruled GROUP BY node),
judged AS (
  SELECT page_id, {_lower(f"regexp_extract(coalesce(url, ''), {_quoted(u.SITE)}, 1)")} AS host,
    regexp_extract(coalesce(url, ''), {_quoted(u.SITE)}, 2) AS path, {_node("url")} AS node FROM pages)
SELECT page_id, host, path, {_ruled(rules, "site")} AS rule,
  coalesce({_ruled(rules, "verdict")}, passed_on, 'allow') AS verdict, passed_on
FROM judged LEFT JOIN passed USING (node)"""


def chat_sql() -> str:
    plain = "replace(replace({}, '<|im_start|>', '<| im_start|>'), '<|im_end|>', '<| im_end|>')"
    name = f"coalesce(nullif(trim(regexp_replace({plain.format('role')}, '[\\r\\n]+', ' ', 'g')), ''), '{chat.NAMELESS}')"
    narrators = ", ".join(map(_quoted, chat.NARRATORS))
    return f"""
WITH given AS (SELECT conv_id, turn, {name} AS name, {plain.format("coalesce(text, '')")} AS text FROM conversations),
said AS (
  SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, name, text) - 1) // {chat.PART_TURNS} AS part FROM given),
speakers AS (SELECT DISTINCT conv_id, name AS speaker FROM said WHERE name NOT IN ({narrators})),
cut AS (
  SELECT s.*, speaker, '{chat.CLOSE}' AS close, '{chat.OPEN}' || CASE WHEN name = speaker THEN 'assistant'
    WHEN name IN ({narrators}) THEN name ELSE 'user name=' || name END || chr(10) AS head,
    row_number() OVER (PARTITION BY s.conv_id, part, speaker ORDER BY turn NULLS FIRST, name, text) AS place
  FROM said s JOIN speakers p ON s.conv_id IS NOT DISTINCT FROM p.conv_id),
placed AS (
  SELECT *, coalesce(sum(length(head || text || close) + 1) OVER (PARTITION BY conv_id, part, speaker ORDER BY place
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS own FROM cut)
SELECT conv_id, part, speaker, CAST(count(*) AS INTEGER) AS n_turns,
  string_agg(head || text || close, chr(10) ORDER BY place) || chr(10) AS rendered,
  coalesce(string_agg(CASE WHEN name = speaker THEN CAST(own AS BIGINT) || '-' || CAST(own + length(text || close) AS BIGINT) END, ' ' ORDER BY place), '') AS loss_spans,
  CAST(coalesce(sum(CASE WHEN name = speaker THEN length(text || close) END), 0) AS BIGINT) AS loss_chars
FROM placed GROUP BY conv_id, part, speaker"""


def quality_rules_sql(risk: float = quality_rules.RISK, confidence: float = quality_rules.CONFIDENCE) -> str:
    """Base counts, the exact binomial tests of every cutoff, and the verdicts."""
    grids = quality_rules.GRIDS
    share = risk / len(grids)
    tried = ", ".join(f"({_quoted(m)}, {step}, CAST({c} AS DOUBLE))" for m, grid in grids.items() for step, c in enumerate(grid))
    values = " UNION ALL ".join(f"SELECT rid, stratum, {_quoted(m)} AS metric, {m} AS value FROM shares" for m in grids)
    return rf"""
WITH texts AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text FROM documents),
cut AS (
  SELECT rid, doc_id, stratum, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM texts),
tokens AS (SELECT rid, unnest(words) AS a, generate_subscripts(words, 1) AS i FROM cut),
windows AS (
  SELECT rid, i, a, lead(a, 1) OVER w AS b, lead(a, 2) OVER w AS c FROM tokens WINDOW w AS (PARTITION BY rid ORDER BY i)),
counted AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM windows WHERE c IS NOT NULL),
covered AS (SELECT rid, count(DISTINCT i + k) AS n FROM counted, (VALUES (0), (1), (2)) v(k) WHERE n > 1 GROUP BY rid),
stuttered AS (SELECT rid, count(*) AS n_same FROM windows WHERE a = b GROUP BY rid),
base AS (
  SELECT c.*, len(words) AS n_words, array_to_string(words, '') AS joined, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words, coalesce(n_same, 0) AS n_same FROM cut c LEFT JOIN covered USING (rid) LEFT JOIN stuttered USING (rid)),
counts AS (
  SELECT *, length(joined) AS word_chars, length(regexp_replace(joined, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base),
shares AS (
  SELECT *, n_symbols / greatest(word_chars, 1) AS symbol_share, n_dup_lines / greatest(len(lines), 1) AS dup_line_share,
    n_repeat_words / greatest(n_words, 1) AS repeat_word_share,
    length(regexp_replace(joined, '[^\p{{Lu}}]+', '', 'g')) / greatest(word_chars, 1) AS capital_share,
    length(regexp_replace(joined, '[^!]+', '', 'g')) / greatest(word_chars, 1) AS bang_share,
    n_same / greatest(n_words, 1) AS same_word_share FROM counts),
measured AS ({values}),
good AS (
  SELECT m.* FROM measured m JOIN shares s USING (rid)
  WHERE NOT s.base_failed AND s.doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
tested AS (
  SELECT stratum, metric, step, cutoff, count(*) AS n, count(*) FILTER (value > cutoff) AS bad
  FROM good JOIN (VALUES {tried}) t(metric, step, cutoff) USING (metric) GROUP BY ALL),
proven AS (
  SELECT *, list_sum(list_transform(range(0, bad + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
    + i * ln({share}) + (n - i) * ln(1 - {share})))) <= {1 - confidence} / ((SELECT count(DISTINCT stratum) FROM good) * {len(grids)}) AS safe
  FROM tested),
cutoffs AS (
  SELECT p.stratum, p.metric, min(p.cutoff) AS cutoff FROM proven p WHERE p.step <
    coalesce((SELECT min(f.step) FROM proven f WHERE f.stratum = p.stratum AND f.metric = p.metric AND NOT f.safe), 1000000)
  GROUP BY p.stratum, p.metric),
beyond AS (SELECT DISTINCT rid FROM measured JOIN cutoffs USING (stratum, metric) WHERE value > cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND rid NOT IN (SELECT rid FROM beyond) AS kept, stratum FROM shares"""


#: usable vectors by row number, one row per component
_COMPONENTS = """given AS (
  SELECT row_number() OVER (ORDER BY vec_id, label) AS rid, vec_id, label, embedding FROM embeddings WHERE embedding IS NOT NULL),
parts AS (
  SELECT rid, vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS place FROM given),
usable AS (
  SELECT rid, count(*) AS width FROM parts GROUP BY rid HAVING bool_and(x IS NOT NULL AND NOT isnan(x) AND NOT isinf(x))),
v AS MATERIALIZED (
  SELECT rid, vec_id, label, width, place, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS x FROM parts JOIN usable USING (rid))"""


def top_k_sql() -> str:
    return f"""
WITH {_COMPONENTS},
scored AS (
  SELECT q.rid AS qid, q.vec_id AS query_id, d.rid, d.vec_id, CAST(sum(q.x * d.x) AS BIGINT) AS score
  FROM v q JOIN v d ON q.place = d.place AND q.rid <> d.rid WHERE q.vec_id % 50 = 0 GROUP BY ALL),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, vec_id, rid) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def negatives_sql() -> str:
    return f"""
WITH {_COMPONENTS},
w AS (
  SELECT rid, vec_id, place, x, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label FROM v WHERE label IS NOT NULL),
scored AS MATERIALIZED (
  SELECT a.rid AS aid, a.vec_id AS anchor_id, d.rid, d.vec_id, a.label = d.label AS alike, CAST(sum(a.x * d.x) AS BIGINT) AS score
  FROM w a JOIN w d ON a.place = d.place AND a.rid <> d.rid WHERE a.vec_id % 50 = 0 GROUP BY ALL),
positives AS (
  SELECT aid, anchor_id, rid AS pid, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY aid ORDER BY score DESC, vec_id, rid) <= 5),
ranked AS (
  SELECT p.anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.aid, pid ORDER BY s.score DESC, s.vec_id, s.rid) AS INTEGER) AS rank
  FROM positives p JOIN scored s ON p.aid = s.aid AND NOT s.alike
    AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3
"""


def clustering_sql(k: int = 40, rounds: int = 5, seed: int = 2, width: int = 64) -> str:
    def assigned(n: int) -> str:
        return f"""
a{n} AS MATERIALIZED (
  SELECT rid, vec_id, cluster, distance FROM (
    SELECT p.rid, p.vec_id, c.cluster, CAST(sum((p.x - c.x) * (p.x - c.x)) AS BIGINT) AS distance
    FROM points p JOIN c{n} c USING (place) GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY distance, cluster) = 1)"""

    def moved(n: int) -> str:
        return f"""
c{n + 1} AS MATERIALIZED (
  SELECT c.cluster, c.place, coalesce(m.x, c.x) AS x FROM c{n} c LEFT JOIN (
    SELECT cluster, place, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS x
    FROM points JOIN a{n} USING (rid) GROUP BY cluster, place) m USING (cluster, place))"""

    steps = ",".join(x for n in range(rounds) for x in (assigned(n), moved(n)))
    return f"""
WITH {_COMPONENTS},
points AS MATERIALIZED (SELECT * FROM v WHERE width = {width}),
firsts AS (
  SELECT rid, CAST(row_number() OVER (ORDER BY sha256('{seed}:' || CAST(vec_id AS VARCHAR)), rid) - 1 AS INTEGER) AS cluster
  FROM (SELECT DISTINCT rid, vec_id FROM points)),
c0 AS MATERIALIZED (SELECT cluster, place, x FROM points JOIN firsts USING (rid) WHERE cluster < {k}),{steps},{assigned(rounds)},
names AS (
  SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY place)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster)
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} JOIN names USING (cluster)
"""
