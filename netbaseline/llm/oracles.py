"""DuckDB SQL of the queries that SQL can express over whole tables."""

from __future__ import annotations

from . import decontamination, mixing, multi_index, url_reputation, vector_codes
from .common import WORD

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_COMPONENTS = """
reach(a, b) AS (
  SELECT id, id FROM nodes
  UNION
  SELECT r.a, e.b FROM reach r JOIN links e ON r.b = e.a),
parts AS (SELECT a AS id, min(b) AS component_id FROM reach GROUP BY a)"""

OP2 = f"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 3
    THEN list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)])
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
  FROM worded),
nodes AS (SELECT doc_id AS id, len(s) AS n FROM sets),
items AS (SELECT doc_id AS id, unnest(s) AS t FROM sets),
pairs AS (SELECT x.id AS a, y.id AS b, count(*) AS c FROM items x JOIN items y ON x.t = y.t AND x.id <> y.id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM pairs JOIN nodes x ON x.id = a JOIN nodes y ON y.id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
{_COMPONENTS.strip()}
SELECT id AS doc_id, CAST(n AS BIGINT) AS n_shingles, component_id FROM nodes JOIN parts USING (id)"""

OP6 = f"""
WITH RECURSIVE fine AS (
  SELECT vec_id AS id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
nodes AS (SELECT vec_id AS id FROM embeddings),
links AS (
  SELECT x.id AS a, y.id AS b FROM fine x JOIN fine y ON x.label = y.label AND x.id <> y.id AND len(x.v) = len(y.v)
  WHERE list_cosine_similarity(x.v, y.v) >= {multi_index.SIMILARITY}),
{_COMPONENTS.strip()},
degrees AS (SELECT a AS id, count(*) AS n FROM links GROUP BY a)
SELECT id AS vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, id = component_id AS kept
FROM nodes JOIN parts USING (id) LEFT JOIN degrees USING (id)"""


def _rules_sql() -> str:
    """CASE over the rules, longest first, with ``{rule}`` or ``{verdict}`` as the result."""
    out = []
    for rule, verdict in sorted(url_reputation.RULES, key=lambda r: (-len(r[0]), r[0])):
        host, _, path = rule.partition("/")
        out.append((f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}')", rule, verdict))
    return out


def _level(up: str, level: str, above: str, keys: str, up_keys: str) -> str:
    """CTEs of one level: groups, their parents, the strength by moments (``above`` without replication), priors."""
    lo, hi = url_reputation.STRENGTH_MIN, url_reputation.STRENGTH_MAX
    return f"""
group_{level} AS (SELECT {keys}, sum(bad) AS b, sum(n) AS n FROM hosts GROUP BY {keys}),
family_{level} AS (
  SELECT *, sum(b) OVER f AS fb, sum(n) OVER f AS fn, sum(n * n) OVER f AS fnn, count(*) OVER f AS fk
  FROM group_{level} WINDOW f AS (PARTITION BY {up_keys})),
moments_{level} AS (
  SELECT count(*) - sum(1.0 / fk) AS freedom, sum(n) - count(*) AS inner_freedom,
         sum(n * (b / n - fb / fn) * (b / n - fb / fn)) AS apart, sum(b * (1 - b / n)) AS inside,
         sum(n) - sum(fnn / fn / fk) AS reach
  FROM family_{level}),
rho_{level} AS (
  SELECT freedom > 0.5 AND inner_freedom > 0 AS told, apart / freedom AS x, inside / inner_freedom AS y, reach / freedom - 1 AS r
  FROM moments_{level}),
strength_{level} AS (
  SELECT CASE WHEN NOT coalesce(told, false) THEN {above}
    WHEN x + r * y > 0 AND x > y THEN least({hi}, greatest({lo}, (x + r * y) / (x - y) - 1)) ELSE {hi} END AS m FROM rho_{level}),
prior_{level} AS (
  SELECT {keys}, g.b, g.n, (u.b - g.b + u.w * u.p) / (u.n - g.n + u.w) AS p, 1 / (1 / m + 1 / (u.n - g.n + u.w)) AS w
  FROM group_{level} g JOIN prior_{up} u USING ({up_keys}), strength_{level}),"""


def _op9() -> str:
    rules = _rules_sql()
    rule = "CASE " + " ".join(f"WHEN {c} THEN '{r}'" for c, r, _ in rules) + " END"
    verdict = "CASE " + " ".join(f"WHEN rule = '{r}' THEN '{v}'" for _, r, v in rules)
    return rf"""
WITH rows AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
marks AS (
  SELECT doc_id, max(CAST(coalesce(quality, 1) = 0 OR coalesce(toxic, 0) = 1 AS INTEGER)) AS bad
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
hosts AS (
  SELECT host, 1 AS everything, array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS domain,
         string_split(host, '.')[-1] AS suffix, CAST(sum(bad) AS DOUBLE) AS bad, CAST(count(*) AS DOUBLE) AS n
  FROM rows JOIN marks ON doc_id = TRY_CAST(nullif(regexp_extract(path, '/([0-9]{{1,18}})(?:\.[a-z]+)?/?$', 1), '') AS BIGINT)
  WHERE host <> '' GROUP BY host),
prior_all AS (SELECT everything, sum(bad) AS b, sum(n) AS n, 0.5 AS p, 1.0 AS w FROM hosts GROUP BY everything),
{_level("all", "suffix", str(url_reputation.STRENGTH_MIN), "everything, suffix", "everything")}
{_level("suffix", "domain", "(SELECT m FROM strength_suffix)", "everything, suffix, domain", "everything, suffix")}
{_level("domain", "host", "(SELECT m FROM strength_domain)", "everything, suffix, domain, host", "everything, suffix, domain")}
post AS (SELECT host, (b + w * p) / (n + w) AS q, n + w AS k FROM prior_host),
judged AS (SELECT host, q - {url_reputation.Z} * sqrt(q * (1 - q) / (k + 1)) > {url_reputation.MAX_BAD_RATE} AS blocked FROM post),
ruled AS (SELECT *, {rule} AS rule FROM rows)
SELECT page_id, host, path, rule,
       {verdict} WHEN coalesce(blocked, false) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled LEFT JOIN judged USING (host)"""


OP9 = _op9()

OP10 = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS total FROM sized GROUP BY source),
placed AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM totals),
weighed AS (SELECT *, {list(mixing.WEIGHTS)}[place % {len(mixing.WEIGHTS)} + 1] AS w FROM placed),
filled AS (
  SELECT *, row_number() OVER o AS k,
         (SELECT sum(total) FROM totals) - coalesce(sum({mixing.CAP} * total) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over,
         sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_left
  FROM weighed WINDOW o AS (ORDER BY {mixing.CAP} * total / w, place)),
share AS (
  SELECT arg_min(CAST(left_over AS DOUBLE) / CAST(w_left AS DOUBLE), k) AS x FROM filled
  WHERE w * (CAST(left_over AS DOUBLE) / CAST(w_left AS DOUBLE)) <= {mixing.CAP} * total),
targets AS (
  SELECT source, total, least(w * x, CAST({mixing.CAP} * total AS DOUBLE)) AS target,
         CAST('0x' || substr(md5('{mixing.SEED}|' || coalesce('s' || source, '')), 1, 5) AS INTEGER) / 1048576.0 AS offset_
  FROM weighed, share),
ranked AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, doc_id NULLS FIRST) AS r FROM sized),
rated AS (
  SELECT doc_id, size, total, target, r, CAST(offset_ AS DOUBLE) AS u, CASE WHEN total > 0 THEN target / total ELSE 0.0 END AS rate
  FROM ranked JOIN targets ON ranked.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, total AS source_size, target,
       CAST((floor(u + rate * r) - floor(u + rate * (r - 1))) * size AS BIGINT) AS taken
FROM rated"""


def _op11() -> str:
    parts, entries, scale = vector_codes.PARTS, vector_codes.ENTRIES, vector_codes.SCALE

    def assigned(name: str, book: str) -> str:
        return f"""
{name} AS MATERIALIZED (
  SELECT r, p, arg_min(e, (d, e)) AS e, min(d) AS d FROM (
    SELECT r, p, e, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM cut JOIN {book} USING (p)) GROUP BY r, p),"""

    rounds = ""
    for k in range(vector_codes.ROUNDS):
        rounds += assigned(f"a{k}", f"b{k}") + f"""
m{k} AS (
  SELECT p, e, i, CAST(floor(CAST(sum(x[i]) AS DOUBLE) / count(*)) AS BIGINT) AS c
  FROM a{k} JOIN cut USING (r, p), (SELECT unnest(range(1, 1 + (SELECT max(len(x)) FROM cut))) AS i) WHERE i <= len(x) GROUP BY p, e, i),
b{k + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(n.c, b{k}.c) AS c
  FROM b{k} LEFT JOIN (SELECT p, e, list(c ORDER BY i) AS c FROM m{k} GROUP BY p, e) n USING (p, e)),"""
    last = vector_codes.ROUNDS
    return f"""
WITH fine AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cut AS MATERIALIZED (
  SELECT r, p, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] AS x
  FROM fine, (SELECT unnest(range({parts})) AS p)),
b0 AS MATERIALIZED (SELECT p, r - 1 AS e, x AS c FROM cut WHERE r <= {entries}),{rounds}{assigned("last_", f"b{last}")}
coded AS (
  SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM last_ GROUP BY r),
per AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM fine JOIN coded USING (r) GROUP BY label),
book AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS h FROM b{last})
SELECT vec_id, code, error, label_error, h AS codebooks_sha256
FROM fine JOIN coded USING (r) JOIN per ON per.label IS NOT DISTINCT FROM fine.label, book"""


OP11 = _op11()

OP13 = rf"""
WITH w AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
cuts AS (SELECT item, w, least(len(w), {decontamination.WINDOW}) AS k FROM t WHERE len(w) > 0),
wanted AS MATERIALIZED (
  SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT item, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM cuts)),
runs AS (
  SELECT r, i, k, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT DISTINCT k FROM wanted) WHERE len(w) >= k)),
met AS MATERIALIZED (SELECT r, i, k, item FROM runs JOIN wanted USING (k, s)),
words AS (
  SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS j FROM (SELECT DISTINCT r, i, k FROM met)) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM met) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN words USING (r) LEFT JOIN items USING (r)"""

ORACLE_SQL = {
    "op2_jaccard_join": OP2,
    "op6_embedding_dedup": OP6,
    "op9_url_reputation": OP9,
    "op10_mixing": OP10,
    "op11_vector_codes": OP11,
    "op13_decontamination": OP13,
}
