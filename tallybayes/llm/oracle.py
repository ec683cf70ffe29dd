"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from tallybayes.llm.license_scan import TEMPLATES

_MIX = r"""
WITH docs AS (
  SELECT d.doc_id, d.source, coalesce(len(regexp_extract_all(d.text, '[^\x20\x09-\x0D]+')), 0) AS size,
         CASE WHEN l.q IS NULL THEN 1.0::DOUBLE WHEN l.q >= 1 THEN 2.0::DOUBLE ELSE 0.5::DOUBLE END AS weight
  FROM documents d LEFT JOIN (
    SELECT doc_id, min(quality) AS q FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id
  ) l ON d.doc_id = l.doc_id
), keyed AS (
  SELECT *, -ln((('0x' || substr(md5('13:' || coalesce(doc_id::VARCHAR, 'null')), 1, 12))::BIGINT::DOUBLE + 0.5)
              / 281474976710656.0::DOUBLE) / weight AS key
  FROM docs
), per AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source
), weighed AS (
  SELECT *, ([3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM per
), limits AS (
  SELECT *, source_size::DOUBLE * 2.0::DOUBLE AS most, source_size::DOUBLE * 2.0::DOUBLE / w AS ratio FROM weighed
), levels AS (
  SELECT *, (sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE
     - coalesce(sum(most) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0::DOUBLE))
     / sum(w) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM limits
), goals AS (
  SELECT source, source_size,
    CASE WHEN level < ratio THEN w * max(CASE WHEN level < ratio THEN level END) OVER () ELSE most END AS target
  FROM levels
), budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM goals
), runs AS (
  SELECT k.*, b.source_size, b.target, b.epochs, b.target - b.epochs * b.source_size AS budget,
    sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id NULLS LAST, k.size ROWS UNBOUNDED PRECEDING) AS run
  FROM keyed k JOIN budgets b ON k.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  (size * (epochs + CASE WHEN budget > 0 AND run - size / 2.0::DOUBLE <= budget THEN 1 ELSE 0 END))::BIGINT AS taken
FROM runs
"""

_URL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, coalesce(rest, '') AS rest FROM cut)
), rules(h, p, v) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
)
SELECT page_id, host, path,
  (SELECT h || p FROM rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
   ORDER BY length(h || p) DESC LIMIT 1) AS rule,
  coalesce((SELECT v FROM rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
   ORDER BY length(h || p) DESC LIMIT 1), 'allow') AS verdict
FROM parts
"""



def _license_sql() -> str:
    rows = ", ".join(f"({i}, '{n}', '{t.replace(chr(39), chr(39) * 2)}')" for i, (n, t) in enumerate(TEMPLATES))
    marks = r"[\x00-/:-`{-\x7f]"
    upper = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

    def words(text: str) -> str:
        return f"string_split(trim(regexp_replace(translate({text}, {upper}), '{marks}+', ' ', 'g')), ' ')"

    def pairs(w: str) -> str:
        return f"list_transform(range(1, len({w})), lambda i: {w}[i] || ' ' || {w}[i + 1])"

    return f"""
WITH templates(t, name, body) AS (VALUES {rows}),
tw AS (SELECT t, name, {words('body')} AS w FROM templates),
tb AS (SELECT t, name, len(w) - 1 AS size, unnest({pairs('w')}) AS b FROM tw),
tc AS (SELECT t, name, size, b, count(*) AS n FROM tb GROUP BY ALL),
units AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS u FROM documents
  UNION ALL SELECT doc_id, unnest(regexp_split_to_array(text, '\\x0A{marks}*\\x0A')) FROM documents
  UNION ALL SELECT doc_id, text FROM documents
),
uw AS (SELECT row_number() OVER () AS k, doc_id, {words('u')} AS w FROM units),
small AS (SELECT * FROM uw WHERE len(w) - 1 BETWEEN 1 AND (SELECT max(size) * 1.5 + 1 FROM tb)),
ub AS (SELECT k, doc_id, len(w) - 1 AS size, unnest({pairs('w')}) AS b FROM small),
uc AS (SELECT k, doc_id, size, b, count(*) AS n FROM ub GROUP BY ALL),
dice AS (
  SELECT u.k, u.doc_id, c.t, c.name, 2.0::DOUBLE * sum(least(u.n, c.n)) / (any_value(u.size) + any_value(c.size)) AS d
  FROM uc u JOIN tc c ON u.b = c.b GROUP BY u.k, u.doc_id, c.t, c.name
),
hits AS (
  SELECT doc_id, string_agg(DISTINCT name, ',' ORDER BY name) AS licenses, max(d) AS best FROM dice WHERE d >= 0.8 GROUP BY doc_id
)
SELECT d.doc_id, h.licenses, round(h.best, 9) AS best_dice FROM documents d LEFT JOIN hits h USING (doc_id)
"""


# every window as a digest of its words, and the smallest document that has it
_REPEATS = r"""
WITH w AS (
  SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i, len(ws) AS n
  FROM (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM documents WHERE text IS NOT NULL) t
),
h AS (
  SELECT *, CASE WHEN i + 49 <= n THEN
    md5(string_agg(w, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)) END AS k FROM w
),
f AS (SELECT k, min(doc_id) AS low FROM h WHERE k IS NOT NULL GROUP BY k),
m AS (
  SELECT h.doc_id, h.i, h.w, max(CASE WHEN f.low < h.doc_id THEN 1 ELSE 0 END)
    OVER (PARTITION BY h.doc_id ORDER BY h.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
  FROM h LEFT JOIN f ON h.k = f.k
),
r AS (
  SELECT doc_id, count(*) AS n_words, CAST(sum(gone) AS BIGINT) AS n_removed, string_agg(w, ' ' ORDER BY i) FILTER (gone = 0) AS kept
  FROM m GROUP BY doc_id
)
SELECT d.doc_id, coalesce(r.n_words, 0) AS n_words, coalesce(r.n_removed, 0) AS n_removed, sha256(coalesce(r.kept, '')) AS kept_sha256
FROM documents d LEFT JOIN r USING (doc_id)
"""

_TOP = """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_sum([p[1] * p[2] FOR p IN list_zip(a.q, b.q)]) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0
)
SELECT query_id, CAST(rn AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rn FROM s) x WHERE rn <= 5
"""


ORACLE_SQL = {
    "op1_substring_dedup": _REPEATS, "op2_source_mix": _MIX, "op3_url_filter": _URL, "op7_exact_knn": _TOP, "op8_license_scan": _license_sql(),
}
