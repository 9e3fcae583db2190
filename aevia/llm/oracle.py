"""DuckDB SQL for the queries of this subpackage that SQL can express."""

ORACLE = {}

ORACLE["op9_url_filters"] = r"""
WITH u AS (
  SELECT page_id, html,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
p AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         regexp_replace(coalesce(html, ''), '<[^>]*>', '', 'g') AS seen
  FROM u),
o AS (
  SELECT *, CASE WHEN length(seen) - length(regexp_replace(seen, '[#*$%|!]', '', 'g')) > 0.03::DOUBLE * length(seen)
                 THEN 1 ELSE 0 END AS bad FROM p),
h AS (SELECT host, regexp_extract(host, '[^.]*\.?[^.]*$') AS domain, count(*) AS n, sum(bad) AS k FROM o GROUP BY ALL),
d AS (SELECT domain, regexp_extract(domain, '[^.]*$') AS suffix, sum(n) AS n, sum(k) AS k FROM h GROUP BY ALL),
s AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM d GROUP BY ALL),
stats AS (
  SELECT lvl, count(*) AS g, sum(n)::DOUBLE AS n, sum(k)::DOUBLE AS k, sum(k::DOUBLE * k / n) AS q
  FROM (SELECT 0 AS lvl, n, k FROM s UNION ALL SELECT 1, n, k FROM d UNION ALL SELECT 2, n, k FROM h) GROUP BY lvl),
moments AS (SELECT *, (k + 1.0) / (n + 2.0) AS m FROM stats),
spread AS (SELECT *, (q - 2 * m * k + m * m * n) / n - m * (1 - m) * g / n AS between_ FROM moments),
conc AS (
  SELECT lvl, m, least(greatest(CASE WHEN between_ > 0 THEN m * (1 - m) / between_ - 1 ELSE 1000.0 END, 2.0), 1000.0) AS s
  FROM spread),
s1 AS (SELECT suffix, (k + c.s * c.m) / (n + c.s) AS prior FROM s, conc c WHERE c.lvl = 0),
d1 AS (SELECT domain, (k + c.s * s1.prior) / (n + c.s) AS prior FROM d JOIN s1 USING (suffix), conc c WHERE c.lvl = 1),
h1 AS (SELECT host, n + c.s + 1 AS total, (k + c.s * d1.prior) / (n + c.s) AS rate
       FROM h JOIN d1 USING (domain), conc c WHERE c.lvl = 2),
rules AS (SELECT * FROM (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                                ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')) r(rhost, rpath, verdict)),
hit AS (
  SELECT page_id, host, path, max_by(rhost || rpath, length(rhost || rpath)) AS rule,
         max_by(verdict, length(rhost || rpath)) AS verdict
  FROM o JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY ALL)
SELECT o.page_id, o.host, o.path, hit.rule,
       coalesce(hit.verdict, CASE WHEN rate - 1.645 * sqrt(rate * (1 - rate) / total) > 0.25 THEN 'block' ELSE 'allow' END) AS verdict
FROM o JOIN h1 USING (host) LEFT JOIN hit ON hit.page_id = o.page_id
"""

ORACLE["op10_exact_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = len(embedding)),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.x) = len(c.x))
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""

ORACLE["op11_warc"] = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
d AS (
  SELECT page_id, payload_bytes,
         translate(array_to_string(list_transform(range(0, 8), lambda i: to_base(CAST('0x' || substr(h, CAST(5 * i + 1 AS INTEGER), 5) AS BIGINT), 32, 4)), ''),
                   '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest
  FROM p),
r AS (
  SELECT *, row_number() OVER w AS place, first_value(page_id) OVER w AS original
  FROM d WINDOW w AS (PARTITION BY payload_digest ORDER BY page_id NULLS LAST))
SELECT page_id, payload_bytes, payload_digest, CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN place > 1 THEN original END AS refers_to
FROM r
"""
