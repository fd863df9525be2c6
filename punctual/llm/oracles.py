"""SQL twins of the queries that SQL can express."""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWERED = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"

MINHASH = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_LOWERED} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * k >= 75 * (nx.n + ny.n - k)),
r(node, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.node, e.y FROM r JOIN e ON e.x = r.root),
c AS (SELECT node, min(root) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN c ON c.node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

SUBSTRING = f"""
WITH w AS (SELECT doc_id, {_WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM w)),
f AS (SELECT h, min(doc_id) AS m FROM win GROUP BY h),
bad AS (SELECT win.doc_id, i FROM win JOIN f USING (h) WHERE m < doc_id),
gone AS (SELECT DISTINCT doc_id, i + o AS j FROM bad CROSS JOIN range(50) t(o)),
pos AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS j FROM w),
kept AS (SELECT p.doc_id, string_agg(word, ' ' ORDER BY j) AS t, count(*) AS n FROM pos p ANTI JOIN gone g ON g.doc_id = p.doc_id AND g.j = p.j GROUP BY p.doc_id)
SELECT w.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id
"""

MIXING = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source
), weighed AS (
  SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1]::DOUBLE AS w, source_size * 2.0::DOUBLE AS cap FROM sources
), leveled AS (
  SELECT *, ((SELECT sum(source_size) FROM sources) * 1.5::DOUBLE
    - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed
), targets AS (
  SELECT source, source_size, CASE WHEN cap <= level * w THEN cap
    ELSE least(cap, (SELECT arg_min(level, cap / w) FROM leveled WHERE cap > level * w) * w) END AS target FROM leveled
), rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
    ('0x' || substr(md5('mix' || coalesce(source, chr(0))), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS off FROM targets
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY floor(sqrt(size)), md5(coalesce(doc_id::VARCHAR, '?' || size)), doc_id::VARCHAR NULLS LAST) AS rk FROM docs
)
SELECT d.doc_id, d.size, r.source_size, r.target,
  ((floor(rate * rk + off) - floor(rate * (rk - 1) + off)) * d.size)::BIGINT AS taken
FROM ranked d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source
"""
