"""SQL that states the same rows as the queries that SQL can express."""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3 = rf"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
    SELECT DISTINCT doc_id, array_to_string(words[i : i + 4], ' ') AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM w WHERE len(words) > 0)
), n AS (
    SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM s AS a JOIN s AS b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
    SELECT u, v FROM shared JOIN n AS a ON a.doc_id = u JOIN n AS b ON b.doc_id = v WHERE 100 * k >= 80 * (a.n + b.n - k)
), reach AS (
    SELECT doc_id, doc_id AS root FROM documents UNION SELECT v, root FROM reach JOIN links ON u = reach.doc_id
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, (SELECT min(root) FROM reach WHERE reach.doc_id = d.doc_id)::BIGINT AS component_id
FROM documents AS d LEFT JOIN n ON n.doc_id = d.doc_id
"""

OP7 = rf"""
WITH d AS (
    SELECT doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
    SELECT item_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + 9], ' ') AS words
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), found AS (
    SELECT doc_id, i, n, item_id
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM windows)) AS p
    JOIN windows USING (n) WHERE array_to_string(p.w[p.i : p.i + n - 1], ' ') = windows.words
), hit AS (
    SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM found) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP10 = """
WITH t AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), windows AS (
    SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS w FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS i FROM t)
), later AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS k FROM windows) WHERE k > 1
), runs AS (
    SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM (
        SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run
        FROM (SELECT doc_id, i, (i - lag(i, 1, -1000) OVER (PARTITION BY doc_id ORDER BY i) > 100)::INT AS fresh FROM later)
    ) GROUP BY doc_id, run
), gaps AS (
    SELECT doc_id, a, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS s, a AS e FROM runs
    UNION ALL SELECT doc_id, NULL, max(b), NULL FROM runs GROUP BY doc_id
), kept AS (
    SELECT doc_id, string_agg(substr(h, 2 * s + 1, 2 * (coalesce(e, len(h) // 2) - s)), '' ORDER BY s) AS h FROM gaps JOIN t USING (doc_id) GROUP BY doc_id
), sums AS (
    SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id
)
SELECT t.doc_id, (len(t.h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept.h, t.h))) AS kept_sha256
FROM t LEFT JOIN kept USING (doc_id) LEFT JOIN sums USING (doc_id)
"""

OP12 = """
WITH t AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos,
           coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
), bits AS (
    SELECT conv_id, conv_id - conv_id % 5 AS base, xor(list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
        lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))
    ), 4294967295) % 9 AS h
    FROM (SELECT DISTINCT conv_id FROM t)
), heads AS (
    SELECT b.conv_id, b.h, b.base, least(h, (SELECT count(*) FROM t WHERE t.conv_id = b.base)) AS taken FROM bits AS b
), turns AS (
    SELECT conv_id AS c, taken + pos - h + 1 AS depth, role, text FROM t JOIN heads USING (conv_id) WHERE pos >= h
    UNION ALL
    SELECT heads.conv_id, pos + 1, role, text FROM heads JOIN t ON t.conv_id = heads.base WHERE pos < h
), paths AS (
    SELECT c, depth, strlen(text) AS bytes, string_agg(md5(length(role) || ':' || role || text), '') OVER (PARTITION BY c ORDER BY depth) AS path FROM turns
    UNION ALL SELECT conv_id, 0, 0, '' FROM heads
), nodes AS (
    SELECT path, min(depth) AS depth, min(c) AS conv_id, count(*) AS n_convs, min(bytes) AS bytes FROM paths GROUP BY path
), last AS (
    SELECT path, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids FROM (SELECT c, max(path) AS path FROM paths GROUP BY c) GROUP BY path
), full_ AS (
    SELECT n.*, (SELECT count(*) FROM nodes AS m WHERE m.depth = n.depth + 1 AND starts_with(m.path, n.path)) AS n_children FROM nodes AS n
), sums AS (
    SELECT v.path, sum((u.n_children = 0)::INT) AS n_leaves, sum((u.n_convs - 1) * u.bytes) AS saved
    FROM full_ AS v JOIN full_ AS u ON starts_with(u.path, v.path) GROUP BY v.path
)
SELECT n.conv_id::BIGINT AS conv_id, n.depth::BIGINT AS depth, p.conv_id::BIGINT AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
       n.n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM full_ AS n JOIN sums USING (path) LEFT JOIN last USING (path)
LEFT JOIN nodes AS p ON p.path = left(n.path, length(n.path) - 32) AND n.depth > 0
"""


def _lloyd(rounds: int, clusters: int, dims: int, scale: int) -> str:
    """Rounds written out one after the other; a centroid is a row per component."""
    floor = "((s - ((s % n) + n) % n) // n)"
    parts = [
        f"""
v AS MATERIALIZED (
    SELECT vec_id, row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST) AS r, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS q
    FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}
), x AS MATERIALIZED (
    SELECT r, i, q[i]::BIGINT AS x FROM (SELECT r, q, unnest(range(1, {dims + 1})) AS i FROM v)
), c0 AS MATERIALIZED (
    SELECT (r - 1)::INT AS k, i, x AS c FROM x WHERE r <= {clusters}
)"""
    ]
    for n in range(rounds + 1):
        parts.append(f"""d{n} AS MATERIALIZED (
    SELECT r, k, d FROM (SELECT r, k, sum((x - c) * (x - c))::BIGINT AS d FROM x JOIN c{n} USING (i) GROUP BY r, k)
    QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, k) = 1
)""")
        if n < rounds:
            parts.append(f"""c{n + 1} AS MATERIALIZED (
    SELECT k, i, coalesce({floor}, c)::BIGINT AS c FROM c{n} LEFT JOIN (SELECT k, i, sum(x)::HUGEINT AS s, count(*) AS n FROM d{n} JOIN x USING (r) GROUP BY k, i) USING (k, i)
)""")
    return "WITH " + ", ".join(parts) + f"""
SELECT vec_id, k AS cluster, d AS distance, (sum(d) OVER (PARTITION BY k))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
       sha256((SELECT string_agg(c::VARCHAR, ',' ORDER BY i) FROM c{rounds} AS f WHERE f.k = d.k)) AS centroid_sha256
FROM d{rounds} AS d JOIN v USING (r)
"""


OP13 = _lloyd(rounds=3, clusters=16, dims=64, scale=64)
