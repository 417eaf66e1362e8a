"""SQL for the registered queries that SQL can express."""

from __future__ import annotations

_OP2_SQL = """
WITH normal AS (
    SELECT doc_id,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz') AS body
    FROM documents
), grouped AS (
    SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM normal GROUP BY body
)
SELECT n.doc_id, g.keep_id, g.group_size,
       n.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(n.body) AS text_sha256
FROM normal n JOIN grouped g USING (body)
"""

_DIGEST = " || ".join(
    f"to_base(('0x' || substr(sha1(body), {start}, 5))::BIGINT, 32, 4)" for start in range(1, 41, 5)
)
_OP4_SQL = f"""
WITH pages_in AS (
    SELECT page_id, coalesce(html, '') AS body FROM pages
), payloads AS (
    SELECT page_id, octet_length(encode(body)) AS payload_bytes,
           translate({_DIGEST}, '0123456789ABCDEFGHIJKLMNOPQRSTUV',
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest
    FROM pages_in
), firsts AS (
    SELECT payload_digest, min(page_id) AS first_id FROM payloads GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM payloads JOIN firsts USING (payload_digest)
"""

_OP5_SQL = r"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) AS s FROM worded
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both_have
    FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM pairs JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
    WHERE 100 * both_have >= 80 * (p.n + q.n - both_have)
), reach(a, b) AS (
    SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), components AS (
    SELECT a AS doc_id, min(b) AS smallest FROM reach GROUP BY a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(smallest, doc_id)) AS component_id
FROM worded LEFT JOIN sizes USING (doc_id) LEFT JOIN components USING (doc_id)
"""

_OP7_SQL = r"""
WITH RECURSIVE vectors AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
), able AS (
    SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS size FROM vectors
    WHERE v IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), solid AS (
    SELECT * FROM able WHERE size > 0
), links AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM solid x JOIN solid y ON len(x.v) = len(y.v) AND x.vec_id <> y.vec_id
    WHERE list_dot_product(x.v, y.v) >= 0.95 * x.size * y.size
), reach(a, b) AS (
    SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), components AS (
    SELECT a AS vec_id, min(b) AS smallest FROM reach GROUP BY a
), numbers AS (
    SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(smallest, vec_id)) AS component_id,
       vec_id <= coalesce(smallest, vec_id) AS kept
FROM vectors LEFT JOIN numbers USING (vec_id) LEFT JOIN components USING (vec_id)
"""

_OP11_SQL = r"""
WITH table_of AS (
    SELECT list(list_reduce(list_prepend(i, [0, 1, 2, 3, 4, 5, 6, 7]),
        lambda d, k: CASE WHEN d & 1 = 1 THEN xor(d >> 1, 3988292384) ELSE d >> 1 END) ORDER BY i) AS t
    FROM range(256) AS x(i)
), texts AS (
    SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text, TRUE AS own FROM documents
    UNION ALL SELECT -row_number() OVER (), NULL, coalesce(text, ''), FALSE FROM benchmark
), worded AS (
    SELECT k, doc_id, own, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts
), features AS (
    SELECT k, own, unnest(w) AS f FROM worded
    UNION ALL
    SELECT k, own, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM worded WHERE len(w) > 1
), distinct_of AS (
    SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM features)
), hashed AS (
    SELECT f, xor(list_reduce(
        list_prepend(4294967295, list_transform(range(0, len(h) // 2), lambda i: CAST('0x' || substr(h, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
    FROM distinct_of, table_of
), placed AS (
    SELECT k, own, bucket FROM features JOIN hashed USING (f)
), counts AS (
    SELECT b AS bucket, count(*) FILTER (WHERE own) AS s, count(*) FILTER (WHERE NOT own) AS t
    FROM range(10000) AS x(b) LEFT JOIN placed ON bucket = b GROUP BY b
), sums AS (
    SELECT sum(s)::DOUBLE AS all_s, sum(t)::DOUBLE AS all_t FROM counts
), gains AS (
    SELECT bucket, CAST(floor(1000 * ln((t + 1)::DOUBLE * (all_s + 10000) / ((s + 1)::DOUBLE * (all_t + 10000)))) AS BIGINT) AS gain
    FROM counts, sums
), weighed AS (
    SELECT k, count(*) AS n, CAST(floor(sum(gain)::DOUBLE / count(*)) AS BIGINT) AS weight
    FROM placed JOIN gains USING (bucket) WHERE own GROUP BY k
), scored AS (
    SELECT k, doc_id, len(w) AS words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
    FROM worded LEFT JOIN weighed USING (k) WHERE own
), ordered AS (
    SELECT k, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS place,
           count(*) OVER () * 25 // 100 AS drawn
    FROM scored WHERE words >= 20
)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score, CASE WHEN place <= drawn THEN place END AS rank
FROM scored LEFT JOIN ordered USING (k)
"""

_OP13_SQL = r"""
WITH RECURSIVE bytes AS (
    SELECT doc_id, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT)) AS b
    FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
), crc AS (
    SELECT doc_id, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: list_reduce(
        list_prepend(xor(c, x), [0, 1, 2, 3, 4, 5, 6, 7]),
        lambda d, i: CASE WHEN d & 1 = 1 THEN xor(d >> 1, 3988292384) ELSE d >> 1 END)), 4294967295) AS crc
    FROM bytes
), parts AS (
    SELECT doc_id, lang,
           coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
           || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
           coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS n,
           coalesce(strlen(CAST(CAST(n_chars AS HUGEINT) + 1 AS VARCHAR)) || ':' || (CAST(n_chars AS HUGEINT) + 1), '-') AS more,
           coalesce(strlen(text) || ':' || text, '-') AS body
    FROM documents
), leaves AS (
    SELECT doc_id, lang, sha256(head || n || body) AS leaf, sha256(head || more || body) AS altered FROM parts
), ranked AS (
    SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
           row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r,
           count(*) OVER (PARTITION BY lang) AS n
    FROM leaves
), nodes(tree, level, idx, digest, n) AS (
    SELECT tree, 0, r, leaf, n FROM ranked
    UNION ALL
    SELECT tree, level + 1, idx // 2, sha256(string_agg(digest, '' ORDER BY idx)), (n + 1) // 2
    FROM nodes WHERE n > 1 GROUP BY tree, level, idx // 2, n
), subroots AS (
    SELECT tree, level AS height, digest, (SELECT count(DISTINCT tree) FROM ranked) AS trees FROM nodes WHERE n = 1
), tops(level, idx, digest, n) AS (
    SELECT 0, tree, digest, trees FROM subroots
    UNION ALL
    SELECT level + 1, idx // 2, sha256(string_agg(digest, '' ORDER BY idx)), (n + 1) // 2
    FROM tops WHERE n > 1 GROUP BY level, idx // 2, n
), root AS (
    SELECT level AS height, digest FROM tops WHERE n = 1
), steps AS (
    SELECT d.tree, d.r, l.level, s.digest AS sibling, (d.r >> l.level) & 1 = 1 AS at_left
    FROM ranked d JOIN subroots t USING (tree) JOIN (SELECT unnest(range(64)) AS level) l ON l.level < t.height
    LEFT JOIN nodes s ON s.tree = d.tree AND s.level = l.level AND s.idx = xor(d.r >> l.level, 1)
), top_steps AS (
    SELECT t.tree, l.level, s.digest AS sibling, (t.tree >> l.level) & 1 = 1 AS at_left
    FROM subroots t JOIN root ON TRUE JOIN (SELECT unnest(range(64)) AS level) l ON l.level < root.height
    LEFT JOIN tops s ON s.level = l.level AND s.idx = xor(t.tree >> l.level, 1)
), proofs AS (
    SELECT tree, r, sha256(coalesce(string_agg(sibling, '' ORDER BY stage, level), '')) AS proof FROM (
        SELECT tree, r, 0 AS stage, level, sibling FROM steps UNION ALL
        SELECT d.tree, d.r, 1, s.level, s.sibling FROM ranked d JOIN top_steps s USING (tree) UNION ALL
        SELECT tree, r, 2, 0, NULL FROM ranked)
    GROUP BY tree, r
), folds(tree, r, level, digest) AS (
    SELECT tree, r, 0, CASE WHEN crc % 7 = 0 THEN altered ELSE leaf END FROM ranked LEFT JOIN crc USING (doc_id)
    UNION ALL
    SELECT f.tree, f.r, f.level + 1,
           sha256(CASE WHEN s.at_left THEN coalesce(s.sibling, '') || f.digest ELSE f.digest || coalesce(s.sibling, '') END)
    FROM folds f JOIN steps s ON s.tree = f.tree AND s.r = f.r AND s.level = f.level
), top_folds(tree, r, level, digest) AS (
    SELECT f.tree, f.r, 0, f.digest FROM folds f JOIN subroots t ON t.tree = f.tree AND t.height = f.level
    UNION ALL
    SELECT f.tree, f.r, f.level + 1,
           sha256(CASE WHEN s.at_left THEN coalesce(s.sibling, '') || f.digest ELSE f.digest || coalesce(s.sibling, '') END)
    FROM top_folds f JOIN top_steps s ON s.tree = f.tree AND s.level = f.level
)
SELECT d.doc_id, d.leaf, t.digest AS subroot, root.digest AS root, p.proof AS proof_sha256,
       f.digest AS folded_root, f.digest = root.digest AS verified
FROM ranked d JOIN subroots t USING (tree) JOIN root ON TRUE JOIN proofs p USING (tree, r)
JOIN top_folds f ON f.tree = d.tree AND f.r = d.r AND f.level = root.height
"""

ORACLE_SQL: dict[str, str] = {
    "op2_exact_dedup": _OP2_SQL,
    "op4_warc": _OP4_SQL,
    "op5_ngram_join": _OP5_SQL,
    "op7_embedding_dedup": _OP7_SQL,
    "op11_importance_resampling": _OP11_SQL,
    "op13_merkle_manifest": _OP13_SQL,
}
