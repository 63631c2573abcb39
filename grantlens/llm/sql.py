"""Checking SQL (DuckDB) for the queries that SQL can express."""

MIXING = r"""
WITH sized AS (
    SELECT doc_id, source,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
           length(coalesce(text, '')) AS chars,
           ('0x' || md5('mix|' || coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, ''))[1:13])::BIGINT AS draw
    FROM documents
), keyed AS (
    SELECT *, -ln((draw + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE)
              / CASE WHEN chars / greatest(size, 1) BETWEEN 3 AND 12 THEN 1.0::DOUBLE ELSE 0.25::DOUBLE END AS k
    FROM sized
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           list_extract([5.0, 2.0, 1.0], 1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT)::DOUBLE AS weight
    FROM keyed GROUP BY source
), ordered AS (
    SELECT *, 2.0::DOUBLE * source_size AS most,
           1.5::DOUBLE * sum(source_size) OVER () AS budget,
           sum(weight) OVER () AS weights,
           row_number() OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST) AS rank
    FROM sources
), levels AS (
    SELECT *, (budget - coalesce(sum(most) OVER before, 0)) / (weights - coalesce(sum(weight) OVER before, 0)) AS level
    FROM ordered WINDOW before AS (ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
    SELECT source, source_size, least(most, max(level) OVER () * weight) AS target FROM levels
), placed AS (
    SELECT doc_id, size, source_size, target,
           CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs,
           sum(size) OVER (PARTITION BY keyed.source ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS start
    FROM keyed JOIN targets ON keyed.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (epochs * size + greatest(0, least(size, floor(target)::BIGINT - epochs * source_size - start)))::BIGINT AS taken
FROM placed
"""

TOP_K = """
WITH good AS (
    SELECT vec_id::BIGINT AS vec_id, list_transform(embedding, lambda x: floor(1024.0::DOUBLE * x::DOUBLE)::BIGINT) AS vector
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           list_sum(list_transform(list_zip(q.vector, c.vector), lambda x: x[1] * x[2]))::BIGINT AS score
    FROM good q JOIN good c ON q.vec_id <> c.vec_id AND len(q.vector) = len(c.vector)
    WHERE q.vec_id % 100 = 0
), ranked AS (
    SELECT query_id, vec_id, score,
           row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

DIVERGENCE = r"""
WITH docs AS (
    SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), used AS (
    SELECT doc, lang, source, unnest(terms) AS term FROM docs
), kept AS (
    SELECT lang, term, count(*)::HUGEINT AS n FROM used GROUP BY lang, term HAVING count(DISTINCT doc) >= 10
), langs AS (
    SELECT lang, count(*) AS terms, sum(n) + 2 * count(*) AS total FROM kept GROUP BY lang
), own AS (
    SELECT lang, source, term, count(*)::HUGEINT AS n FROM used SEMI JOIN kept USING (lang, term) GROUP BY ALL
), totals AS (
    SELECT lang, source, sum(n) AS n FROM own GROUP BY lang, source
), sides AS (
    SELECT d.lang, d.source, coalesce(t.n, 0) + 2 * l.terms AS total, l.total AS lang_total
    FROM (SELECT DISTINCT lang, source FROM docs) d
    LEFT JOIN totals t USING (lang, source) LEFT JOIN langs l ON l.lang = d.lang
), shares AS (
    SELECT s.lang, s.source, k.term, coalesce(o.n, 0) AS n,
           1 + (1000000000 * (coalesce(o.n, 0) + 2)) // s.total AS p, 1 + (1000000000 * (k.n + 2)) // s.lang_total AS q
    FROM sides s JOIN kept k USING (lang) LEFT JOIN own o USING (lang, source, term)
), pairs AS (
    SELECT a.lang, a.source, b.source AS item,
           coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0)::BIGINT AS value
    FROM sides a JOIN sides b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
    LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
    WHERE x.term IS NULL OR y.term IS NOT NULL
    GROUP BY a.lang, a.source, b.source
), terms AS (
    SELECT lang, source, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value FROM shares WHERE n > 0 AND p > q
), ranked AS (
    SELECT lang, source, 'pair' AS part, item, value FROM pairs
    UNION ALL
    SELECT lang, source, 'term', item, value FROM terms
)
SELECT lang, source, part, item, value, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM ranked
) WHERE part = 'pair' OR rank <= 10
"""
