"""The queries of this package that SQL can express, for DuckDB."""

from __future__ import annotations

_OP6 = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


_OP1 = """
WITH usable AS (
    SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           list_sum([q.v[i] * c.v[i] for i in range(1, len(c.v) + 1)])::BIGINT AS score
    FROM usable q JOIN usable c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


_OP11 = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), said AS (SELECT row, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term, count(*)::HUGEINT AS n FROM said GROUP BY ALL HAVING count(DISTINCT row) >= 3),
sizes AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS n FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM said SEMI JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (
    SELECT g.lang, g.source, coalesce(s.v, 0) AS v, coalesce(s.n, 0) AS lang_n,
           coalesce((SELECT sum(c.n) FROM counts c WHERE c.lang = g.lang AND c.source = g.source), 0)::HUGEINT AS n
    FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN sizes s ON s.lang = g.lang
), rates AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
           1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (g.n + g.v) AS p,
           1 + 1000000000::HUGEINT * (k.n + 1) // (g.lang_n + g.v) AS q
    FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)
), found AS (
    SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM rates WHERE n > 0 AND p > q
    UNION ALL
    SELECT a.lang, a.source, 'pair', b.source, coalesce(sum((x.p - y.p) * (x.p - y.p) // y.p), 0)
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN rates x ON x.lang = a.lang AND x.source = a.source
    LEFT JOIN rates y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
    GROUP BY a.lang, a.source, b.source
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place FROM found
)
SELECT lang, source, part, item, value::BIGINT AS value, place::INTEGER AS rank FROM ranked WHERE part = 'pair' OR place <= 200
"""

_OP12 = r"""
WITH words AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
           min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first
    FROM documents
), fails AS (
    SELECT doc_id, part,
           (len(w) < 100)::INT + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::INT
           + 4 * (100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text))::INT
           + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * coalesce(doc_id > first, false)::INT AS mask
    FROM words
), marks AS (
    SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
    FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), docs AS (
    SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
    FROM fails LEFT JOIN marks USING (doc_id) GROUP BY ALL
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
    SELECT filter_order, s.step, bits[s.step] AS own, coalesce(list_sum(bits[1:s.step - 1]), 0)::INT AS before
    FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step) s
), counted AS (
    SELECT d.part, s.filter_order, s.step, s.own,
           sum(n) FILTER (WHERE mask & (before | own) = 0) AS kept, sum(n) FILTER (WHERE mask & own <> 0 AND mask & before = 0) AS removed,
           sum(n) FILTER (WHERE mask & own <> 0 AND mask & before <> 0) AS redundant, sum(n) FILTER (WHERE mask = own) AS unique_fails,
           sum(good) FILTER (WHERE mask & own <> 0 AND mask & before = 0) AS good_lost,
           sum(toxic) FILTER (WHERE mask & own <> 0 AND mask & before = 0) AS toxic_lost
    FROM docs d, steps s GROUP BY ALL
)
SELECT part, filter_order, step::INTEGER AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, own), 0)::BIGINT AS shapley
FROM counted
"""


def oracles() -> dict[str, str]:
    return {
        "op1_threshold_top_k": _OP1, "op6_exact_dedup": _OP6, "op11_source_divergence": _OP11, "op12_filter_audit": _OP12,
    }
