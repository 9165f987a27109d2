"""The results of queries in SQL for DuckDB, where SQL can express them."""

#: Lines as words; a line goes if an equal one or one with one word inserted, deleted or
#: replaced comes earlier. Lines without a word stay, near ones have five words at least.
LINES = r"""
WITH raw AS (
    SELECT doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) AS raw,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS place
    FROM documents
), lines AS (
    SELECT doc_id, place, raw,
        trim(regexp_replace(raw, '[\x20\x09-\x0D]+', ' ', 'g')) AS line
    FROM raw
), earliest AS (
    SELECT line, string_split(line, ' ') AS words,
        min((doc_id * 1000000000::HUGEINT) + place) AS spot
    FROM lines WHERE length(line) >= 1 GROUP BY line
), variants AS (
    SELECT spot, len(words) AS n, i,
        array_to_string(list_concat(words[1:i - 1], words[i + 1:]), ' ') AS rest
    FROM (SELECT spot, words, unnest(range(1, len(words) + 1)) AS i FROM earliest
          WHERE len(words) >= 5)
), replaced AS (
    SELECT n, i, rest, min(spot) AS first_at FROM variants GROUP BY n, i, rest
), near AS (
    SELECT v.spot FROM variants v JOIN replaced r USING (n, i, rest) WHERE r.first_at < v.spot
    UNION
    SELECT greatest(v.spot, e.spot) FROM variants v JOIN earliest e ON e.line = v.rest
), stays AS (
    SELECT spot FROM earliest WHERE spot NOT IN (SELECT spot FROM near)
)
"""

#: Every pair of a query and another vector, scored and ranked.
INNER_PRODUCTS = r"""
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS terms
    FROM embeddings
    WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.terms, c.terms)::BIGINT AS score
    FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place
    FROM scored
)
SELECT query_id, place::INTEGER AS rank, vec_id, score FROM ranked WHERE place <= 5
"""

ORACLE: dict[str, str] = {
    "op11_max_score": INNER_PRODUCTS,
    "op10_line_neighbourhood": LINES
    + """
    SELECT doc_id, count(*)::INTEGER AS n_lines,
        count_if(NOT stay)::INTEGER AS n_removed,
        coalesce(string_agg(raw, chr(10) ORDER BY place) FILTER (WHERE stay), '') AS text
    FROM (
        SELECT l.doc_id, l.place, l.raw,
            length(l.line) < 1 OR s.spot IS NOT NULL AS stay
        FROM lines l
        LEFT JOIN stays s ON s.spot = (l.doc_id * 1000000000::HUGEINT) + l.place
    )
    GROUP BY doc_id
    """,
}
