"""SQL for those queries that SQL can express."""

from __future__ import annotations

_OP6 = """
WITH sized AS (
    SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, text, '')), 1, 2))::INT AS id_class,
           CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS src,
           len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size
    FROM documents
), sources AS (
    SELECT src, sum(size)::BIGINT AS source_size FROM sized GROUP BY src
), weighted AS (
    SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY src) - 1) % 3 + 1)::INT]::DOUBLE AS weight,
           source_size * 3.0::DOUBLE AS cap
    FROM sources
), levels AS (
    SELECT *, (sum(source_size) OVER ()::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / weight, src
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
              / sum(weight) OVER (ORDER BY cap / weight, src
               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighted
), chosen AS (
    SELECT (SELECT level FROM levels WHERE level <= cap / weight ORDER BY cap / weight, src LIMIT 1) AS level
), targets AS (
    SELECT src, source_size, least(cap, coalesce((SELECT level FROM chosen) * weight, cap)) AS target,
           ('0x' || substr(md5('mix-1/' || src), 1, 12))::BIGINT / 281474976710656.0::DOUBLE AS shift
    FROM levels
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY src ORDER BY
               CASE WHEN size > 0 THEN len(bin(size)) * 8 + ((size * 8) >> (len(bin(size)) - 1)) - 8 ELSE 0 END,
               id_class, size, doc_id NULLS FIRST) - 1 AS place
    FROM sized
), stepped AS (
    SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS each
    FROM ranked JOIN targets USING (src)
)
SELECT doc_id, size, source_size, target,
       ((floor(shift + each * (place + 1)) - floor(shift + each * place))::BIGINT * size)::BIGINT AS taken
FROM stepped
"""

_OP1 = """
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), escaped AS (
    SELECT *, length(regexp_replace(replace(x, '\\', '\\\\'),
        '(<\\|im_start\\|>|<\\|im_sep\\|>|<\\|im_end\\|>|<\\|endoftext\\|>|<s>|</s>|\\[INST\\]|\\[/INST\\])',
        '?\\1', 'g')) AS n
    FROM (SELECT *, unnest([role, text]) AS x FROM turns)
), sums AS (SELECT conv_id, sum(n) AS n FROM escaped GROUP BY conv_id)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (any_value(n) + count(*) * 33)::BIGINT AS formatted_chars
FROM turns JOIN sums USING (conv_id) GROUP BY conv_id
"""

_OP5 = """
WITH RECURSIVE good AS (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM good a, good b
    WHERE a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.9
), reach AS (
    SELECT a AS node, a AS other FROM (SELECT DISTINCT a FROM links)
    UNION
    SELECT node, b FROM reach JOIN links ON other = a
), tops AS (SELECT node, min(other) AS top FROM reach GROUP BY node),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(top, vec_id) AS component_id,
       coalesce(top, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN counts ON vec_id = a LEFT JOIN tops ON vec_id = node
"""

_OP7 = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
           ELSE list_distinct(list_transform(range(1, len(w) - 1),
                lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
    FROM words
), items AS (
    SELECT doc_id, unnest(s) AS item FROM sets
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM items a JOIN items b USING (item) WHERE a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM shared JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
    WHERE 100 * n >= 85 * (len(x.s) + len(y.s) - n)
), reach AS (
    SELECT a AS node, a AS other FROM (SELECT DISTINCT a FROM links)
    UNION
    SELECT node, b FROM reach JOIN links ON other = a
), tops AS (SELECT node, min(other) AS top FROM reach GROUP BY node)
SELECT doc_id, len(s)::BIGINT AS n_shingles, coalesce(top, doc_id) AS component_id,
       coalesce(top, doc_id) = doc_id AS kept
FROM sets LEFT JOIN tops ON doc_id = node
"""

ORACLE_SQL: dict[str, str] = {
    "op1_chat_format": _OP1,
    "op5_cover_tree": _OP5,
    "op6_mix_sources": _OP6,
    "op7_minhash": _OP7,
}
