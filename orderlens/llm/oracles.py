"""DuckDB SQL for the corpus queries that SQL can express."""

OP10 = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
WINDOW same AS (PARTITION BY t)
"""

OP9 = """
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), turns AS (
  SELECT *, contains(text, '<s>') OR contains(text, '</s>') OR contains(text, '[INST]') OR contains(text, '[/INST]') AS bad
  FROM said
), pieces AS (
  SELECT *,
    length('<s>[') + length('] ') + length('</s>') + CASE WHEN bad THEN 1 ELSE 0 END
      + CASE role WHEN 'user' THEN 4 WHEN 'assistant' THEN 5
             ELSE 5 + length(replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&lsqb;'), ']', '&rsqb;')) END
      + CASE WHEN bad THEN length(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&lsqb;'))
             ELSE length(text) END AS chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM pieces GROUP BY conv_id
"""

OP7 = """
WITH RECURSIVE usable AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND NOT list_contains([x IS NULL OR NOT isfinite(x) FOR x IN embedding], true)
    AND list_contains([x <> 0 FOR x IN embedding], true)
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), reach AS (
  SELECT vec_id AS v, vec_id AS r FROM embeddings
  UNION SELECT reach.v, links.b FROM reach JOIN links ON links.a = reach.r
), least AS (SELECT v, min(r) AS component_id FROM reach GROUP BY v),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least ON v = vec_id LEFT JOIN counts ON a = vec_id
"""

OP13 = r"""
WITH terms AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), tf AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
size AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY ALL),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM size),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY ALL),
asked AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark) GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM df, total WHERE term IN (SELECT term FROM asked)
), parts AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // words))) AS part
  FROM tf JOIN weights USING (term) JOIN size USING (doc_id), total
), scored AS (
  SELECT item_id, doc_id, CAST(sum(times * part) AS BIGINT) AS score FROM asked JOIN parts USING (term) GROUP BY ALL
), ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

ORACLES: dict[str, str] = {"op7_embedding_dedup": OP7, "op9_chat_format": OP9, "op10_exact_dedup": OP10, "op13_lexical_search": OP13}
