"""SQL that the corpus queries must agree with, where SQL can express them.

Language models, tokenizers and pattern positions cannot be written in it; those queries
are held against brute force or held-out labels in ``tests/llm``.
"""

LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLES: dict[str, str] = {
    "op2_warc": """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d FROM pages
), c AS (SELECT d, n, max(page_id) AS first FROM p WHERE n >= 1000 GROUP BY d, n)
SELECT p.page_id, p.n::BIGINT AS payload_bytes, p.d AS payload_digest,
  CASE WHEN c.first IS NULL OR p.page_id = c.first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN p.page_id <> c.first THEN c.first END AS refers_to
FROM p LEFT JOIN c ON p.d = c.d AND p.n = c.n""",
    "op3_minhash": f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {LOWER}), '[^ \\t\\n\\x0B\\f\\r]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM w WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n
  HAVING 100 * count(*) >= 75 * (na.n + nb.n - count(*))
), r AS (
  SELECT a AS doc_id, a AS other FROM l UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.other = l.a
), c AS (SELECT doc_id, min(other) AS component FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(c.component, d.doc_id) AS component_id,
  coalesce(c.component, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.doc_id = d.doc_id""",
    "op4_decontaminate": f"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {LOWER}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {LOWER}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark
), p AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS width, array_to_string(list_slice(w, i, i + 9), ' ') AS pattern
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM b WHERE len(w) > 0)
), o AS (
  SELECT d.doc_id, d.i, d.width, p.item_id FROM (
    SELECT doc_id, width, i, array_to_string(list_slice(w, i, i + width - 1), ' ') AS part
    FROM (SELECT doc_id, w, width, unnest(generate_series(1, len(w) - width + 1)) AS i
          FROM w, (SELECT DISTINCT width FROM p) WHERE len(w) >= width)
  ) d JOIN p ON p.pattern = d.part AND p.width = d.width
), h AS (
  SELECT doc_id, count(DISTINCT place) AS n FROM (
    SELECT doc_id, unnest(generate_series(i, i + width - 1)) AS place FROM o) GROUP BY doc_id
), f AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM o) GROUP BY doc_id
)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit,
  coalesce(f.n, 0)::BIGINT AS n_items, sha256(coalesce(f.items, '')) AS items_sha256,
  coalesce(h.n, 0) > 0 AS contaminated
FROM w LEFT JOIN h ON h.doc_id = w.doc_id LEFT JOIN f ON f.doc_id = w.doc_id""",
    "op5_chat_format": """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), m AS (
  SELECT *, length(text) + length(regexp_replace(text, '[^\\\\<\\[\\]]', '', 'g')) + CASE role
    WHEN 'system' THEN 18 WHEN 'user' THEN 15 WHEN 'assistant' THEN 7
    ELSE 16 + length(role) + length(regexp_replace(role, '[^\\\\<\\[\\]]', '', 'g')) END AS chars
  FROM t
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars,
  regexp_full_match(string_agg(role, ',' ORDER BY turn, role, text), '(system,)?user,assistant(,user,assistant)*') AS valid
FROM m GROUP BY conv_id""",
    "op8_line_dedup": f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    unnest(generate_series(1, len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {LOWER}) AS key FROM l
), r AS (
  SELECT key, max(doc_id) AS holder FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), m AS (
  SELECT k.*, r.holder IS NULL OR r.holder = k.doc_id AS keep FROM k LEFT JOIN r ON r.key = k.key
)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (NOT keep))::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (keep), '')) AS kept_sha256
FROM m GROUP BY doc_id""",
    "op10_top_k": """
WITH v AS (
  SELECT vec_id, [floor(x::DOUBLE * 256) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 5""",
    "op12_phrases": f"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), {LOWER}), '[.,;:!?\\n\\x0B\\f\\r]')) AS piece
  FROM documents
), w AS (SELECT lang, regexp_extract_all(piece, '[^ \\t]+') AS w FROM p),
g AS (
  SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i
        FROM w, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k)
), f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10
), x AS (
  SELECT c.lang, c.phrase, c.a, cut, l.f AS l, r.f AS r, (1000000::HUGEINT * c.a * c.a) // (l.f::HUGEINT * r.f) AS score
  FROM (SELECT *, unnest(generate_series(1, k - 1)) AS cut FROM c) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:cut], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[cut + 1:], ' ')
), s AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
d AS (
  SELECT DISTINCT s.lang, s.phrase FROM s
  JOIN (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM c WHERE k = 3) t
    ON t.lang = s.lang AND t.phrase = s.phrase AND 100 * t.a >= 50 * s.a
)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, encode(s.phrase)) AS rank,
  s.phrase, a, l, r, n, score::BIGINT AS score
FROM s JOIN n ON n.lang = s.lang ANTI JOIN d ON d.lang = s.lang AND d.phrase = s.phrase
QUALIFY rank <= 2000""",
    "op13_filter_audit": """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^ \\t\\n\\x0B\\f\\r]+') AS w FROM t),
f AS (SELECT text, min(doc_id) AS first FROM t GROUP BY text),
m AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
d AS (
  SELECT part, coalesce(good, false) AS good, coalesce(m.toxic, false) AS toxic,
    (CASE WHEN len(w) < 100 THEN 'A' ELSE '' END) || (CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END)
    || (CASE WHEN 100 * length(regexp_replace(w.text, '[^A-Z]', '', 'g')) > 10 * length(w.text) THEN 'C' ELSE '' END)
    || (CASE WHEN regexp_matches(w.text, '[#$%&*|]') THEN 'D' ELSE '' END)
    || (CASE WHEN f.first < w.doc_id THEN 'E' ELSE '' END) AS fails
  FROM w JOIN f ON f.text = w.text LEFT JOIN m ON m.doc_id = w.doc_id
), c AS (SELECT part, good, toxic, fails, count(*) AS n FROM d GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
o AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM l a, l b, l c, l d, l e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5
), s AS (
  SELECT filter_order, step, filter_order[step] AS filter, filter_order[1:step - 1] AS before
  FROM o, (SELECT unnest(generate_series(1, 5)) AS step)
), x AS (
  SELECT c.*, s.*, contains(fails, filter) AS hit,
    before <> '' AND length(translate(fails, before, '')) < length(fails) AS gone
  FROM c, s
), r AS (
  SELECT part, filter_order, step, filter, coalesce(sum(n) FILTER (NOT gone AND NOT hit), 0) AS kept,
    coalesce(sum(n) FILTER (hit AND NOT gone), 0) AS removed, coalesce(sum(n) FILTER (hit AND gone), 0) AS redundant,
    coalesce(sum(n) FILTER (fails = filter), 0) AS unique_fails,
    coalesce(sum(n) FILTER (hit AND NOT gone AND good), 0) AS good_lost,
    coalesce(sum(n) FILTER (hit AND NOT gone AND toxic), 0) AS toxic_lost
  FROM x GROUP BY ALL
)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
  redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
  toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley
FROM r""",
}
