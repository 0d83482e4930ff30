"""DuckDB SQL for the training-data queries that SQL can express."""

ORACLES = {
    "op10_rotate": """
WITH c AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
s AS (SELECT DISTINCT conv_id, role AS speaker FROM c WHERE role <> 'system'),
j AS (SELECT c.conv_id, s.speaker, CAST(floor(c.turn / 64.0) AS BIGINT) AS part, c.turn, c.role, c.text, c.role = s.speaker AS own,
  CASE WHEN c.role = 'system' THEN '<|system|>' || chr(10) WHEN c.role = s.speaker THEN '<|assistant|>' || chr(10)
       ELSE '<|user name=' || c.role || '|>' || chr(10) END AS head
  FROM c JOIN s ON c.conv_id IS NOT DISTINCT FROM s.conv_id),
p AS (SELECT *, coalesce(sum(length(head) + length(text) + 9) OVER (PARTITION BY conv_id, speaker, part
        ORDER BY turn NULLS FIRST, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos0 FROM j)
SELECT conv_id, speaker, part, count(*) AS n_turns,
  string_agg(head || text || chr(10) || '<|end|>' || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS rendered,
  coalesce(string_agg(CASE WHEN own THEN CAST(CAST(pos0 + length(head) AS BIGINT) AS VARCHAR) || '-' ||
    CAST(CAST(pos0 + length(head) + length(text) AS BIGINT) AS VARCHAR) END, ',' ORDER BY turn NULLS FIRST, role, text), '') AS mask_spans,
  CAST(coalesce(sum(CASE WHEN own THEN length(text) END), 0) AS BIGINT) AS mask_chars
FROM p GROUP BY conv_id, speaker, part
""",
    "op2_contaminated": """
WITH RECURSIVE masks(m, offs) AS (VALUES ('11111', [0,1,2,3,4]), ('1101011', [0,1,3,5,6]), ('11001011', [0,1,4,6,7]),
  ('101100011', [0,2,3,7,8])),
d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\pL\\pN]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\\pL\\pN]+') AS w FROM benchmark),
di AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d),
ii AS (SELECT item_id, w, unnest(range(1, len(w) + 1)) AS p FROM i WHERE len(w) >= 5),
ds AS (SELECT doc_id, p, m, [w[p + o] FOR o IN offs] AS seed FROM di, masks WHERE p + offs[5] <= len(w)),
si AS (SELECT item_id, p, m, [w[p + o] FOR o IN offs] AS seed FROM ii, masks WHERE p + offs[5] <= len(w)),
hit AS (SELECT DISTINCT doc_id, item_id, ds.p - si.p AS diagonal FROM ds JOIN si ON ds.m = si.m AND ds.seed = si.seed),
laid AS (SELECT doc_id, item_id, diagonal, ii.p, len(ii.w) AS n_words,
   CASE WHEN diagonal + ii.p >= 1 AND diagonal + ii.p <= len(d.w) AND d.w[diagonal + ii.p] = ii.w[ii.p] THEN 1 ELSE 0 END AS same
   FROM hit JOIN d USING (doc_id) JOIN ii USING (item_id)),
win AS (SELECT *, sum(same) OVER (PARTITION BY doc_id, item_id, diagonal ORDER BY p ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS near
   FROM laid),
diag AS (SELECT doc_id, item_id, diagonal, n_words, sum(same) AS matches, max(near) AS best_run FROM win
   GROUP BY doc_id, item_id, diagonal, n_words)
SELECT doc_id, item_id, CAST(max(matches) AS BIGINT) AS matches, CAST(max(n_words) AS BIGINT) AS n_words,
  CAST(max(best_run) AS BIGINT) AS best_run
FROM diag WHERE matches * 100 >= n_words * 80 OR best_run >= 11 GROUP BY doc_id, item_id
""",
    "op5_near_duplicate_vectors": """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
   WHERE label IS NOT NULL AND embedding IS NOT NULL),
n AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS z FROM v),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.label = b.label AND a.vec_id <> b.vec_id
   AND a.z > 0 AND b.z > 0 AND list_dot_product(a.e, b.e) >= 0.98 * a.z * b.z),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
c AS (SELECT a, min(b) AS root FROM reach GROUP BY a),
k AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(k.n, 0) AS n_links, root AS component_id, vec_id = root AS kept
FROM embeddings JOIN c ON vec_id = c.a LEFT JOIN k ON vec_id = k.a
""",
    "op7_capture_histories": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
s AS (SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest FROM p),
k AS (SELECT payload_digest, max(page_id) AS kept FROM s WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN kept IS NOT NULL AND kept <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN kept <> page_id THEN kept END AS refers_to
FROM s LEFT JOIN k USING (payload_digest)
""",
    "op9_near_duplicates": """
WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
   ELSE [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)] END) AS g FROM d),
u AS (SELECT doc_id, unnest(g) AS x FROM s),
both_in AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM u a JOIN u b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
half AS (SELECT a, b FROM both_in JOIN s sa ON a = sa.doc_id JOIN s sb ON b = sb.doc_id
   WHERE 100 * c >= 85 * (len(sa.g) + len(sb.g) - c)),
links AS (SELECT a, b FROM half UNION ALL SELECT b, a FROM half),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
c AS (SELECT a, min(b) AS root FROM reach GROUP BY a)
SELECT doc_id, CAST(len(g) AS BIGINT) AS n_shingles, root AS component_id, doc_id = root AS kept FROM s JOIN c ON doc_id = a
""",
    "op11_repeated_passages": """
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
   FROM documents),
win AS (SELECT doc_id, p, array_to_string(w[p:p + 49], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM d)),
first AS (SELECT s, min(doc_id) AS m FROM win GROUP BY s),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS q FROM win JOIN first USING (s) WHERE m < doc_id),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS q FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY q) AS t FROM word ANTI JOIN gone USING (doc_id, q) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""",
    "op12_collocations": """
WITH piece AS (SELECT row_number() OVER () AS id, lang, list_filter(string_split_regex(x, '[\\x20\\x09]+'), lambda y: y <> '') AS w
   FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS x FROM documents)),
spot AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM piece),
gram AS (SELECT lang, w[i:i + k - 1] AS g FROM spot, range(1, 6) AS s(k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, g, count(*) AS a FROM gram GROUP BY lang, g HAVING count(*) >= 100),
size AS (SELECT lang, count(*) AS n FROM spot GROUP BY lang),
cand AS (SELECT lang, g, a FROM f WHERE len(g) >= 2),
inner_of AS (SELECT DISTINCT lang, g[i:j] AS g, a FROM (SELECT lang, g, a, i, unnest(range(i + 1, len(g) + 1)) AS j
   FROM (SELECT lang, g, a, unnest(range(1, len(g))) AS i FROM cand WHERE len(g) > 2)) WHERE j - i + 1 < len(g)),
left_over AS (SELECT c.* FROM cand c WHERE NOT EXISTS (SELECT 1 FROM inner_of o WHERE o.lang = c.lang AND o.g = c.g AND o.a >= c.a)),
cut AS (SELECT lang, g, a, unnest(range(1, len(g))) AS k FROM left_over),
scored AS (SELECT cut.lang, cut.g, cut.a, k, x.a AS l, y.a AS r, n,
   (1000::HUGEINT * cut.a * n) // (x.a::HUGEINT * y.a) AS score
   FROM cut JOIN f x ON x.lang = cut.lang AND x.g = cut.g[1:k] JOIN f y ON y.lang = cut.lang AND y.g = cut.g[k + 1:]
   JOIN size ON size.lang = cut.lang),
least AS (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, k) AS o FROM scored),
ranked AS (SELECT *, array_to_string(g, ' ') AS phrase FROM least WHERE o = 1)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM ranked) WHERE rank <= 2000
""",
    "op13_filter_audit": """
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
   min(doc_id) OVER (PARTITION BY text) AS first FROM t),
m AS (SELECT doc_id, part, [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
   100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text), regexp_matches(text, '[#$%&*|]'),
   coalesce(doc_id > first, false)] AS fails FROM w),
marks AS (SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels GROUP BY doc_id),
j AS (SELECT part, fails, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic FROM m LEFT JOIN marks USING (doc_id)),
c AS (SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM j GROUP BY ALL),
l(x) AS (VALUES (1), (2), (3), (4), (5)),
o AS (SELECT [a.x, b.x, c.x, d.x, e.x] AS o FROM l a, l b, l c, l d, l e
   WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT o, unnest(range(1, 6)) AS step FROM o),
r AS (SELECT part, o, step, n, good, toxic, fails, fails[o[step]] AS here,
   len(list_filter(o[1:step - 1], lambda x: fails[x])) > 0 AS gone, len(list_filter(fails, lambda x: x)) = 1 AS alone FROM c, s),
g AS (SELECT part, o, step, sum(n) FILTER (WHERE NOT gone AND NOT here) AS kept, sum(n) FILTER (WHERE here AND NOT gone) AS removed,
   sum(n) FILTER (WHERE here AND gone) AS redundant, sum(n) FILTER (WHERE here AND alone) AS unique_fails,
   sum(good) FILTER (WHERE here AND NOT gone) AS good_lost, sum(toxic) FILTER (WHERE here AND NOT gone) AS toxic_lost
   FROM r GROUP BY part, o, step)
SELECT part, array_to_string(list_transform(o, lambda x: substr('ABCDE', x, 1)), '') AS filter_order, CAST(step AS INTEGER) AS step,
  CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
  CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, o[step]) AS BIGINT) AS shapley
FROM g
""",
}
