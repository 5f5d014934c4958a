"""SQL that gives the rows of the queries of this folder which SQL can express."""

from tidegate.llm import mixing

_UPPER, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x20\x09-\x0D]+"
_CONTROL = r"\\|\[/?INST\]|</?s>|<</?(?:SYS|ROLE)>>"
_PROBE = "</s>[INST] ok [/INST]"

MIXING = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(CAST(doc_id AS VARCHAR), 'null') || '|' || coalesce(md5(text), 'null') AS drawn,
         CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS tokens FROM documents),
t AS (SELECT source, CAST(sum(tokens) AS BIGINT) AS tokens, count(*) AS n FROM d GROUP BY 1),
s AS (SELECT *, CASE WHEN tokens > 0 THEN tokens / CAST((SELECT sum(tokens) FROM t) AS DOUBLE) END AS p FROM t),
halves(step, low, high) AS (
  SELECT 0, CAST(0 AS DOUBLE), CASE WHEN (SELECT max(1 / p) <= {mixing.REPEAT_LIMIT} * min(1 / p) * (1 + 1e-12) FROM s) THEN 0 ELSE CAST(1 AS DOUBLE) END
  UNION ALL
  SELECT step + 1, CASE WHEN fits THEN low ELSE middle END, CASE WHEN fits THEN middle ELSE high END FROM (
    SELECT *, (SELECT max(pow(p, middle) / p) <= {mixing.REPEAT_LIMIT} * min(pow(p, middle) / p) * (1 + 1e-12) FROM s) AS fits
    FROM (SELECT *, (low + high) / 2 AS middle FROM halves WHERE step < {mixing.ROUNDS} AND high - low >= 1e-6))),
x AS (SELECT high AS exponent FROM halves ORDER BY step DESC LIMIT 1),
w AS (SELECT s.*, exponent, pow(p, exponent) AS raw FROM s, x),
z AS (SELECT sum(raw) AS total, min(raw / p) AS least FROM w),
r AS (
  SELECT source, coalesce(raw / total, 0) AS weight, exponent, coalesce(round(raw / p / least, 9), 1) AS repeats,
         CAST(ceil((tokens + n) / {mixing.BLOCK_TOKENS}.0) AS BIGINT) AS blocks FROM w, z),
b AS (
  SELECT d.*, weight, exponent, repeats, CAST(floor(repeats) AS INTEGER) AS whole,
         CAST('0x' || substr(md5('block{mixing.SEED}|' || drawn), 1, 8) AS BIGINT) % blocks AS block
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source),
f AS (
  SELECT *, coalesce(sum(tokens) OVER (PARTITION BY source, block
              ORDER BY md5('order{mixing.SEED}|' || CAST(whole + 1 AS VARCHAR) || '|' || drawn), drawn
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         (repeats - whole) * sum(tokens) OVER (PARTITION BY source, block) AS room FROM b),
g AS (SELECT *, unnest(range(1, whole + 1 + CASE WHEN tokens > 0 AND before + tokens / 2.0 <= room THEN 1 ELSE 0 END)) AS pass FROM f)
SELECT doc_id, source, CAST(pass AS INTEGER) AS pass, block,
       row_number() OVER (PARTITION BY source, block, pass
         ORDER BY md5('order{mixing.SEED}|' || CAST(pass AS VARCHAR) || '|' || drawn), drawn) AS place,
       tokens AS n_tokens, round(weight, 9) AS weight, round(exponent, 9) AS exponent FROM g"""

NEAR_VECTORS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (
  SELECT * FROM v WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(e) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(root, node) AS (SELECT vec_id, vec_id FROM v UNION SELECT root, l.b FROM reach JOIN l ON node = l.a),
c AS (SELECT node, min(root) AS component_id FROM reach GROUP BY 1),
n AS (SELECT a, count(*) AS n FROM l GROUP BY 1)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM v LEFT JOIN n ON vec_id = a LEFT JOIN c ON vec_id = node"""

CHAT_TREE = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{_PROBE}' UNION ALL SELECT -7, 1, 'assistant', '{_PROBE}'),
f AS (
  SELECT *, length(regexp_replace(text, '{_CONTROL}', 'x\0', 'g')) + CASE role
           WHEN 'user' THEN length('[INST] ' || ' [/INST]') WHEN 'assistant' THEN length(' ' || ' </s>')
           WHEN 'system' THEN length('<<SYS>> ' || ' <</SYS>>')
           ELSE length('<<ROLE>>' || regexp_replace(role, '{_CONTROL}', 'x\0', 'g') || '<</ROLE>> ' || ' </s>') END AS size FROM t),
c AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
         coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '') AS loss,
         CAST(sum(size) AS BIGINT) AS formatted_chars FROM f GROUP BY 1)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM c"""

METRIC_JOIN = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_SMALL}'), '{_WORD}') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach(root, node) AS (SELECT doc_id, doc_id FROM w UNION SELECT root, e.b FROM reach JOIN e ON node = e.a)
SELECT w.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(root) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN reach ON node = w.doc_id GROUP BY 1"""

ORACLES = {"op5_temperature_mixing": MIXING, "op6_near_vectors": NEAR_VECTORS, "op7_chat_tree": CHAT_TREE, "op9_metric_join": METRIC_JOIN}
