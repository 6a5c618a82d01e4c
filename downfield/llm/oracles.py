"""SQL (DuckDB's) for the operators that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

CHAT = r"""
WITH c AS (SELECT conv_id, turn, role, coalesce(text, '') AS text, text IS NULL AS no_text FROM conversations),
p AS (SELECT DISTINCT conv_id, role AS perspective FROM c WHERE role IS NOT NULL AND role <> 'system'),
s AS (SELECT c.*, perspective, coalesce(role = perspective, false) AS own, coalesce(role = 'system', false) AS narrated FROM c JOIN p ON c.conv_id IS NOT DISTINCT FROM p.conv_id),
m AS (SELECT *, CASE WHEN own THEN 'assistant' WHEN narrated THEN role ELSE 'user' END AS as_role, CASE WHEN NOT own AND NOT narrated THEN coalesce(role, 'unknown') END AS name FROM s),
h AS (SELECT *, '<|im_start|>' || as_role || coalesce(' name=' || name, '') || chr(10) AS head FROM m),
r AS (SELECT *, head || text || '<|im_end|>' || chr(10) AS rendered FROM h),
o AS (SELECT *, coalesce(sum(length(rendered)) OVER w, 0)::BIGINT AS start, (row_number() OVER v - 1)::BIGINT AS seq FROM r
      WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, role NULLS FIRST, no_text DESC, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
             v AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, role NULLS FIRST, no_text DESC, text))
SELECT conv_id, perspective, seq, turn, as_role AS role, name, rendered, start, CASE WHEN own THEN start + length(head) ELSE start END AS mask_start, CASE WHEN own THEN start + length(rendered) - 1 ELSE start END AS mask_end FROM o
"""

MINHASH = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END) AS shingle FROM d),
n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS i FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * i >= 85 * (x.c + y.c - i)),
b AS (SELECT u, v FROM e UNION ALL SELECT v, u FROM e),
reach(u, v) AS (SELECT u, v FROM b UNION SELECT reach.u, b.v FROM reach JOIN b ON reach.v = b.u),
least_of AS (SELECT u, min(v) AS v FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(c, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(v, d.doc_id)) AS component_id, d.doc_id <= coalesce(v, d.doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least_of ON u = d.doc_id
"""

#: Filling the block where a quota ends, as often as the operator does.
_FILL = """
f{k} AS (SELECT *, CASE WHEN NOT more{j} AND size BETWEEN 1 AND floor(gap{j}) AND sum(CASE WHEN NOT more{j} AND size BETWEEN 1 AND floor(gap{j}) THEN size END) OVER (PARTITION BY source, block ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) <= gap{j} THEN true ELSE false END AS now{k} FROM g{j}),
g{k} AS (SELECT *, more{j} OR now{k} AS more{k}, gap{j} - coalesce(sum(CASE WHEN now{k} THEN size END) OVER (PARTITION BY source, block), 0) AS gap{k} FROM f{k}),"""

MIXING = rf"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5('mix:' || doc_id) AS h FROM documents),
s AS (SELECT source, count(*) AS n_docs, sum(size)::BIGINT AS source_size FROM d GROUP BY 1),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS k FROM s),
w AS (SELECT *, [5.0, 2.0, 1.0][(k - 1) % 3 + 1]::DOUBLE AS weight, 2.0::DOUBLE * source_size AS cap FROM r),
q AS (SELECT *, cap / weight AS ratio FROM w),
l AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY ratio, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY ratio, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM q),
x AS (SELECT *, arg_min(level, (ratio, k)) FILTER (level <= ratio) OVER () AS share FROM l),
t AS (SELECT source, n_docs, source_size, CASE WHEN level > ratio THEN cap ELSE share * weight END AS target FROM x),
u AS (SELECT *, least(4096, greatest(1, ceil(n_docs / 512)))::BIGINT AS blocks, coalesce(floor(target / nullif(source_size, 0)), 0)::BIGINT AS base FROM t),
p AS (SELECT d.*, source_size, target, base, target - base * source_size AS rest, floor(('0x' || h[1:8])::BIGINT / 4294967296.0::DOUBLE * blocks)::BIGINT AS block FROM d JOIN u ON d.source IS NOT DISTINCT FROM u.source),
b AS (SELECT source, block, sum(size) AS words, sum(sum(size)) OVER (PARTITION BY source ORDER BY block) AS upto FROM p GROUP BY 1, 2),
g0 AS (SELECT p.*, upto <= rest AS more0, upto > rest AND upto - words <= rest AS part, CASE WHEN upto > rest AND upto - words <= rest THEN rest - (upto - words) ELSE 0 END AS gap0 FROM p JOIN b ON p.source IS NOT DISTINCT FROM b.source AND p.block = b.block),
{"".join(_FILL.format(k=k, j=k - 1) for k in (1, 2, 3))}
n AS (SELECT *, row_number() OVER (PARTITION BY source, block ORDER BY CASE WHEN NOT more3 AND size > 0 THEN abs(size - gap3) END NULLS LAST, h, doc_id, size) AS nearest FROM g3)
SELECT doc_id, size, source_size, target, (size * (base + (more3 OR (part AND nearest = 1 AND size BETWEEN 1 AND 2 * gap3))::INT))::BIGINT AS taken FROM n
"""

#: crc32 of a decimal number, bit by bit.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)), lambda a, c:
  list_reduce(list_prepend(xor(a, c), range(8)), lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295)"""

TRIE = rf"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place FROM conversations WHERE conv_id IS NOT NULL),
s AS (SELECT conv_id, count(*) AS n, {_CRC} % 9 AS h, conv_id - conv_id % 5 AS base FROM t GROUP BY conv_id),
c AS (SELECT s.*, least(h, coalesce((SELECT n FROM s b WHERE b.conv_id = s.base), 0)) AS taken FROM s),
r AS (SELECT c.conv_id, t.place AS depth, role, text FROM c JOIN t ON t.conv_id = c.base AND place <= taken
      UNION ALL SELECT c.conv_id, t.place - h + taken, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND place > h),
m AS (SELECT conv_id, depth, octet_length(encode(text)) AS bytes, list((role, text)) OVER (PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING) AS node FROM r
      UNION ALL SELECT conv_id, 0, 0, [] FROM c),
e AS (SELECT conv_id, max(depth) AS n_turns FROM m GROUP BY 1),
n AS (SELECT depth, min(m.conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(bytes) AS saved, string_agg(m.conv_id::VARCHAR, ',' ORDER BY m.conv_id) FILTER (depth = n_turns) AS ends, node FROM m JOIN e ON m.conv_id = e.conv_id GROUP BY node, depth),
k AS (SELECT n.*, p.conv_id AS parent_conv_id FROM n LEFT JOIN n p ON p.depth = n.depth - 1 AND p.node = n.node[1:n.depth - 1]),
l AS (SELECT k.*, (SELECT count(*) FROM k x WHERE x.depth = k.depth + 1 AND x.parent_conv_id = k.conv_id) AS n_children FROM k),
a AS (SELECT q.conv_id, q.depth, sum((l.n_children = 0)::INT) AS n_leaves, sum(l.saved) AS saved_tokens FROM l JOIN l q ON q.depth <= l.depth AND q.node = l.node[1:q.depth] GROUP BY 1, 2)
SELECT l.conv_id, l.depth::BIGINT AS depth, parent_conv_id, n_convs::BIGINT AS n_convs, n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256
FROM l JOIN a ON a.conv_id = l.conv_id AND a.depth = l.depth
"""

NEGATIVES = """
WITH u AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS own, list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))::BIGINT AS score FROM u a JOIN u b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE own QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER w AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT own AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 3
"""

ORACLES = {
    "op1_chat_perspectives": CHAT, "op2_minhash_dedup": MINHASH, "op6_mix_sources": MIXING, "op11_prefix_trie": TRIE,
    "op13_hard_negatives": NEGATIVES,
}
