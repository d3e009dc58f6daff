"""DuckDB SQL for the operators that SQL can express: plain, all pairs, for small tables."""

from __future__ import annotations

import string

_WORDS = r"'[^\x20\x09-\x0D]+'"


def _reach(links: str, nodes: str) -> str:
    """CTEs: the smallest node that every node reaches over ``links`` (a, b)."""
    return f"""
both_ways AS (SELECT a, b FROM {links} UNION SELECT b, a FROM {links}),
walk AS (SELECT n AS node, n AS seen FROM {nodes}
         UNION SELECT w.node, l.b FROM walk w JOIN both_ways l ON l.a = w.seen),
least AS (SELECT node, min(seen) AS component_id FROM walk GROUP BY node)"""


def _escaped(column: str) -> str:
    out = f"replace({column}, '\\', '\\\\')"
    for control in ("[INST]", "[/INST]", "</s>", "<s>"):
        out = f"replace({out}, '{control}', '{control[0]}\\{control[1:]}')"
    return out


CHAT = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(17 + length({_escaped('role')}) + length({_escaped('text')})) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id"""

SUBSTRING = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 34], ' ') AS k FROM w, unnest(range(1, len(ws) - 33)) AS r(i)),
rep AS (SELECT k FROM win GROUP BY k HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM win JOIN rep USING (k), range(35) AS r(j)),
pos AS (SELECT doc_id, p, ws[p] AS word FROM w, unnest(range(1, len(ws) + 1)) AS r(p)),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text FROM pos ANTI JOIN gone USING (doc_id, p)
         GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS n, sha256(html) AS digest FROM p),
f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY digest) ELSE page_id END AS first_id FROM d)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to,
       CASE WHEN first_id = page_id THEN greatest(1, CAST(ceil(n / 262144) AS BIGINT)) ELSE 1 END AS n_chunks
FROM f"""

MINHASH = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
                                    {_WORDS}) AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS k FROM w, unnest(range(1, greatest(len(ws) - 2, 2))) AS r(i)
      WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.k = y.k AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
          WHERE 100 * c >= 80 * (na.n + nb.n - c)),
nodes AS (SELECT doc_id AS n FROM w),{_reach('links', 'nodes')}
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, component_id = w.doc_id AS kept
FROM w JOIN least ON node = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id"""

EMBEDDINGS = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y
          ON x.label = y.label AND x.vec_id < y.vec_id AND len(x.e) = len(y.e)
          WHERE list_cosine_similarity(x.e, y.e) >= 0.93),
nodes AS (SELECT vec_id AS n FROM embeddings),{_reach('links', 'nodes')},
degree AS (SELECT a, count(*) AS n FROM both_ways GROUP BY a)
SELECT node AS vec_id, coalesce(n, 0) AS n_links, component_id, component_id = node AS kept
FROM least LEFT JOIN degree ON a = node"""

# CRC-32 (reversed polynomial 0xEDB88320) of the ASCII text of a column
_CRC_TABLE = "list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i))"


def _crc32(column: str, table: str) -> str:
    codes = f"list_transform(string_split(CAST({column} AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))"
    step = f"lambda c, b: xor(c // 256, {table}[xor(c % 256, b) + 1])"
    return f"xor(4294967295, list_reduce({codes}, {step}, CAST(4294967295 AS BIGINT)))"


def _field(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE octet_length(encode(CAST({column} AS VARCHAR))) || ':' || {column} END"


def _leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', n_chars, 'text')))})"


def _tree(name: str, base: str) -> str:
    """CTEs: ``name`` has the nodes (seq, level, pos, d, n) of the trees over ``base`` (seq, pos, d, n)."""
    return f"""
{name} AS (SELECT seq, 0 AS level, pos, d, n FROM {base}
  UNION ALL
  SELECT seq, level + 1, pos // 2, sha256(string_agg(d, '' ORDER BY pos)), (n + 1) // 2 FROM {name} WHERE n > 1
  GROUP BY seq, level, pos // 2, n)"""


MERKLE = f"""
WITH RECURSIVE crc AS (SELECT {_CRC_TABLE} AS t),
docs AS (SELECT doc_id, coalesce('=' || lang, '') AS seq, {_leaf('n_chars')} AS leaf,
                CASE WHEN {_crc32('doc_id', 't')} % 7 = 0 THEN {_leaf('(n_chars + 1)')} ELSE {_leaf('n_chars')} END AS shown
         FROM documents, crc),
placed AS (SELECT *, row_number() OVER w - 1 AS pos, count(*) OVER (PARTITION BY seq) AS n, row_number() OVER () AS id FROM docs
           WINDOW w AS (PARTITION BY seq ORDER BY doc_id NULLS FIRST, leaf)),
base AS (SELECT seq, pos, leaf AS d, n FROM placed),{_tree('low', 'base')},
subroots AS (SELECT seq, d, level FROM low WHERE n = 1),
top_base AS (SELECT '' AS seq, row_number() OVER (ORDER BY encode(seq)) - 1 AS pos, d, count(*) OVER () AS n, seq AS name FROM subroots),
{_tree('top', '(SELECT seq, pos, d, n FROM top_base)').strip()},
steps AS (
  SELECT id, level, d, low.pos % 2 AS after FROM placed JOIN low ON low.seq = placed.seq AND low.pos = xor(placed.pos >> low.level, 1)
  UNION ALL
  SELECT id, s.level + top.level, top.d, top.pos % 2 FROM placed JOIN subroots s USING (seq)
  JOIN top_base b ON b.name = placed.seq JOIN top ON top.pos = xor(b.pos >> top.level, 1)),
heights AS (SELECT seq, s.level + (SELECT max(level) FROM top) AS height FROM subroots s),
fold AS (SELECT id, 0 AS level, shown AS d, height FROM placed JOIN heights USING (seq)
  UNION ALL
  SELECT f.id, f.level + 1, CASE WHEN s.d IS NULL THEN sha256(f.d) WHEN s.after = 1 THEN sha256(f.d || s.d) ELSE sha256(s.d || f.d) END, height
  FROM fold f LEFT JOIN steps s ON s.id = f.id AND s.level = f.level WHERE f.level < height),
proofs AS (SELECT id, sha256(string_agg(d, '' ORDER BY level)) AS proof FROM steps GROUP BY id),
root AS (SELECT d AS root FROM top WHERE n = 1)
SELECT doc_id, leaf, s.d AS subroot, root, coalesce(proof, sha256('')) AS proof_sha256, f.d AS folded_root, f.d = root AS verified
FROM placed JOIN subroots s USING (seq) CROSS JOIN root JOIN fold f ON f.id = placed.id AND f.level = f.height LEFT JOIN proofs ON proofs.id = placed.id"""

RUNS = f"""
WITH crc AS (SELECT {_CRC_TABLE} AS t),
d AS (SELECT doc_id, row_number() OVER () AS id, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS ws,
             {_crc32('doc_id', 't')} AS h FROM documents, crc),
e AS (SELECT *, len(ws) AS n, h // 10 AS g, (h // 10) % greatest(len(ws), 1) AS a FROM d),
w AS (SELECT doc_id, id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i:
             ws[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END + 1]) ELSE ws END AS ws FROM e),
win AS (SELECT id, i, array_to_string(ws[i:i + 5], ' ') AS k FROM w, unnest(range(1, n - 4)) AS r(i)),
pair AS (SELECT x.id, x.i, y.i - x.i AS q FROM win x JOIN win y ON x.id = y.id AND x.k = y.k AND x.i < y.i),
island AS (SELECT *, i - row_number() OVER (PARTITION BY id, q ORDER BY i) AS nr FROM pair),
stretch AS (SELECT id, q, min(i) - 1 AS s, count(*) + 5 + q AS len FROM island GROUP BY id, q, nr),
runs AS (SELECT id, s, len, min(q) AS q FROM stretch WHERE len >= greatest(12, 2 * q) GROUP BY id, s, len),
listed AS (SELECT id, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
                  min_by({{'s': s, 'len': len, 'q': q}}, {{'l': -len, 's': s, 'q': q}}) AS best FROM runs GROUP BY id),
gone AS (SELECT DISTINCT id, s + j AS p FROM runs, unnest(range(q, len)) AS r(j)),
kept AS (SELECT id, string_agg(ws[p + 1], ' ' ORDER BY p) AS text
         FROM (SELECT id, ws, p FROM w, unnest(range(n)) AS r(p)) ANTI JOIN gone USING (id, p) GROUP BY id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.len AS length, best.q AS period,
       1000 * best.len // best.q AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM w LEFT JOIN listed USING (id) LEFT JOIN kept USING (id)"""

ORACLE_SQL = {
    "op1_chat_tree": CHAT,
    "op2_substring_dedup": SUBSTRING,
    "op6_warc_records": WARC,
    "op7_minhash_dedup": MINHASH,
    "op9_embedding_dedup": EMBEDDINGS,
    "op11_periodic_runs": RUNS,
    "op12_merkle_manifest": MERKLE,
}
