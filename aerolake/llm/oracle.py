"""Plain SQL of the queries that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_REACH = """
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT id AS a, id AS b FROM nodes UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a),
smallest AS (SELECT a AS id, min(b) AS component_id FROM reach GROUP BY a)
"""

OP2 = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(w) - 2, 1) + 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS s FROM words
), nodes AS (SELECT id FROM sets), items AS (SELECT id, unnest(s) AS x FROM sets),
shared AS (SELECT p.id AS a, q.id AS b, count(*) AS n FROM items p JOIN items q ON p.x = q.x AND p.id < q.id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sets p ON a = p.id JOIN sets q ON b = q.id WHERE 100 * n >= 85 * (len(p.s) + len(q.s) - n)
), {_REACH}
SELECT id AS doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, id = component_id AS kept FROM sets JOIN smallest USING (id)
"""

OP3 = f"""
WITH RECURSIVE nodes AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
good AS (
  SELECT id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS n FROM nodes
  WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x != 0)) > 0
), links AS (
  SELECT p.id AS a, q.id AS b FROM good p JOIN good q ON p.id < q.id AND len(p.e) = len(q.e)
  WHERE list_inner_product(p.e, q.e) / (p.n * q.n) >= 0.9
), {_REACH},
counts AS (SELECT a AS id, count(*) AS n FROM both_ways GROUP BY a)
SELECT id AS vec_id, coalesce(counts.n, 0) AS n_links, component_id, id = component_id AS kept
FROM smallest LEFT JOIN counts USING (id)
"""

OP6 = """
WITH good AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x != 0)) > 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_reduce(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i]), lambda x, y: x + y) AS score
  FROM good q JOIN good c ON q.vec_id % 20 = 0 AND q.vec_id != c.vec_id AND len(q.e) = len(c.e)
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n, vec_id, score FROM scored
)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM ranked WHERE n <= 20
"""

OP7 = rf"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos FROM split),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), '{_UPPER}', '{_LOWER}') AS k FROM lines
), repeated AS (
  SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), marked AS (SELECT keyed.*, coalesce(doc_id != last, false) AS gone FROM keyed LEFT JOIN repeated USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


_ZEROS = "[0, 0, 0, 0, 0, 0, 0, 0]"


def _crc32(text: str) -> str:
    """The unsigned crc32 of a text's UTF-8 bytes, bit by bit."""
    code = f"hex(encode({text}))"
    digit = lambda at: f"(instr('0123456789ABCDEF', substr({code}, {at}, 1)) - 1)"
    octets = f"list_transform(range(1, length({code}) // 2 + 1), lambda i: CAST({digit('2 * i - 1')} * 16 + {digit('2 * i')} AS BIGINT))"
    shifted = f"list_reduce(list_prepend(xor(c, o), CAST({_ZEROS} AS BIGINT[])), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {octets}), lambda c, o: {shifted}), 4294967295)"


OP11 = rf"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')), '{_UPPER}', '{_LOWER}') AS run FROM documents
), counted AS (
  SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL
), hashed AS (
  SELECT run, n, {_crc32("concat(CAST(doc_id AS VARCHAR), ':', run)")} AS h FROM counted
), words AS (
  SELECT CASE WHEN h % 199 = 0 THEN concat(substr(run, 1, h % length(run)), substr(run, h % length(run) + 2)) ELSE run END AS word, CAST(sum(n) AS BIGINT) AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 6 AND sum(n) >= 5
), places AS (SELECT word, n, unnest(range(length(word) + 1)) AS i FROM words),
cut AS (
  SELECT word, n, substr(word, 1, i) AS head, substr(word, i + 1) AS rest FROM places
  UNION ALL SELECT word, n, substr(word, 1, i), substr(word, i + 2) FROM places WHERE i < length(word)
), near AS (
  SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.head = b.head AND a.rest = b.rest AND a.word != b.word
), best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n FROM near GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * n THEN other END AS form, CASE WHEN other_n >= 5 * n THEN other_n END AS form_n
  FROM words w LEFT JOIN best USING (word)
), followed AS (
  SELECT word, word AS leads FROM forms UNION ALL SELECT f.word, form FROM followed f JOIN forms ON forms.word = leads WHERE form IS NOT NULL
)
SELECT forms.word, n, form, form_n, n_near, leads AS root FROM forms JOIN followed ON followed.word = forms.word
WHERE leads IN (SELECT word FROM forms WHERE form IS NULL)
"""


OP12 = f"""
WITH own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS place, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
  SELECT conv_id, count(*) AS n, conv_id - conv_id % 100 AS base, {_crc32("CAST(conv_id AS VARCHAR)")} % 6 AS shared FROM own GROUP BY conv_id
), moved AS (
  SELECT i.conv_id, i.base, i.shared, least(i.shared, coalesce(b.n, 0)) AS kept FROM ids i LEFT JOIN ids b ON b.conv_id = i.base
), turns AS (
  SELECT m.conv_id, place + 1 AS depth, role, text FROM moved m JOIN own o ON o.conv_id = base AND place < shared
  UNION ALL SELECT m.conv_id, kept + place - shared + 1, role, text FROM moved m JOIN own o ON o.conv_id = m.conv_id AND place >= shared
), prefixes AS (
  SELECT conv_id, depth, length(text) AS chars,
    string_agg(md5(concat(length(role), ' ', role, text)), '') OVER (PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING) AS path
  FROM turns UNION ALL SELECT conv_id, 0, 0, '' FROM ids
), nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars FROM prefixes GROUP BY path, depth
), named AS (
  SELECT p.conv_id AS member, depth, n.conv_id AS node FROM prefixes p JOIN nodes n USING (path, depth)
), linked AS (
  SELECT n.conv_id, n.depth, n_convs, chars, u.node AS parent FROM nodes n LEFT JOIN named u ON u.member = n.conv_id AND u.depth = n.depth - 1
), children AS (
  SELECT parent AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM linked WHERE parent IS NOT NULL GROUP BY ALL
), whole AS (
  SELECT l.*, coalesce(n_children, 0) AS n_children FROM linked l LEFT JOIN children USING (conv_id, depth)
), sums AS (
  SELECT a.node AS conv_id, a.depth, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum((n_convs - 1) * chars) AS BIGINT) AS saved_tokens
  FROM whole u JOIN named a ON a.member = u.conv_id AND a.depth <= u.depth GROUP BY ALL
), ends AS (
  SELECT node AS conv_id, depth, sha256(string_agg(CAST(member AS VARCHAR), ',' ORDER BY member)) AS ends
  FROM (SELECT *, max(depth) OVER (PARTITION BY member) AS last FROM named) WHERE depth = last GROUP BY ALL
)
SELECT conv_id, depth, parent AS parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
FROM whole JOIN sums USING (conv_id, depth) LEFT JOIN ends USING (conv_id, depth)
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_minhash_dedup": OP2, "op3_embedding_dedup": OP3, "op6_vp_trees": OP6, "op7_line_dedup": OP7, "op11_spelling": OP11, "op12_prefix_trie": OP12}
