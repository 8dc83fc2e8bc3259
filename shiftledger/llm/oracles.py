"""The queries that SQL can express, as DuckDB SQL."""

from __future__ import annotations

from shiftledger.llm.mixing import MAX_RATE, SEED, WEIGHTS

def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    bits = "list_reduce(range(8), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)), xor(crc, byte))"
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: ord(substr({text}, i, 1))::BIGINT)"
    return f"xor(list_reduce({codes}, lambda crc, byte: {bits}, 4294967295::BIGINT), 4294967295)"


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({value}::VARCHAR) || ':' || {value} END"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", n_chars, "text"))) + ")"


ORACLES: dict[str, str] = {
    "op1_warc": """
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex
  FROM pages
), firsts AS (
  SELECT hex, min(page_id) AS first_id FROM payloads GROUP BY hex
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  list_aggregate(
    list_transform(range(0, 32), lambda n: substr(
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + ((CAST('0x' || substr(hex, 5 * (n // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (n % 4))) & 31)::INTEGER,
      1)),
    'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM payloads JOIN firsts USING (hex)
""",
    "op2_debruijn": """
WITH split AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS words FROM documents
), places AS (
  SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS pos FROM split WHERE len(words) >= 35
), keyed AS (
  SELECT doc_id, pos, sha256(array_to_string(words[pos:pos + 34], ' ')) AS content FROM places
), counted AS (
  SELECT doc_id, pos, count(*) OVER (PARTITION BY content) AS n FROM keyed
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(pos, pos + 35)) AS pos FROM counted WHERE n > 1
), listed AS (
  SELECT doc_id, list(pos) AS removed FROM gone GROUP BY doc_id
), exploded AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM split
), kept AS (
  SELECT e.doc_id, string_agg(e.word, ' ' ORDER BY e.pos) AS kept
  FROM exploded e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.pos = g.pos
  WHERE g.pos IS NULL GROUP BY e.doc_id
)
SELECT s.doc_id, len(words)::BIGINT AS n_words, coalesce(len(removed), 0)::BIGINT AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM split s LEFT JOIN listed l ON s.doc_id = l.doc_id LEFT JOIN kept k ON s.doc_id = k.doc_id
""",
    "op8_suffixes": """
WITH split AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), strings AS (
  SELECT doc_id, pos, md5(substr(h, 2 * pos + 1, 100)) AS content
  FROM (SELECT doc_id, h, unnest(range(0, strlen(h) // 2 - 49)) AS pos FROM split)
), firsts AS (
  SELECT content, min(doc_id) AS least FROM strings GROUP BY content
), gone AS (
  SELECT s.doc_id, s.pos FROM strings s JOIN firsts f ON f.content = s.content WHERE s.doc_id > f.least
), ordered AS (
  -- a string that starts within or right behind the one before goes on its run
  SELECT *, pos > coalesce(lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) + 50, -1) AS new FROM gone
), numbered AS (
  SELECT *, sum(new::INTEGER) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM ordered
), runs AS (
  SELECT doc_id, run, min(pos) AS low, max(pos) + 50 AS high FROM numbered GROUP BY doc_id, run
), pieces AS (
  SELECT r.*, substr(h, 2 * coalesce(lag(high) OVER w, 0) + 1, 2 * (low - coalesce(lag(high) OVER w, 0))) AS piece
  FROM runs r JOIN split s ON s.doc_id = r.doc_id WINDOW w AS (PARTITION BY r.doc_id ORDER BY low)
), parts AS (
  SELECT doc_id, count(*) AS n_spans, sum(high - low) AS n_removed, max(high) AS high,
    string_agg(piece, '' ORDER BY low) AS kept
  FROM pieces GROUP BY doc_id
)
SELECT s.doc_id, (strlen(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
  coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept || substr(h, 2 * high + 1), h))) AS kept_sha256
FROM split s LEFT JOIN parts p ON p.doc_id = s.doc_id
""",
    "op10_mixing": f"""
WITH sized AS (
  SELECT doc_id, source,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
  FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, [{", ".join(map(str, WEIGHTS))}][
    1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)}] AS weight
  FROM totals
), levels AS (
  -- the level if this source and all of smaller ratio are capped
  SELECT (sum(source_size) OVER () - {MAX_RATE} * coalesce(sum(source_size) OVER before, 0))::DOUBLE
      / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level,
    source_size, weight, row_number() OVER (ORDER BY source_size / weight, source) AS place
  FROM weighed
  WINDOW before AS (ORDER BY source_size / weight, source
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), chosen AS (
  SELECT arg_min(level, place) AS level FROM levels WHERE {MAX_RATE} * source_size >= weight * level
), targets AS (
  SELECT source, source_size, least(({MAX_RATE} * source_size)::DOUBLE, weight * level) AS target
  FROM weighed, chosen
), rated AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
    ('0x' || substr(md5('{SEED}|' || coalesce(s.doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE
      / {16**13}::DOUBLE AS draw
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  size * (floor(rate) + (draw < rate - floor(rate))::INTEGER)::BIGINT AS taken
FROM rated
""",
    "op11_merkle": f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, {_leaf("n_chars")} AS leaf, {_leaf("(n_chars::HUGEINT + 1)")} AS tampered,
    coalesce({_crc32("doc_id::VARCHAR")} % 7 = 0, false) AND n_chars IS NOT NULL AS chosen
  FROM documents
), placed AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
    count(*) OVER (PARTITION BY lang) AS size
  FROM leaves
), nodes AS (
  SELECT tree, 0 AS level, place, size, leaf AS digest FROM placed
  UNION ALL
  SELECT tree, level + 1, place // 2, (size + 1) // 2, sha256(string_agg(digest, '' ORDER BY place))
  FROM nodes WHERE size > 1 GROUP BY tree, level, place // 2, size
), subroots AS (
  SELECT tree, level AS height, digest FROM nodes WHERE size = 1
), top AS (
  SELECT 0 AS level, tree AS place, (SELECT count(*) FROM subroots) AS size, digest FROM subroots
  UNION ALL
  SELECT level + 1, place // 2, (size + 1) // 2, sha256(string_agg(digest, '' ORDER BY place))
  FROM top WHERE size > 1 GROUP BY level, place // 2, size
), steps AS (
  -- every level of every leaf: its sibling, and on which side
  SELECT p.tree, p.place, n.level, n.digest AS sibling, n.place < (p.place >> n.level::BIGINT) AS is_left
  FROM placed p JOIN nodes n ON n.tree = p.tree AND n.place = xor(p.place >> n.level::BIGINT, 1)
  UNION ALL
  SELECT p.tree, p.place, s.height + t.level, t.digest, t.place < (p.tree >> t.level::BIGINT)
  FROM placed p JOIN subroots s ON s.tree = p.tree JOIN top t ON t.place = xor(p.tree >> t.level::BIGINT, 1)
), heights AS (
  SELECT tree, height + (SELECT max(level) FROM top) AS height, digest AS subroot FROM subroots
), folds AS (
  SELECT p.tree, place, 0::BIGINT AS level, CASE WHEN chosen THEN tampered ELSE leaf END AS digest, height
  FROM placed p JOIN heights h ON h.tree = p.tree
  UNION ALL
  SELECT f.tree, f.place, f.level + 1, sha256(CASE
    WHEN s.sibling IS NULL THEN f.digest WHEN s.is_left THEN s.sibling || f.digest ELSE f.digest || s.sibling END), f.height
  FROM folds f LEFT JOIN steps s ON s.tree = f.tree AND s.place = f.place AND s.level = f.level
  WHERE f.level < f.height
), proofs AS (
  SELECT tree, place, string_agg(sibling, '' ORDER BY level) AS proof FROM steps GROUP BY tree, place
)
SELECT p.doc_id, p.leaf, h.subroot, r.digest AS root, sha256(coalesce(o.proof, '')) AS proof_sha256,
  f.digest AS folded_root, f.digest = r.digest AS verified
FROM placed p JOIN heights h ON h.tree = p.tree
JOIN folds f ON f.tree = p.tree AND f.place = p.place AND f.level = f.height
LEFT JOIN proofs o ON o.tree = p.tree AND o.place = p.place
CROSS JOIN (SELECT digest FROM top WHERE size = 1) r
""",
    "op12_prefix_trie": f"""
WITH RECURSIVE placed AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
  SELECT conv_id, {_crc32("conv_id::VARCHAR")} % 4 AS lent FROM placed GROUP BY conv_id
), joined AS (
  SELECT i.conv_id, 0 AS part, p.place, p.role, p.text
  FROM ids i JOIN placed p ON p.conv_id = i.conv_id - i.conv_id % 20 AND p.place <= i.lent
  UNION ALL
  SELECT i.conv_id, 1, p.place, p.role, p.text FROM ids i JOIN placed p ON p.conv_id = i.conv_id AND p.place > i.lent
), turns AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY part, place) AS depth FROM joined
), prefixes AS (
  SELECT conv_id, 0::BIGINT AS depth, '' AS key, 0::BIGINT AS words FROM ids
  UNION ALL
  SELECT p.conv_id, t.depth, sha256(p.key || strlen(t.role) || ':' || t.role || t.text),
    len(regexp_extract_all(t.text, '[^\\x20\\x09-\\x0D]+'))
  FROM prefixes p JOIN turns t ON t.conv_id = p.conv_id AND t.depth = p.depth + 1
), lengths AS (
  SELECT conv_id, max(depth) AS size FROM prefixes GROUP BY conv_id
), nodes AS (
  SELECT p.key, p.depth, min(p.conv_id) AS conv_id, count(*) AS n_convs, min(words) AS words,
    sha256(coalesce(string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) FILTER (l.size = p.depth), '')) AS ends_sha256
  FROM prefixes p JOIN lengths l USING (conv_id) GROUP BY p.key, p.depth
), above AS (
  -- every node with each node on the way to the root
  SELECT n.key, a.key AS top, a.depth AS top_depth FROM nodes n JOIN prefixes a ON a.conv_id = n.conv_id AND a.depth <= n.depth
), parents AS (
  SELECT a.key, p.conv_id AS parent_conv_id, p.key AS parent
  FROM nodes n JOIN above a ON a.key = n.key AND a.top_depth = n.depth - 1 JOIN nodes p ON p.key = a.top
), children AS (
  SELECT parent AS key, count(*) AS n_children FROM parents GROUP BY parent
), subtrees AS (
  SELECT a.top AS key, count(*) FILTER (c.key IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.words) AS saved_tokens
  FROM above a JOIN nodes n ON n.key = a.key LEFT JOIN children c ON c.key = n.key GROUP BY a.top
)
SELECT n.conv_id, n.depth, parent_conv_id, n.n_convs, coalesce(n_children, 0)::BIGINT AS n_children,
  n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM nodes n JOIN subtrees s ON s.key = n.key
LEFT JOIN parents p ON p.key = n.key LEFT JOIN children c ON c.key = n.key
""",
    "op13_lines": """
WITH split AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key
  FROM split
), common AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT k.*, c.key IS NOT NULL AND c.keeper <> k.doc_id AS gone FROM keyed k LEFT JOIN common c USING (key)
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
""",
}
