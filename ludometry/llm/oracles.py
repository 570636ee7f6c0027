"""SQL for the results that SQL can state."""

# Exact containment of every item in every document that shares a shingle with it.
CONTAMINATION = r"""
WITH item_words AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM benchmark
), item_shingles AS (
  SELECT DISTINCT item_id, unnest([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]) AS s FROM item_words
), items AS (
  SELECT item_id, count(*) AS n_item FROM item_shingles GROUP BY item_id
), doc_words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM documents
), doc_shingles AS (
  SELECT DISTINCT doc_id, unnest([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]) AS s FROM doc_words
), shared AS (
  SELECT doc_id, item_id, count(*) AS n_shared
  FROM doc_shingles JOIN item_shingles USING (s) GROUP BY doc_id, item_id
)
SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment
FROM shared JOIN items USING (item_id)
WHERE n_shared / n_item >= 0.8
"""

# The CRC-32 of the bytes that a hex string h states, bit by bit.
_CRC = """
xor(4294967295::BIGINT, list_reduce(
  list_concat([4294967295::BIGINT], flatten([[('0x' || substr(h, 2 * i - 1, 2))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]
                                             for i in range(1, length(h) // 2 + 1)])),
  lambda c, o: CASE WHEN o >= 0 THEN xor(c, o) ELSE xor(c >> 1, (c & 1) * 3988292384) END))
"""

# Every prefix of the rebuilt conversations as a list of turns.
TRIE = rf"""
WITH RECURSIVE own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL
), heads AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, {_CRC} % 4 AS h
  FROM (SELECT DISTINCT conv_id, hex(encode(conv_id::VARCHAR)) AS h FROM own)
), turns AS (
  SELECT heads.conv_id, place, role, text FROM heads JOIN own ON own.conv_id = base AND place < h
  UNION ALL
  SELECT heads.conv_id, place, role, text FROM heads JOIN own ON own.conv_id = heads.conv_id AND place >= h
), numbered AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY place) AS d,
    length(role)::VARCHAR || ':' || role || text AS turn, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
  FROM turns
), paths AS (
  SELECT conv_id, 0::BIGINT AS d, '' AS path, '' AS above, 0::BIGINT AS words FROM heads
  UNION ALL
  SELECT n.conv_id, n.d, sha256(paths.path || '|' || turn), paths.path, n.words
  FROM paths JOIN numbered n ON n.conv_id = paths.conv_id AND n.d = paths.d + 1
), lengths AS (
  SELECT conv_id, max(d) AS length FROM paths GROUP BY conv_id
), nodes AS (
  SELECT path, any_value(above) AS above, any_value(d) AS depth, any_value(words) AS words, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (d = length), '')) AS ends_sha256
  FROM paths JOIN lengths USING (conv_id) GROUP BY path
), linked AS (
  SELECT nodes.*, parent.conv_id AS parent_conv_id,
    (SELECT count(*) FROM nodes c WHERE c.above = nodes.path AND c.depth = nodes.depth + 1) AS n_children
  FROM nodes LEFT JOIN nodes parent ON nodes.depth > 0 AND parent.path = nodes.above
), below AS (
  SELECT path AS top, path, words, n_convs, n_children FROM linked
  UNION ALL
  SELECT below.top, c.path, c.words, c.n_convs, c.n_children
  FROM below JOIN linked c ON c.above = below.path AND c.depth > 0
), sums AS (
  SELECT top, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * words)::BIGINT AS saved_tokens FROM below GROUP BY top
)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM linked JOIN sums ON top = path
"""

# Words one edit apart: the same without one character, or one without it the other.
VARIANTS = rf"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
  FROM documents
), counted AS (
  SELECT run, count(*) AS n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS h FROM runs WHERE length(run) >= 7 GROUP BY doc_id, run
), drawn AS (
  SELECT run, n, {_CRC} AS crc FROM counted
), written AS (
  SELECT CASE WHEN crc % 31 = 0 THEN substr(run, 1, (crc % length(run))::INT) || substr(run, (crc % length(run))::INT + 2) ELSE run END AS word, n FROM drawn
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM written WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), cut AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS short
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.short = b.short AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT cut.word, words.word, words.n FROM cut JOIN words ON cut.short = words.word
  UNION
  SELECT words.word, cut.word, cut.n FROM cut JOIN words ON cut.short = words.word
), best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, encode(near)) AS near, max(near_n) AS near_n FROM pairs GROUP BY word
), formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near,
    CASE WHEN near_n >= 10 * n THEN near END AS form, CASE WHEN near_n >= 10 * n THEN near_n END AS form_n
  FROM words LEFT JOIN best USING (word)
), followed AS (
  SELECT word, form, word AS last FROM formed
  UNION ALL
  SELECT followed.word, next.form, next.word FROM followed JOIN formed next ON next.word = followed.form
)
SELECT formed.word, formed.form, last AS root, n, n_near, form_n
FROM formed JOIN followed ON followed.word = formed.word AND followed.form IS NULL
"""

# Sets of shingles compared pair by pair, then joined from the smallest doc_id outwards.
JACCARD = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i + 2], ' ') for i in range(1, len(w) - 1)] END) AS s FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM sizes
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), least AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT documents.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, documents.doc_id) AS component_id
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)
"""
