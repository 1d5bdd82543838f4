"""DuckDB SQL of those text queries that SQL can express."""

from __future__ import annotations

WORDS = r"""list_filter(regexp_split_to_array(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'),
  lambda w: w <> '')"""

DECONTAMINATE = f"""
WITH items AS (SELECT item_id, {WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i + 1 : i + least(len(w), 10)], ' ') AS words
  FROM (SELECT item_id, w, unnest(range(0, greatest(len(w) - 10, 0) + 1)) AS i FROM items WHERE len(w) > 0)),
docs AS (SELECT doc_id, {WORDS} AS w FROM documents),
places AS (
  SELECT doc_id, n, i, array_to_string(w[i + 1 : i + n], ' ') AS words
  FROM (SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS i
    FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, n, item_id FROM places JOIN windows USING (n, words)),
hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY 1),
hit_items AS (
  SELECT doc_id, list_sort(list(DISTINCT cast(item_id AS varchar))) AS ids FROM hits GROUP BY 1)
SELECT doc_id, cast(len(w) AS bigint) AS n_words, coalesce(n_hit, 0) AS n_hit,
  cast(coalesce(len(ids), 0) AS bigint) AS n_items,
  sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)"""

EMBEDDINGS = """
WITH RECURSIVE v AS (
  SELECT vec_id, cast(embedding AS double[]) AS e FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b
  ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least_of AS (SELECT x, min(y) AS y FROM reach GROUP BY 1),
counts AS (SELECT x, count(*) AS n FROM links GROUP BY 1)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(y, vec_id)) AS component_id,
  vec_id <= coalesce(y, vec_id) AS kept
FROM embeddings LEFT JOIN least_of ON vec_id = least_of.x LEFT JOIN counts ON vec_id = counts.x"""

# crc32 byte by byte, with the table that its polynomial gives
VARIANTS = r"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(0, 256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{00C0}-\x{00FF}]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce([4294967295::bigint] || list_transform(
      range(0, length(bytes) // 2), lambda i: ('0x' || substr(bytes, 2 * i + 1, 2))::bigint),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
  FROM (SELECT run, n, hex(encode(coalesce(doc_id::varchar, '') || ':' || run)) AS bytes FROM runs), crc_table),
words AS (
  SELECT word, cast(sum(n) AS bigint) AS n FROM (
    SELECT n, CASE WHEN h % 31 = 0 THEN substr(run, 1, cast(h % length(run) AS bigint))
      || substr(run, cast(h % length(run) AS bigint) + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
less AS (
  SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, unnest(range(0, length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT word, rest FROM less WHERE rest IN (SELECT word FROM words)
  UNION SELECT rest, word FROM less WHERE rest IN (SELECT word FROM words)),
ranked AS (
  SELECT near.word, other, o.n AS form_n, count(*) OVER (PARTITION BY near.word) AS n_near,
    row_number() OVER (PARTITION BY near.word ORDER BY o.n DESC, other) AS place
  FROM near JOIN words o ON other = o.word),
forms AS (
  SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * n THEN other END AS form,
    CASE WHEN form_n >= 10 * n THEN form_n END AS form_n
  FROM words LEFT JOIN ranked ON words.word = ranked.word AND place = 1),
chains AS (
  SELECT word, form AS root, 1 AS step FROM forms WHERE form IS NOT NULL
  UNION ALL SELECT chains.word, forms.form, step + 1 FROM chains JOIN forms ON chains.root = forms.word
  WHERE forms.form IS NOT NULL),
roots AS (SELECT word, arg_max(root, step) AS root FROM chains GROUP BY word)
SELECT forms.word, form, coalesce(root, forms.word) AS root, n, n_near, form_n FROM forms LEFT JOIN roots USING (word)"""

ORACLES = {"op1_decontaminate": DECONTAMINATE, "op9_embeddings": EMBEDDINGS, "op13_variants": VARIANTS}
