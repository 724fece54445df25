"""SQL twins of the queries that SQL can express (DuckDB)."""

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    coalesce(regexp_extract_all({LOWER.format('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w
  FROM documents
), b AS (
  SELECT item_id,
    coalesce(regexp_extract_all({LOWER.format('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w
  FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, l, array_to_string(w[i:i + l - 1], ' ') AS g
  FROM (SELECT item_id, w, least(10, len(w)) AS l, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i
        FROM b WHERE len(w) > 0)
), doc_windows AS (
  SELECT r, i, l, array_to_string(w[i:i + l - 1], ' ') AS g
  FROM (SELECT r, w, l, unnest(range(1, len(w) - l + 2)) AS i
        FROM d, (SELECT DISTINCT l FROM item_windows) WHERE len(w) >= l)
), found AS (
  SELECT r, i, l, item_id FROM doc_windows JOIN item_windows USING (l, g)
), words AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT r, unnest(range(i, i + l)) AS p FROM found) GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM found WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

OP7 = """
WITH d AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL
), l AS (
  SELECT doc_id, i, len(regexp_extract_all(lines[i], '[^\\x20\\x09-\\x0D]+')) AS words
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM d)
), c AS (
  SELECT doc_id, i, words, sum(words) OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM l
), runs AS (
  SELECT a.doc_id, a.i AS first, min(b.i) AS last
  FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.i >= a.i AND b.upto - a.upto + a.words >= 50 GROUP BY ALL
  UNION
  SELECT b.doc_id, max(a.i) AS first, b.i AS last
  FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.i >= a.i AND b.upto - a.upto + a.words >= 50 GROUP BY ALL
), ordered AS (
  SELECT doc_id, first, last,
    row_number() OVER (PARTITION BY array_to_string(lines[first:last], chr(10)) ORDER BY doc_id, first) AS nth
  FROM runs JOIN d USING (doc_id)
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(first, last + 1)) AS i FROM ordered WHERE nth > 1
), kept AS (
  SELECT l.doc_id, count(*) AS n_lines, count(g.i) AS n_deleted,
    coalesce(string_agg(lines[l.i], chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL), '') AS text
  FROM l JOIN d ON l.doc_id = d.doc_id LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i
  GROUP BY l.doc_id
)
SELECT doc_id, kept.text, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_deleted, 0)::BIGINT AS n_deleted
FROM documents LEFT JOIN kept USING (doc_id)
"""

_DRAWN = "('0x' || substr(d, {}, 8))::BIGINT"

OP12 = f"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, ''))::BIGINT AS n,
    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS d
  FROM documents
), h AS (
  SELECT doc_id, text, n, {_DRAWN.format(1)} % (n + 1) AS c1, {_DRAWN.format(9)} % (n + 1) AS c2,
    CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
        OR {_DRAWN.format(17)} % 100 >= 90 THEN 'plain'
      WHEN {_DRAWN.format(25)} % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM t
), p AS (
  SELECT doc_id, text, n, form, least(c1, c2) AS a, greatest(c1, c2) - least(c1, c2) AS m FROM h
), o AS (
  SELECT *, substr(text, 1, a) AS prefix, substr(text, a + 1, m) AS middle, substr(text, a + m + 1) AS suffix FROM p
)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN m END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text
    WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM o
"""

OP13 = """
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w
  FROM documents
), first AS (
  SELECT text, min(doc_id) AS least FROM d GROUP BY text
), l AS (
  SELECT doc_id, max(coalesce(quality, 0) = 1) AS good, max(coalesce(toxic, 0) = 1) AS toxic FROM labels GROUP BY doc_id
), fails AS (
  SELECT part, coalesce(good, false)::INT AS good, coalesce(toxic, false)::INT AS toxic,
    [len(w) < 200,
     100 * len(list_distinct(w)) < 50 * len(w),
     100 * length(regexp_replace(d.text, '[^A-Z]', '', 'g')) > 2 * length(d.text),
     regexp_matches(d.text, '[#$%&*|]'),
     coalesce(d.doc_id > least, false)] AS f
  FROM d JOIN first ON d.text = first.text LEFT JOIN l ON l.doc_id = d.doc_id
), masks AS (
  SELECT part, f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM fails GROUP BY part, f
), letters AS (
  SELECT unnest([1, 2, 3, 4, 5]) AS x
), orders AS (
  SELECT [a.x, b.x, c.x, d.x, e.x] AS o
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
  SELECT o, unnest([1, 2, 3, 4, 5])::INT AS step FROM orders
), met AS (
  SELECT part, o, step, n, good, toxic, f[o[step]] AS failed,
    list_bool_or(list_transform(o[1:step - 1], lambda i: f[i])) AS before,
    list_bool_or(list_transform(list_filter([1, 2, 3, 4, 5], lambda i: i <> o[step]), lambda i: f[i])) AS other
  FROM masks, steps
), found AS (
  SELECT part, o, step, o[step] AS x,
    coalesce(sum(n) FILTER (WHERE NOT failed AND NOT coalesce(before, false)), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (WHERE failed AND NOT coalesce(before, false)), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (WHERE failed AND coalesce(before, false)), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (WHERE failed AND NOT other), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (WHERE failed AND NOT coalesce(before, false)), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (WHERE failed AND NOT coalesce(before, false)), 0)::BIGINT AS toxic_lost
  FROM met GROUP BY part, o, step
)
SELECT part, array_to_string(list_transform(o, lambda i: substr('ABCDE', i, 1)), '') AS filter_order, step,
  kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley
FROM found
"""
