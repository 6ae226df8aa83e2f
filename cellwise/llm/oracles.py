"""SQL twins of those queries that SQL can express."""

from __future__ import annotations

from cellwise.llm import decontamination, mixing, negatives, rules, spelling

ORACLES: dict[str, str] = {}

ORACLES["op2_mixing"] = f"""
WITH RECURSIVE weights AS (
  SELECT doc_id, CASE min(quality) WHEN 1 THEN 2.0::DOUBLE WHEN 0 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), sized AS (
  SELECT d.doc_id, d.source,
    coalesce(len(regexp_extract_all(d.text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
    -ln((('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, 'null' || md5(coalesce(d.text, ''))) || '-mix'), 1, {mixing.HEX_DIGITS}))::BIGINT::DOUBLE + 0.5)
      / {float(16**mixing.HEX_DIGITS)!r}::DOUBLE) / coalesce(w.weight, 1.0::DOUBLE) AS key
  FROM documents d LEFT JOIN weights w USING (doc_id)
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    ([5, 2, 1])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM sized GROUP BY source
), levels AS (
  SELECT 0 AS round, 0::BIGINT AS capped, (SELECT sum(weight)::BIGINT FROM sources) AS free,
    (SELECT sum(source_size)::BIGINT FROM sources) AS total
  UNION ALL
  SELECT round + 1,
    (SELECT coalesce(sum(source_size) FILTER (weight * ((1.5::DOUBLE * total - 2.0::DOUBLE * capped) / free) >= source_size * 2.0::DOUBLE), 0)::BIGINT FROM sources),
    (SELECT coalesce(sum(weight) FILTER (weight * ((1.5::DOUBLE * total - 2.0::DOUBLE * capped) / free) < source_size * 2.0::DOUBLE), 0)::BIGINT FROM sources),
    total
  FROM levels WHERE free > 0 AND round < (SELECT count(*) FROM sources)
), final AS (
  SELECT * FROM levels ORDER BY round DESC LIMIT 1
), targets AS (
  SELECT source, source_size,
    CASE WHEN free = 0 THEN source_size * 2.0::DOUBLE
      ELSE least(weight * ((1.5::DOUBLE * total - 2.0::DOUBLE * capped) / free), source_size * 2.0::DOUBLE) END AS target
  FROM sources, final
), placed AS (
  SELECT s.doc_id, s.source, s.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size)::BIGINT ELSE 0 END AS epochs,
    sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size ROWS UNBOUNDED PRECEDING) - s.size AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, source,
  (size * (epochs + CASE WHEN before + size / 2.0::DOUBLE <= target - epochs * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed
"""

_N = decontamination.N
_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
    " 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)
ORACLES["op3_decontamination"] = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents
), items AS (
  SELECT item_id, w, least(len(w), {_N}) AS n FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, n, list_slice(w, i, i + n - 1) AS run
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM items)
), grams AS (
  SELECT r, n, i, list_slice(w, i, i + n - 1) AS run
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM items) WHERE len(w) >= n)
), hits AS (
  SELECT g.r, g.i, g.n, x.item_id FROM grams g JOIN windows x ON g.n = x.n AND g.run = x.run
), words AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r
), found AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN found USING (r)
"""

ORACLES["op11_negatives"] = f"""
WITH rows AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({negatives.SCALE} * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.id AS a, a.label AS own, r.id AS id, r.label AS label, list_dot_product(a.v, r.v)::BIGINT AS score
  FROM rows a JOIN rows r ON a.id % 100 = 0 AND a.id <> r.id
), positives AS (
  SELECT a, own, id, score FROM scores WHERE own = label
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, id) <= {negatives.POSITIVES}
)
SELECT p.a AS anchor_id, p.id AS positive_id,
  row_number() OVER (PARTITION BY p.a, p.id ORDER BY s.score DESC, s.id)::INTEGER AS rank,
  s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.a = p.a AND s.label <> p.own
  AND 100 * s.score BETWEEN {negatives.LEAST} * p.score AND {negatives.MOST} * p.score
QUALIFY row_number() OVER (PARTITION BY p.a, p.id ORDER BY s.score DESC, s.id) <= {negatives.NEGATIVES}
"""

# Near words by edit distance over all pairs. DuckDB's distance counts bytes, so letters beyond
# ASCII take the place of signs that words do not have.
_WIDE = "".join(map(chr, range(0xC0, 0x100)))
_NARROW = "".join(map(chr, range(0x21, 0x61))).replace("'", "''")
_LOWERED = f"translate(text, '{spelling.UPPER}', '{spelling.LOWER}')"
ORACLES["op12_spelling"] = f"""
WITH RECURSIVE steps AS (
  SELECT i, i::BIGINT AS c, 0 AS k FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8
), byte_table AS (
  SELECT list(c ORDER BY i) AS crcs FROM steps WHERE k = 8
), runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all({_LOWERED}, '[A-Za-zÀ-ÿ]+')) AS run FROM documents
), keyed AS (
  SELECT run, count(*) AS n, hex(encode(id || ':' || run)) AS bytes FROM runs WHERE length(run) >= {spelling.MIN_LENGTH} GROUP BY id, run
), hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(1, length(bytes), 2), lambda i: ('0x' || substr(bytes, i, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1]))) AS h
  FROM keyed, byte_table
), words AS (
  SELECT CASE WHEN h % {spelling.ERRORS} = 0
    THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n
  FROM hashed
), counts AS (
  SELECT word, sum(n)::BIGINT AS n, translate(word, '{_WIDE}', '{_NARROW}') AS short FROM words
  WHERE length(word) >= {spelling.MIN_LENGTH} GROUP BY word HAVING sum(n) >= {spelling.MIN_COUNT}
), near AS (
  SELECT a.word, count(*) AS n_near, min((-b.n, b.word)) AS best
  FROM counts a JOIN counts b ON length(b.word) BETWEEN length(a.word) - 1 AND length(a.word) + 1
    AND levenshtein(a.short, b.short) = 1
  GROUP BY a.word
), formed AS (
  SELECT c.word, c.n, coalesce(n_near, 0)::BIGINT AS n_near,
    CASE WHEN -best[1] >= {spelling.RATIO} * c.n THEN best[2] END AS form,
    CASE WHEN -best[1] >= {spelling.RATIO} * c.n THEN -best[1] END AS form_n
  FROM counts c LEFT JOIN near USING (word)
), paths AS (
  SELECT word, word AS root FROM formed
  UNION ALL
  SELECT p.word, f.form FROM paths p JOIN formed f ON f.word = p.root WHERE f.form IS NOT NULL
), ends AS (
  SELECT p.word, p.root FROM paths p JOIN formed f ON f.word = p.root WHERE f.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)
"""

_SENTENCE_END = rules.SENTENCE_END.replace("'", "''")
ORACLES["op13_rules"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT r, doc_id, t, regexp_extract_all(t, '{rules.WORD}') AS words FROM d
), l AS (
  SELECT r, line, count(*) AS n FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '{rules.WORD}') GROUP BY r, line
), judged AS (
  SELECT r, n, line, len(regexp_extract_all(line, '{rules.WORD}')) AS m FROM l
), lines AS (
  SELECT r, sum(n - 1)::BIGINT AS dup, coalesce(sum(m) FILTER (
    regexp_matches(line, '{_SENTENCE_END}')
    AND 4 * len(regexp_extract_all(line, '{rules.DOUBLED}')) <= m
    AND 4 * len(regexp_extract_all(line, '{rules.SYMBOL}')) <= m
    AND 4 * len(regexp_extract_all(line, '{rules.SEPARATOR}')) <= m
    AND NOT regexp_matches(line, '{rules.MENU}')
    AND NOT (m <= {rules.BOILERPLATE_WORDS} AND regexp_matches(line, '{rules.BOILERPLATE}'))), 0)::BIGINT AS left_over
  FROM judged GROUP BY r
), runs AS (
  SELECT r, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) > 2)
), repeated AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS k FROM runs) WHERE k > 1
), covered AS (
  SELECT r, count(*) AS n FROM (SELECT DISTINCT r, unnest(range(i, i + 3)) AS p FROM repeated) GROUP BY r
), figures AS (
  SELECT w.r, doc_id, len(words)::BIGINT AS n_words,
    (length(t) - len(regexp_extract_all(t, '[\x20\x09-\x0D]')))::BIGINT AS word_chars,
    len(regexp_extract_all(t, '{rules.SYMBOL}'))::BIGINT AS n_symbols,
    coalesce(dup, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
    coalesce(left_over, 0)::BIGINT AS n_left
  FROM w LEFT JOIN lines USING (r) LEFT JOIN covered USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEATED} * n_words AS base_failed,
  NOT (n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEATED} * n_words)
    AND 100 * (n_words - n_left) <= {rules.MAX_LOST} * n_words AS kept,
  n_left
FROM figures
"""
