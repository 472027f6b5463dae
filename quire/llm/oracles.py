"""SQL that some queries agree with, comparing every window, pair or set directly."""

WORDS = "[^ \\t-\\r]+"
UPPER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SUBSTRINGS = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS w FROM documents),
starts AS (SELECT doc_id, w, CAST(unnest(range(1, len(w) - 33)) AS BIGINT) AS i FROM d WHERE len(w) >= 35),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS k FROM starts),
repeated AS (SELECT doc_id, i FROM windows WHERE k IN (SELECT k FROM windows GROUP BY k HAVING count(*) > 1)),
gone AS (SELECT DISTINCT doc_id, i + unnest(range(0, 35)) AS p FROM repeated),
places AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN kept USING (doc_id)"""

VECTORS = """
WITH RECURSIVE e AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.9),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a AS vec_id, min(b) AS least FROM reach GROUP BY a),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(least, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(least, vec_id)) AS kept
FROM embeddings LEFT JOIN least USING (vec_id) LEFT JOIN counts USING (vec_id)"""

SHINGLES = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({UPPER.format("coalesce(text, '')")}, '{WORDS}') AS w FROM documents),
starts AS (SELECT doc_id, w, CAST(unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS BIGINT) AS i FROM d WHERE len(w) > 0),
s AS (SELECT DISTINCT doc_id, least(len(w), 4) || ' ' || array_to_string(w[i:i + 3], ' ') AS k FROM starts),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a AS doc_id, min(b) AS least FROM reach GROUP BY a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(doc_id, coalesce(least, doc_id)) AS component_id, doc_id = least(doc_id, coalesce(least, doc_id)) AS kept
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)"""

PHRASES = f"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({UPPER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
g AS (
  SELECT lang, 1 AS k, unnest(w) AS phrase FROM w
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM w),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
cut AS (
  SELECT c.*, 1 AS place, w[1] AS x, array_to_string(w[2:], ' ') AS y FROM c
  UNION ALL SELECT c.*, 2, w[1] || ' ' || w[2], w[3] FROM c WHERE k = 3),
s AS (
  SELECT cut.lang, cut.phrase, a, place, l.f AS l, r.f AS r, CAST((1000000::HUGEINT * a * a) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM cut JOIN f l ON l.lang = cut.lang AND l.phrase = x JOIN f r ON r.lang = cut.lang AND r.phrase = y),
least AS (SELECT lang, phrase, a, l, r, score FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, place) = 1),
longer AS (
  SELECT lang, phrase, max(a) AS most FROM (
    SELECT lang, w[1] || ' ' || w[2] AS phrase, a FROM c WHERE k = 3 UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM c WHERE k = 3)
  GROUP BY ALL)
SELECT least.lang, row_number() OVER (PARTITION BY least.lang ORDER BY score DESC, a DESC, least.phrase) AS rank, least.phrase, a, l, r, n, score
FROM least JOIN totals USING (lang) LEFT JOIN longer ON longer.lang = least.lang AND longer.phrase = least.phrase
WHERE most IS NULL OR 100 * most < 50 * a QUALIFY rank <= 2000"""
