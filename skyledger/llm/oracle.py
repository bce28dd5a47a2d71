"""SQL of the queries whose results SQL can state, over the driver tables."""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANK_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_ALNUM_WORDS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

MAXSCORE = """
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
        CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))) AS BIGINT) AS score
    FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 100 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM scored
)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM ranked WHERE n <= 10
"""

DECONTAMINATE = f"""
WITH docs AS (
    SELECT doc_id, {_ALNUM_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents
), items AS (
    SELECT CAST(item_id AS VARCHAR) AS item, {_ALNUM_WORDS.format(_LOWER.format("text"))} AS w FROM benchmark WHERE text IS NOT NULL
), item_windows AS (
    SELECT item, least(len(w), 10) AS k, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS gram
    FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM items WHERE len(w) > 0)
), doc_windows AS (
    SELECT doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') AS gram
    FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM docs, (SELECT DISTINCT k FROM item_windows) WHERE len(w) >= k)
), hits AS (
    SELECT DISTINCT doc_id, i, k, item FROM doc_windows JOIN item_windows USING (k, gram)
), hit_words AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id
), hit_items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
    FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

REPEATS = f"""
WITH docs AS (
    SELECT doc_id, {_BLANK_WORDS.format("coalesce(text, '')")} AS w FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS gram
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM docs WHERE len(w) >= 20)
), later AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY gram ORDER BY doc_id, i) AS n FROM windows) WHERE n > 1
), removed AS (
    SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 20)) AS p FROM later)
), words AS (
    SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM docs
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text FROM words ANTI JOIN removed USING (doc_id, p) GROUP BY doc_id
), gone AS (
    SELECT doc_id, count(*) AS n FROM removed GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(gone.n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id) LEFT JOIN gone USING (doc_id)
"""

MINHASH = f"""
WITH RECURSIVE docs AS (
    SELECT doc_id, {_BLANK_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM docs WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
    SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * common.n >= 75 * (x.n + y.n - common.n)
), reach (doc_id, other) AS (
    SELECT doc_id, doc_id FROM docs UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a
)
SELECT doc_id, coalesce(any_value(sizes.n), 0) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""

PHRASES = f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents
), words AS (
    SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w FROM pieces
), totals AS (
    SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang
), grams AS (
    SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*) AS f
    FROM (SELECT lang, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM words, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k)
    GROUP BY ALL HAVING f >= 100
), candidates AS (
    SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE k >= 2
), cuts AS (
    SELECT c.lang, c.phrase, c.a, cut, x.f AS l, y.f AS r, n,
        CAST(1000 AS HUGEINT) * c.a * n // (CAST(x.f AS HUGEINT) * y.f) AS score
    FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates) c
    JOIN grams x ON x.lang = c.lang AND x.phrase = array_to_string(w[1 : cut], ' ')
    JOIN grams y ON y.lang = c.lang AND y.phrase = array_to_string(w[cut + 1 : c.k], ' ')
    JOIN totals t ON t.lang = c.lang
), scored AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inner_phrases AS (
    SELECT lang, array_to_string(w[i : i + s - 1], ' ') AS phrase, max(a) AS longer
    FROM (SELECT lang, w, a, s, unnest(range(1, k - s + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS s FROM candidates))
    GROUP BY ALL
), ranked AS (
    SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, s.a DESC, s.phrase) AS rank
    FROM scored s LEFT JOIN inner_phrases i ON i.lang = s.lang AND i.phrase = s.phrase
    WHERE i.longer IS NULL OR 100 * i.longer < 100 * s.a
)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000
"""

SUFFIXES = """
WITH docs AS (
    SELECT row_number() OVER () AS d, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), windows AS (
    SELECT d, i, md5(substr(h, 2 * i + 1, 400)) AS gram FROM (SELECT d, h, unnest(range(0, strlen(h) // 2 - 199)) AS i FROM docs WHERE strlen(h) >= 400)
), covered AS (
    SELECT d, i FROM windows WHERE gram IN (SELECT gram FROM windows GROUP BY gram HAVING count(*) > 1)
), edges AS (
    SELECT d, i, coalesce(i - lag(i) OVER (PARTITION BY d ORDER BY i) > 200, true) AS new FROM covered
), spans AS (
    SELECT d, min(i) AS a, max(i) + 200 AS b FROM (SELECT d, i, sum(new::INT) OVER (PARTITION BY d ORDER BY i) AS span FROM edges) GROUP BY d, span
), kept AS (
    SELECT d, string_agg(substr(h, 2 * prev + 1, 2 * (a - prev)), '' ORDER BY a) AS k
    FROM (SELECT d, h, a, coalesce(lag(b) OVER (PARTITION BY d ORDER BY a), 0) AS prev
          FROM (SELECT d, a, b FROM spans UNION ALL SELECT d, strlen(h) // 2, NULL FROM docs) JOIN docs USING (d))
    GROUP BY d
), gone AS (
    SELECT d, sum(b - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY d
)
SELECT doc_id, CAST(strlen(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
    coalesce(n_spans, 0) AS n_spans, sha256(unhex(k)) AS kept_sha256
FROM docs JOIN kept USING (d) LEFT JOIN gone USING (d)
"""


def _rounds(rounds: int) -> str:
    """Assignments to the centroids of each round, and the centroids after it."""
    parts = []
    for r in range(rounds + 1):
        parts.append(f"""
a{r} AS (
    SELECT i, vec_id, v, cluster, distance FROM (
        SELECT i, vec_id, x.v, c.cluster, CAST(list_sum(list_transform(list_zip(x.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS distance
        FROM vectors x CROSS JOIN c{r} c)
    QUALIFY row_number() OVER (PARTITION BY i ORDER BY distance, cluster) = 1
)""")
        if r < rounds:
            parts.append(f"""
m{r} AS (
    SELECT cluster, list(m ORDER BY k) AS v FROM (
        SELECT cluster, k, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS m
        FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS k FROM a{r}) GROUP BY cluster, k)
    GROUP BY cluster
), c{r + 1} AS (
    SELECT c.cluster, CAST(coalesce(m.v, c.v) AS BIGINT[]) AS v FROM c{r} c LEFT JOIN m{r} m ON m.cluster = c.cluster
)""")
    return ",".join(parts)


CENTROIDS = f"""
WITH vectors AS MATERIALIZED (
    SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS (
    SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS INTEGER) AS cluster, v FROM vectors
    QUALIFY row_number() OVER (ORDER BY sha256('2:' || vec_id), v) <= 40
),{_rounds(5)}
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
    CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a5 JOIN c5 c USING (cluster)
"""

ORACLE = {
    "op2_maxscore": MAXSCORE,
    "op3_decontaminate": DECONTAMINATE,
    "op6_repeats": REPEATS,
    "op10_minhash": MINHASH,
    "op11_phrases": PHRASES,
    "op12_suffix_dedup": SUFFIXES,
    "op13_centroids": CENTROIDS,
}
