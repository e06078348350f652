"""DuckDB SQL for the results of the queries that SQL can express."""

WORDS = r"regexp_extract_all(coalesce({text}, ''), '[^\x20\x09-\x0D]+')"
HAS_WORD = r"regexp_matches({line}, '[^\x20\x09-\x0D]')"


def _words(text: str) -> str:
    return WORDS.format(text=text)


QUALITY_RULES = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS text,
           {_words("text")} AS words
    FROM documents
), lines AS (
    SELECT row, source, unnest(string_split(text, chr(10))) AS line FROM docs
), worded AS (
    SELECT row, source, line, length(line) AS chars,
           regexp_replace(
               trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g')), '[0-9]', '0', 'g'
           ) AS normal
    FROM lines WHERE {HAS_WORD.format(line="line")}
), frequent AS (
    SELECT source, normal FROM worded GROUP BY ALL HAVING count(DISTINCT row) > 100
), shares AS (
    SELECT row, count(*) - count(DISTINCT line) AS n_dup_lines, sum(chars) AS total,
           coalesce(sum(chars) FILTER (WHERE f.normal IS NOT NULL), 0) AS gone
    FROM worded w LEFT JOIN frequent f
      ON w.normal = f.normal AND w.source IS NOT DISTINCT FROM f.source
    GROUP BY row
), places AS (
    SELECT row, words, unnest(range(1, len(words) - 1)) AS p FROM docs WHERE len(words) > 3
), windows AS (
    SELECT row, p, count(*) OVER (PARTITION BY row, words[p], words[p + 1], words[p + 2]) AS n
    FROM places
), covered AS (
    SELECT row, count(DISTINCT p + k) AS n_repeat_words
    FROM windows, (VALUES (0), (1), (2)) AS offsets(k)
    WHERE n > 1 GROUP BY row
), counts AS (
    SELECT d.row, doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
           coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
           CASE WHEN coalesce(total, 0) = 0 THEN 1.0 ELSE 1 - gone / total END AS share
    FROM docs d LEFT JOIN shares s ON d.row = s.row LEFT JOIN covered c ON d.row = c.row
), judged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND share >= 0.5 AS kept
FROM judged
"""

MIXING = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id, source, len({_words("text")}) AS size
    FROM documents
), sizes AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source
), ranked AS (
    SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS w,
           3.0::DOUBLE * source_size AS cap
    FROM sizes
), leveled AS (
    SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (
                  ORDER BY cap / w, source NULLS LAST
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(w) OVER (ORDER BY cap / w, source NULLS LAST
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
           row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS place
    FROM ranked
), final AS (
    SELECT *, (SELECT arg_min(level, place) FROM leveled WHERE level * w <= cap) AS final
    FROM leveled
), goals AS (
    SELECT source, source_size, least(cap, coalesce(final * w, cap)) AS target FROM final
), queue AS (
    SELECT row, doc_id, size, target, pass,
           md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS place,
           (pass * source_size + sum(size) OVER (
                PARTITION BY source, pass ORDER BY place, doc_id, size, row
                ROWS UNBOUNDED PRECEDING)) / target AS finish
    FROM docs JOIN goals USING (source), (VALUES (0), (1), (2)) AS passes(pass)
    WHERE target > 0
), used AS (
    SELECT row, sum(size) OVER (
               ORDER BY finish, place, pass, row ROWS UNBOUNDED PRECEDING) AS used
    FROM queue WHERE size > 0
), taken AS (
    SELECT row, count(*) AS passes FROM used
    WHERE used <= (SELECT sum(target) FROM goals) GROUP BY row
)
SELECT doc_id, size, source_size, target, (size * coalesce(passes, 0))::BIGINT AS taken
FROM docs JOIN goals ON docs.source IS NOT DISTINCT FROM goals.source LEFT JOIN taken USING (row)
"""

EXACT_DEDUP = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (same ORDER BY doc_id DESC) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

SUFFIX_DEDUP = """
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id, hex(encode(coalesce(text, ''))) AS digits
    FROM documents
), keys AS (
    SELECT row, doc_id, unnest(range(len(digits) // 2 - 99)) AS p,
           unnest(list_transform(range(len(digits) // 2 - 99),
                                 lambda p: md5(substr(digits, 2 * p + 1, 200)))) AS key
    FROM docs WHERE len(digits) >= 200
), later AS (
    SELECT row, p FROM keys
    QUALIFY row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, row, p) > 1
), islands AS (
    SELECT row, p, sum(new) OVER (PARTITION BY row ORDER BY p) AS island
    FROM (SELECT *, (p > coalesce(lag(p) OVER (PARTITION BY row ORDER BY p), -200) + 100)::INT
                    AS new
          FROM later)
), spans AS (
    SELECT row, min(p) AS low, max(p) + 100 AS high FROM islands GROUP BY row, island
), gaps AS (
    SELECT row, low, high, coalesce(lag(high) OVER (PARTITION BY row ORDER BY low), 0) AS before
    FROM spans
), kept AS (
    SELECT row, sum(high - low)::BIGINT AS n_removed, count(*) AS n_spans, max(high) AS last,
           string_agg(substr(digits, 2 * before + 1, 2 * (low - before)), '' ORDER BY low) AS head
    FROM gaps JOIN docs USING (row) GROUP BY row
)
SELECT doc_id, len(digits) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed,
       coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(digits, 2 * coalesce(last, 0) + 1)))
           AS kept_sha256
FROM docs LEFT JOIN kept USING (row)
"""

SUBSTRING_DEDUP = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id, {_words("text")} AS words FROM documents
), places AS (
    SELECT row, unnest(range(1, len(words) - 33)) AS p,
           unnest(list_transform(range(1, len(words) - 33),
                                 lambda p: md5(array_to_string(words[p:p + 34], ' ')))) AS key
    FROM docs WHERE len(words) >= 35
), windows AS (
    SELECT row, p, count(*) OVER (PARTITION BY key) AS n FROM places
), covered AS (
    SELECT DISTINCT row, p + k AS i FROM windows, range(35) AS offsets(k) WHERE n > 1
), listed AS (
    SELECT row, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM docs
), kept AS (
    SELECT row, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text
    FROM listed ANTI JOIN covered USING (row, i) GROUP BY row
)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (row)
"""

NGRAM_JACCARD = rf"""
WITH RECURSIVE docs AS (
    SELECT row_number() OVER () AS row, doc_id,
           {WORDS.format(text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
               AS words
    FROM documents
), listed AS (
    SELECT row, words, unnest(range(1, greatest(len(words) - 3, 2))) AS p FROM docs
    WHERE len(words) > 0
), shingles AS (
    SELECT DISTINCT row, words[p:p + 4] AS shingle FROM listed
), sizes AS (
    SELECT row, count(*) AS n FROM shingles GROUP BY row
), common AS (
    SELECT a.row AS a, b.row AS b, count(*) AS shared
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.row <> b.row GROUP BY ALL
), links AS (
    SELECT a, b FROM common JOIN sizes x ON x.row = a JOIN sizes y ON y.row = b
    WHERE 100 * shared >= 80 * (x.n + y.n - shared)
), reached AS (
    SELECT row AS a, row AS b FROM docs
    UNION
    SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b
), least AS (
    SELECT r.a AS row, min(d.doc_id) AS component_id
    FROM reached r JOIN docs d ON d.row = r.b GROUP BY r.a
), degrees AS (
    SELECT a AS row, count(*) AS n_links FROM links GROUP BY a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, coalesce(n_links, 0) AS n_links
FROM docs JOIN least USING (row) LEFT JOIN sizes USING (row) LEFT JOIN degrees USING (row)
"""

TERMS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
    r" 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)

LEXICAL_SEARCH = f"""
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id, {TERMS} AS terms FROM documents
), totals AS (
    SELECT count(*) FILTER (WHERE len(terms) > 0) AS documents, sum(len(terms))::BIGINT AS total
    FROM docs
), items AS (
    SELECT row_number() OVER () AS item, item_id, {TERMS} AS terms FROM benchmark
), asked AS (
    SELECT item, item_id, term, count(*) AS times
    FROM (SELECT item, item_id, unnest(terms) AS term FROM items) GROUP BY ALL
), counts AS (
    SELECT row, doc_id, n, term, count(*) AS tf
    FROM (SELECT row, doc_id, len(terms) AS n, unnest(terms) AS term FROM docs) GROUP BY ALL
), weights AS (
    SELECT term,
           floor(1000 * ln((2 * any_value(documents) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM counts, totals GROUP BY term
), impacts AS (
    SELECT row, doc_id, term,
           (1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * documents) // total)) AS impact
    FROM counts, totals
), scores AS (
    SELECT item, item_id, row, doc_id, sum(times * w * impact)::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN impacts USING (term) GROUP BY ALL
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank
    FROM scores WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""

# Words q apart agree over max(12 - q, q) places of a run at least, and so over 6.
PERIODIC_RUNS = rf"""
WITH crc_table AS (
    SELECT list_transform(range(256), lambda i: list_reduce(
        [i, 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
        lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
    )) AS steps
), docs AS (
    SELECT row_number() OVER () AS row, doc_id, {_words("text")} AS words,
           list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)) AS digits
    FROM documents
), hashed AS (
    SELECT row, doc_id, words, len(words) AS n, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, digits::BIGINT[]),
        lambda c, d: xor(c >> 8, steps[(xor(c, d) & 255) + 1])
    )) AS h
    FROM docs, crc_table
), placed AS (
    SELECT *, CASE WHEN n > 0 THEN (h // 10) % n END AS a,
           CASE WHEN n > 0 THEN 1 + (n - (h // 10) % n) // (3 + (h // 10) % 8) END AS p
    FROM hashed
), texts AS (
    SELECT row, doc_id, n,
           CASE WHEN h % 10 = 0 AND n > 0
                THEN list_transform(range(n), lambda i:
                         words[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1])
                ELSE words END AS words
    FROM placed
), places AS (
    SELECT row, n, words, unnest(range(n)) AS i FROM texts
), grams AS (
    SELECT row, i, words[i + 1:i + 6] AS gram FROM places WHERE i + 6 <= n
), agreeing AS (
    SELECT x.row, x.i, y.i - x.i AS q
    FROM grams x JOIN grams y ON x.row = y.row AND x.gram = y.gram AND x.i < y.i
), parts AS (
    SELECT row, q, i, i - row_number() OVER (PARTITION BY row, q ORDER BY i) AS part FROM agreeing
), stretches AS (
    SELECT row, q, min(i) AS start, count(*) + 5 + q AS length FROM parts GROUP BY row, q, part
), runs AS (
    SELECT row, start, length, min(q) AS period FROM stretches
    WHERE length >= greatest(12, 2 * q) GROUP BY row, start, length
), listed AS (
    SELECT row, count(*) AS n_runs,
           string_agg(start || ',' || length || ',' || period || chr(10), ''
                      ORDER BY start, period) AS lines,
           max({{'length': length, 'start': -start, 'period': -period}}) AS best
    FROM runs GROUP BY row
), gone AS (
    SELECT DISTINCT row, unnest(range(start + period, start + length)) AS i FROM runs
), kept AS (
    SELECT row, string_agg(words[i + 1], ' ' ORDER BY i) AS collapsed
    FROM places ANTI JOIN gone USING (row, i) GROUP BY row
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, -best.start AS start, best.length AS length,
       -best.period AS period, (1000 * best.length) // -best.period AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM texts LEFT JOIN listed USING (row) LEFT JOIN kept USING (row)
"""

NEAR_VECTORS = """
WITH RECURSIVE vectors AS (
    SELECT row_number() OVER () AS row, vec_id, embedding::DOUBLE[] AS v FROM embeddings
), directed AS (
    SELECT * FROM vectors
    WHERE len(list_filter(v, lambda x: x <> 0)) > 0
      AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), links AS (
    SELECT a.row AS a, b.row AS b FROM directed a JOIN directed b
    ON a.row <> b.row AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95
), reached AS (
    SELECT row AS a, row AS b FROM vectors
    UNION
    SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b
), least AS (
    SELECT r.a AS row, min(vec_id) AS component_id
    FROM reached r JOIN vectors v ON v.row = r.b GROUP BY r.a
), degrees AS (
    SELECT a AS row, count(*) AS n_links FROM links GROUP BY a
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id,
       component_id IS NOT DISTINCT FROM vec_id AS kept
FROM vectors JOIN least USING (row) LEFT JOIN degrees USING (row)
"""

ORACLE = {
    "op1_quality_rules": QUALITY_RULES,
    "op3_mixing": MIXING,
    "op4_suffix_array_dedup": SUFFIX_DEDUP,
    "op5_exact_dedup": EXACT_DEDUP,
    "op7_ngram_jaccard": NGRAM_JACCARD,
    "op9_substring_dedup": SUBSTRING_DEDUP,
    "op11_lexical_search": LEXICAL_SEARCH,
    "op12_periodic_runs": PERIODIC_RUNS,
    "op13_embedding_forest": NEAR_VECTORS,
}
