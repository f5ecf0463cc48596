"""SQL twins of the corpus queries, for DuckDB."""

OP1 = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM placed WHERE rank <= 5
"""

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"
# measure, slack of the quartile distance, whether it has a lower fence
FENCED = (("m_word", 50, True), ("m_symbol", 100, False), ("m_dup_line", 500, False), ("m_repeat", 300, False))


def fence_levels() -> str:
    """Quartile fences per (lang, source), per lang and over all, from the bucket counts."""
    parts = []
    for name, keys in (("fine", "lang, source"), ("coarse", "lang"), ("whole", "1")):
        columns = ["max(total) AS n_rows"]
        for measure, slack, two_sided in FENCED:
            q1, q3 = (f"min(bucket) FILTER (WHERE measure = '{measure}' AND 4 * cum >= {k} * total)" for k in (1, 3))
            spread = f"3 * greatest({q3} - {q1}, {slack})"
            columns.append(f"{q3} + {spread} AS {measure}_high")
            if two_sided:
                columns.append(f"{q1} - {spread} AS {measure}_low")
        group = "" if keys == "1" else f"{keys}, "
        parts.append(f"""{name} AS (
  SELECT {group}{', '.join(columns)} FROM (
    SELECT {group}measure, bucket, sum(n) OVER (PARTITION BY {keys}, measure ORDER BY bucket) AS cum,
           sum(n) OVER (PARTITION BY {keys}, measure) AS total
    FROM (SELECT {group}measure, bucket, count(*) AS n FROM entries GROUP BY {group}measure, bucket)
  ) {'' if keys == '1' else 'GROUP BY ' + keys}
)""")
    return ",\n".join(parts)


def inside_fences() -> str:
    tests = []
    for measure, _, two_sided in FENCED:
        for side, sign in (("high", "<="), ("low", ">=")) if two_sided else (("high", "<="),):
            at = (f"CASE WHEN f.n_rows >= 200 THEN f.{measure}_{side} WHEN c.n_rows >= 200 THEN c.{measure}_{side} "
                  f"WHEN f.n_rows > 0 THEN w.{measure}_{side} END")
            tests.append(f"coalesce({measure} {sign} {at}, true)")
    return " AND ".join(tests)


OP5 = f"""
WITH texts AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '{WORD}') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines
  FROM documents
), windows AS (
  SELECT rid, i, array_to_string(w[i:i + 7], ' ') AS s FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM texts)
), twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, s) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM (SELECT rid, i, unnest(range(8)) AS k FROM twice) GROUP BY rid
), counted AS (
  SELECT t.rid, doc_id, lang, source, length(body) AS chars, len(lines) AS n_lines, len(w) AS n_words,
         length(regexp_replace(body, '{SPACE}', '', 'g')) AS word_chars,
         length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
  FROM texts t LEFT JOIN covered c USING (rid)
), measured AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         100 * word_chars // greatest(n_words, 1) AS m_word, 10000 * n_symbols // greatest(chars, 1) AS m_symbol,
         10000 * n_dup_lines // greatest(n_lines, 1) AS m_dup_line, 10000 * n_repeat_words // greatest(n_words, 1) AS m_repeat
  FROM counted
), entries AS (
  SELECT lang, source, measure, (v >> scale) << scale AS bucket FROM (
    SELECT lang, source, measure, v, greatest(length(bin(v)) - 7, 0) AS scale FROM (
      {" UNION ALL ".join(f"SELECT lang, source, '{m}' AS measure, {m}::BIGINT AS v FROM measured WHERE NOT base_failed" for m, _, _ in FENCED)}))
), {fence_levels()}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {inside_fences()} AS kept
FROM measured m
LEFT JOIN fine f ON m.lang IS NOT DISTINCT FROM f.lang AND m.source IS NOT DISTINCT FROM f.source
LEFT JOIN coarse c ON m.lang IS NOT DISTINCT FROM c.lang
CROSS JOIN whole w
"""

OP6 = f"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w
  FROM documents
), sets AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM texts WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
), reach AS (
  SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.r = links.a
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, c.component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) c ON c.doc_id = d.doc_id
"""

# crc32 of a number's decimal digits: every byte enters and is followed by eight shifts
CRC32 = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
    string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda crc, s: CASE WHEN s >= 0 THEN xor(crc, s) ELSE xor(crc >> 1, 3988292384 * (crc & 1)) END), 4294967295)"""

OP11 = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, {CRC32} % 4 AS part,
         ' ' || trim(regexp_replace(lower(coalesce(text, '')), '[^\p{{L}}]+', ' ', 'g')) || ' ' AS body
  FROM documents
), chars AS (
  SELECT rid, unnest(string_split(body, '')) AS c, generate_subscripts(string_split(body, ''), 1) AS pos
  FROM texts WHERE length(body) > 2
), placed AS (
  SELECT rid, unicode(c)::BIGINT AS a, lead(unicode(c)::BIGINT, 1) OVER w AS b, lead(unicode(c)::BIGINT, 2) OVER w AS d
  FROM chars WINDOW w AS (PARTITION BY rid ORDER BY pos)
), grams AS (
  SELECT rid, gram, count(*) AS n FROM (
    SELECT rid, a AS gram FROM placed WHERE a <> 32
    UNION ALL SELECT rid, a * 2097152 + b FROM placed WHERE b IS NOT NULL
    UNION ALL SELECT rid, (a * 2097152 + b) * 2097152 + d FROM placed WHERE d IS NOT NULL AND b <> 32
  ) GROUP BY rid, gram
), profiles AS (
  SELECT lang, gram, row_number() OVER (PARTITION BY lang ORDER BY sum(n) DESC, gram) - 1 AS place
  FROM grams JOIN texts USING (rid) WHERE lang IS NOT NULL AND part <> 2 GROUP BY lang, gram
  QUALIFY place < 300
), own AS (
  SELECT rid, gram, row_number() OVER (PARTITION BY rid ORDER BY n DESC, gram) - 1 AS place FROM grams QUALIFY place < 300
), distances AS (
  SELECT rid, l.lang, sum(coalesce(abs(o.place - p.place), 300))::BIGINT AS distance, count(*) AS grams
  FROM own o CROSS JOIN (SELECT DISTINCT lang FROM profiles) l LEFT JOIN profiles p ON p.lang = l.lang AND p.gram = o.gram
  GROUP BY rid, l.lang
), best AS (
  SELECT * FROM distances QUALIFY row_number() OVER (PARTITION BY rid ORDER BY distance, lang) = 1
)
SELECT doc_id, coalesce(part = 2, false) AS held_out, coalesce(best.lang, 'und') AS lang_pred,
       CASE WHEN best.lang IS NULL THEN 0.0::DOUBLE ELSE 1.0::DOUBLE - distance::DOUBLE / (300 * grams)::DOUBLE END AS score
FROM texts LEFT JOIN best USING (rid)
"""

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
FOLDED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP12 = f"""
WITH texts AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({FOLDED}, '{TERM}') AS found FROM documents
), held AS (
  SELECT rid, doc_id, found, len(found)::BIGINT AS n FROM texts WHERE len(found) > 0
), totals AS (
  SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM held
), tf AS (
  SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(found) AS term FROM held) GROUP BY rid, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tf CROSS JOIN totals GROUP BY term, n_docs
), asked AS (
  SELECT item_id, asked_text, term, count(*) AS times FROM (
    SELECT item_id, text AS asked_text, unnest(regexp_extract_all({FOLDED}, '{TERM}')) AS term
    FROM (SELECT DISTINCT item_id, text FROM benchmark)
  ) GROUP BY item_id, asked_text, term
), scored AS (
  SELECT item_id, asked_text, rid, doc_id,
         sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN held USING (rid) CROSS JOIN totals
  GROUP BY item_id, asked_text, rid, doc_id
), placed AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id, asked_text ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank,
         doc_id, score
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 20
"""


def op13(clusters: int = 40, rounds: int = 5, salt: int = 2) -> str:
    """Every round is a step of its own."""
    assigned = """assigned{r} AS MATERIALIZED (
  SELECT rid, vec_id, v, cluster, distance FROM (
    SELECT rid, vec_id, v, cluster, list_sum(list_transform(list_zip(v, centroid), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS distance
    FROM vectors CROSS JOIN centroids{r}
  ) QUALIFY row_number() OVER (PARTITION BY rid ORDER BY distance, cluster) = 1
)"""
    moved = """moved{r} AS (
  SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY pos) AS centroid FROM (
    SELECT cluster, pos, sum(x)::BIGINT AS s, count(*)::BIGINT AS n FROM (
      SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM assigned{r}) GROUP BY cluster, pos
  ) GROUP BY cluster
), centroids{next} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.centroid, c.centroid) AS centroid FROM centroids{r} c LEFT JOIN moved{r} m USING (cluster)
)"""
    steps = []
    for r in range(rounds):
        steps += [assigned.format(r=r), moved.format(r=r, next=r + 1)]
    steps.append(assigned.format(r=rounds))
    return f"""
WITH vectors AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), centroids0 AS MATERIALIZED (
  SELECT cluster, v AS centroid FROM (
    SELECT v, (row_number() OVER (ORDER BY sha256('{salt}:' || vec_id) NULLS LAST, v) - 1)::INTEGER AS cluster FROM vectors
  ) WHERE cluster < {clusters}
), {', '.join(steps)}
SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(centroid, ',')) AS centroid_sha256
FROM assigned{rounds} JOIN centroids{rounds} USING (cluster)
"""


ORACLES: dict[str, str] = {
    "op1_pivot_search": OP1, "op5_quality_rules": OP5, "op6_jaccard_join": OP6,
    "op11_rank_order_language": OP11, "op12_shared_term_search": OP12, "op13_bitplane_clusters": op13(),
}
