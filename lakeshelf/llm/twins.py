"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from lakeshelf.llm import licenses, mixing, resampling, vector_codes


def mix_sql(seed: int = mixing.SEED, draws: int = mixing.DRAWS, ceiling: int = mixing.CEILING) -> str:
    """The mix: targets from the sources in the order in which they reach their ceiling, then the nearest draw."""
    weights = ", ".join(f"{w}.0" for w in mixing.WEIGHTS)
    by = f"{ceiling}.0 * source_size / weight, source"
    level = f"CAST(total - {ceiling} * capped AS DOUBLE) / left_weight"
    taken = "floor(u + step * (rank + 1)) - floor(u + step * rank)"
    return rf"""WITH sizes AS (SELECT doc_id, source,
  CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source),
weighed AS (SELECT *, CAST([{weights}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1] AS DOUBLE)
  AS weight FROM sources),
filled AS (SELECT *, sum(source_size) OVER () AS total, row_number() OVER (ORDER BY {by}) AS k,
  coalesce(sum(source_size) OVER (ORDER BY {by} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
  sum(weight) OVER (ORDER BY {by} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_weight FROM weighed),
level AS (SELECT {level} AS level FROM filled WHERE weight * ({level}) < {ceiling}.0 * source_size ORDER BY k LIMIT 1),
goals AS (SELECT source, source_size,
  least({ceiling}.0::DOUBLE * source_size, weight * coalesce((SELECT level FROM level), 0.0)) AS target FROM weighed),
steps AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS step FROM goals),
ranked AS (SELECT doc_id, s.source, size, source_size, target, step,
  row_number() OVER (PARTITION BY s.source ORDER BY size DESC, md5(concat_ws('|', {seed}, doc_id))) - 1 AS rank
  FROM sizes s JOIN steps g ON s.source IS NOT DISTINCT FROM g.source),
draws AS (SELECT source, i,
  CAST('0x' || substr(md5(concat_ws('|', {seed}, i, source)), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE AS u
  FROM steps CROSS JOIN range({draws}) t(i)),
tried AS (SELECT r.source, i, u, abs(sum(size * ({taken})) - any_value(target)) AS off
  FROM ranked r JOIN draws d ON r.source IS NOT DISTINCT FROM d.source GROUP BY r.source, i, u),
best AS (SELECT source, u FROM tried QUALIFY row_number() OVER (PARTITION BY source ORDER BY off, i) = 1)
SELECT doc_id, r.source, size, source_size, target, CAST({taken} AS BIGINT) AS copies,
  CAST({taken} AS BIGINT) * size AS taken
FROM ranked r JOIN best b ON r.source IS NOT DISTINCT FROM b.source"""


def license_sql() -> str:
    """All windows of the templates' lengths, without bands: a band missed would show as a missing row."""
    listed = ", ".join(f"('{name}', '{text}')" for name, text in licenses.TEMPLATES)
    words = r"list_filter(string_split(regexp_replace(lower({}), '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' '), lambda x: x <> '')"
    runs = "list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))"
    return rf"""WITH given(license, t) AS (VALUES {listed}),
templates AS (SELECT license, len(w) AS n, greatest(1, len(w) // 4) AS step, list_distinct({runs}) AS wanted
  FROM (SELECT license, {words.format("t")} AS w FROM given)),
lengths AS (SELECT DISTINCT n, step FROM templates),
texts AS (SELECT doc_id, {runs} AS h FROM (SELECT doc_id, {words.format("text")} AS w FROM documents
  WHERE regexp_matches(lower(text), 'licen|permission|redistribut|documentation|unencumbered|international')) WHERE len(w) >= 5),
spread AS (SELECT doc_id, h, n, step, unnest(range(0, len(h), step)) AS start FROM texts CROSS JOIN lengths),
shares AS (SELECT doc_id, license, s.n, start, s.step,
  len(list_intersect(wanted, h[start + 1:start + s.n + s.step - 4])) / len(wanted) AS share
  FROM spread s JOIN templates t ON s.n = t.n),
best AS (SELECT doc_id, license, share, start, n + step AS width FROM shares WHERE share >= 0.8 - 1e-9
  QUALIFY row_number() OVER (PARTITION BY doc_id, license ORDER BY share DESC, start, n DESC) = 1)
SELECT doc_id, license, share, CAST(start AS INTEGER) AS start_word, CAST(width AS INTEGER) AS n_words FROM best x
WHERE NOT EXISTS (SELECT 1 FROM best y WHERE y.doc_id = x.doc_id AND y.share > x.share
  AND y.start < x.start + x.width AND x.start < y.start + y.width)"""


def codes_sql(parts: int = vector_codes.PARTS, entries: int = vector_codes.ENTRIES, rounds: int = vector_codes.ROUNDS) -> str:
    """Lloyd's rounds written out, every part against every entry in every round."""
    away = "CAST(list_sum(list_transform(list_zip(x.v, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT)"
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, x.p, min(struct_pack(d := {away}, e := b.e)) AS near
  FROM parts x JOIN b{r} b ON x.p = b.p GROUP BY vec_id, x.p)""")
        if r < rounds:
            steps.append(f"""m{r} AS (SELECT p, e, place, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (SELECT x.p, near.e AS e,
  unnest(range(1, len(v) + 1)) AS place, unnest(v) AS x FROM parts x JOIN a{r} USING (vec_id, p)) GROUP BY p, e, place),
n{r} AS (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY place) AS c FROM m{r} GROUP BY p, e),
b{r + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(n.c, b.c) AS c FROM b{r} b LEFT JOIN n{r} n ON b.p = n.p AND b.e = n.e)""")
    cut = f"v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})]"
    return f"""WITH kept AS MATERIALIZED (SELECT vec_id, label,
  list_transform(embedding, lambda x: CAST(floor({vector_codes.SCALE}.0::DOUBLE * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT vec_id, p, {cut} AS v FROM kept CROSS JOIN range({parts}) t(p)),
first AS (SELECT v, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT {entries}),
b0 AS MATERIALIZED (SELECT p, e, {cut} AS c FROM first CROSS JOIN range({parts}) t(p)),
{", ".join(steps)},
coded AS (SELECT vec_id, string_agg(lower(printf('%02x', CAST(near.e AS INTEGER))), '' ORDER BY p) AS code,
  CAST(sum(near.d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id),
books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS digest FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, digest AS codebooks_sha256
FROM coded JOIN kept USING (vec_id) CROSS JOIN books"""


def resample_sql(buckets: int = resampling.BUCKETS, seed: int = resampling.SEED) -> str:
    """All features one by one; CRC-32 bit by bit for its table, byte by byte for each different feature."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = rf"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    runs = " || ".join(f"list_transform(range(1, len(w) - {k - 2}), lambda i: array_to_string(w[i:i + {k - 1}], ' '))" for k in (1, 2, 3))
    bit = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END"
    codes = "list_transform(range(octet_length(encode(gram))), lambda i: CAST('0x' || substr(hex(encode(gram)), 2 * i + 1, 2) AS UBIGINT))"
    share, of = resampling.SHARE
    return f"""WITH crc AS MATERIALIZED (SELECT list_transform(range(256), lambda x: list_reduce(
  [CAST(x AS UBIGINT), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, i: {bit})) AS t),
texts AS (SELECT doc_id, {words} AS w, false AS wanted FROM documents UNION ALL SELECT NULL, {words}, true FROM benchmark),
held AS (SELECT doc_id, wanted, len(w) AS n_words, {runs} AS grams FROM texts),
each AS MATERIALIZED (SELECT doc_id, wanted, unnest(grams) AS gram FROM held),
hashed AS MATERIALIZED (SELECT gram, CAST(xor(list_reduce(list_prepend(4294967295::UBIGINT, {codes}),
  lambda c, b: xor(t[CAST((xor(c, b) & 255) + 1 AS BIGINT)], c >> 8)), 4294967295::UBIGINT) % {buckets} AS INTEGER) AS bucket
  FROM (SELECT DISTINCT gram FROM each) CROSS JOIN crc),
placed AS MATERIALIZED (SELECT doc_id, wanted, bucket FROM each JOIN hashed USING (gram)),
counts AS (SELECT bucket, count(*) FILTER (WHERE NOT wanted) AS s, count(*) FILTER (WHERE wanted) AS t FROM placed GROUP BY bucket),
gains AS (SELECT bucket, CAST(floor({resampling.SCALE} * ln(CAST(t + 1 AS DOUBLE) * (sum(s) OVER () + {buckets})
  / (CAST(s + 1 AS DOUBLE) * (sum(t) OVER () + {buckets})))) AS BIGINT) AS gain FROM counts),
weighed AS (SELECT doc_id, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight FROM placed JOIN gains USING (bucket)
  WHERE NOT wanted GROUP BY doc_id),
scored AS (SELECT doc_id, n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + CAST(floor(-{resampling.SCALE}.0::DOUBLE
    * ln(-ln((CAST('0x' || substr(sha256('{seed}:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM held LEFT JOIN weighed USING (doc_id) WHERE NOT wanted),
fit AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n
  FROM scored WHERE n_words >= {resampling.LEAST_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= {share} * n // {of} THEN rank END AS rank
FROM scored LEFT JOIN fit USING (doc_id)"""
