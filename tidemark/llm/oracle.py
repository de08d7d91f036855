"""Independent SQL for the operators that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

def _url_level(width: int, before: str) -> str:
    """Chances after contexts of ``width`` symbols, smoothed by those of the level before."""
    size = 32 ** (width + 1)
    chance = {c: f"{before}.{c}" if before else "(1.0::DOUBLE / 32)" for c in ("pa", "pr")}
    joined = f"JOIN {before} ON {before}.code = c.code" if before else ""
    return f"""own{width} AS (
  SELECT code % {size} AS short, sum(a) AS a, sum(r) AS r FROM url_counts GROUP BY 1
), context{width} AS (
  SELECT short // 32 AS context, sum(a) AS all_a, sum(r) AS all_r,
    count(*) FILTER (a > 0) AS kinds_a, count(*) FILTER (r > 0) AS kinds_r FROM own{width} GROUP BY 1
), level{width} AS (
  SELECT c.code,
    CASE WHEN all_a > 0 THEN (coalesce(o.a, 0) + kinds_a * {chance["pa"]}) / (all_a + kinds_a) ELSE {chance["pa"]} END AS pa,
    CASE WHEN all_r > 0 THEN (coalesce(o.r, 0) + kinds_r * {chance["pr"]}) / (all_r + kinds_r) ELSE {chance["pr"]} END AS pr
  FROM (SELECT unnest(range(0, 32768)) AS code) c {joined}
  LEFT JOIN own{width} o ON o.short = c.code % {size} LEFT JOIN context{width} x ON x.context = (c.code % {size}) // 32
)"""


OP1 = rf"""
WITH parted AS (
  SELECT row_number() OVER () AS row_id, page_id, coalesce(url, '') AS url,
    {_LOWER.format("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)")} AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
    {_LOWER.format("regexp_replace(coalesce(url, ''), '(?s)^.*?://', '')")} AS rest
  FROM pages
), ruled AS (
  SELECT *, ('0x' || md5(url)[1:4])::INT % 5 = 0 AS held,
    translate(regexp_replace(rest, '[^a-z0-9./-]', '_', 'g'), 'abcdefghijklmnopqrstuvwxyz0123456789./-',
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ[[[[[[[[[[\]^') AS s,
    CASE WHEN ('.' || host) LIKE '%.www.example.com' AND path LIKE '/en/%' THEN 'www.example.com/en/'
         WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/en/%' THEN 'example.com/en/'
         WHEN ('.' || host) LIKE '%.net' AND path LIKE '/es/%' THEN 'net/es/'
         WHEN ('.' || host) LIKE '%.net' AND path LIKE '/fr/%' THEN 'net/fr/'
         WHEN ('.' || host) LIKE '%.com' AND path LIKE '/%' THEN 'com/' END AS rule
  FROM parted
), judged AS (
  SELECT *, rule IN ('com/', 'www.example.com/en/') AS accepted FROM ruled
), runs AS (
  SELECT row_id, substr('@@' || s, pos, 3) AS run
  FROM (SELECT row_id, s, unnest(range(1, len(s) + 1)) AS pos FROM judged)
), coded AS (
  SELECT row_id, (ascii(run[1]) - 64) * 1024 + (ascii(run[2]) - 64) * 32 + ascii(run[3]) - 64 AS code FROM runs
), url_counts AS (
  SELECT code, count(*) FILTER (accepted) AS a, count(*) FILTER (NOT accepted) AS r
  FROM coded JOIN judged USING (row_id) WHERE rule IS NOT NULL AND NOT held GROUP BY code
), {_url_level(0, "")}, {_url_level(1, "level0")}, {_url_level(2, "level1")}, ratios AS (
  SELECT code, round((ln(pa) - ln(pr)) * 1000000)::BIGINT AS ratio FROM level2
), totals AS (
  SELECT row_id, sum(ratio) AS total FROM coded JOIN ratios USING (code) GROUP BY row_id
), scored AS (
  SELECT j.*, coalesce(floor(total / len(s)), 0)::BIGINT AS score FROM judged j LEFT JOIN totals USING (row_id)
), bins AS (
  SELECT floor(score / 10000) AS bin, count(*) FILTER (accepted) AS a, count(*) FILTER (NOT accepted) AS r
  FROM scored WHERE rule IS NOT NULL AND held GROUP BY 1
), gains AS (
  SELECT bin, coalesce(sum(r) OVER before, 0) / sum(r) OVER () - coalesce(sum(a) OVER before, 0) / sum(a) OVER () AS gain,
    sum(a) OVER () AS n_a, sum(r) OVER () AS n_r
  FROM bins WINDOW before AS (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), least AS (
  SELECT coalesce((SELECT bin * 10000 FROM gains WHERE n_a > 0 AND n_r > 0 ORDER BY gain DESC, bin LIMIT 1), 0) AS least
)
SELECT page_id, host, path, rule, score,
  CASE WHEN rule IS NOT NULL THEN CASE WHEN accepted THEN 'allow' ELSE 'block' END
       WHEN score >= (SELECT least FROM least) THEN 'allow' ELSE 'block' END AS verdict
FROM scored
"""

OP2 = rf"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS words FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(words) < 3 THEN list_aggregate(words, 'string_agg', ' ')
    ELSE words[pos] || ' ' || words[pos + 1] || ' ' || words[pos + 2] END AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 1, 2))) AS pos FROM texts WHERE len(words) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n FROM shingles a JOIN shingles b USING (shingle)
  WHERE a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT u, v FROM common c JOIN sizes a ON a.doc_id = u JOIN sizes b ON b.doc_id = v
  WHERE 100 * c.n >= 85 * (a.n + b.n - c.n)
), reached AS (
  SELECT doc_id AS u, doc_id AS v FROM documents
  UNION
  SELECT reached.u, links.v FROM reached JOIN links ON links.u = reached.v
), least AS (
  SELECT u AS doc_id, min(v) AS component_id FROM reached GROUP BY u
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents LEFT JOIN sizes USING (doc_id) JOIN least USING (doc_id)
"""

OP3 = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text, {_WORDS} AS words FROM documents
), windows AS (
  SELECT row_id, unnest(range(1, greatest(len(words) - 1, 1))) AS pos, words FROM texts
), grams AS (
  SELECT row_id, pos, count(*) OVER (PARTITION BY row_id, words[pos], words[pos + 1], words[pos + 2]) AS n FROM windows
), places AS (
  SELECT DISTINCT row_id, unnest([pos, pos + 1, pos + 2]) AS place FROM grams WHERE n > 1
), repeats AS (
  SELECT row_id, count(*) AS n_repeat_words FROM places GROUP BY row_id
), counted AS (
  SELECT doc_id, text, len(words) AS n_words, len(list_aggregate(words, 'string_agg', '')) AS word_chars,
    len(text) - len(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len([x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')]) AS full_lines,
    len(list_distinct([x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')])) AS own_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, len(string_split(text, chr(10))) AS n_lines,
    len(regexp_replace(text, '[^\p{{L}}]+', '', 'g')) AS letters,
    len(regexp_extract_all(text, '(^|\n)[\x20\x09]*[-•*][\x20\x09]')) AS bullets,
    len(regexp_extract_all(text, '(\.\.\.|…)[\x20\x09\x0D]*(\n|$)')) AS dots
  FROM texts LEFT JOIN repeats USING (row_id)
), filled AS (
  SELECT * REPLACE (coalesce(word_chars, 0) AS word_chars), full_lines - own_lines AS n_dup_lines,
    (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed
  FROM counted
)
SELECT doc_id, n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words
    OR 10 * n_dup_lines > 3 * n_lines OR 10 * letters < 6 * word_chars
    OR 10 * bullets > 9 * n_lines OR 10 * dots > 3 * n_lines) AS kept
FROM filled
"""

OP6 = rf"""
WITH sized AS (
  SELECT doc_id, source, len({_WORDS}) AS size, md5('17:' || coalesce(doc_id::VARCHAR, '')) AS seeded FROM documents
), sources AS (
  SELECT source, count(*) AS n_docs, sum(size)::BIGINT AS source_size,
    row_number() OVER (ORDER BY source NULLS LAST) AS r FROM sized GROUP BY source
), weighed AS (
  SELECT *, [5.0::DOUBLE, 2.0, 1.0][(r - 1) % 3 + 1] AS w, 2.0::DOUBLE * source_size AS cap FROM sources
), levels AS (
  SELECT a.r, a.cap / a.w AS ratio,
    ((SELECT sum(source_size) * 1.5::DOUBLE FROM weighed)
      - coalesce(sum(b.cap) FILTER (WHERE (b.cap / b.w, b.r) < (a.cap / a.w, a.r)), 0))
      / sum(b.w) FILTER (WHERE (b.cap / b.w, b.r) >= (a.cap / a.w, a.r)) AS level
  FROM weighed a, weighed b GROUP BY ALL
), targets AS (
  SELECT *, coalesce(least(cap, w * (SELECT arg_min(level, (ratio, r)) FROM levels WHERE level <= ratio)), cap) AS target
  FROM weighed
), source_seats AS (
  SELECT r, k, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, r, k) AS rank
  FROM (SELECT r, target, unnest(range(0, (target / 16)::BIGINT + 50)) AS k FROM targets WHERE target > 0)
), source_quotas AS (
  SELECT t.*, ceil(n_docs / 5000.0)::BIGINT AS n_shards,
    (SELECT count(*) FROM source_seats s WHERE s.r = t.r AND rank <= (SELECT round(sum(target) / 16) FROM targets)) AS quota
  FROM targets t
), placed AS (
  SELECT s.*, q.r, q.source_size, q.target, q.quota, ('0x' || seeded[1:8])::BIGINT % n_shards AS shard
  FROM sized s JOIN source_quotas q ON s.source IS NOT DISTINCT FROM q.source
), shards AS (
  SELECT r, shard, sum(size)::BIGINT AS shard_size, any_value(quota) AS quota FROM placed GROUP BY r, shard
), shard_seats AS (
  SELECT r, shard, quota, row_number() OVER (PARTITION BY r ORDER BY shard_size / (2 * k + 1) DESC, shard, k) AS rank
  FROM (SELECT *, unnest(range(0, quota + 1)) AS k FROM shards WHERE shard_size > 0)
), shard_quotas AS (
  SELECT h.r, h.shard, h.shard_size, ceil(h.shard_size / 16)::BIGINT AS blocks,
    least(2 * ceil(h.shard_size / 16)::BIGINT, (SELECT count(*) FROM shard_seats s WHERE s.r = h.r AND s.shard = h.shard AND rank <= h.quota)) AS quota
  FROM shards h
), streamed AS (
  SELECT p.*, q.blocks, q.quota AS shard_quota, CASE WHEN q.blocks > 0 THEN q.quota // q.blocks ELSE 0 END AS passes,
    coalesce(sum(size) OVER (PARTITION BY p.r, p.shard ORDER BY seeded, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begin_at
  FROM placed p JOIN shard_quotas q ON p.r = q.r AND p.shard = q.shard
)
SELECT doc_id, size, source_size, target,
  (passes * size + least(greatest((shard_quota - passes * blocks) * 16 - begin_at, 0), size))::BIGINT AS taken
FROM streamed
"""

OP9 = rf"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS place, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT *, {_LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM lines
), shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE len(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), judged AS (
  SELECT doc_id, place, line, coalesce(doc_id <> keeper, FALSE) AS dropped FROM keyed LEFT JOIN shared USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

_PII = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "TRUE"),
    ("ip", r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", "len([p FOR p IN string_split(m, '.') IF p::HUGEINT > 255]) = 0"),
    ("card", r"[0-9](?:[\x20-]?[0-9])+", "len(d) BETWEEN 12 AND 19 AND luhn % 10 = 0"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "len(d) BETWEEN 9 AND 15"),
)


def _matches(pattern: str, source: str) -> str:
    """Matches of a pattern with their places; gaps and matches alternate."""
    return rf"""SELECT row_id, m, (ends - len(m))::BIGINT AS s, ends::BIGINT AS e FROM (
    SELECT row_id, m, sum(len(g) + len(m)) OVER (PARTITION BY row_id ORDER BY i) AS ends FROM (
      SELECT row_id, unnest(ms) AS m, unnest(gs[:len(ms)]) AS g, unnest(range(1, len(ms) + 1)) AS i FROM (
        SELECT row_id, regexp_extract_all(text, '{pattern}') AS ms, string_split_regex(text, '{pattern}') AS gs
        FROM {source} WHERE regexp_matches(text, '{pattern}'))))"""


def _kind(rank: int, kind: str, pattern: str, check: str) -> str:
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    doubled = "CASE WHEN (len(d) - i) % 2 = 0 THEN d[i]::INT WHEN d[i]::INT > 4 THEN 2 * d[i]::INT - 9 ELSE 2 * d[i]::INT END"
    luhn = f"list_sum([{doubled} FOR i IN range(1, len(d) + 1)])" if kind == "card" else "0"
    return f"""SELECT row_id, s, {rank} AS rank, e, '{kind}' AS kind, m FROM (
    SELECT *, {luhn} AS luhn FROM (SELECT *, {digits} AS d FROM ({_matches(pattern, "texts")}))) WHERE {check}"""


_WORD = r"[\p{L}\p{N}]+"

OP10 = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents
), base AS (
  {" UNION ALL ".join(_kind(rank, *entry) for rank, entry in enumerate(_PII))}
), mentions AS (
  SELECT row_id, kind, CASE WHEN kind IN ('card', 'phone') THEN regexp_replace(m, '[^0-9]', '', 'g') ELSE lower(m) END AS value, s, e, text
  FROM base JOIN texts USING (row_id)
), neighbours AS (
  SELECT *, lag(e) OVER own AS e_before, coalesce(s - lag(e) OVER own >= 160, TRUE) AS first, coalesce(lead(s) OVER own - e >= 160, TRUE) AS last
  FROM mentions WINDOW own AS (PARTITION BY row_id, kind, value ORDER BY s)
), surroundings AS (
  SELECT row_id, kind, value, s, sum(first::INT) OVER (PARTITION BY row_id, kind, value ORDER BY s) AS merged,
    CASE WHEN NOT first THEN text[e_before + 1 : s] WHEN s > 80 THEN regexp_replace(text[s - 79 : s], '^{_WORD}', '') ELSE text[1 : s] END
    || chr(10) || CASE WHEN NOT last THEN '' WHEN e + 80 < len(text) THEN regexp_replace(text[e + 1 : e + 80], '{_WORD}$', '') ELSE text[e + 1 : e + 80] END AS near
  FROM neighbours
), contexts AS (
  SELECT row_id, kind, value, merged, string_agg(near, chr(0) ORDER BY s) AS near,
    string_agg(s - least_s || ':' || near, chr(0) ORDER BY s) AS context
  FROM (SELECT *, min(s) OVER (PARTITION BY row_id, kind, value, merged) AS least_s FROM surroundings) GROUP BY ALL
), near_terms AS (
  SELECT kind, value, context, unnest(regexp_extract_all(lower(near), '{_WORD}')) AS term FROM contexts
), known AS (
  SELECT term, max(n) AS n_near FROM (
    SELECT kind, value, term, count(*) AS n FROM near_terms WHERE len(term) >= 3
    GROUP BY ALL HAVING count(DISTINCT context) >= 3) GROUP BY term
), words AS (
  SELECT term, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '{_WORD}')) AS term FROM texts)
  GROUP BY term
), revealing AS (
  SELECT term FROM known JOIN words USING (term) WHERE 100 * n_near >= 80 * n
), term_spans AS (
  SELECT row_id, s, 4 AS rank, e, 'term' AS kind FROM ({_matches(_WORD, "texts")}) w
  WHERE lower(m) IN (SELECT term FROM revealing)
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.row_id = w.row_id AND b.s < w.e AND w.s < b.e)
), spans AS (
  SELECT row_id, s, rank, kind || ':' || s || ':' || e AS span FROM base
  UNION ALL SELECT row_id, s, rank, kind || ':' || s || ':' || e FROM term_spans
), listed AS (
  SELECT row_id, string_agg(span, ',' ORDER BY s, rank) AS spans,
    string_agg(span, ',' ORDER BY s, rank) FILTER (rank < 4) AS base_spans,
    {", ".join(f"count(*) FILTER (rank = {rank}) AS n_{kind}" for rank, (kind, _, _) in enumerate(_PII))}
  FROM spans GROUP BY row_id
)
SELECT doc_id, {", ".join(f"coalesce(n_{kind}, 0) AS n_{kind}" for kind, _, _ in _PII)},
  sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN listed USING (row_id)
"""

# The steps of CRC-32 for one byte, and for all bytes of a text.
_CRC_STEP = "CASE WHEN {0} % 2 = 1 THEN xor({0} // 2, 3988292384) ELSE {0} // 2 END"


def _crc_table() -> str:
    """A list of 256 numbers, by eight steps each."""
    entry = "range(0, 256)"
    for _ in range(8):
        entry = f"[{_CRC_STEP.format('x')} FOR x IN {entry}]"
    return entry


def _runs(source: str) -> str:
    words = f"regexp_extract_all({_LOWER.format('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""SELECT row_id, doc_id, len(words) AS n_words,
    unnest(words || [words[i] || ' ' || words[i + 1] FOR i IN range(1, len(words))]) AS run
  FROM (SELECT row_id, doc_id, {words} AS words FROM {source})"""


OP11 = rf"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents
), target AS (
  SELECT row_number() OVER () AS row_id, NULL AS doc_id, coalesce(text, '') AS text FROM benchmark
), doc_runs AS MATERIALIZED ({_runs("docs")}
), target_runs AS MATERIALIZED ({_runs("target")}
), runs AS MATERIALIZED (
  SELECT run, hex(encode(run)) AS digits FROM (SELECT run FROM doc_runs UNION SELECT run FROM target_runs)
), crc_table AS MATERIALIZED (
  SELECT {_crc_table()} AS t
), bucketed AS MATERIALIZED (
  SELECT run, xor(list_reduce(
    [4294967295::BIGINT] || [('0x' || digits[2 * i - 1 : 2 * i])::BIGINT FOR i IN range(1, len(digits) // 2 + 1)],
    lambda crc, byte: xor(crc // 256, t[xor(crc % 256, byte) + 1])
  ), 4294967295) % 10000 AS bucket FROM runs, crc_table
), corpus AS (
  SELECT bucket, count(*) AS s FROM doc_runs JOIN bucketed USING (run) GROUP BY bucket
), aimed AS (
  SELECT bucket, count(*) AS t FROM target_runs JOIN bucketed USING (run) GROUP BY bucket
), gains AS MATERIALIZED (
  SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM doc_runs) + 10000))
    / ((s + 1)::DOUBLE * ((SELECT count(*) FROM target_runs) + 10000))))::BIGINT AS gain
  FROM corpus LEFT JOIN aimed USING (bucket)
), weights AS (
  SELECT row_id, any_value(n_words) AS n_words, count(*) AS n_features, sum(gain)::BIGINT AS total
  FROM doc_runs JOIN bucketed USING (run) JOIN gains USING (bucket) GROUP BY row_id
), weighed AS (
  SELECT docs.row_id, docs.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_features, 0) AS n_features,
    coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0)::BIGINT AS weight,
    ('0x' || sha256('7:' || docs.doc_id)[1:8])::BIGINT AS h
  FROM docs LEFT JOIN weights USING (row_id)
), scored AS (
  SELECT *, (weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score FROM weighed
), ranked AS (
  SELECT row_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
  FROM scored WHERE n_words >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 25 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN ranked USING (row_id)
"""


def _round(i: int) -> str:
    """Assignment to the centroids of round ``i``, and the centroids after it."""
    return f"""near{i} AS MATERIALIZED (
  SELECT row_id, any_value(v) AS v, any_value(vec_id) AS vec_id, min(d) AS distance, arg_min(cluster, d * 8 + cluster) AS cluster
  FROM (SELECT k.row_id, k.vec_id, k.v, c.cluster, list_sum([(k.v[i] - c.v[i]) * (k.v[i] - c.v[i]) FOR i IN range(1, 65)])::BIGINT AS d
    FROM kept k, c{i} c) GROUP BY row_id
), sums{i} AS (
  SELECT cluster, i, sum(x) AS s, count(*) AS n FROM (SELECT cluster, unnest(v) AS x, unnest(range(1, 65)) AS i FROM near{i}) GROUP BY ALL
), c{i + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN (
    SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS v FROM sums{i} GROUP BY cluster) m USING (cluster)
)"""


OP13 = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row_id, vec_id, [floor(1024 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1)::INTEGER AS cluster, v FROM kept WHERE vec_id IS NOT NULL
  QUALIFY cluster < 8
), {", ".join(_round(i) for i in range(11))}, totals AS (
  SELECT cluster, sum(distance)::BIGINT AS cluster_inertia, any_value(sha256(array_to_string(c10.v, ','))) AS centroid_sha256
  FROM near10 JOIN c10 USING (cluster) GROUP BY cluster
)
SELECT vec_id, cluster, distance, cluster_inertia, (SELECT sum(distance)::BIGINT FROM near10) AS inertia, centroid_sha256
FROM near10 JOIN totals USING (cluster)
"""

LLM_ORACLE: dict[str, str] = {
    "op10_disclosure_pii": OP10,
    "op11_importance_resampling": OP11,
    "op13_simplex_clusters": OP13,
    "op1_url_model": OP1,
    "op2_minmax_dedup": OP2,
    "op3_quality_cascade": OP3,
    "op6_apportioned_mix": OP6,
    "op9_line_dedup": OP9,
}
