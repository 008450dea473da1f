"""SQL for DuckDB that gives the same rows as the operators' queries, where SQL can express them."""

from __future__ import annotations

import string

LOWER = f"translate({{}}, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
BENCH_WORDS = (
    f"regexp_extract_all({LOWER.format("coalesce(text, '')")}, "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
SPACE_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

DECONTAMINATE = f"""
WITH items AS (SELECT item_id::VARCHAR AS item, {BENCH_WORDS} AS w FROM benchmark),
sized AS (SELECT item, w, least(10, len(w)) AS n FROM items WHERE len(w) > 0),
grams AS (SELECT item, n, array_to_string(w[s:s + n - 1], ' ') AS gram
          FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM sized)),
docs AS (SELECT doc_id, {BENCH_WORDS} AS w FROM documents),
placed AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s
           FROM docs, (SELECT DISTINCT n FROM grams)),
hits AS (SELECT doc_id, s, p.n, item FROM placed p
         JOIN grams g ON g.n = p.n AND g.gram = array_to_string(w[s:s + p.n - 1], ' ')),
hit_words AS (SELECT doc_id, count(DISTINCT place) AS n_hit
              FROM (SELECT doc_id, unnest(range(s, s + n)) AS place FROM hits) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
              FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)"""

SUBSTRING_DEDUP = f"""
WITH docs AS (SELECT doc_id, {SPACE_WORDS} AS w FROM documents),
windows AS (SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS gram
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM docs)),
ranked AS (SELECT doc_id, s, row_number() OVER (PARTITION BY gram ORDER BY doc_id, s) AS r FROM windows),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS place FROM ranked WHERE r > 1),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM docs),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS text
         FROM words ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)"""

WARC = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS digest FROM p),
g AS (SELECT *, max(page_id) OVER (PARTITION BY digest) AS latest FROM d)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> latest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> latest THEN latest END AS refers_to FROM g"""

MIXING = f"""
WITH docs AS (SELECT doc_id, source, len({SPACE_WORDS}) AS size FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
weighted AS (SELECT *, [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1]::DOUBLE AS w
             FROM totals),
levels AS (SELECT *, source_size * 2 / w AS level, sum(source_size) OVER () * 1.5::DOUBLE AS total FROM weighted),
rests AS (SELECT *, (total - coalesce(sum(source_size * 2) OVER (ORDER BY level, source NULLS LAST
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                 / sum(w) OVER (ORDER BY level, source NULLS LAST
                       ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM levels),
targets AS (SELECT source, source_size,
            least(source_size * 2.0::DOUBLE, max(rest) FILTER (WHERE rest <= level) OVER () * w) AS target FROM rests),
rates AS (SELECT doc_id, size, source_size, target,
          CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
          ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
          FROM docs JOIN targets ON docs.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * (floor(rate) + (u < rate - floor(rate))::INTEGER))::BIGINT AS taken FROM rates"""

LINE_DEDUP = r"""
WITH p AS (SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) AS host,
           CASE WHEN html IS NULL THEN [] ELSE string_split_regex(html, '<[^>]*>|\n') END AS lines FROM pages),
totals AS (SELECT host, count(*) AS pages FROM p GROUP BY host),
counts AS (SELECT host, line, count(*) AS n FROM
           (SELECT DISTINCT page_id, host, unnest(lines) AS line FROM p) WHERE trim(line) <> '' GROUP BY host, line),
drops AS (SELECT counts.host, line FROM counts JOIN totals ON counts.host IS NOT DISTINCT FROM totals.host
          WHERE n >= 5 AND n > pages * 0.1),
each AS (SELECT page_id, host, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM p),
kept AS (SELECT page_id, count(*) AS n, string_agg(each.line, chr(10) ORDER BY place) AS text FROM each
         LEFT JOIN drops ON each.host IS NOT DISTINCT FROM drops.host AND each.line = drops.line
         WHERE drops.line IS NULL GROUP BY page_id)
SELECT page_id, len(lines)::BIGINT AS n_lines, (len(lines) - coalesce(n, 0))::BIGINT AS n_dropped,
       sha256(coalesce(text, '')) AS kept_sha256 FROM p LEFT JOIN kept USING (page_id)"""


USABLE = """embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""
WHOLE = "list_transform(embedding, lambda x: floor({scale} * x::DOUBLE))"

HARD_NEGATIVES = f"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           {WHOLE.format(scale=256)} AS v FROM embeddings WHERE label IS NOT NULL AND {USABLE}),
scores AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
           list_inner_product(a.v, b.v)::BIGINT AS score
           FROM v a, v b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM scores WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other))::INTEGER AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) <= 10"""

TOPK_SEARCH = f"""
WITH v AS (SELECT vec_id, {WHOLE.format(scale=1024)} AS v FROM embeddings WHERE {USABLE}),
scores AS (SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.v, b.v)::BIGINT AS score
           FROM v a, v b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM scores QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10"""

# CRC-32 of the bytes of a word, by its table of 256 remainders.
IMPORTANCE_RESAMPLING = f"""
WITH crc_table AS (SELECT list_transform(range(256), lambda n:
           list_reduce(list_prepend(n, range(8)), lambda c, i:
             CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t),
docs AS (SELECT doc_id, {BENCH_WORDS} AS w FROM documents),
seen AS (SELECT w, sum(raw)::BIGINT AS raw, sum(target)::BIGINT AS target FROM (
           SELECT unnest(w) AS w, 1 AS raw, 0 AS target FROM docs
           UNION ALL SELECT unnest({BENCH_WORDS}), 0, 1 FROM benchmark) GROUP BY w),
bytes AS (SELECT *, hex(encode(w)) AS h FROM seen),
placed AS (SELECT w, raw, target, xor(4294967295, list_reduce(
             list_prepend(4294967295, list_transform(range(length(h) // 2), lambda i:
               ('0x' || substr(h, (2 * i + 1)::BIGINT, 2))::BIGINT)),
             lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]))) % 10000 AS bucket FROM bytes, crc_table),
sums AS (SELECT bucket, sum(raw)::BIGINT AS s, sum(target)::BIGINT AS t FROM placed GROUP BY bucket),
totals AS (SELECT coalesce(sum(s), 0)::BIGINT AS s_all, coalesce(sum(t), 0)::BIGINT AS t_all FROM sums),
gains AS (SELECT bucket, floor(1000 * ln(((t + 1) * (s_all + 10000))::DOUBLE / ((s + 1) * (t_all + 10000))::DOUBLE))::BIGINT
                 AS gain FROM sums, totals),
word_gains AS (SELECT w, gain FROM placed JOIN gains USING (bucket)),
weights AS (SELECT doc_id, sum(gain)::BIGINT AS weight
            FROM (SELECT doc_id, unnest(w) AS w FROM docs) JOIN word_gains USING (w) GROUP BY doc_id),
scored AS (SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
           coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln(
             (('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT + 0.5::DOUBLE)
             / 4294967296.0::DOUBLE)))::BIGINT AS score
           FROM docs LEFT JOIN weights USING (doc_id)),
drawn AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n
          FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank
FROM scored LEFT JOIN drawn USING (doc_id)"""


def oracles() -> dict[str, str]:
    return {
        "op1_decontaminate": DECONTAMINATE,
        "op3_substring_dedup": SUBSTRING_DEDUP,
        "op5_warc": WARC,
        "op9_mixing": MIXING,
        "op10_line_dedup": LINE_DEDUP,
        "op11_hard_negatives": HARD_NEGATIVES,
        "op12_importance_resampling": IMPORTANCE_RESAMPLING,
        "op13_topk_search": TOPK_SEARCH,
    }
