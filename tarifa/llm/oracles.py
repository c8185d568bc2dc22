"""DuckDB statements for the document queries that SQL can express on whole tables."""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

# Lines of every document with their keys; ``{docs}`` names the table.
_LINES = f"""
    SELECT d.row_no, d.doc_id, u.n AS line_no, u.line,
           {_LOWER.format(f"trim(u.line, {_SPACE})")} AS line_key
    FROM (SELECT row_number() OVER () AS row_no, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM {{docs}}) d,
         LATERAL (SELECT unnest(d.parts) AS line, generate_subscripts(d.parts, 1) AS n) u
"""

LINE_DEDUP = f"""
WITH lines AS ({_LINES.format(docs="documents")}),
common AS (SELECT line_key FROM lines WHERE length(line_key) >= 1 GROUP BY line_key HAVING count(DISTINCT row_no) >= 10),
marked AS (SELECT l.*, c.line_key IS NOT NULL AS gone FROM lines l LEFT JOIN common c USING (line_key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY row_no, doc_id
"""

_WORDS = "regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""
WITH docs AS (SELECT row_number() OVER () AS row_no, doc_id, {_WORDS} AS words FROM documents),
items AS (SELECT cast(item_id AS VARCHAR) AS item_id, {_WORDS} AS words FROM benchmark),
sizes AS (SELECT DISTINCT least(10, len(words)) AS size FROM items WHERE len(words) > 0),
item_runs AS (
    SELECT DISTINCT item_id, size, array_to_string(words[i:i + size - 1], ' ') AS run
    FROM (SELECT item_id, words, size, unnest(range(1, len(words) - size + 2)) AS i
          FROM (SELECT *, least(10, len(words)) AS size FROM items WHERE len(words) > 0))
),
doc_runs AS (
    SELECT row_no, i, size, array_to_string(words[i:i + size - 1], ' ') AS run
    FROM (SELECT row_no, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM docs, sizes)
),
hits AS (SELECT d.row_no, d.i, d.size, r.item_id FROM doc_runs d JOIN item_runs r USING (size, run)),
words_hit AS (
    SELECT row_no, count(DISTINCT place) AS n_hit
    FROM (SELECT DISTINCT row_no, unnest(range(i, i + size)) AS place FROM hits) GROUP BY row_no
),
items_hit AS (
    SELECT row_no, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
    FROM (SELECT DISTINCT row_no, item_id FROM hits) GROUP BY row_no
)
SELECT d.doc_id, cast(len(d.words) AS BIGINT) AS n_words, coalesce(w.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
       sha256(coalesce(i.names, '')) AS items_sha256, coalesce(w.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN words_hit w USING (row_no) LEFT JOIN items_hit i USING (row_no)
"""

# The CRC-32 of every word of ``{words}`` (``word``): a table of 256 remainders, then one step per byte.
_WORD_CRC = """
crc_table AS (
    SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: xor(c >> 1, 3988292384 * (c & 1))) ORDER BY i) AS steps
    FROM range(256) r(i)
),
word_bytes AS (
    SELECT word, list_transform(range(1, length(hex(word)) // 2 + 1), lambda i: 16 * strpos('123456789ABCDEF', substr(hex(word), 2 * i - 1, 1))
               + strpos('123456789ABCDEF', substr(hex(word), 2 * i, 1))) AS bytes
    FROM (SELECT DISTINCT word FROM {words})
),
word_crc AS (
    SELECT word, xor(4294967295, list_reduce(list_prepend(4294967295, bytes),
               lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]))) AS crc
    FROM word_bytes, crc_table
)"""

RESAMPLING = f"""
WITH docs AS (SELECT row_number() OVER () AS row_no, doc_id, {_WORDS} AS words FROM documents),
items AS (SELECT unnest({_WORDS}) AS word FROM benchmark),
doc_words AS (SELECT row_no, unnest(words) AS word FROM docs),
all_words AS (SELECT word FROM doc_words UNION SELECT word FROM items),
{_WORD_CRC.format(words="all_words")},
source AS (SELECT crc % 10000 AS bucket, count(*) AS s FROM doc_words JOIN word_crc USING (word) GROUP BY 1),
target AS (SELECT crc % 10000 AS bucket, count(*) AS t FROM items JOIN word_crc USING (word) GROUP BY 1),
totals AS (SELECT (SELECT coalesce(sum(s), 0) FROM source)::DOUBLE + 10000 AS s_all,
                  (SELECT coalesce(sum(t), 0) FROM target)::DOUBLE + 10000 AS t_all),
gain AS (
    SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * s_all / ((s + 1)::DOUBLE * t_all)))::BIGINT AS gain
    FROM source LEFT JOIN target USING (bucket), totals
),
sums AS (
    SELECT row_no, count(*) AS n, sum(gain)::BIGINT AS total
    FROM doc_words JOIN word_crc USING (word) JOIN gain ON gain.bucket = crc % 10000 GROUP BY row_no
),
weights AS (
    SELECT doc_id, coalesce(n, 0) AS n_features,
           coalesce((total - ((total % n) + n) % n) // n, 0) AS weight,
           ('0x' || substr(sha256('2024:' || cast(doc_id AS VARCHAR)), 1, 8))::BIGINT AS h
    FROM docs LEFT JOIN sums USING (row_no)
),
scored AS (
    SELECT doc_id, n_features, weight,
           weight + floor(-1000.0::DOUBLE * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score
    FROM weights
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
           count(*) OVER (PARTITION BY n_features >= 20) AS n
    FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank FROM ranked
"""


def _rounds(rounds: int) -> str:
    """Assignment and new centroids, ``rounds`` times."""
    steps = []
    for i in range(rounds + 1):
        # The smallest distance, then the smallest number, of eight centroids.
        steps.append(f"""
near{i} AS MATERIALIZED (
    SELECT row_no, min(8 * list_sum(list_transform(list_zip(q, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT + cluster) AS best
    FROM kept, centroids{i} GROUP BY row_no
)""")
        if i < rounds:
            steps.append(f"""
sums{i} AS (
    SELECT cluster, pos, sum(x)::HUGEINT AS total, count(*) AS n
    FROM (SELECT best % 8 AS cluster, unnest(q) AS x, generate_subscripts(q, 1) AS pos FROM near{i} JOIN kept USING (row_no))
    GROUP BY cluster, pos
),
moved{i} AS (
    SELECT cluster, list(((total - ((total % n) + n) % n) // n)::BIGINT ORDER BY pos) AS c FROM sums{i} GROUP BY cluster
),
centroids{i + 1} AS MATERIALIZED (
    SELECT o.cluster, coalesce(m.c, o.c) AS c FROM centroids{i} o LEFT JOIN moved{i} m USING (cluster)
)""")
    return ",".join(steps)


CLUSTERING = f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS row_no, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS q
    FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
),
centroids0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY digest, q) - 1 AS cluster, q AS c
    FROM (SELECT *, sha256('3:' || coalesce(cast(vec_id AS VARCHAR), '')) AS digest FROM kept ORDER BY digest, q LIMIT 8)
),{_rounds(10)},
placed AS (SELECT vec_id, (best % 8)::INTEGER AS cluster, best // 8 AS distance FROM near10 JOIN kept USING (row_no))
SELECT vec_id, p.cluster, distance, sum(distance) OVER (PARTITION BY p.cluster)::BIGINT AS cluster_inertia,
       sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM placed p JOIN centroids10 c ON c.cluster = p.cluster
"""

ORACLES = {
    "op7_line_dedup": LINE_DEDUP,
    "op8_benchmark_decontamination": DECONTAMINATION,
    "op11_centroid_clustering": CLUSTERING,
    "op13_importance_resampling": RESAMPLING,
}
