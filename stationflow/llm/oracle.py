"""SQL for DuckDB with the same rows as the queries that SQL can state."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPLIT = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"

#: Links between shingle sets; ``more`` words follow a shingle's first.
_LINKED = f"""
WITH RECURSIVE w AS (
    SELECT doc_id, {_SPLIT.format(f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")} AS words FROM documents),
places AS (SELECT doc_id, words, unnest(generate_series(1, greatest(len(words) - {{more}}, 1))) AS i FROM w WHERE len(words) > 0),
shingles AS (SELECT DISTINCT doc_id, array_to_string(words[i:i+{{more}}], ' ') AS s FROM places),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
    FROM shingles AS a JOIN shingles AS b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
    SELECT a, b FROM pairs JOIN sizes AS x ON x.doc_id = a JOIN sizes AS y ON y.doc_id = b
    WHERE 100 * common >= 85 * (x.n + y.n - common)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.b FROM reach AS r JOIN edges AS e ON e.a = r.other)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, m.component_id{{columns}}
FROM documents AS d
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) AS m USING (doc_id)
LEFT JOIN sizes AS s USING (doc_id)"""
DUPLICATES = _LINKED.format(more=2, columns=", d.doc_id = m.component_id AS kept")
OVERLAPS = _LINKED.format(more=3, columns="")

PHRASES = f"""
WITH w AS (SELECT doc_id, {_SPLIT.format("coalesce(text, '')")} AS words FROM documents),
places AS (SELECT doc_id, words, unnest(generate_series(1, len(words) - 12)) AS i FROM w),
win AS (SELECT doc_id, i, array_to_string(words[i:i+12], ' ') AS win FROM places),
first AS (SELECT win, min(doc_id) AS first FROM win GROUP BY win),
gone AS (
    SELECT DISTINCT doc_id, i + k AS spot FROM win JOIN first USING (win), (SELECT unnest(generate_series(0, 12)) AS k) AS k
    WHERE first < doc_id),
listed AS (SELECT doc_id, unnest(words) AS word, unnest(generate_series(1, len(words))) AS spot FROM w),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY spot) AS text FROM listed ANTI JOIN gone USING (doc_id, spot) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) AS g USING (doc_id)"""



def _crc_table() -> list[int]:
    """The checksum's table of half bytes, from its polynomial."""
    table = list(range(16))
    for _ in range(4):
        table = [0xEDB88320 ^ (c >> 1) if c & 1 else c >> 1 for c in table]
    return table


RESAMPLING = rf"""
WITH texts AS (
    SELECT 0 AS part, doc_id AS id, text FROM documents UNION ALL SELECT 1, row_number() OVER (), text FROM benchmark),
w AS (
    SELECT part, id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM texts),
listed AS (SELECT part, id, unnest(words) AS x, unnest(generate_series(1, len(words))) AS i FROM w),
runs AS (
    SELECT part, id, x, x || ' ' || lead(x, 1) OVER spots AS xx, x || ' ' || lead(x, 1) OVER spots || ' ' || lead(x, 2) OVER spots
        AS xxx FROM listed WINDOW spots AS (PARTITION BY part, id ORDER BY i)),
feature AS (SELECT part, id, f FROM (SELECT part, id, unnest([x, xx, xxx]) AS f FROM runs) AS u WHERE f IS NOT NULL),
bytes AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM feature)),
halves AS (  -- of each byte the lower half first
    SELECT f, list_transform(range(0, len(h)), lambda i: instr('0123456789ABCDEF', h[xor(i, 1) + 1]) - 1) AS b FROM bytes),
crc AS (
    SELECT f, xor(4294967295, list_reduce(list_prepend(4294967295, b),
        lambda c, x: xor(c >> 4, {_crc_table()}[xor(c & 15, x) + 1]))) % 10000 AS bucket FROM halves),
bucketed AS (SELECT part, id, bucket FROM feature JOIN crc USING (f)),
counts AS (SELECT bucket, count(*) FILTER (part = 0) AS s, count(*) FILTER (part = 1) AS t FROM bucketed GROUP BY bucket),
sums AS (SELECT CAST(coalesce(sum(s), 0) AS DOUBLE) AS s, CAST(coalesce(sum(t), 0) AS DOUBLE) AS t FROM counts),
gains AS (
    SELECT bucket, CAST(floor(1000 * ln((c.t + 1.0::DOUBLE) * (a.s + 10000) / ((c.s + 1.0::DOUBLE) * (a.t + 10000)))) AS BIGINT)
        AS gain FROM counts AS c, sums AS a),
weights AS (
    SELECT id, count(*) AS n, CAST(sum(gain) AS BIGINT) AS weight FROM bucketed JOIN gains USING (bucket)
    WHERE part = 0 GROUP BY id),
scored AS (
    SELECT d.id, len(words) AS n_words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
        + CAST(floor(-1000 * ln(-ln((CAST('0x' || sha256('42:' || d.id)[:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))
        AS BIGINT) AS score
    FROM w AS d LEFT JOIN weights USING (id) WHERE part = 0),
able AS (
    SELECT id, row_number() OVER (ORDER BY score DESC, id) AS rank, count(*) OVER () AS all_able FROM scored WHERE n_words >= 20)
SELECT s.id AS doc_id, n_features, weight, score, CASE WHEN rank <= 5 * all_able // 100 THEN rank END AS rank,
       CAST(n_words AS BIGINT) AS n_words
FROM scored AS s LEFT JOIN able USING (id)"""

DIVERGENCE = rf"""
WITH d AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
    FROM documents),
w AS (SELECT r, lang, source, unnest(words) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY 1, 2 HAVING count(DISTINCT r) >= 30),
n AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY 1),
total AS (SELECT lang, source, sum(n) AS total FROM n GROUP BY 1, 2),
p AS (
    SELECT g.lang, g.source, term, coalesce(n, 0) AS n,
        1 + (1000000000 * (coalesce(n, 0) + 5)::HUGEINT) // (coalesce(total, 0) + 5 * v) AS p
    FROM g JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN n USING (lang, source, term) LEFT JOIN total USING (lang, source)),
q AS (
    SELECT lang, term, 1 + (1000000000 * (sum(n) + 5)::HUGEINT) // (any_value(a) + 5 * any_value(v)) AS q
    FROM p JOIN v USING (lang) JOIN (SELECT lang, sum(total) AS a FROM total GROUP BY 1) AS a USING (lang) GROUP BY 1, 2),
far AS (
    SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
    FROM p AS x JOIN p AS y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY 1, 2, 3),
pair AS (
    SELECT x.lang, x.source, 'pair' AS part, y.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
    FROM g AS x JOIN g AS y ON x.lang = y.lang AND x.source <> y.source
    LEFT JOIN far ON far.lang = x.lang AND far.source = x.source AND far.item = y.source),
term AS (
    SELECT lang, source, 'term' AS part, term AS item, CAST(p - q AS BIGINT) AS value
    FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
    FROM (SELECT * FROM pair UNION ALL SELECT * FROM term) AS u)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50"""
