"""SQL for the operators that SQL can express."""

_WORDS = (
    "list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
)


def _shingles(name: str, base: str, key: str) -> str:
    """CTEs: ``name`` has the distinct shingles (id, g) of a table's texts; fewer words than five are one shingle."""
    return f"""{name}_words AS (SELECT {key} AS id, {_WORDS} AS w FROM {base}),
{name} AS (SELECT DISTINCT id, unnest(CASE
    WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: list_aggregate(w[i:i + 4], 'string_agg', ' '))
    WHEN len(w) > 0 THEN [list_aggregate(w, 'string_agg', ' ')] ELSE [] END) AS g FROM {name}_words)"""


OP6_SQL = f"""
WITH {_shingles("d", "documents", "doc_id")},
{_shingles("b", "benchmark", "item_id")},
size AS (SELECT id, count(*) AS q FROM b GROUP BY id),
hits AS (SELECT d.id AS doc_id, b.id AS item_id, count(*) AS shared FROM d JOIN b USING (g) GROUP BY d.id, b.id)
SELECT doc_id, item_id, q AS item_shingles, shared AS shared_shingles
FROM hits JOIN size ON size.id = item_id WHERE 100 * shared >= 75 * q
"""

OP8_SQL = f"""
WITH RECURSIVE {_shingles("s", "documents", "doc_id")},
size AS (SELECT id, count(*) AS n FROM s GROUP BY id),
shared AS (SELECT a.id AS x, b.id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.id < b.id GROUP BY a.id, b.id),
link AS (SELECT x, y FROM shared JOIN size p ON p.id = x JOIN size q ON q.id = y WHERE 100 * k >= 75 * (p.n + q.n - k)),
edge AS (SELECT x, y FROM link UNION SELECT y, x FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.y FROM reach r JOIN edge e ON e.x = r.b)
SELECT doc_id, coalesce(size.n, 0) AS n_shingles, component_id
FROM documents LEFT JOIN size ON size.id = doc_id
JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) ON a = doc_id
"""

# Checksums by the usual byte table, for distinct words only.
OP13_SQL = """
WITH RECURSIVE bit(b, k, v) AS (
    SELECT range, 0, range FROM range(256)
    UNION ALL SELECT b, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bit WHERE k < 8
),
bytes AS (SELECT list(v ORDER BY b) AS t FROM bit WHERE k = 8),
texts AS (
    SELECT 'd' AS side, doc_id, row_number() OVER () AS row, text FROM documents
    UNION ALL SELECT 'b', NULL, -row_number() OVER (), text FROM benchmark
),
found AS (
    SELECT side, doc_id, row, coalesce(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+'), []) AS w
    FROM texts
),
times AS (SELECT side, row, word, count(*) AS n FROM (SELECT side, row, unnest(w) AS word FROM found) GROUP BY ALL),
distinct_words AS (SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM times)),
hashed AS (
    SELECT word, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, len(h) // 2), lambda i:
        (strpos('0123456789ABCDEF', h[2 * i + 1]) - 1) * 16 + strpos('0123456789ABCDEF', h[2 * i + 2]) - 1)),
        lambda r, x: xor(r >> 8, t[(xor(r, x) & 255) + 1])), 4294967295) % 10000 AS bucket
    FROM distinct_words, bytes
),
bucket AS (
    SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0) AS s, coalesce(sum(n) FILTER (side = 'b'), 0) AS t
    FROM times JOIN hashed USING (word) GROUP BY bucket
),
total AS (SELECT coalesce(sum(s), 0) AS s_all, coalesce(sum(t), 0) AS t_all FROM bucket),
gain AS (
    SELECT bucket, CAST(floor(1000 * ln((t + 1)::DOUBLE * (s_all + 10000)::DOUBLE /
        ((s + 1)::DOUBLE * (t_all + 10000)::DOUBLE))) AS BIGINT) AS gain FROM bucket, total
),
summed AS (
    SELECT row, sum(n) AS n, sum(n * gain) AS gains
    FROM times JOIN hashed USING (word) JOIN gain USING (bucket) WHERE side = 'd' GROUP BY row
),
weighed AS (
    SELECT doc_id, row, len(w) AS n_words, coalesce(n, 0) AS n_features,
        coalesce((gains - ((gains % n) + n) % n) // n, 0) AS weight,
        ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT AS h
    FROM found LEFT JOIN summed USING (row) WHERE side = 'd'
),
scored AS (
    SELECT *, CAST(weight + floor(-1000 * ln(-ln((h + 0.5)::DOUBLE / 4294967296::DOUBLE))) AS BIGINT) AS score FROM weighed
),
ordered AS (
    SELECT row, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, row) AS rank, count(*) OVER () * 10 // 100 AS taken
    FROM scored WHERE n_words >= 20
)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, score,
    CAST(CASE WHEN rank <= taken THEN rank END AS BIGINT) AS rank
FROM scored LEFT JOIN ordered USING (row)
"""
