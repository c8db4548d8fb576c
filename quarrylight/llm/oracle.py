"""ANSI SQL that gives the rows of the llm queries which SQL can express over whole tables."""

P2_TERMS = r"""
WITH numbered AS (SELECT *, row_number() OVER () AS rid FROM trend_snapshot),
entries AS (
    SELECT 'tag_counts' AS field_name, CAST(snapshot_id AS VARCHAR) AS record, rid, unnest(map_entries(tag_counts)) AS e FROM numbered
    UNION ALL
    SELECT 'category_counts', CAST(snapshot_id AS VARCHAR), rid, unnest(map_entries(category_counts)) FROM numbered
),
cases AS (SELECT repo_id, row_number() OVER () AS rid, use_cases FROM enrichment_result),
flat AS (
    SELECT field_name, record, rid, e.key AS term, e.value AS times FROM entries
    UNION ALL
    SELECT 'use_cases', repo_id, rid, unnest(use_cases), 1 FROM cases
),
clean AS (
    SELECT field_name, record, rid, lower(trim(regexp_replace(term, '[ \t\r\n]+', ' ', 'g'), ' ')) AS term, times FROM flat WHERE times >= 1
),
per_row AS (SELECT field_name, record, rid, term, sum(times) AS times FROM clean WHERE term <> '' GROUP BY ALL),
per_record AS (SELECT field_name, record, term, max(times) AS times FROM per_row GROUP BY ALL),
total AS (SELECT field_name, count(DISTINCT record) AS n FROM per_record GROUP BY field_name),
counts AS (SELECT field_name, term, CAST(sum(times) AS BIGINT) AS occurrences, count(*) AS records FROM per_record GROUP BY ALL),
marked AS (
    SELECT field_name, term, occurrences, records,
        CASE WHEN records < 3 OR occurrences < 5 THEN 'rare' WHEN records > 0.3 * n THEN 'common' END AS mark
    FROM counts JOIN total USING (field_name)
)
"""

_SPACE = r"[\s\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x0b]"

P5_FOUND = rf"""
WITH flat AS (
    SELECT 'integration_tags' AS field_name, repo_id AS key, unnest(integration_tags) AS item FROM enrichment_result
    UNION ALL
    SELECT 'topics', full_name, unnest(topics) FROM github_repo
),
clean AS (
    SELECT DISTINCT field_name, key, lower(regexp_replace(item, '^{_SPACE}+|{_SPACE}+$', '', 'g')) AS item FROM flat WHERE item IS NOT NULL
),
items AS (SELECT * FROM clean WHERE item <> ''),
total AS (SELECT field_name, count(DISTINCT key) AS n FROM items GROUP BY field_name),
single AS (SELECT field_name, item, count(*) AS n FROM items GROUP BY ALL),
often AS (SELECT items.* FROM items JOIN single USING (field_name, item) JOIN total USING (field_name) WHERE 500 * single.n >= total.n),
pairs AS (
    SELECT a.field_name, a.item AS item_a, b.item AS item_b, count(*) AS n_ab
    FROM often a JOIN often b ON a.field_name = b.field_name AND a.key = b.key AND a.item < b.item GROUP BY ALL
)
SELECT p.field_name, p.item_a, p.item_b
FROM pairs p JOIN total t USING (field_name)
JOIN single x ON x.field_name = p.field_name AND x.item = p.item_a
JOIN single y ON y.field_name = p.field_name AND y.item = p.item_b
WHERE n_ab >= 5 AND 500 * n_ab >= t.n AND n_ab * t.n >= 3 * x.n * y.n
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p2_terms": P2_TERMS + "SELECT * FROM marked",
        "p2_found": P2_TERMS + "SELECT field_name, term, mark FROM marked WHERE mark IS NOT NULL",
        "p5_found": P5_FOUND,
    }
