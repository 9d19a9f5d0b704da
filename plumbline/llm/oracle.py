"""SQL for DuckDB of the queries of this subpackage that SQL can express."""

TIMES = """
times AS (
  SELECT content_id, end_at - start_at AS seconds FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY dt DESC) AS place FROM eval_tasks
  ) WHERE place = 1 AND status = 12 AND end_at >= start_at
)"""

LINKS = """
links AS (
  SELECT DISTINCT query_id_a AS a, query_id_b AS b FROM query_match WHERE is_match = 1 AND query_id_a <> query_id_b
  UNION SELECT DISTINCT query_id_b, query_id_a FROM query_match WHERE is_match = 1 AND query_id_a <> query_id_b
),
reached(query_id, other) AS (
  SELECT a, a FROM links
  UNION SELECT reached.query_id, links.b FROM reached JOIN links ON reached.other = links.a
),
linked AS (SELECT query_id, min(other) AS group_id FROM reached GROUP BY query_id)"""

CATEGORIES = """
current_items AS (
  SELECT query_id, lower(trim(category)) AS cat FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY dm DESC) AS place FROM query_item
  ) WHERE place = 1
),
available AS (SELECT cat, count(*) AS n FROM current_items GROUP BY cat),
wanted AS (
  SELECT category, greatest(min_count, ceil(round(target_share * sample_size, 6))) AS needed FROM sample_targets
)"""

FULL = "".join(chr(c + 0xFEE0) for c in range(0x21, 0x7F)).replace("'", "''") + chr(0x3000)
HALF = "".join(chr(c) for c in range(0x21, 0x7F)).replace("'", "''") + " "

CANONICAL = rf"""
current_items AS (
  SELECT query_id, lower(translate(raw_query, '{FULL}', '{HALF}')) AS t FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY dm DESC) AS place FROM query_item
  ) WHERE place = 1 AND raw_query IS NOT NULL
),
parted AS (
  SELECT query_id, t, list_filter(regexp_split_to_array(t, '[|;\r\n]+'), lambda x: trim(x) <> '') AS parts FROM current_items
),
told AS (
  SELECT query_id, t,
    CASE
      WHEN regexp_full_match(t, '(?s)\s*\{{.*\}}\s*') AND json_valid(t) THEN
        list_transform(json_keys(t::JSON), lambda k: regexp_replace(k, '[^\p{{L}}\p{{M}}\p{{N}}]', '', 'g') || '=' ||
          regexp_replace(coalesce(json_extract_string(t::JSON, '$."' || k || '"'), ''), '[^\p{{L}}\p{{M}}\p{{N}}]', '', 'g'))
      WHEN len(parts) > 1 AND len(list_filter(parts, lambda x: regexp_full_match(x, '(?s)\s*[\p{{L}}_][\p{{L}}\p{{N}}_ .-]*[=:]\s*\S.*'))) = len(parts) THEN
        list_transform(parts, lambda x: regexp_replace(regexp_extract(x, '(?s)^([^=:]*)[=:]', 1), '[^\p{{L}}\p{{M}}\p{{N}}]', '', 'g') || '=' ||
          regexp_replace(regexp_replace(x, '(?s)^[^=:]*[=:]', ''), '[^\p{{L}}\p{{M}}\p{{N}}]', '', 'g'))
    END AS fields
  FROM parted
),
canonical AS (
  SELECT query_id, coalesce(CASE WHEN len(fields) > 1 THEN '{{' || array_to_string(list_sort(fields), chr(10)) WHEN len(fields) = 1 THEN replace(fields[1], '=', '') END, nullif(regexp_replace(t, '[^\p{{L}}\p{{M}}\p{{N}}]', '', 'g'), '')) AS c FROM told
),
grouped AS (
  SELECT query_id, min(query_id) OVER (PARTITION BY c) AS group_id, count(*) OVER (PARTITION BY c) AS copies FROM canonical WHERE c IS NOT NULL
)"""


def oracle_sql() -> dict[str, str]:
    """SQL by query name."""
    return {
        "p2_found": f"WITH RECURSIVE {LINKS} SELECT query_id, group_id FROM linked",
        "p2_groups": f"""WITH RECURSIVE {LINKS}
            SELECT i.query_id, coalesce(group_id, i.query_id) AS group_id
            FROM (SELECT DISTINCT query_id FROM query_item) i LEFT JOIN linked USING (query_id)""",
        "p4_found": f"""WITH {TIMES}, q AS (
              SELECT content_id, quantile_cont(seconds, 0.5) AS p50, quantile_cont(seconds, 0.9) AS p90
              FROM times GROUP BY content_id HAVING count(*) >= 10)
            SELECT content_id, 'p50' AS measure FROM q WHERE p50 > 240
            UNION ALL SELECT content_id, 'p90' FROM q WHERE p90 > 1200""",
        "p4_percentiles": f"""WITH {TIMES} SELECT content_id, count(*) AS n, 0 AS rank_error, quantile_cont(seconds, 0.5) AS p50,
              quantile_cont(seconds, 0.9) AS p90, quantile_cont(seconds, 0.99) AS p99 FROM times GROUP BY content_id""",
        "p6_found": f"WITH {CATEGORIES} SELECT category FROM wanted LEFT JOIN available ON cat = lower(trim(category)) WHERE coalesce(n, 0) < needed",
        "p6_shortfalls": f"""WITH {CATEGORIES}
            SELECT w.category, target_share, min_count, needed::BIGINT AS needed, coalesce(n, 0) AS available, greatest(needed - coalesce(n, 0), 0)::BIGINT AS gap
            FROM wanted w JOIN sample_targets USING (category) LEFT JOIN available ON cat = lower(trim(w.category))""",
        "p7_duplicates": f"""WITH {CANONICAL} SELECT min(query_id) AS group_id, count(*) AS copies, count(DISTINCT raw) AS writings
            FROM canonical JOIN (SELECT query_id, raw_query AS raw FROM (
              SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY dm DESC) AS place FROM query_item) WHERE place = 1) USING (query_id)
            WHERE c IS NOT NULL GROUP BY c""",
        # The answer doesn't depend on how tokens are counted; here a token is 3.5 bytes.
        "p9_found": """SELECT source FROM mix_targets LEFT JOIN (SELECT source, sum(strlen(text)) / 3.5 AS tokens FROM documents GROUP BY source) USING (source)
            WHERE coalesce(tokens, 0) * max_repeats < target_share * total_tokens""",
        "p7_found": f"WITH {CANONICAL} SELECT query_id, group_id FROM grouped WHERE copies > 1",
    }
