"""Plain relational operators: one SQL text each, run by Spark here and by the oracle as it stands.

{name} stands for a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SQL: dict[str, str] = {
    # scans and projections
    "s4_table_scan": "SELECT n_nationkey, n_name, n_regionkey FROM {nation}",
    "s17_values": "SELECT * FROM (VALUES ('1111.1111', 'A', 'cs.LG'), ('2222.2222', 'B', 'cs.LG'), ('3333.3333', 'C', 'cs.CV')) AS t(arxiv_id, title, primary_category)",
    "p1_project_rename": "SELECT o_orderkey AS arxiv_id, o_orderpriority AS category FROM {orders}",
    "p2_select_star": "SELECT * FROM {region}",
    "p3_constants": "SELECT 'kaggle_dump' AS source, 0 AS n_files, 'success' AS status, r_name FROM {region}",
    "p4_equality": "SELECT doc_id, lang FROM {documents} WHERE source = 'src3' AND lang = 'en'",
    "p5_in_list": "SELECT doc_id, lang FROM {documents} WHERE lang IN ('de', 'fr')",
    "p6_date_ranges": "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS STRING) AS day FROM {orders} WHERE o_orderdate >= TIMESTAMP '1995-01-01 00:00:00' AND o_orderdate <= TIMESTAMP '1995-12-31 00:00:00'",
    "p7_null_tests": "SELECT d.doc_id, l.toxic IS NULL AS pending, l.toxic IS NOT NULL AS complete FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id",
    "p8_tri_state": "SELECT d.doc_id FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id WHERE (l.toxic = 1) = TRUE",
    "p8_tri_state_false": "SELECT d.doc_id FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id WHERE (l.toxic = 1) = FALSE",
    "p9_like": "SELECT p_partkey, p_type FROM {part} WHERE p_type LIKE 'S%'",
    "p10_ilike_net": "SELECT p_partkey, p_name FROM {part} WHERE (p_name ILIKE '%RED%' OR p_name ILIKE '%blue%') AND p_name NOT ILIKE '%steel%'",
    "p12_mask": "SELECT doc_id FROM {labels} WHERE quality = 1",
    "p13_labelled": "SELECT d.doc_id, CAST(l.quality AS INT) AS label FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id WHERE l.quality IS NOT NULL",
    "p15_head": "SELECT doc_id, lang FROM {documents} ORDER BY doc_id LIMIT 25",
    "p16_hold_out": "SELECT l.doc_id FROM {labels} l LEFT JOIN (SELECT doc_id FROM {labels} WHERE quality = 1 ORDER BY doc_id LIMIT 6) x ON l.doc_id = x.doc_id WHERE x.doc_id IS NULL",
    # joins
    "j1_using": "SELECT c_custkey, n_name FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey",
    "j2_join_group": "SELECT n_name, count(*) AS n_customers FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey GROUP BY n_name",
    "j5_payload_anti": "SELECT d.doc_id FROM {documents} d LEFT JOIN (SELECT doc_id, CASE WHEN quality = 1 THEN 'x' END AS path FROM {labels}) s ON d.doc_id = s.doc_id WHERE s.path IS NULL",
    "j8_extraction_queue": "SELECT d.doc_id, d.source FROM {documents} d JOIN {labels} l ON d.doc_id = l.doc_id WHERE d.source IS NOT NULL AND l.quality = 0",
    "j11_golden_in_corpus": "SELECT l.doc_id FROM {labels} l JOIN {embeddings} e ON l.doc_id = e.vec_id WHERE l.quality = 1",
    "j12_keyed_zip": "SELECT a.conv_id, a.turn, a.role AS asked, b.role AS answered FROM {conversations} a JOIN {conversations} b ON a.conv_id = b.conv_id AND a.turn + 1 = b.turn",
    "j13_legacy_queue": "SELECT d.doc_id FROM {documents} d JOIN {labels} l ON d.doc_id = l.doc_id WHERE CASE WHEN l.toxic = 1 THEN 'p' END IS NULL",
    # aggregates
    "a1_global_counts": "SELECT count(*) AS n, count(CASE WHEN url LIKE 'https%' THEN url END) AS n_secure FROM {pages}",
    "a2_group_count": "SELECT lang, count(*) AS n FROM {documents} GROUP BY lang",
    "a4_conditional_sum": "SELECT CAST(sum(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS BIGINT) AS toxic, CAST(sum(CASE WHEN toxic = 1 THEN 0 ELSE 1 END) AS BIGINT) AS clean FROM {labels}",
    "a4_empty_sum": "SELECT CAST(sum(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS BIGINT) AS toxic FROM {labels} WHERE doc_id < 0",
    "a5_high_water": "SELECT max(o_orderdate) AS watermark FROM {orders}",
    "a6_representative": "SELECT lower(p_brand) AS name_normalized, min(p_brand) AS name_raw FROM {part} GROUP BY lower(p_brand)",
    "a7_distinct": "SELECT DISTINCT source, lang FROM {documents}",
    "a9_value_counts": "SELECT quality AS label, count(*) AS n FROM {labels} GROUP BY quality",
    "a12_verdict_count": "SELECT CAST(sum(CASE WHEN l.toxic = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_true FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id",
    "a14_counters": "SELECT CASE WHEN l.doc_id IS NULL THEN 'failed' ELSE 'ok' END AS status, count(*) AS n FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id GROUP BY 1",
    # order, limits, sets, subqueries
    "t1_largest_groups": "SELECT source, count(*) AS n FROM {documents} GROUP BY source ORDER BY n DESC, source LIMIT 5",
    "t2_ordered_queue": "SELECT doc_id FROM {documents} WHERE lang = 'es' ORDER BY doc_id",
    "t3_multi_key": "SELECT lang, source, doc_id FROM {documents} ORDER BY lang, source, doc_id LIMIT 100",
    "t9_paths_capped": "SELECT url FROM {pages} ORDER BY url, page_id LIMIT 40",
    "u1_table_counts": "SELECT 'documents' AS name, count(*) AS n FROM {documents} UNION ALL SELECT 'labels', count(*) FROM {labels} UNION ALL SELECT 'pages', count(*) FROM {pages} UNION ALL SELECT 'orders', count(*) FROM {orders} UNION ALL SELECT 'events', count(*) FROM {events}",
    "u2_concat": "SELECT doc_id, 1 AS net FROM {labels} WHERE quality = 1 UNION ALL SELECT doc_id, 0 FROM {labels} WHERE toxic = 1",
    "q1_cte": "WITH ranked AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) AS rn FROM {documents}) SELECT doc_id, lang FROM ranked WHERE rn <= 10",
    "q2_derived": "SELECT word, count(*) AS n FROM (SELECT split_part(name, ' ', 1) AS word FROM (SELECT p_name AS name FROM {part} WHERE p_size > 10) a) b GROUP BY word",
    "q3_scalar_subqueries": "SELECT 'load' AS source, (SELECT count(*) FROM {orders}) AS n_papers, (SELECT CAST(CAST(max(o_orderdate) AS DATE) AS STRING) FROM {orders}) AS watermark",
    # scalars
    "f3_list_length": "SELECT p_partkey, CAST(length(p_name) - length(replace(p_name, ' ', '')) + 1 AS BIGINT) AS n FROM {part}",
    "f4_split_part": "SELECT p_partkey, split_part(p_name, ' ', 1) AS primary_category, split_part(p_name, ' ', 9) AS missing FROM {part}",
    "f8_nullif": "SELECT page_id, nullif(CASE WHEN url LIKE 'https%' THEN url ELSE '' END, '') AS url FROM {pages}",
    "f9_coalesce": "SELECT d.doc_id, coalesce(l.toxic, -1) AS toxic FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id",
    "f10_concat_null": "SELECT d.doc_id, d.lang || '/' || CASE WHEN l.toxic = 1 THEN 'toxic' END AS tag FROM {documents} d JOIN {labels} l ON d.doc_id = l.doc_id",
    "f11_is_not_null": "SELECT d.doc_id, l.doc_id IS NOT NULL AS has_label FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id",
    "f13_trim": "SELECT item_id, trim('  ' || text || ' ') AS text FROM {benchmark}",
    "f14_lower": "SELECT c_custkey, lower(c_name) AS name FROM {customer}",
    "f17_cast_date": "SELECT event_id, CAST(CAST(ts AS DATE) AS STRING) AS day FROM {events}",
    "f19_case": "SELECT p_partkey, CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 30 THEN 'medium' ELSE 'large' END AS size FROM {part}",
    "f21_equality_column": "SELECT p_partkey, split_part(p_name, ' ', 2) = split_part(p_name, ' ', 1) AS is_primary FROM {part}",
    "f22_truncate": "SELECT doc_id, substring(text, 1, 400) AS short, length(substring(text, 1, 800)) AS n FROM {documents}",
    "f26_title_abstract": "SELECT d.doc_id, d.lang || '. ' || d.text AS text FROM {documents} d",
    "f33_percentage": "SELECT CAST(100.0 * sum(CASE WHEN toxic = 0 THEN 1 ELSE 0 END) / count(*) AS DOUBLE) AS success_rate FROM {labels}",
}


def run(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Tables are read by path, so nothing is registered and scans are pruned as usual."""

    class Tables(dict):
        def __missing__(self, table):
            return f"parquet.`{sf_dir}/{table}.parquet`"

    return spark.sql(SQL[name].format_map(Tables()))


def oracle(name: str) -> str:
    class Names(dict):
        def __missing__(self, table):
            return table

    return SQL[name].format_map(Names())
