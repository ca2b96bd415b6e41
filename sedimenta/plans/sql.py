"""DuckDB SQL of the queries, written from the rules rather than the plans."""

NEVER = "(-9223372036854775808)::BIGINT"

_E = """
e AS (SELECT event_id, user_id, event_type, value, epoch_us(ts) AS us, strftime(ts, '%Y-%m-%d') AS day FROM events),
cell AS (SELECT *, CASE WHEN value < 5 THEN 'd' ELSE 'live' END AS kind FROM e WHERE event_type NOT IN ('signup', 'error')),
newest AS (SELECT * FROM cell QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY us DESC, kind DESC, event_id::VARCHAR DESC) = 1),
del AS (SELECT user_id, coalesce(max(us) FILTER (event_type = 'signup'), -9223372036854775808)::BIGINT AS deleted_at FROM e GROUP BY user_id),
alive AS (
  SELECT n.*, d.deleted_at FROM newest n JOIN del d USING (user_id)
  WHERE n.us > d.deleted_at
    AND NOT EXISTS (SELECT 1 FROM e r WHERE r.event_type = 'error' AND r.user_id = n.user_id AND n.event_type BETWEEN 'click' AND 'purchase' AND r.us >= n.us)
)"""
_SHOWN = "event_type || '=' || event_id || CASE WHEN kind = 'd' THEN ':d' ELSE '' END"
_Q01 = "SELECT user_id, event_type, arg_max(event_id, (us, event_id::VARCHAR)) AS event_id, max(epoch_us(ts)) AS us FROM (SELECT *, epoch_us(ts) AS us FROM events) GROUP BY 1, 2"
_Q10 = f"""WITH {_E}
SELECT d.user_id, d.deleted_at, count(a.event_id)::BIGINT AS n_cells, coalesce(string_agg({_SHOWN}, '|' ORDER BY event_type), '') AS cells
FROM del d LEFT JOIN alive a ON a.user_id = d.user_id GROUP BY 1, 2"""
_SIZE = "(15 + length(event_type) + length(event_id::VARCHAR))"
_SIZED = f"""WITH {_E},
atom AS (
  SELECT user_id, us, CASE event_type WHEN 'signup' THEN NULL WHEN 'error' THEN 'click' ELSE event_type END AS name,
         CASE event_type WHEN 'signup' THEN 'row' WHEN 'error' THEN 'rt' ELSE CASE WHEN value < 5 THEN 'd' ELSE 'live' END END AS kind, event_id,
         CASE event_type WHEN 'signup' THEN 0 WHEN 'error' THEN 30 ELSE {_SIZE} END AS size
  FROM e
),
run AS (
  SELECT *, sum(size) OVER (PARTITION BY user_id ORDER BY name NULLS FIRST, CASE WHEN kind = 'row' THEN NULL ELSE us END NULLS FIRST, kind,
         CASE WHEN kind IN ('row', 'rt') THEN NULL ELSE event_id::VARCHAR END NULLS FIRST ROWS UNBOUNDED PRECEDING) AS upto
  FROM atom
)"""
_LOADED = f"""WITH {_E}, loaded AS (SELECT n.*, d.deleted_at FROM newest n JOIN del d USING (user_id))"""

SQL = {
    "q01_lww": _Q01,
    "q02_row_delete_marker": f"WITH {_E} SELECT * FROM del",
    "q03_row_tombstone": f"""WITH {_E} SELECT user_id, event_type, event_id FROM newest n
        WHERE NOT EXISTS (SELECT 1 FROM e s WHERE s.event_type = 'signup' AND s.user_id = n.user_id AND s.us >= n.us)""",
    "q04_range_tombstone": f"""WITH {_E} SELECT user_id, event_type, event_id FROM newest n
        WHERE event_type NOT BETWEEN 'click' AND 'purchase' OR us > coalesce((SELECT max(us) FROM e r WHERE r.event_type = 'error' AND r.user_id = n.user_id), -1)""",
    "q05_keep_cell_tombstones": f"WITH {_E} SELECT kind, count(*) AS n_cells FROM alive GROUP BY kind",
    "q06_empty_row_kept": f"WITH {_E} SELECT d.user_id, count(a.event_id)::BIGINT AS n_cells FROM del d LEFT JOIN alive a USING (user_id) GROUP BY 1",
    "q07_ordered_cells": f"SELECT user_id, string_agg(event_type || '=' || event_id, '|' ORDER BY event_type) AS cells FROM ({_Q01}) GROUP BY 1",
    "q08_trace_source": f"""WITH {_E},
        d2 AS (SELECT user_id, day, coalesce(max(us) FILTER (event_type = 'signup'), -9223372036854775808)::BIGINT AS deleted_at FROM e GROUP BY ALL),
        n2 AS (SELECT * FROM cell QUALIFY row_number() OVER (PARTITION BY user_id, day, event_type ORDER BY us DESC) = 1),
        a2 AS (SELECT n.* FROM n2 n JOIN d2 USING (user_id, day) WHERE n.us > deleted_at AND NOT EXISTS (
            SELECT 1 FROM e r WHERE r.event_type = 'error' AND r.user_id = n.user_id AND r.day = n.day AND n.event_type BETWEEN 'click' AND 'purchase' AND r.us >= n.us))
        SELECT d2.user_id, d2.day, deleted_at, coalesce(string_agg({_SHOWN}, '|' ORDER BY event_type), '') AS cells
        FROM d2 LEFT JOIN a2 ON a2.user_id = d2.user_id AND a2.day = d2.day GROUP BY ALL""",
    "q09_size_limit": f"""{_SIZED}
        SELECT user_id, count(*) FILTER (upto <= 1500) AS n_atoms, coalesce(sum(size) FILTER (upto <= 1500), 0)::BIGINT AS bytes, max((upto > 1500)::BIGINT) AS too_big
        FROM run GROUP BY 1""",
    "q10_compact": _Q10,
    "q11_too_large_row": f"""WITH {_E},
        line AS (SELECT d.user_id, d.deleted_at, coalesce(sum({_SIZE}), 0) AS size, coalesce(string_agg('["' || event_type || '","' || event_id || '",' || us ||
            CASE WHEN kind = 'd' THEN ',"d"' ELSE '' END || ']', ',' ORDER BY event_type), '') AS cells
            FROM del d LEFT JOIN alive a ON a.user_id = d.user_id GROUP BY 1, 2)
        SELECT user_id || chr(9) || '{{"' || user_id || '":{{"deletedAt":' || deleted_at || ',"columns":[' ||
            CASE WHEN size > 100 THEN '"error","row too large: ' || format('{{:,}}', size::BIGINT) || ' bytes - limit 100 bytes",0' ELSE cells END || ']}}}}' AS line,
            size > 100 AS too_big FROM line""",
    "q12_union_inputs": f"SELECT user_id, event_type, event_id FROM ({_Q01})",
    "q13_cleanse": f"""{_LOADED} SELECT user_id, string_agg(event_type, ',' ORDER BY event_type) AS names FROM loaded
        WHERE NOT deleted_at > us AND kind <> 'd' GROUP BY 1""",
    "q14_loader_projection": f"""{_LOADED} SELECT d.user_id, d.deleted_at AS deletedat, max(CASE WHEN event_type = 'click' THEN event_id END) AS click,
        max(CASE WHEN event_type = 'view' THEN us END) AS view_ts, max(CASE WHEN event_type = 'purchase' AND kind = 'd' THEN 'd' END) AS purchase_status
        FROM del d LEFT JOIN loaded l ON l.user_id = d.user_id GROUP BY 1, 2""",
    "q15_cql_rows": "SELECT user_id, " + ", ".join(f"max(CASE WHEN event_type = '{t}' THEN event_id END) AS {t}" for t in ("click", "error", "purchase", "signup", "view")) + f" FROM ({_Q01}) GROUP BY 1",
    "q16_static_columns": "SELECT c_custkey AS o_custkey, c_mktsegment, o_orderkey, o_orderpriority FROM customer LEFT JOIN orders ON o_custkey = c_custkey",
    "q17_hex_key": "SELECT c_custkey, lower(hex(c_name)) AS hex_key FROM customer",
    "q18_legacy_name": """SELECT p_partkey, p_brand || ' \\"' || p_type || '\\\\  ' || p_name AS legacy FROM part""",
    "q19_cast_int_long": """SELECT o_orderkey, o_custkey::VARCHAR AS as_text, o_custkey::INTEGER AS as_int, o_custkey AS as_long, (o_orderkey * -7919)::INTEGER AS four_int,
        o_orderkey * -7919 AS eight_long, (o_orderkey * -7919)::INTEGER AS eight_int, NULL::BIGINT AS nothing FROM orders""",
    "q20_signed_key_order": """SELECT c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY k, c_custkey) AS place FROM (
        SELECT *, list_transform([1, 3, 5, 7], lambda i: ((('0x' || substr(md5(c_name), i, 2))::INTEGER + 128) % 256)) AS k FROM customer)""",
    "q21_latest_batch": "SELECT max('/in/batch_id=' || strftime(ts, '%Y%m%d')) AS path FROM events",
    "q22_secondary_index_filter": "SELECT page_id, url AS path FROM pages WHERE len(list_last(string_split(url, '/'))) - len(replace(list_last(string_split(url, '/')), '.', '')) <= 1",
    "q23_distinct_globs": "SELECT DISTINCT regexp_replace(url, '/[^/]*$', '') || '/*-Data.db' AS pattern FROM pages",
    "q24_counters": f"""{_SIZED}
        SELECT count(*) AS rows_written, sum(big)::BIGINT AS rows_too_big, 0::BIGINT AS inputs_in_error FROM (SELECT user_id, max((upto > 1500)::INTEGER) AS big FROM run GROUP BY 1)""",
    "q25_version_homogeneity": "SELECT 'jb' AS version, count(*) AS files, true AS two_refused FROM orders WHERE o_orderkey % 2 = 0",
    "q26_partition_info": """SELECT 'priority=' || o_orderpriority[1] AS partition, '/w/priority=' || o_orderpriority[1] AS location, count(*) AS files, sum(o_orderkey)::BIGINT AS bytes
        FROM orders GROUP BY 1, 2""",
    "q27_json_round_trip": f"""WITH {_E} SELECT d.user_id, d.deleted_at, event_type, event_id, us, CASE WHEN kind = 'd' THEN 'd' END AS status
        FROM del d LEFT JOIN alive a ON a.user_id = d.user_id""",
    "q28_typed_rows": "SELECT c_custkey AS o_custkey, o_orderkey, c_mktsegment AS segment, o_orderstatus, o_orderpriority FROM customer LEFT JOIN orders ON o_custkey = c_custkey",
    "q29_uuid_text": "SELECT s_suppkey, md5(s_name)::UUID::VARCHAR AS id, s_suppkey * -99991 AS number FROM supplier",
    "q30_table_files": _Q10,
    "q31_cells": f"WITH {_E} SELECT user_id, event_type, event_id, deleted_at FROM alive",
    "q32_library_lines": f"""{_LOADED} SELECT '{{"' || user_id || '": {{"deletedAt": ' || deleted_at || ', "columns": [' ||
        string_agg('["' || event_type || '","' || event_id || '",' || us || ']', ', ' ORDER BY event_type) || ']}}}}' AS line
        FROM loaded WHERE NOT deleted_at > us AND kind <> 'd' GROUP BY user_id, deleted_at""",
    "q33_packed_files": _Q10,
    "q34_packed_by_minute": _Q10,
    "q35_directory_walk": "SELECT 'r=' || n_regionkey || '/n-' || n_nationkey || '-jb-1-Data.db' AS path, length(n_name) AS length FROM nation WHERE n_nationkey % 7 <> 0",
    "q36_first_file": """SELECT path, length FROM (
        SELECT 'r=' || n_regionkey || '/n-' || n_nationkey || x AS path, CASE x WHEN '-jb-1-Index.db' THEN length('i' || n_nationkey) WHEN '-jb-1-Data.db' THEN CASE WHEN n_nationkey % 7 = 0 THEN 0 ELSE length(n_name) END ELSE length(n_name) END AS length
        FROM nation, (VALUES ('-jb-1-Data.db'), ('-jb-1-Index.db'), ('.idx-jb-2-Data.db')) t(x)) WHERE length > 0 ORDER BY path LIMIT 1""",
    "q37_manifest": "SELECT DISTINCT trim(url) AS path FROM pages WHERE trim(url) <> ''",
    "q38_copy": """SELECT 'r=' || n_regionkey || '/n-' || n_nationkey || '-jb-1-' || x AS path, length(text) AS length, text, true AS again_refused FROM (
        SELECT *, CASE x WHEN 'Index.db' THEN 'i' || n_nationkey ELSE CASE WHEN n_nationkey % 7 = 0 THEN '' ELSE n_name END END AS text FROM nation, (VALUES ('Data.db'), ('Index.db')) t(x)) WHERE text <> ''""",
    "q39_copy_snappy": "SELECT 'n-' || n_nationkey AS path, length(n_name) * 100 AS length, md5(repeat(n_name, 100)) AS digest FROM nation",
    "q40_manifest_or_inputs": "SELECT true AS none_refused, true AS both_refused",
    "q41_comparator_order": """SELECT o_orderkey,
        row_number() OVER (PARTITION BY o_orderpriority ORDER BY (o_custkey * 7919) % 1000 - 500 DESC, o_orderkey) AS int_place,
        row_number() OVER (PARTITION BY o_orderpriority ORDER BY (o_orderkey % 400 - 200) * CASE o_orderkey % 3 WHEN 0 THEN 100 WHEN 1 THEN 10 ELSE 1 END, o_orderkey) AS decimal_place,
        row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_custkey % 50 - 25, o_orderstatus DESC, o_orderkey) AS composite_place FROM orders""",
    "q42_rendered_order": "SELECT p_brand AS key, string_agg(p_partkey::VARCHAR, ',' ORDER BY p_partkey) AS by_number, string_agg(p_partkey::VARCHAR, ',' ORDER BY p_partkey::VARCHAR) AS by_text FROM part GROUP BY 1",
    "q43_float_casts": """SELECT c_custkey, c_acctbal AS eight_double, c_acctbal::FLOAT::DOUBLE AS four_double, c_acctbal::FLOAT::DOUBLE AS four_float, c_acctbal::FLOAT::DOUBLE AS eight_float,
        NULL::DOUBLE AS nothing FROM customer""",
    "q44_typed_values": """SELECT o_orderkey, epoch_ms(o_orderdate) AS millis, lower(hex(o_orderstatus)) AS blob, (cents // 100) || '.' || lpad((cents % 100)::VARCHAR, 2, '0') AS price,
        (o_custkey * -1000)::VARCHAR AS thousands, (o_orderkey::HUGEINT * 18446744073709551616)::VARCHAR AS large, (o_orderkey::HUGEINT * -18446744073709551616)::VARCHAR AS large_negative
        FROM (SELECT *, round(o_totalprice * 100)::BIGINT AS cents FROM orders)""",
    "q45_paths": """SELECT page_id, 's3n://b/' || url AS old, 'h/s3://' || url AS kept, 'x y+z/' || page_id || '/f' AS below, '/other/' || page_id AS outside,
        '/base/x%20y+z/' || page_id AS folder, 'f' AS name FROM pages""",
    "q46_key_branch": "SELECT DISTINCT o_custkey, 1::BIGINT AS branches, true AS in_range FROM orders",
    "q47_ddl": """SELECT * FROM (VALUES ('one', 'UUIDType', 'UTF8Type', 'v', '', false),
        ('Two', 'CompositeType(Int32Type,UTF8Type)', 'CompositeType(ReversedType(LongType),UTF8Type)', 'v', '', true),
        ('three', 'Int32Type', 'CompositeType(UTF8Type)', 'v', '', false),
        ('four', 'TimeUUIDType', 'CompositeType(TimestampType,UTF8Type)', 'v', 's', true)) t(name, key_type, comparator, regular, static, exportable)""",
    "q48_export_job": "SELECT c_custkey AS o_custkey, o_orderkey, c_mktsegment AS segment, o_orderstatus, true AS nested_refused FROM customer LEFT JOIN orders ON o_custkey = c_custkey",
    "q49_snapshot_job": f"""WITH {_E}, size AS (SELECT user_id, sum({_SIZE}) AS size FROM alive GROUP BY 1)
        SELECT (SELECT count(DISTINCT user_id) FROM e) AS lines, (SELECT count(DISTINCT user_id) FROM e) AS rows_written, (SELECT count(*) FROM size WHERE size > 1500) AS rows_too_big,
        0::BIGINT AS inputs_in_error, true AS refused, 0::BIGINT AS left_over""",
    "q50_key_order": "SELECT 0::BIGINT AS out_of_order, count(DISTINCT user_id) AS n_rows FROM events",
    "q51_typed_ranges": """WITH o AS (SELECT o_custkey, o_orderkey, o_orderkey % 200 - 100 AS number, o_orderkey % 7 AS v FROM orders),
        cell AS (
          SELECT o_custkey, number, max(o_orderkey) AS ts, 'int' AS names FROM o GROUP BY o_custkey, number
          UNION ALL SELECT o_custkey, number, max(o_orderkey), 'composite' FROM o GROUP BY o_custkey, number, v),
        kept AS (SELECT * FROM cell WHERE NOT (number BETWEEN -20 AND 30 AND ts <= o_custkey * 40 AND EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)))
        SELECT o_custkey AS c_custkey, names, way, count(*) AS n_cells, sum(number)::BIGINT AS total FROM kept, (VALUES ('rows'), ('cells')) t(way) GROUP BY ALL""",
    "q52_stream": _Q10,
    "q53_refused_casts": "SELECT * FROM (VALUES ('bag', true), ('map', true), ('tuple', true), ('boolean', true), ('datetime', true)) t(kind, refused)",
}
