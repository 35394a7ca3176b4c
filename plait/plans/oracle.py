"""Reference SQL (DuckDB dialect) for every catalogue query, over the same
parquet tables registered as views.  Column names and types match the
Spark side."""

from __future__ import annotations

from .catalogue import ROUND_ONE_BEFORE, ROUND_TWO_FROM, SOURCE_FROM, TARGET_BEFORE

_LINE_KEY = "concat_ws('-', l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey)"
_DAY = "strftime({c}, '%Y-%m-%d')"

_ORDERS_WITH_LINES = """
    FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey"""

_LINES_OF_ORDERS = """
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""

# Every line of an order reply with its feature key: document (order / page)
# and position in the document's sorted feature array (line number, part,
# supplier, then the rest of the feature, as the document builder sorts).
_FEATURES = f"""
    WITH c AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey),
         g AS (SELECT l.*, {_LINE_KEY} AS linekey, strftime(l.l_shipdate, '%Y-%m-%d') AS shipdate,
                      CAST((l.l_partkey * 1000003 + l.l_suppkey * 1009 + l.l_linenumber)
                           % CAST(ceil(c.n / 500.0) AS BIGINT) AS INTEGER) AS page
               FROM lineitem l JOIN c ON l.l_orderkey = c.l_orderkey
                               JOIN orders o ON l.l_orderkey = o.o_orderkey),
         f AS (SELECT g.*, concat_ws('/', l_orderkey, page, row_number() OVER (
                          PARTITION BY l_orderkey, page
                          ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                                   l_discount, l_tax, linekey, l_orderkey, l_linenumber, l_partkey,
                                   l_suppkey, l_returnflag, l_linestatus, shipdate) - 1) AS featurekey
               FROM g)"""


def _batches(null_keys: bool) -> str:
    key = ("CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderkey END"
           if null_keys else "o_orderkey")
    return f"""
    WITH t AS (SELECT {key} AS o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
                      o_orderpriority FROM orders WHERE o_orderdate < TIMESTAMP '{TARGET_BEFORE}'),
         s AS (SELECT {key} AS o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2 AS o_totalprice,
                      o_orderdate, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '{SOURCE_FROM}')
    SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey)
    UNION ALL SELECT * FROM s"""


def _profile_part(col: str) -> str:
    return (f"SELECT '{col}' AS column_name, count(*) AS n_rows, count(*) - count({col}) AS n_nulls, "
            f"count(DISTINCT {col}) AS n_distinct, CAST(min({col}) AS VARCHAR) AS min_value, "
            f"CAST(max({col}) AS VARCHAR) AS max_value FROM orders")


ORACLE = {
    "q01_parse_json": """
        SELECT event_id, user_id, event_type,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""",

    "q02_infer_schema": """
        SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""",

    "q03_explode": """
        SELECT vec_id, label, CAST(v AS DOUBLE) AS value
        FROM (SELECT vec_id, label, unnest(embedding) AS v FROM embeddings)""",

    "q04_posexplode": """
        SELECT vec_id, CAST(pos AS BIGINT) AS pos, CAST(embedding[pos + 1] AS DOUBLE) AS value
        FROM (SELECT vec_id, embedding, unnest(range(len(embedding))) AS pos FROM embeddings)""",

    "q05_explode_outer": f"""
        SELECT o.o_orderkey AS order_key, l.l_linenumber AS line_no, l.l_partkey AS part_key,
               l.l_quantity AS quantity, {_DAY.format(c='l.l_shipdate')} AS ship_date
        {_ORDERS_WITH_LINES}""",

    "q06_posexplode_outer": """
        WITH c AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey),
             p AS (SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
                          CAST((l.l_partkey * 1000003 + l.l_suppkey * 1009 + l.l_linenumber)
                               % CAST(ceil(c.n / 500.0) AS BIGINT) AS INTEGER) AS page
                   FROM lineitem l JOIN c ON l.l_orderkey = c.l_orderkey)
        SELECT o.o_orderkey AS order_key, COALESCE(p.page, 0) AS page,
               CASE WHEN p.l_orderkey IS NULL THEN NULL ELSE CAST(row_number() OVER (
                    PARTITION BY o.o_orderkey, p.page
                    ORDER BY p.l_linenumber, p.l_partkey, p.l_suppkey) - 1 AS BIGINT) END AS pos,
               p.l_linenumber AS line_no, p.l_partkey AS part_key, p.l_suppkey AS supp_key
        FROM orders o LEFT JOIN p ON p.l_orderkey = o.o_orderkey""",

    "q07_expand_struct": f"""
        SELECT o_orderkey AS orderkey, o_custkey AS custkey, o_orderstatus AS orderstatus,
               o_totalprice AS totalprice, {_DAY.format(c='o_orderdate')} AS orderdate,
               o_orderpriority AS orderpriority FROM orders""",

    "q08_flatten": f"""
        SELECT 'FeatureCollection' AS type,
               o.o_orderkey AS properties_orderkey, o.o_custkey AS properties_custkey,
               o.o_orderstatus AS properties_orderstatus, o.o_totalprice AS properties_totalprice,
               {_DAY.format(c='o.o_orderdate')} AS properties_orderdate,
               o.o_orderpriority AS properties_orderpriority,
               CASE WHEN l.l_orderkey IS NULL THEN NULL ELSE 'Feature' END AS features_type,
               l.l_quantity AS features_measures_quantity,
               l.l_extendedprice AS features_measures_extendedprice,
               l.l_discount AS features_measures_discount, l.l_tax AS features_measures_tax,
               CASE WHEN l.l_orderkey IS NULL THEN NULL ELSE {_LINE_KEY} END AS features_properties_linekey,
               l.l_orderkey AS features_properties_orderkey, l.l_linenumber AS features_properties_lineno,
               l.l_partkey AS features_properties_partkey, l.l_suppkey AS features_properties_suppkey,
               l.l_returnflag AS features_properties_returnflag,
               l.l_linestatus AS features_properties_linestatus,
               {_DAY.format(c='l.l_shipdate')} AS features_properties_shipdate
        {_ORDERS_WITH_LINES}""",

    "q09_split_measures": f"""{_FEATURES}
        SELECT featurekey, l_quantity AS quantity, l_extendedprice AS extendedprice,
               l_discount AS discount, l_tax AS tax FROM f""",

    "q10_split_lines": f"""{_FEATURES}
        SELECT featurekey, linekey, l_orderkey AS orderkey, l_linenumber AS lineno,
               l_partkey AS partkey, l_suppkey AS suppkey, l_returnflag AS returnflag,
               l_linestatus AS linestatus, shipdate FROM f""",

    "q31_bronze_lines": f"""
        SELECT {_LINE_KEY} AS linekey, l.l_orderkey AS orderkey, l.l_linenumber AS lineno,
               l.l_partkey AS partkey, l.l_suppkey AS suppkey, l.l_returnflag AS returnflag,
               l.l_linestatus AS linestatus, {_DAY.format(c='l.l_shipdate')} AS shipdate
        {_LINES_OF_ORDERS}""",

    "q11_recombine": f"""{_FEATURES}
        SELECT featurekey, l_quantity AS quantity, l_extendedprice AS extendedprice,
               l_discount AS discount, l_tax AS tax, linekey, l_orderkey AS orderkey,
               l_linenumber AS lineno, l_partkey AS partkey, l_suppkey AS suppkey,
               l_returnflag AS returnflag, l_linestatus AS linestatus, shipdate FROM f""",

    "q12_sanitize_sql": f"""
        SELECT o.o_orderkey AS orderkey, {_LINE_KEY} AS linekey, l.l_extendedprice AS extendedprice,
               {_DAY.format(c='l.l_shipdate')} AS shipdate
        {_LINES_OF_ORDERS}""",

    "q13_upsert": _batches(null_keys=False),

    "q14_dedupe_latest": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
               l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY l_orderkey, l_linenumber
                  ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC,
                           l_quantity DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
                           l_linestatus DESC) AS rn
              FROM lineitem) WHERE rn = 1""",

    "q15_scd2_history": """
        WITH x AS (SELECT user_id, event_id, ts, event_type,
                          lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev,
                          row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
                   FROM events),
             v AS (SELECT * FROM x WHERE rn = 1 OR prev IS DISTINCT FROM event_type)
        SELECT user_id, event_type, event_id AS start_event_id, ts AS valid_from,
               lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to,
               lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL AS is_current
        FROM v""",

    "q29_scd2_load": """
        WITH x AS (SELECT user_id, event_id, ts, event_type,
                          lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev
                   FROM events),
             v AS (SELECT * FROM x WHERE prev IS DISTINCT FROM event_type)
        SELECT user_id, event_type, event_id, ts AS valid_from,
               lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to,
               lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL AS is_current
        FROM v""",

    "q16_key_report": """
        SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",

    "q17_upsert_null_keys": _batches(null_keys=True),

    "q18_fetch": """
        SELECT user_id AS request_key,
               CASE WHEN user_id % 10 = 3 THEN 403 WHEN user_id % 10 = 7 THEN 500 ELSE 200 END AS status,
               user_id % 10 NOT IN (3, 7) AS accepted,
               CASE WHEN user_id % 10 NOT IN (3, 7) THEN user_id END AS body_user
        FROM (SELECT DISTINCT user_id FROM events)""",

    "q19_corrupt_capture": """
        SELECT event_id,
               CASE WHEN event_type = 'error' THEN NULL
                    ELSE CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k,
               event_type = 'error' AS is_corrupt
        FROM events""",

    "q20_load_twice": _batches(null_keys=False),

    "q21_replace": "SELECT * FROM orders",

    "q30_register_append": "SELECT * FROM orders",

    "q22_incremental": f"""
        SELECT event_id, ts, user_id, event_type,
               CASE WHEN ts >= TIMESTAMP '{ROUND_TWO_FROM}' THEN value + 1 ELSE value END AS value, props
        FROM events""",

    "q23_profile": "\nUNION ALL\n".join(_profile_part(c) for c in (
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")),

    "q24_first_rows": "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",

    "q25_step_observed": f"""
        SELECT 'explode_lines' AS step, count(*) AS n_rows {_LINES_OF_ORDERS}""",

    "q26_cluster": """
        SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty,
               CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS sum_price_cents,
               count(*) AS n_rows, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
        FROM lineitem GROUP BY l_returnflag, l_linestatus""",

    "q27_conform": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
               CAST(NULL AS VARCHAR) AS o_orderpriority FROM orders""",

    "q28_explode_map": """
        SELECT event_id, key, CAST(json_extract_string(props, '$."' || key || '"') AS INTEGER) AS value
        FROM (SELECT event_id, props, unnest(json_keys(props)) AS key FROM events)""",

    "q32_payload_forms": """
        WITH e AS (SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
        SELECT event_id, k, CAST(NULL AS VARCHAR) AS reason FROM e WHERE event_type IN ('view', 'click')
        UNION ALL SELECT event_id, 1000, NULL FROM e WHERE event_type = 'click'
        UNION ALL SELECT event_id, NULL, CASE WHEN event_type = 'error' THEN 'status 400' ELSE 'empty' END
        FROM e WHERE event_type IS NULL OR event_type NOT IN ('view', 'click')""",

    "q33_rename": """
        SELECT o_orderkey AS order_id, o_custkey AS customer, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
        FROM orders""",

    "q34_schema_rows": " UNION ALL ".join(f"""
        SELECT '{c}' AS path, '{t}' AS type, true AS nullable, count(*) AS n_rows, count(*) - count({c}) AS n_nulls
        FROM orders""" for c, t in (("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
                                    ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"),
                                    ("o_orderpriority", "string"))),

    "q35_geometry": """
        SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Polygon' WHEN 'O' THEN 'MultiPolygon' ELSE 'Point' END AS kind,
               CASE WHEN o_orderstatus = 'F' THEN o_custkey::DOUBLE END AS polygon_x,
               CASE WHEN o_orderstatus = 'O' THEN o_custkey::DOUBLE END AS multipolygon_x,
               length(o_custkey::VARCHAR) + 6 + CASE o_orderstatus WHEN 'F' THEN 4 WHEN 'O' THEN 6 ELSE 0 END AS raw_chars
        FROM orders""",

    "q36_map_outer": """
        SELECT event_id, CASE WHEN event_type <> 'error' THEN 0 END::INTEGER AS pos,
               CASE WHEN event_type <> 'error' THEN 'k' END AS key,
               CASE WHEN event_type <> 'error' THEN json_extract_string(props, '$.k') END::INTEGER AS value
        FROM events
        UNION ALL SELECT event_id, 1, 'j', 1 FROM events WHERE event_type = 'purchase'""",

    "q39_upsert_partitioned_text": f"""
        SELECT *, o_orderpriority || ' a:b%c' AS p FROM ({_batches(null_keys=False)})""",

    "q40_upsert_null_keys_table": _batches(null_keys=True),

    "q41_upsert_empty_batch": "SELECT * FROM orders",

    "q42_upsert_new_column": f"""
        SELECT *, CASE WHEN o_orderdate >= TIMESTAMP '{SOURCE_FROM}' THEN o_orderpriority END AS o_note
        FROM ({_batches(null_keys=False)})""",
}

ORACLE["q37_scd2_late_rows"] = ORACLE["q29_scd2_load"]
ORACLE["q38_scd2_null_keys"] = ORACLE["q29_scd2_load"].replace(
    "FROM events", "FROM (SELECT * REPLACE (CASE WHEN user_id > 20 THEN user_id END AS user_id) FROM events)")

ORACLE["q43_upsert_key_buckets"] = _batches(null_keys=True)
ORACLE["q44_upsert_touched_parts"] = """
    SELECT count(DISTINCT CASE WHEN CAST(o_orderdate AS DATE) = DATE '1996-01-02' THEN o_orderkey // 500 END) AS parts_rewritten,
           count(DISTINCT o_orderkey // 500) AS parts, count(*) AS n_rows,
           count(*) FILTER (WHERE CAST(o_orderdate AS DATE) = DATE '1996-01-02') AS n_updated
    FROM orders"""
ORACLE["q45_request_source"] = ORACLE["q18_fetch"]
ORACLE["q46_request_stream"] = f"""
    WITH k AS (SELECT DISTINCT user_id * 100 + dayofmonth(ts) AS request_key, CASE WHEN ts < TIMESTAMP '{ROUND_ONE_BEFORE}' THEN 1 ELSE 2 END AS run
               FROM events)
    SELECT CAST(request_key AS BIGINT) AS request_key,
           CAST(CASE WHEN request_key % 10 = 3 THEN 403 WHEN request_key % 10 = 7 THEN 500 ELSE 200 END AS INTEGER) AS status,
           CAST(run AS INTEGER) AS run FROM k"""
ORACLE["q47_call_ledger"] = """
    WITH u AS (SELECT user_id, CASE WHEN user_id % 10 = 3 THEN 403 WHEN user_id % 10 = 7 THEN 500 ELSE 200 END AS status,
                      row_number() OVER (ORDER BY CAST(user_id AS VARCHAR)) AS n
               FROM (SELECT DISTINCT user_id FROM events WHERE user_id IS NOT NULL)),
         one AS (SELECT * FROM u WHERE n <= 50),
         two AS (SELECT user_id, status, 0 AS tries FROM u WHERE n > 50
                 UNION ALL SELECT user_id, status, 1 FROM one WHERE status <> 200
                 ORDER BY tries, CAST(user_id AS VARCHAR) LIMIT 50)
    SELECT user_id AS request_key, DATE '2024-02-01' AS call_day, CAST(status AS INTEGER) AS status FROM one
    UNION ALL SELECT user_id, DATE '2024-02-02', CAST(status AS INTEGER) FROM two"""
ORACLE["q48_history_one_second"] = """
    WITH e AS (SELECT event_id, event_type, user_id, CAST(date_trunc('year', ts) AS TIMESTAMP) AS ts FROM events),
         x AS (SELECT *, lag(user_id) OVER w AS prev, row_number() OVER w AS rn FROM e WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)),
         v AS (SELECT * FROM x WHERE rn = 1 OR prev IS DISTINCT FROM user_id)
    SELECT event_type, user_id, event_id AS start_event_id, ts AS valid_from,
           lead(ts) OVER w AS valid_to, lead(event_id) OVER w IS NULL AS is_current
    FROM v WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)"""
_NUMBERS = {"o_orderkey": "o_orderkey", "o_custkey": "o_custkey", "o_totalprice": "o_totalprice", "o_orderdate": "epoch_us(o_orderdate)"}
ORACLE["q49_profile_sketches"] = " UNION ALL ".join(f"""
    SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_nulls,
           {f"CAST(min({_NUMBERS[c]}) AS DOUBLE)" if c in _NUMBERS else "CAST(NULL AS DOUBLE)"} AS low,
           {f"CAST(max({_NUMBERS[c]}) AS DOUBLE)" if c in _NUMBERS else "CAST(NULL AS DOUBLE)"} AS high,
           true AS distinct_close, {"true" if c in _NUMBERS else "CAST(NULL AS BOOLEAN)"} AS median_inside
    FROM orders""" for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"))
ORACLE["q50_layout_proof"] = """
    SELECT CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS low, count(*) AS n_rows, true AS pruned, true AS complete
    FROM lineitem WHERE year(l_shipdate) = 1995 AND day(l_shipdate) < 28 GROUP BY 1"""

_ORDER_FIELDS = {"order-key": "o_orderkey", "cust-key": "o_custkey", "order-status": "o_orderstatus", "total-price": "o_totalprice",
                 "order-date": "o_orderdate", "order-priority": "o_orderpriority"}
_LINE_FIELDS = {"line-key": "l_orderkey", "order-key": "l_orderkey", "line-no": "l_linenumber", "part-key": "l_partkey", "supp-key": "l_suppkey",
                "return-flag": "l_returnflag", "line-status": "l_linestatus", "ship-date": "l_shipdate"}
ORACLE["q51_paths_unknown_depth"] = " UNION ALL ".join(
    [f"SELECT 'properties.{f}' AS path, count({c}) AS n_values, count(DISTINCT CASE WHEN {c} IS NOT NULL THEN o_orderkey END) AS n_documents FROM orders HAVING count({c}) > 0"
     for f, c in _ORDER_FIELDS.items()]
    + [f"SELECT 'features[].properties.{f}', count({c}), count(DISTINCT CASE WHEN {c} IS NOT NULL THEN l_orderkey END) {_LINES_OF_ORDERS} HAVING count({c}) > 0"
       for f, c in _LINE_FIELDS.items()])
ORACLE["q52_geometry_collection"] = """
    WITH o AS (SELECT o_orderkey, o_custkey::DOUBLE AS x, coalesce(o_orderstatus, '') AS s FROM orders)
    SELECT o_orderkey, CASE s WHEN 'F' THEN '0.0' WHEN 'O' THEN '0' ELSE '' END AS path, 'Point' AS kind, x FROM o
    UNION ALL SELECT o_orderkey, CASE s WHEN 'F' THEN '0.1' ELSE '1' END, 'LineString', x FROM o WHERE s IN ('F', 'O')
    UNION ALL SELECT o_orderkey, '1', 'Point', x FROM o WHERE s = 'F'"""
ORACLE["q53_stream_metrics"] = f"""
    WITH e AS (SELECT CAST(CASE WHEN ts < TIMESTAMP '{ROUND_ONE_BEFORE}' THEN 0 ELSE 1 END AS BIGINT) AS batch_id, event_type, value FROM events)
    SELECT batch_id, 'rows' AS metric, count(*) AS value FROM e GROUP BY batch_id
    UNION ALL SELECT batch_id, 'errors', count(*) FILTER (WHERE event_type = 'error') FROM e GROUP BY batch_id
    UNION ALL SELECT batch_id, 'users', count(value) FROM e GROUP BY batch_id"""
ORACLE["q54_nested_evolution"] = f"""
    SELECT o_orderkey, o_totalprice, CASE WHEN o_orderdate >= TIMESTAMP '{SOURCE_FROM}' THEN o_orderpriority END AS o_orderpriority
    FROM ({_batches(null_keys=False)})"""
