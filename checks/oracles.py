"""SQL that gives each query's rows straight from the tables."""

from __future__ import annotations

from checks.inputs import FACTOR, WEEK

EVENTS = """
  SELECT event_id, user_id, event_type AS series_name, CAST(ts AS DATE) AS obs_date, value,
         strftime(date_trunc('week', ts), '%Y-%m-%d') AS batch_ref
  FROM events
"""

ORDERS = """
  SELECT o_orderkey, o_orderpriority AS series_name, CAST(o_orderdate AS DATE) AS obs_date,
         o_totalprice AS value
  FROM orders
"""

RAW_EVENTS = f"""
  SELECT event_id, user_id AS series_code, event_type AS series_name,
         CASE WHEN event_type = 'error' THEN strftime(ts, '%Y-%m-%d')
              ELSE strftime(ts, '%d/%m/%Y') END AS obs_date,
         CASE WHEN value < 1 THEN NULL ELSE value * CAST({FACTOR} AS DOUBLE) END AS value
  FROM events
"""

TYPED_EVENTS = f"""
  SELECT event_id, series_code, series_name,
         CAST(try_strptime(obs_date, '%d/%m/%Y') AS DATE) AS obs_date,
         round(value, 4) AS value
  FROM ({RAW_EVENTS})
"""

CLEAN_EVENTS = f"""
  SELECT * FROM ({TYPED_EVENTS})
  WHERE obs_date IS NOT NULL AND value IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY obs_date, series_code ORDER BY event_id DESC) = 1
"""

CUSTOMER_COUNTS = """
  SELECT count(*) AS n,
         count(*) FILTER (c_mktsegment IS NULL) AS null_date,
         count(*) FILTER (c_acctbal IS NULL) AS null_value,
         count(*) FILTER (c_acctbal < 0) AS negative,
         count(*) - (SELECT count(*) FROM
             (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer)) AS duplicate
  FROM customer
"""

CUSTOMER_REPORT = f"""
  SELECT 'customer' AS dataset, CAST(NULL AS VARCHAR) AS series_name, check_name,
         CAST(observed AS BIGINT) AS observed,
         CASE WHEN check_name = 'volume_minimo' THEN observed > 0 ELSE observed = 0 END AS passed,
         CAST(observed AS VARCHAR) || detail AS detail
  FROM (
    SELECT 'volume_minimo' AS check_name, n AS observed, ' rows (expected: > 0)' AS detail
    FROM ({CUSTOMER_COUNTS})
    UNION ALL
    SELECT 'nulos_data', null_date, ' nulls in c_mktsegment' FROM ({CUSTOMER_COUNTS})
    UNION ALL
    SELECT 'nulos_valor', null_value, ' nulls in c_acctbal' FROM ({CUSTOMER_COUNTS})
    UNION ALL
    SELECT 'valor_positivo', negative, ' rows with a negative value' FROM ({CUSTOMER_COUNTS})
    UNION ALL
    SELECT 'sem_duplicatas', duplicate, ' duplicates by (c_nationkey, c_mktsegment)'
    FROM ({CUSTOMER_COUNTS})
  )
"""


# Two overlapping batches of whole amounts, the second with revised values.
BATCHES = f"""
  SELECT series_name, obs_date, CAST(floor(value) AS BIGINT) AS value,
         '1998-03-31' AS batch_ref
  FROM ({ORDERS}) WHERE obs_date <= DATE '1998-03-31'
  UNION ALL
  SELECT series_name, obs_date, CAST(floor(value) AS BIGINT) + 1, '2001-12-31'
  FROM ({ORDERS}) WHERE obs_date >= DATE '1998-03-15'
"""

MERGED = f"""
  SELECT series_name, obs_date, CAST(max(value) AS DOUBLE) AS value FROM ({BATCHES})
  WHERE batch_ref = '2001-12-31' OR obs_date < DATE '1998-03-15'
  GROUP BY ALL
"""

ORDER_CODE = "CAST(left(series_name, 1) AS BIGINT) AS series_code"
EVENT_CODE = """CAST(CASE series_name WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3
                   WHEN 'signup' THEN 4 WHEN 'view' THEN 5 END AS BIGINT) AS series_code"""

DEFECTS = f"""
  SELECT series_name, CASE
           WHEN series_name = 'view' THEN 'uncatalogued'
           WHEN series_name = 'error'
             OR series_name = 'signup' AND obs_date = DATE '2024-01-15' THEN 'broken'
           WHEN obs_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-15' THEN 'bronze'
           ELSE 'out' END AS kind
  FROM ({EVENTS})
"""


def monthly(rows: str) -> str:
    return f"""
      SELECT series_name, CAST(year(obs_date) AS INTEGER) AS obs_year,
             CAST(month(obs_date) AS INTEGER) AS obs_month,
             round(avg(value), 4) AS mean_value, round(min(value), 4) AS min_value,
             round(max(value), 4) AS max_value, round(stddev_samp(value), 4) AS stddev_value
      FROM ({rows}) GROUP BY ALL ORDER BY 1, 2, 3
    """


ORACLES: dict[str, str] = {
    "q_landing_read": f"""
      SELECT series_name, batch_ref, count(*) AS row_count, round(sum(value), 2) AS total,
             min(obs_date) AS first_date
      FROM ({EVENTS}) GROUP BY ALL
    """,
    "q_landing_quarantine": f"""
      SELECT CAST(CASE series_name WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3
                                   WHEN 'signup' THEN 4 WHEN 'view' THEN 5 END AS BIGINT)
               AS series_code,
             batch_ref, count(*) AS row_count, series_name = 'error' AS broken, series_name
      FROM ({EVENTS}) GROUP BY series_name, batch_ref
    """,
    "q_landing_array": f"""
      SELECT series_name, strftime(obs_date, '%Y-%m-%d') AS batch_ref, count(*) AS row_count,
             round(sum(value), 2) AS total, min(obs_date) AS first_date
      FROM ({EVENTS}) GROUP BY series_name, obs_date
    """,
    "q_extract_window": f"""
      SELECT series_name, count(*) AS row_count, '08/01/2024' AS first_date,
             '15/01/2024' AS last_date
      FROM ({EVENTS})
      WHERE obs_date BETWEEN DATE '2024-01-15' - 7 AND DATE '2024-01-15'
      GROUP BY ALL
    """,
    "q_bronze_stamp": f"""
      SELECT event_id, series_name, strftime(obs_date, '%d/%m/%Y') AS obs_date, value,
             '{WEEK}' AS batch_ref, 'events' AS source_system
      FROM ({EVENTS})
    """,
    "q_bronze_replace": f"""
      SELECT series_name, batch_ref, count(*) AS row_count,
             round(sum(CASE WHEN series_name = 'click' AND batch_ref = '{WEEK}'
                            THEN value + 100 ELSE value END), 2) AS total
      FROM ({EVENTS}) GROUP BY ALL
    """,
    "q_bronze_batch": f"""
      SELECT strftime(obs_date, '%d/%m/%Y') AS obs_date, value, series_name,
             CAST(CASE series_name WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3
                                   WHEN 'signup' THEN 4 WHEN 'view' THEN 5 END AS BIGINT)
               AS series_code
      FROM ({EVENTS}) WHERE batch_ref = '{WEEK}'
    """,
    "q_batch_filter": f"""
      SELECT event_id, user_id, series_name, obs_date, value
      FROM ({EVENTS}) WHERE batch_ref = '{WEEK}'
    """,
    "q_silver_typed": TYPED_EVENTS,
    "q_silver_complete": f"""
      SELECT * FROM ({TYPED_EVENTS}) WHERE obs_date IS NOT NULL AND value IS NOT NULL
    """,
    "q_silver_clean": CLEAN_EVENTS,
    "q_silver_dropped": f"""
      SELECT series_name, count(*) AS row_count,
             count(*) FILTER (obs_date IS NULL OR value IS NULL) AS incomplete,
             count(*) FILTER (obs_date IS NOT NULL AND value IS NOT NULL)
               - count(DISTINCT CASE WHEN obs_date IS NOT NULL AND value IS NOT NULL
                                     THEN (obs_date, series_code) END) AS duplicates
      FROM ({TYPED_EVENTS}) GROUP BY ALL
    """,
    "q_silver_upsert": f"""
      WITH clean AS (SELECT obs_date, series_code, value FROM ({CLEAN_EVENTS})),
           target AS (SELECT * FROM clean WHERE obs_date < DATE '2024-01-20'),
           source AS (SELECT obs_date, series_code, value + 1 AS value FROM clean
                      WHERE obs_date >= DATE '2024-01-13')
      SELECT obs_date, series_code,
             CASE WHEN s.value IS NOT NULL THEN s.value ELSE t.value END AS value
      FROM target t FULL OUTER JOIN source s USING (obs_date, series_code)
    """,
    "q_silver_publish": f"""
      SELECT obs_date, o_orderkey AS series_code,
             CASE WHEN obs_date >= DATE '1998-03-15' THEN value + 1 ELSE value END AS value,
             strftime(obs_date, '%Y-%m') AS month_ref
      FROM ({ORDERS})
    """,
    "q_silver_as_of": f"""
      WITH refs AS (
        SELECT CAST(DATE '2024-01-01' + 7 * CAST(i AS INTEGER) AS DATE) AS ref FROM range(0, 6) t(i)
      )
      SELECT obs_date, user_id AS series_code, series_name,
             round(value + (ref - obs_date), 4) AS value,
             strftime(ref, '%Y-%m-%d') AS batch_ref
      FROM ({EVENTS}) JOIN refs ON obs_date BETWEEN ref - 7 AND ref
      WHERE ref <= DATE '2024-01-22'
      QUALIFY row_number() OVER (
        PARTITION BY obs_date, user_id
        ORDER BY ref DESC, round(value + (ref - obs_date), 4) DESC, series_name DESC) = 1
    """,
    "q_quality_report": CUSTOMER_REPORT,
    "q_quality_dups": """
      SELECT count(*) AS row_count,
             count(*) - (SELECT count(*) FROM
               (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS duplicates
      FROM lineitem
    """,
    "q_quality_series": f"""
      WITH names AS (SELECT unnest(['click', 'error', 'purchase', 'refund', 'signup', 'view'])
                            AS series_name),
           counts AS (
             SELECT series_name, count(*) AS n,
                    count(*) FILTER (obs_date IS NULL) AS null_date,
                    count(*) FILTER (value IS NULL) AS null_value,
                    count(*) FILTER (value < 0) AS negative,
                    count(*) - count(DISTINCT (obs_date, user_id)) AS duplicate
             FROM ({EVENTS}) GROUP BY ALL),
           filled AS (
             SELECT series_name, coalesce(n, 0) AS n, coalesce(null_date, 0) AS null_date,
                    coalesce(null_value, 0) AS null_value, coalesce(negative, 0) AS negative,
                    coalesce(duplicate, 0) AS duplicate
             FROM names LEFT JOIN counts USING (series_name))
      SELECT series_name, 'volume_minimo' AS check_name, n AS observed, n > 0 AS passed FROM filled
      UNION ALL SELECT series_name, 'nulos_data', null_date, null_date = 0 FROM filled
      UNION ALL SELECT series_name, 'nulos_valor', null_value, null_value = 0 FROM filled
      UNION ALL SELECT series_name, 'valor_positivo', negative, negative = 0 FROM filled
      UNION ALL SELECT series_name, 'sem_duplicatas', duplicate, duplicate = 0 FROM filled
    """,
    "q_quality_layered": f"""
      WITH lowest AS (SELECT min(c_acctbal) AS min_value FROM customer GROUP BY c_nationkey),
      policy(layer, check_name) AS (VALUES
        ('bronze', 'volume_minimo'), ('bronze', 'nulos_data'), ('bronze', 'nulos_valor'),
        ('silver', 'volume_minimo'), ('silver', 'nulos_data'), ('silver', 'nulos_valor'),
        ('silver', 'valor_positivo'), ('silver', 'sem_duplicatas'))
      SELECT layer, check_name, observed, passed
      FROM policy JOIN ({CUSTOMER_REPORT}) USING (check_name)
      UNION ALL
      SELECT 'gold', 'volume_minimo', count(*), count(*) > 0 FROM lowest
      UNION ALL
      SELECT 'gold', 'valor_positivo', count(*) FILTER (min_value < 0),
             count(*) FILTER (min_value < 0) = 0 FROM lowest
    """,
    "q_gate_verdict": f"""
      SELECT dataset, count(*) FILTER (NOT passed) AS failures,
             string_agg(check_name, ',' ORDER BY check_name) FILTER (NOT passed)
               AS failed_checks,
             threshold, count(*) FILTER (NOT passed) > threshold AS stopped
      FROM ({CUSTOMER_REPORT}) CROSS JOIN (VALUES (0), (1), (2)) t(threshold)
      GROUP BY dataset, threshold
    """,
    "q_gold_union": f"""
      SELECT series_name, obs_date, value FROM ({ORDERS})
      UNION ALL
      SELECT series_name, obs_date, value FROM ({EVENTS})
    """,
    "q_gold_monthly": monthly(ORDERS),
    "q_gold_publish": monthly(ORDERS),
    "q_gold_state": monthly(f"""
      SELECT series_name, obs_date,
             CASE WHEN year(obs_date) = 1996 THEN floor(floor(value) / 2) ELSE floor(value) END AS value
      FROM ({ORDERS})"""),
    "q_gold_lineitem": monthly(
        f"""
          SELECT l_returnflag AS series_name, l_shipdate AS obs_date,
                 l_extendedprice * CAST({FACTOR} AS DOUBLE) AS value
          FROM lineitem
        """
    ),
    "q_gold_single_obs": monthly("""
      SELECT CAST(l_orderkey AS VARCHAR) AS series_name, CAST(l_shipdate AS DATE) AS obs_date,
             floor(l_extendedprice) AS value FROM lineitem"""),
    "q_dim_join": f"""
      SELECT series_name, CAST(series_code AS BIGINT) AS series_code, count(*) AS row_count
      FROM ({ORDERS})
      JOIN (VALUES ('1-URGENT', 1), ('2-HIGH', 2), ('3-MEDIUM', 3)) d(series_name, series_code)
        USING (series_name)
      GROUP BY ALL
    """,
    "q_dim_nation": """
      SELECT n_name, count(*) AS row_count, min(c_acctbal) AS min_value
      FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL
    """,
    "q_schema_evolve": f"""
      SELECT event_id, series_name, obs_date, value,
             CASE WHEN obs_date >= DATE '{WEEK}' THEN user_id END AS user_id
      FROM ({EVENTS})
    """,
    "q_schema_merge": f"""
      SELECT event_id, series_name, obs_date, value,
             CASE WHEN obs_date >= DATE '{WEEK}' THEN user_id END AS user_id
      FROM ({EVENTS})
    """,
    "q_schema_widen": f"""
      SELECT event_id, CAST(obs_date AS TIMESTAMP) AS obs_date,
             CASE WHEN obs_date < DATE '{WEEK}' THEN floor(value) ELSE value END AS value,
             CASE WHEN obs_date < DATE '{WEEK}' THEN 0 ELSE 1 END AS part
      FROM ({EVENTS})
    """,
    "q_run_counts": f"""
      SELECT 'bronze' AS layer, series_name, count(*) AS row_count, '2001-12-31' AS batch_ref
      FROM ({ORDERS}) GROUP BY ALL
      UNION ALL
      SELECT 'silver', series_name, count(DISTINCT obs_date), '2001-12-31'
      FROM ({ORDERS}) GROUP BY ALL
      UNION ALL
      SELECT 'gold', series_name, count(DISTINCT date_trunc('month', obs_date)), '2001-12-31'
      FROM ({ORDERS}) GROUP BY ALL
    """,
    "q_load_bronze": f"""
      SELECT strftime(obs_date, '%d/%m/%Y') AS obs_date, value, {ORDER_CODE},
             'orders' AS source_system, batch_ref, series_name
      FROM ({BATCHES})
    """,
    "q_load_quality": f"""
      WITH raw AS (
             SELECT batch_ref, series_name, count(*) AS n FROM ({BATCHES}) GROUP BY ALL),
           clean AS (
             SELECT batch_ref, series_name, count(DISTINCT obs_date) AS n
             FROM ({BATCHES}) GROUP BY ALL),
           zero(layer, check_name, detail) AS (VALUES
             ('bronze', 'nulos_data', '0 nulls in obs_date'),
             ('bronze', 'nulos_valor', '0 nulls in value'),
             ('silver', 'nulos_data', '0 nulls in obs_date'),
             ('silver', 'nulos_valor', '0 nulls in value'),
             ('silver', 'valor_positivo', '0 rows with a negative value'),
             ('silver', 'sem_duplicatas', '0 duplicates by (obs_date, series_code)'))
      SELECT layer, batch_ref, series_name, 'volume_minimo' AS check_name, n AS observed,
             true AS passed, n || ' rows (expected: > 0)' AS detail
      FROM (SELECT 'bronze' AS layer, * FROM raw UNION ALL SELECT 'silver', * FROM clean)
      UNION ALL
      SELECT layer, batch_ref, series_name, check_name, 0, true, detail FROM raw CROSS JOIN zero
    """,
    "q_load_dropped": f"""
      SELECT series_name, count(*) AS row_count,
             count(*) FILTER (obs_date IS NULL OR value IS NULL) AS incomplete,
             count(*) FILTER (obs_date IS NOT NULL AND value IS NOT NULL)
               - count(DISTINCT CASE WHEN value IS NOT NULL THEN obs_date END) AS duplicates,
             '{WEEK}' AS batch_ref
      FROM ({TYPED_EVENTS}) GROUP BY ALL
    """,
    "q_load_silver": f"""
      SELECT obs_date, value, {ORDER_CODE}, series_name,
             strftime(obs_date, '%Y-%m') AS month_ref
      FROM ({MERGED})
    """,
    "q_run_gold": monthly(MERGED),
    "q_run_gold_touched": monthly(f"""
      SELECT series_name, obs_date,
             max(floor(value)) + CASE WHEN year(obs_date) = 1996 THEN 2
               WHEN strftime(obs_date, '%Y-%m') = '1999-05' THEN 1 ELSE 0 END AS value
      FROM ({ORDERS}) GROUP BY series_name, obs_date"""),
    "q_load_bronze_empty": f"""
      WITH held AS (
        SELECT series_name, count(*) FILTER (series_name <> '1-URGENT') AS n,
               count(DISTINCT obs_date) FILTER (series_name <> '1-URGENT') AS dates
        FROM ({ORDERS}) GROUP BY ALL)
      SELECT 'bronze' AS layer, series_name, n AS observed, n AS bronze_rows FROM held
      UNION ALL SELECT 'silver', series_name, dates, n FROM held
    """,
    "q_load_one_series": f"""
      WITH landed AS (
        SELECT * FROM ({ORDERS})
        WHERE series_name <> '2-HIGH' OR obs_date >= DATE '1998-03-15'),
      counts AS (
        SELECT series_name, count(*) AS n, count(DISTINCT obs_date) AS dates FROM landed GROUP BY ALL),
      months AS (
        SELECT series_name, count(DISTINCT date_trunc('month', obs_date)) AS n
        FROM ({ORDERS}) GROUP BY ALL)
      SELECT 'rows of bronze' AS what, series_name, n FROM counts
      UNION ALL SELECT 'rows of silver', series_name, dates FROM counts
      UNION ALL SELECT 'rows of gold', series_name, n FROM months
      UNION ALL SELECT 'duplicates', series_name, n - dates FROM counts
      UNION ALL SELECT 'passed', series_name, 10 FROM counts
    """,
    "q_load_accounting": f"""
      SELECT {EVENT_CODE}, count(*) AS landed,
             count(*) FILTER (kind = 'bronze') AS bronze,
             count(*) FILTER (kind = 'out') AS out_of_window,
             count(*) FILTER (kind = 'uncatalogued') AS uncatalogued,
             count(*) FILTER (kind = 'broken') AS broken,
             true AS adds_up, true AS held
      FROM ({DEFECTS}) GROUP BY series_name
    """,
    "q_load_refused": f"""
      SELECT {EVENT_CODE}, count(*) AS landed, CAST(0 AS BIGINT) AS bronze,
             count(*) FILTER (kind = 'out') AS out_of_window,
             count(*) FILTER (kind = 'uncatalogued') AS uncatalogued,
             count(*) FILTER (kind = 'broken') AS broken,
             count(*) FILTER (kind = 'bronze') AS refused, CAST(1 AS BIGINT) AS files,
             false AS published
      FROM ({DEFECTS}) GROUP BY series_name
    """,
    "q_load_quarantine": f"""
      SELECT series_name, count(*) AS documents,
             count(*) FILTER (series_name = 'signup') AS messages,
             count(*) AS observed, false AS passed
      FROM ({DEFECTS}) WHERE kind = 'broken' GROUP BY ALL
    """,
    "q_load_as_of": f"""
      SELECT obs_date, {ORDER_CODE}, series_name, value, true AS as_in_silver FROM ({MERGED})
    """,
    "q_load_published": f"""
      SELECT obs_date, {ORDER_CODE}, series_name, CAST(max(value) AS DOUBLE) AS value
      FROM ({BATCHES})
      WHERE CASE WHEN series_name = '1-URGENT' THEN batch_ref = '1998-03-31'
                 ELSE batch_ref = '2001-12-31' OR obs_date < DATE '1998-03-15' END
      GROUP BY series_name, obs_date
    """,
    "q_load_defaults": f"""
      WITH days AS (
             SELECT series_name, obs_date, floor(sum(value)) AS value FROM ({EVENTS})
             WHERE obs_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-15' GROUP BY ALL),
           sizes AS (
             SELECT series_name, count(*) AS n,
                    count(*) FILTER (series_name = 'view' AND obs_date = DATE '2024-01-10') AS gaps,
                    count(*) FILTER (series_name = 'error' AND value > 0) AS negative
             FROM days GROUP BY ALL)
      SELECT 'bronze' AS layer, series_name, 'volume_minimo' AS check_name, n AS observed,
             true AS passed FROM sizes
      UNION ALL SELECT 'bronze', series_name, 'nulos_data', 0, true FROM sizes
      UNION ALL SELECT 'bronze', series_name, 'nulos_valor', gaps, true FROM sizes
      UNION ALL SELECT 'bronze', series_name, 'valor_positivo', negative, true FROM sizes
      UNION ALL SELECT 'bronze', series_name, 'sem_duplicatas', 0, true FROM sizes
      UNION ALL SELECT 'silver', series_name, 'volume_minimo', n - gaps, true FROM sizes
      UNION ALL SELECT 'silver', series_name, 'nulos_data', 0, true FROM sizes
      UNION ALL SELECT 'silver', series_name, 'nulos_valor', 0, true FROM sizes
      UNION ALL SELECT 'silver', series_name, 'valor_positivo', negative, true FROM sizes
      UNION ALL SELECT 'silver', series_name, 'sem_duplicatas', 0, true FROM sizes
      UNION ALL SELECT 'gold', series_name, 'volume_minimo', 1, true FROM sizes
    """,
}
