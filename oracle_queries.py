"""DuckDB SQL that answers each registered query on the same tables.

Written against the tables alone and independent of the package. Building
blocks are common table expressions; ``ask`` chains the ones a query names.
"""

RAW = """raw AS (
  SELECT CASE WHEN o_orderkey % 997 = 0 THEN NULL ELSE o_orderkey END AS order_id,
         concat('C', CAST(o_custkey AS VARCHAR)) AS customer_id,
         CAST(o_orderdate AS DATE) AS order_date,
         CAST(CAST(CAST(floor(o_totalprice / 5) AS BIGINT) / 100.0 AS DECIMAL(18,2)) AS DOUBLE)
           AS amount,
         CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending'
              WHEN 'P' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'cancelled' ELSE 'returned' END
         END AS status,
         n_name AS country
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""

TODAY = "DATE '2001-08-02'"


def staged(name: str, source: str, where: str = "TRUE") -> str:
    return f"{name} AS (SELECT * FROM {source} WHERE order_id IS NOT NULL AND {where})"


def attributes() -> str:
    return """CAST(date_trunc('year', order_date) AS DATE) AS order_year,
       CAST(date_trunc('month', order_date) AS DATE) AS order_month,
       CAST(date_trunc('quarter', order_date) AS DATE) AS order_quarter,
       CAST(dayofweek(order_date) + 1 AS INTEGER) AS day_of_week,
       CAST(weekofyear(order_date) AS INTEGER) AS week_of_year"""


BUCKET = """CASE WHEN amount < 50 THEN 'small' WHEN amount < 200 THEN 'medium'
       WHEN amount < 500 THEN 'large' ELSE 'premium' END AS amount_bucket"""

DONE = "CAST(status IS NOT NULL AND status = 'completed' AS INTEGER)"


def fact(name: str, source: str, where: str = "TRUE") -> str:
    return f"""{name} AS (
  SELECT order_id, customer_id, order_date, status, {BUCKET}, amount FROM {source} WHERE {where})"""


def dims(suffix: str, source: str) -> str:
    return f"""people{suffix} AS (SELECT DISTINCT customer_id, country FROM {source}),
states{suffix} AS (SELECT DISTINCT status, {DONE} AS is_completed FROM {source})"""


TOTAL = "CAST(sum(CAST(amount AS DECIMAL(18,4))) AS DOUBLE)"
FIGURES = f"""CAST(count(DISTINCT order_id) AS BIGINT) AS total_orders, {{0}} AS {{1}},
       {TOTAL} / nullif(count(amount), 0) AS avg_order_value,
       CAST(sum(is_completed) AS BIGINT) AS completed_orders"""


def mart(name: str, source: str, dim: str, where: str = "TRUE", today: str = TODAY,
         total: str = TOTAL) -> str:
    return f"""{name} AS (
  SELECT customer_id, country, total_orders, lifetime_value, avg_order_value,
         first_order_date, last_order_date,
         CAST(date_diff('day', first_order_date, last_order_date) AS INTEGER)
           AS customer_lifespan_days,
         completed_orders, total_orders - completed_orders AS non_completed_orders,
         CAST(date_diff('day', last_order_date, {today}) AS INTEGER) AS days_since_last_order,
         CASE WHEN total_orders = 1 THEN 'one-time'
              WHEN total_orders <= 3 AND lifetime_value < 500 THEN 'occasional'
              WHEN total_orders > 3 AND lifetime_value >= 500 THEN 'loyal'
              WHEN lifetime_value >= 2000 THEN 'vip' ELSE 'regular' END AS customer_segment,
         round(completed_orders / nullif(total_orders, 0) * 100, 2) AS completion_rate_pct
  FROM (SELECT customer_id, {FIGURES.replace(TOTAL, total).format(total, 'lifetime_value')},
               min(order_date) AS first_order_date, max(order_date) AS last_order_date
        FROM {source} JOIN states{dim} USING (status) WHERE {where} GROUP BY customer_id)
  JOIN people{dim} USING (customer_id))"""


DAY_COLUMNS = "order_date, country, total_orders, revenue, avg_order_value, completed_orders"


def daily(name: str, source: str, dim: str, where: str = "TRUE") -> str:
    return f"""{name} AS (
  SELECT order_date, country, {FIGURES.format(TOTAL, 'revenue')}
  FROM {source} JOIN people{dim} USING (customer_id) JOIN states{dim} USING (status)
  WHERE {where} GROUP BY order_date, country)"""


def kpi(name: str, source: str, where: str = "TRUE") -> str:
    return f"""{name} AS (
  SELECT *, round((revenue - revenue_prev_day) / nullif(revenue_prev_day, 0) * 100, 2)
              AS revenue_growth_pct,
         round((total_orders - orders_prev_day) / nullif(orders_prev_day, 0) * 100, 2)
              AS orders_growth_pct
  FROM (SELECT {DAY_COLUMNS},
          CAST(sum(CAST(revenue AS DECIMAL(28,4))) OVER (c ROWS UNBOUNDED PRECEDING) AS DOUBLE)
            AS revenue_running_total,
          lag(revenue) OVER c AS revenue_prev_day, lag(total_orders) OVER c AS orders_prev_day,
          CAST(rank() OVER (PARTITION BY order_date ORDER BY revenue DESC NULLS LAST) AS INTEGER)
            AS country_revenue_rank
        FROM {source} WINDOW c AS (PARTITION BY country ORDER BY order_date))
  WHERE {where})"""


def ask(*parts: str) -> str:
    *blocks, last = parts
    return "WITH " + ",\n".join([RAW, *blocks]) + "\n" + last


# Stored state and new state of the incremental scenario.
OLD_DAYS = "order_date < DATE '2001-07-20'"
NOW = [staged("s", "raw"), fact("f", "s"), dims("", "s")]
OLD = [staged("s0", "raw", OLD_DAYS), fact("f0", "s0"), dims("0", "s0")]
FACT_RUN = [
    fact("fresh", "s", "order_date >= (SELECT max(order_date) - 3 FROM f0)"),
    """f1 AS (SELECT * FROM f0 WHERE order_id NOT IN (SELECT order_id FROM fresh)
       UNION ALL SELECT * FROM fresh)""",
]
MART_RUN = [
    mart("m0", "f0", "0"),
    mart("m_fresh", "f1", "", """customer_id IN (SELECT customer_id FROM f1
       WHERE order_date >= (SELECT max(last_order_date) - 3 FROM m0))"""),
    """m1 AS (SELECT * FROM m0 WHERE customer_id NOT IN (SELECT customer_id FROM m_fresh)
       UNION ALL SELECT * FROM m_fresh)""",
]
SINCE = "(SELECT max(order_date) - 3 FROM k0)"
KPI_RUN = [
    daily("d0", "f0", "0"), kpi("k0", "d0"),
    daily("d_fresh", "f1", "", f"order_date >= {SINCE}"),
    f"""d1 AS (SELECT {DAY_COLUMNS} FROM k0 WHERE order_date < {SINCE}
       UNION ALL SELECT * FROM d_fresh)""",
    kpi("k_fresh", "d1", f"order_date >= {SINCE}"),
]
RUN = [*NOW, *OLD, *FACT_RUN]
KPI_UPSERT = ask(*RUN, *KPI_RUN, """SELECT * FROM k0 WHERE NOT EXISTS (
  SELECT 1 FROM k_fresh k WHERE k.order_date = k0.order_date AND k.country = k0.country)
UNION ALL SELECT * FROM k_fresh""")

# Change capture: two states, their differences, stamps.
SIX = "order_id, customer_id, order_date, amount, status, country"
T0, T1 = "TIMESTAMP '2001-08-01 00:00:00'", "TIMESTAMP '2001-08-02 00:00:00'"
STATES = [
    "before_ AS (SELECT * FROM raw WHERE order_id % 10 <> 0)",
    f"""after_ AS (SELECT * REPLACE (CASE WHEN order_id % 10 = 1 THEN 'returned' ELSE status END
       AS status) FROM raw WHERE order_id IS NULL OR order_id % 10 <> 2)""",
    "gone AS (SELECT * FROM before_ EXCEPT SELECT * FROM after_)",
    "come AS (SELECT * FROM after_ EXCEPT SELECT * FROM before_)",
    "both_ AS (SELECT order_id FROM gone INTERSECT SELECT order_id FROM come)",
]
PAIRED = "order_id IS NOT NULL AND order_id IN (SELECT order_id FROM both_)"
MERGED = f"""merged AS (
  SELECT *, 'INITIAL_LOAD' AS _cdc_action, {T0} AS _loaded_at FROM before_
  WHERE order_id NOT IN (SELECT order_id FROM gone)
  UNION ALL SELECT *, CASE WHEN {PAIRED} THEN 'UPDATE' ELSE 'INSERT' END, {T1} FROM come)"""
OPEN_END = "CAST(NULL AS TIMESTAMP)"
VERSIONS = f"""versions AS (
  SELECT b.*, {T0} AS valid_from,
         CASE WHEN a.order_id IS NULL THEN {T1} END AS valid_to
  FROM before_ b LEFT JOIN after_ a ON a.order_id = b.order_id
    AND a.status IS NOT DISTINCT FROM b.status AND a.amount IS NOT DISTINCT FROM b.amount
  UNION ALL
  SELECT a.*, {T1}, {OPEN_END} FROM after_ a
  WHERE a.order_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM before_ b
    WHERE a.order_id = b.order_id AND a.status IS NOT DISTINCT FROM b.status
      AND a.amount IS NOT DISTINCT FROM b.amount))"""

LATEST = """latest AS (SELECT * REPLACE (CASE WHEN order_id % 10 = 5 THEN amount + 1 ELSE amount END
  AS amount) FROM raw WHERE order_id IS NULL OR order_id % 10 <> 6)"""

REFUNDS = "refunds AS (SELECT * REPLACE (amount - 400 AS amount) FROM f)"
EARLY = [staged("s9", "raw", "order_date < DATE '1996-01-01'"), fact("f9", "s9"), dims("9", "s9")]

# Amounts that no decimal holds, in some orders.
ODD = """odd AS (SELECT * REPLACE (CASE WHEN order_id % 500 = 1 THEN 'nan'::DOUBLE
  WHEN order_id % 500 = 2 THEN 'inf'::DOUBLE WHEN order_id % 500 = 3 THEN '-inf'::DOUBLE
  ELSE amount END AS amount) FROM raw)"""
ODD_TOTAL = """coalesce(sum(CASE WHEN NOT isfinite(amount) THEN amount END),
  CAST(sum(CASE WHEN isfinite(amount) THEN CAST(amount AS DECIMAL(18,4)) END) AS DOUBLE))"""

# The whole check list over tables of which each breaks some rules.
BROKEN = """broken AS (SELECT * REPLACE (amount - 400 AS amount, CASE order_id % 50 WHEN 0 THEN 'lost'
  WHEN 1 THEN NULL ELSE status END AS status) FROM (SELECT * FROM raw UNION ALL
  SELECT * FROM raw WHERE order_id % 100 = 3))"""
BROKEN_DIMS = f"""dim_customer AS (SELECT * FROM people9), dim_status AS (SELECT * FROM states
  WHERE status <> 'pending'), dim_date AS (SELECT DISTINCT order_date FROM s9),
dim_amount_bucket AS (SELECT DISTINCT amount_bucket FROM f9 WHERE amount_bucket <> 'small'),
stg_orders AS (SELECT * REPLACE (CAST(order_date AS VARCHAR) AS order_date) FROM s),
stg_orders_cdc AS (SELECT *, 'LOAD' AS _cdc_action, {T0} AS _loaded_at FROM s),
int_orders_enriched AS (SELECT *, {BUCKET}, {DONE} AS is_completed FROM s),
fact_sales AS (SELECT * FROM f), agg_customers AS (SELECT * FROM m),
sales_daily_kpi AS (SELECT * FROM k)"""

# The whole check list over a first run of the job.
DIMS = """dim_customer AS (SELECT * FROM people), dim_status AS (SELECT * FROM states),
dim_date AS (SELECT DISTINCT order_date FROM s),
dim_amount_bucket AS (SELECT DISTINCT amount_bucket FROM f),
stg_orders AS (SELECT * FROM s),
stg_orders_cdc AS (SELECT *, 'INITIAL_LOAD' AS _cdc_action, now() AS _loaded_at FROM s),
int_orders_enriched AS (SELECT s.*, amount_bucket, """ + DONE.replace("status", "s.status") + """
  AS is_completed FROM s JOIN f USING (order_id)),
fact_sales AS (SELECT * FROM f), agg_customers AS (SELECT * FROM m),
sales_daily_kpi AS (SELECT * FROM k)"""
ORDER_SIX = ["order_id", "customer_id", "order_date", "amount", "status", "country"]
LABELS = "'completed', 'pending', 'cancelled', 'returned'"
SIZES = "'small', 'medium', 'large', 'premium'"


def _check(table: str, column: str, check: str, failing: str) -> str:
    return (f"SELECT '{table}' AS \"table\", '{column}' AS \"column\", '{check}' AS \"check\", "
            f"({failing}) AS n")


def _where(table: str, column: str, check: str, test: str) -> str:
    return _check(table, column, check, f"SELECT count(*) FROM {table} WHERE {test}")


def _report() -> str:
    out = []
    for table, columns in {
        "stg_orders": ORDER_SIX, "stg_orders_cdc": [*ORDER_SIX, "_cdc_action", "_loaded_at"],
        "int_orders_enriched": [*ORDER_SIX, "is_completed"],
        "dim_customer": ["customer_id", "country"], "dim_date": ["order_date"],
        "dim_status": ["status", "is_completed"], "dim_amount_bucket": ["amount_bucket"],
        "fact_sales": ["order_id", "customer_id", "order_date", "status", "amount_bucket",
                       "amount"],
        "agg_customers": ["customer_id", "total_orders", "lifetime_value", "avg_order_value",
                          "first_order_date", "last_order_date"],
        "sales_daily_kpi": ["order_date", "country", "total_orders", "revenue",
                            "avg_order_value"],
    }.items():
        out += [_where(table, c, "not_null", f"{c} IS NULL") for c in columns]
    for table, column in [
        ("stg_orders", "order_id"), ("stg_orders_cdc", "order_id"),
        ("int_orders_enriched", "order_id"), ("dim_customer", "customer_id"),
        ("dim_date", "order_date"), ("dim_status", "status"),
        ("dim_amount_bucket", "amount_bucket"), ("fact_sales", "order_id"),
        ("agg_customers", "customer_id"),
    ]:
        out.append(_check(table, column, "unique", f"""SELECT count(*) FROM (SELECT {column}
          FROM {table} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)"""))
    for table, column, values in [
        ("stg_orders", "status", LABELS), ("stg_orders_cdc", "status", LABELS),
        ("stg_orders_cdc", "_cdc_action", "'INITIAL_LOAD', 'INSERT', 'UPDATE', 'DELETE'"),
        ("int_orders_enriched", "status", LABELS),
        ("int_orders_enriched", "amount_bucket", SIZES),
        ("int_orders_enriched", "is_completed", "0, 1"),
        ("dim_status", "status", LABELS), ("dim_status", "is_completed", "0, 1"),
        ("dim_amount_bucket", "amount_bucket", SIZES), ("fact_sales", "status", LABELS),
        ("agg_customers", "customer_segment",
         "'one-time', 'occasional', 'regular', 'loyal', 'vip'"),
    ]:
        out.append(_where(table, column, "accepted_values", f"{column} NOT IN ({values})"))
    for table, column, test in [
        ("stg_orders", "amount", "amount < 0"), ("stg_orders_cdc", "amount", "amount < 0"),
        ("int_orders_enriched", "amount", "amount < 0"), ("fact_sales", "amount", "amount < 0"),
        ("agg_customers", "total_orders", "total_orders < 1"),
        ("agg_customers", "lifetime_value", "lifetime_value < 0"),
        ("agg_customers", "completion_rate_pct", "completion_rate_pct NOT BETWEEN 0 AND 100"),
        ("sales_daily_kpi", "total_orders", "total_orders < 1"),
        ("sales_daily_kpi", "revenue", "revenue < 0"),
    ]:
        out.append(_where(table, column, "between", test))
    for column, parent in [
        ("customer_id", "dim_customer"), ("order_date", "dim_date"), ("status", "dim_status"),
        ("amount_bucket", "dim_amount_bucket"),
    ]:
        out.append(_check("fact_sales", column, "relationship", f"""SELECT count(DISTINCT {column})
          FROM fact_sales WHERE {column} NOT IN (SELECT {column} FROM {parent}
            WHERE {column} IS NOT NULL)"""))
    out += [
        _where("stg_orders", "order_date", "type", "typeof(order_date) <> 'DATE'"),
        _check("agg_customers", "lifetime_value", "equals_sum_of_orders", f"""SELECT count(*)
          FROM (SELECT customer_id, {TOTAL} AS v FROM f GROUP BY customer_id)
          JOIN m USING (customer_id) WHERE abs(v - lifetime_value) > 0.01"""),
        _check("sales_daily_kpi", "revenue_running_total", "never_falls", """SELECT count(*)
          FROM (SELECT revenue_running_total AS v, lag(revenue_running_total) OVER
            (PARTITION BY country ORDER BY order_date) AS p FROM k) WHERE v < p"""),
        _check("sales_daily_kpi", "order_date, country", "unique_grain", """SELECT count(*) FROM
          (SELECT 1 FROM k GROUP BY order_date, country HAVING count(*) > 1)"""),
        _where("fact_sales", "amount", "not_negative", "amount < 0"),
        _check("fact_sales", "customer_id", "has_customer_mart", """SELECT
          count(DISTINCT customer_id) FROM f WHERE customer_id NOT IN
            (SELECT customer_id FROM m)"""),
    ]
    rows = "\nUNION ALL ".join(out)
    return f"""SELECT "table", "column", "check",
  CASE WHEN n = 0 THEN 'pass' ELSE 'error' END AS status, CAST(n AS BIGINT) AS failing_rows
FROM ({rows})"""


ORACLE = {
    "raw_orders": ask("SELECT * FROM raw"),
    "raw_orders_csv_reload": ask(
        "SELECT * REPLACE (order_id + 3000000000 AS order_id, "
        "replace(country, ' ', chr(10)) AS country) FROM raw WHERE order_id IS NOT NULL"),
    "stg_orders": ask(NOW[0], "SELECT * FROM s"),
    "int_orders_enriched": ask(
        NOW[0], f"SELECT *, {attributes()}, {BUCKET}, {DONE} AS is_completed FROM s"),
    "dim_customer": ask(*NOW, "SELECT * FROM people"),
    "dim_status": ask(*NOW, "SELECT * FROM states"),
    "dim_date": ask(NOW[0], f"SELECT DISTINCT order_date, {attributes()} FROM s"),
    "dim_amount_bucket": ask(*NOW, """SELECT amount_bucket,
  CAST(CASE amount_bucket WHEN 'small' THEN 0 WHEN 'medium' THEN 50 WHEN 'large' THEN 200
       WHEN 'premium' THEN 500 END AS INTEGER) AS min_amount,
  CAST(CASE amount_bucket WHEN 'small' THEN 49.99 WHEN 'medium' THEN 199.99
       WHEN 'large' THEN 499.99 END AS DECIMAL(5,2)) AS max_amount
FROM (SELECT DISTINCT amount_bucket FROM f)"""),
    "fact_sales_full": ask(*NOW, "SELECT * FROM f"),
    "agg_customers_full": ask(*NOW, mart("m", "f", ""), "SELECT * FROM m"),
    "agg_customers_today": ask(*NOW, mart("m", "f", "", today="current_date"), "SELECT * FROM m"),
    "agg_customers_special": ask(ODD, *[x.replace("FROM raw", "FROM odd") for x in NOW],
        mart("m", "f", "", total=ODD_TOTAL), """SELECT customer_id, total_orders, customer_segment,
  CASE WHEN isnan(lifetime_value) THEN 'nan' WHEN isinf(lifetime_value)
       THEN CASE WHEN lifetime_value > 0 THEN 'inf' ELSE '-inf' END ELSE 'finite' END AS kind,
  CASE WHEN isfinite(lifetime_value) THEN lifetime_value END AS lifetime_value,
  CASE WHEN isfinite(avg_order_value) THEN avg_order_value END AS avg_order_value FROM m"""),
    "sales_daily_kpi_full": ask(*NOW, daily("d", "f", ""), kpi("k", "d"), "SELECT * FROM k"),
    "fact_sales_incremental": ask(*RUN, "SELECT * FROM f1"),
    "agg_customers_incremental": ask(*RUN, *MART_RUN, "SELECT * FROM m1"),
    "sales_daily_kpi_incremental": KPI_UPSERT,
    "kpi_replace_window": ask(*RUN, *KPI_RUN, f"""SELECT * FROM k0 WHERE order_date < {SINCE}
UNION ALL SELECT * FROM k_fresh"""),
    "schema_sync": ask(*RUN, """SELECT * REPLACE (NULL AS amount_bucket) FROM f0
WHERE order_id NOT IN (SELECT order_id FROM fresh) UNION ALL SELECT * FROM fresh"""),
    "refresh_job": KPI_UPSERT,
    "refresh_job_fact": ask(*RUN, "SELECT * FROM f1"),
    "refresh_job_customers": ask(*RUN, mart("m0", "f0", "0", today="DATE '2001-07-21'"), *MART_RUN[1:],
                                 "SELECT * FROM m1"),
    "refresh_job_cdc": ask(*NOW, f"""SELECT *, CASE WHEN {OLD_DAYS} THEN 'INITIAL_LOAD' ELSE 'INSERT' END
  AS _cdc_action, CASE WHEN {OLD_DAYS} THEN {T0} ELSE {T1} END AS _loaded_at FROM s"""),
    "refresh_job_history": ask(*NOW, f"""SELECT *, CASE WHEN {OLD_DAYS}
  THEN TIMESTAMP '2001-07-21 00:00:00' ELSE TIMESTAMP '2001-08-02 12:00:00' END AS valid_from,
  {OPEN_END} AS valid_to FROM s"""),
    "refresh_job_dims": ask(*NOW, """SELECT 'customer' AS dim, customer_id || '/' || country AS member
FROM people UNION ALL SELECT 'status', status || '/' || is_completed FROM states
UNION ALL SELECT DISTINCT 'date', CAST(order_date AS VARCHAR) FROM s
UNION ALL SELECT DISTINCT 'bucket', amount_bucket FROM f"""),
    "refresh_job_full": ask(*NOW, daily("d", "f", ""), kpi("k", "d"), "SELECT * FROM k"),
    "orders_change_feed": ask(*STATES, f"""SELECT *, 'DELETE' AS _action,
  {PAIRED} AS _is_update, CAST(0 AS BIGINT) AS _seq FROM gone
UNION ALL SELECT *, 'INSERT', {PAIRED}, 1 FROM come"""),
    "orders_change_feed_copies": ask(*STATES, """old_c AS (SELECT * FROM before_ UNION ALL
  SELECT * FROM before_ WHERE order_id % 10 = 4)""", """new_c AS (SELECT * FROM after_ UNION ALL
  SELECT * FROM after_ WHERE order_id % 10 IN (0, 3))""",
        "lost AS (SELECT * FROM old_c EXCEPT ALL SELECT * FROM new_c)",
        "won AS (SELECT * FROM new_c EXCEPT ALL SELECT * FROM old_c)",
        """SELECT *, 'DELETE' AS _action, order_id IN (SELECT order_id FROM new_c
  WHERE order_id IS NOT NULL) AS _is_update, CAST(0 AS BIGINT) AS _seq FROM lost
UNION ALL SELECT *, 'INSERT', order_id IS NOT NULL AND order_id IN (SELECT order_id FROM lost), 1
FROM won"""),
    "orders_net_changes": ask(*STATES, f"""SELECT *, 'DELETE' AS _action,
  FALSE AS _is_update, CAST(0 AS BIGINT) AS _seq FROM gone
WHERE order_id NOT IN (SELECT order_id FROM both_)
UNION ALL SELECT *, 'INSERT', {PAIRED}, 1 FROM come WHERE order_id IS NOT NULL"""),
    "stg_orders_cdc_initial": ask(*STATES, f"""SELECT *, 'INITIAL_LOAD' AS _cdc_action,
  {T0} AS _loaded_at FROM before_ WHERE order_id IS NOT NULL"""),
    "stg_orders_cdc_merge": ask(*STATES, MERGED, "SELECT * FROM merged WHERE order_id IS NOT NULL"),
    "stg_orders_cdc_merge_literal": ask(*STATES, MERGED, "SELECT * FROM merged"),
    "stg_orders_cdc_stream": ask(
        *STATES, MERGED, "SELECT * FROM merged WHERE order_id IS NOT NULL"),
    "stg_orders_cdc_two_feeds": ask(*STATES[:2], LATEST, *[x.replace("after_", "latest")
        for x in STATES[2:]], MERGED, "SELECT * FROM merged WHERE order_id IS NOT NULL"),
    "stg_orders_cdc_mixed": ask(*STATES[:2], LATEST, "SELECT * FROM latest WHERE order_id IS NOT NULL"),
    "orders_snapshot": ask(*STATES, VERSIONS, "SELECT * FROM versions"),
    "orders_as_of": ask(*STATES, "SELECT * FROM before_"),
    "orders_as_of_boundary": ask(*STATES, "SELECT * FROM after_ WHERE order_id IS NOT NULL"),
    "orders_as_of_later": ask(*STATES, "SELECT * FROM after_ WHERE order_id IS NOT NULL"),
    "check_not_null": ask("SELECT * FROM raw WHERE order_id IS NULL"),
    "check_unique": ask("""SELECT customer_id, CAST(count(*) AS BIGINT) AS row_count FROM raw
GROUP BY customer_id HAVING count(*) > 1"""),
    "check_accepted_values": ask("""SELECT status, CAST(count(*) AS BIGINT) AS row_count FROM raw
WHERE status NOT IN ('completed', 'pending') GROUP BY status"""),
    "check_relationships": ask(*NOW, *EARLY, """SELECT DISTINCT customer_id FROM f
WHERE customer_id NOT IN (SELECT customer_id FROM people9)"""),
    "check_between": ask("SELECT * FROM raw WHERE amount < 50 OR amount > 900"),
    "check_type": ask(NOW[0], """SELECT column_name, expected_type, actual_type,
  CAST(CASE WHEN expected_type <> actual_type THEN n ELSE 0 END AS BIGINT) AS failing_rows
FROM (SELECT count(*) AS n, min(typeof(order_id)) AS a, min(typeof(customer_id)) AS b,
             min(typeof(order_date)) AS c, min(typeof(amount)) AS d FROM s),
LATERAL (VALUES ('order_id', 'int', lower(a)),
  ('customer_id', 'string', CASE b WHEN 'VARCHAR' THEN 'string' ELSE b END),
  ('order_date', 'date', lower(c)), ('amount', 'double', lower(d)))
  AS t(column_name, expected_type, actual_type)"""),
    "check_ltv": ask(*NOW, *OLD, mart("m0", "f0", "0"), f"""SELECT customer_id, expected_ltv,
  lifetime_value AS actual_ltv, abs(expected_ltv - lifetime_value) AS delta
FROM (SELECT customer_id, {TOTAL} AS expected_ltv FROM f GROUP BY customer_id)
JOIN m0 USING (customer_id) WHERE abs(expected_ltv - lifetime_value) > 0.01"""),
    "check_running_total": ask(*NOW, REFUNDS, daily("d", "refunds", ""), kpi("k", "d"),
                               """SELECT * FROM (SELECT order_date, country,
  lag(revenue_running_total) OVER (PARTITION BY country ORDER BY order_date)
    AS prev_running_total, revenue_running_total FROM k)
WHERE revenue_running_total < prev_running_total"""),
    "check_kpi_grain": ask(NOW[0], """SELECT order_date, country,
  CAST(count(*) AS BIGINT) AS row_count FROM s GROUP BY order_date, country
HAVING count(*) > 1"""),
    "check_revenue_positive": ask(
        *NOW, REFUNDS, "SELECT order_id, amount FROM refunds WHERE amount < 0"),
    "check_orphan_customers": ask(*NOW, *EARLY, mart("m9", "f9", "9"), """SELECT DISTINCT
  customer_id FROM f WHERE customer_id NOT IN (SELECT customer_id FROM m9)"""),
    "source_freshness": ask("""SELECT newest, age_hours,
  CASE WHEN age_hours <= 24 THEN 'pass' WHEN age_hours <= 48 THEN 'warn' ELSE 'error' END
    AS status
FROM (SELECT newest, date_diff('second', newest, TIMESTAMP '2001-08-02 12:00:00') / 3600
        AS age_hours
      FROM (SELECT CAST(max(order_date) AS TIMESTAMP) AS newest FROM raw))"""),
    "check_report_failing": ask(
        BROKEN, *[x.replace("FROM raw", "FROM broken") for x in NOW], *EARLY, mart("m", "f9", "9"),
        daily("d", "f", ""), kpi("k1", "d"),
        "k AS (SELECT * FROM k1 UNION ALL SELECT * FROM k1 WHERE country = 'FRANCE')",
        BROKEN_DIMS, _report()),
    "check_report": ask(*NOW, mart("m", "f", ""), daily("d", "f", ""), kpi("k", "d"), DIMS,
                        _report()),
}
