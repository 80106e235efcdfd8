"""The SQL that each registered query is compared with, for DuckDB over the same tables."""

from __future__ import annotations

COUNTY = "NATION_7"
SINCE = "2000-01-01"

SALES = """
counties AS (
  SELECT o_orderkey, n_name AS county
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
),
sales AS (
  SELECT CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_shipdate AS DATE) AS date, county,
         CAST(l_quantity AS INTEGER) AS quantity,
         CAST((CAST(round(l_extendedprice * 100) AS BIGINT) // CAST(l_quantity AS BIGINT)) * 0.01
              AS DECIMAL(12,2)) AS price,
         l_orderkey, l_linenumber
  FROM lineitem LEFT JOIN counties ON l_orderkey = o_orderkey
),
products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_type AS category FROM part
),
refined AS (
  SELECT s.*, p.product_name, p.category FROM sales s LEFT JOIN products p ON s.product_id = p.product_id
)"""

RAW = SALES + """,
raw_sales AS (
  SELECT CASE WHEN l_orderkey % 19 = 0 THEN '' ELSE product_id END AS product_id,
         CAST(date AS VARCHAR) AS date, county,
         CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE CAST(quantity AS VARCHAR) END AS quantity,
         CASE WHEN l_orderkey % 17 = 0 THEN 'n/a'
              WHEN l_orderkey % 13 = 0 THEN '-' || CAST(price AS VARCHAR)
              WHEN l_orderkey % 11 = 0 THEN NULL
              ELSE CAST(price AS VARCHAR) END AS price,
         l_orderkey, l_linenumber
  FROM sales
),
raw_products AS (
  SELECT CASE WHEN p_partkey % 10 = 0 THEN 'old-' ELSE '' END || CAST(p_partkey AS VARCHAR) AS product_id,
         CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE p_name END AS product_name, p_type AS category
  FROM part
),
cleaned AS (
  SELECT * FROM (
    SELECT product_id, TRY_CAST(date AS DATE) AS date, county,
           TRY_CAST(coalesce(quantity, '0') AS INTEGER) AS quantity,
           TRY_CAST(coalesce(price, '0.0') AS DECIMAL(12,2)) AS price, l_orderkey, l_linenumber
    FROM raw_sales)
  WHERE price >= 0 AND quantity >= 0
),
cleaned_products AS (
  SELECT product_id, coalesce(product_name, 'Unknown') AS product_name, coalesce(category, 'Unknown') AS category
  FROM raw_products
),
refined_dirty AS (
  SELECT c.*, p.product_name, p.category
  FROM cleaned c LEFT JOIN cleaned_products p ON c.product_id = p.product_id
)"""


def measures(money: str = "CAST(SUM(price * quantity) AS DOUBLE)") -> str:
    return f"""{money} AS total_revenue, CAST(SUM(quantity) AS BIGINT) AS total_quantity,
         COUNT(*) AS transaction_count"""


PRICES = """CAST(SUM(price) AS DOUBLE) / COUNT(price) AS avg_price,
         CAST(MAX(price) AS DOUBLE) AS max_price, CAST(MIN(price) AS DOUBLE) AS min_price"""
EXACT = "SUM(price * quantity)"

VIEW = f"""
SELECT county, category, product_id, product_name, {measures()}, {PRICES}
FROM refined GROUP BY ALL"""
BY_PRODUCT = f"""
SELECT product_id, product_name, category, {measures()}, {PRICES}
FROM refined GROUP BY ALL"""
BY_COUNTY = f"""
SELECT county, {measures()}, COUNT(product_id) AS unique_products,
       CAST(SUM(price * quantity) AS DOUBLE) / COUNT(price * quantity) AS avg_transaction_value
FROM sales GROUP BY ALL"""
BY_CATEGORY = f"""
SELECT category, {measures()}, COUNT(product_id) AS unique_products,
       CAST(SUM(price) AS DOUBLE) / COUNT(price) AS avg_price
FROM refined GROUP BY ALL"""
ITEMS = f"""
SELECT county, product_id, product_name, category, {measures(EXACT)} FROM refined GROUP BY ALL"""

CURATED = SALES + f""",
view AS (SELECT county, category, product_id, product_name, {measures(EXACT)}, {PRICES}
         FROM refined GROUP BY ALL),
by_product AS (SELECT product_id, product_name, category, {measures(EXACT)}, {PRICES}
               FROM refined GROUP BY ALL),
items AS ({ITEMS}),
ranked AS (SELECT *, CAST(rank() OVER (PARTITION BY county ORDER BY total_revenue DESC) AS INTEGER)
             AS revenue_rank FROM items),
top_items AS (SELECT * FROM ranked WHERE revenue_rank <= 10)"""

TOTALS = """CAST(SUM(total_revenue) AS DOUBLE) AS total_revenue,
       CAST(SUM(total_quantity) AS BIGINT) AS total_quantity"""
MEAN_PRICE = "CAST(SUM(CAST(round(avg_price, 8) AS DECIMAL(28,8))) AS DOUBLE) / COUNT(avg_price)"

TOP_COUNTIES = f"""WITH {CURATED}
SELECT county, {TOTALS}, COUNT(*) AS product_count FROM view
GROUP BY county ORDER BY total_revenue DESC, county LIMIT 10"""
REVENUE_SHARE = f"""WITH {CURATED}
SELECT county, category, {TOTALS},
       round(CAST(SUM(total_revenue) AS DOUBLE) * 100.0
             / CAST(SUM(SUM(total_revenue)) OVER (PARTITION BY county) AS DOUBLE), 2)
         AS revenue_percentage_by_county
FROM view GROUP BY county, category"""
COUNTY_SALES = """SELECT county, COUNT(*) AS sales_count, CAST(SUM(price * quantity) AS DOUBLE) AS total_revenue
FROM {} GROUP BY county"""


def issues(view: str) -> str:
    return f"""SELECT issue_type, issue_count FROM (
  SELECT COUNT(*) FILTER (total_revenue < 0) AS negative, COUNT(*) FILTER (total_quantity = 0) AS zero,
         COUNT(*) FILTER (coalesce(product_name, '') = '') AS nameless FROM {view}) t,
  LATERAL (VALUES ('Negative revenue', negative), ('Zero quantity', zero), ('Null product names', nameless))
    AS v(issue_type, issue_count)"""


CHECKS = f"""WITH {RAW},
typed AS (SELECT product_id, date, TRY_CAST(price AS DECIMAL(12,2)) AS price FROM raw_sales),
checks AS (
  SELECT 'min_rows_check' AS "check", COUNT(*) > 1000 AS passed, COUNT(*) AS actual,
         CAST(1000 AS BIGINT) AS threshold FROM typed
  UNION ALL SELECT 'no_negative_prices_check', COUNT(*) = 0, COUNT(*), 0 FROM typed WHERE price < 0
  UNION ALL SELECT 'no_null_product_ids_check', COUNT(*) = 0, COUNT(*), 0 FROM typed
            WHERE product_id IS NULL OR product_id = ''
  UNION ALL SELECT 'valid_dates_check', COUNT(*) = 0, COUNT(*), 0 FROM typed WHERE TRY_CAST(date AS DATE) IS NULL
)"""

SNAPSHOTS = """
keyed AS (
  SELECT 'user_' || user_id AS table_name, ts, value,
         event_type || '_' || (CAST(props->>'$.k' AS INTEGER) % 4) AS field FROM events
),
old AS (SELECT table_name, field, CASE WHEN max(value) > 120 THEN 'double' WHEN max(value) > 40 THEN 'float'
        ELSE 'int' END AS type FROM keyed WHERE ts < TIMESTAMP '2024-01-16' GROUP BY ALL),
new AS (SELECT table_name, field, CASE WHEN max(value) > 120 THEN 'double' WHEN max(value) > 40 THEN 'float'
        ELSE 'int' END AS type FROM keyed WHERE ts >= TIMESTAMP '2024-01-16' GROUP BY ALL),
changes AS (
  SELECT o.table_name, o.field, CASE WHEN n.field IS NULL THEN 'REMOVED' ELSE 'TYPE_CHANGED' END AS change,
         o.type AS old_type, n.type AS new_type,
         CASE WHEN n.field IS NULL THEN 'Removed field: ' || o.field
              ELSE 'Type change for ' || o.field || ': ' || o.type || ' -> ' || n.type END AS description
  FROM old o LEFT JOIN new n ON o.table_name = n.table_name AND o.field = n.field
  WHERE (n.field IS NULL OR o.type <> n.type) AND o.table_name IN (SELECT table_name FROM new)
)"""


def daily(keys: str, source: str = "sales") -> str:
    return f"""daily AS (
  SELECT {keys}, date, CAST(SUM(quantity) AS BIGINT) AS quantity,
         CAST(round(CAST(SUM(price) AS DOUBLE) / COUNT(price), 8) AS DECIMAL(38,8)) AS price,
         CAST(SUM(price * quantity) AS DOUBLE) AS revenue
  FROM {source} GROUP BY ALL)"""


def features(keys: str, source: str, frame: str, order: str) -> str:
    def over(size: int) -> str:
        return f"OVER (PARTITION BY {keys} ORDER BY {order} {frame} BETWEEN {size - 1} PRECEDING AND CURRENT ROW)"

    def mean(column: str, size: int) -> str:
        return f"CAST(SUM({column}) {over(size)} AS DOUBLE) / COUNT({column}) {over(size)}"

    lag = f"OVER (PARTITION BY {keys} ORDER BY date)"
    return f"""WITH {SALES}, {daily(keys, source)}
SELECT {keys}, CAST(date AS VARCHAR) AS date, quantity,
       CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week, CAST(day(date) AS INTEGER) AS day_of_month,
       CAST(month(date) AS INTEGER) AS month, CAST(quarter(date) AS INTEGER) AS quarter,
       CAST(year(date) AS INTEGER) AS year,
       CASE WHEN dayofweek(date) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
       coalesce(lag(quantity, 1) {lag}, 0) AS prev_day_quantity,
       coalesce(lag(quantity, 7) {lag}, 0) AS prev_week_quantity,
       coalesce(lag(quantity, 30) {lag}, 0) AS prev_month_quantity,
       coalesce({mean('quantity', 3)}, 0) AS rolling_3d_avg,
       coalesce({mean('quantity', 7)}, 0) AS rolling_7d_avg,
       coalesce({mean('quantity', 30)}, 0) AS rolling_30d_avg,
       round(coalesce(stddev_samp(quantity) {over(7)}, 0), 6) AS rolling_7d_std,
       round(coalesce(stddev_samp(quantity) {over(30)}, 0), 6) AS rolling_30d_std,
       CAST(price AS DOUBLE) AS price,
       coalesce({mean('price', 7)}, 0) AS avg_price_7d,
       revenue
FROM daily"""


def hash_number(*keys: str, salt: str = "") -> str:
    text = " || '|' || ".join([f"'{salt}'", *[f"CAST({k} AS VARCHAR)" for k in keys]])
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"


# How often each county is drawn, of 4,700.
COUNTY_WEIGHTS = (
    ("Nairobi", 1410),
    ("Mombasa", 705),
    ("Kisumu", 470),
    ("Nakuru", 470),
    ("Eldoret", 235),
    ("Thika", 30),
    ("Malindi", 30),
    ("Kitale", 30),
    ("Garissa", 30),
    ("Kakamega", 30),
    ("Nyeri", 30),
    ("Meru", 30),
    ("Machakos", 30),
    ("Embu", 30),
    ("Nanyuki", 30),
    ("Kilifi", 60),
    ("Lamu", 60),
    ("Turkana", 30),
    ("Marsabit", 30),
    ("Isiolo", 30),
    ("Mandera", 30),
    ("Wajir", 30),
    ("Samburu", 30),
    ("West Pokot", 30),
    ("Baringo", 30),
    ("Laikipia", 30),
    ("Nyandarua", 30),
    ("Muranga", 30),
    ("Kiambu", 30),
    ("Uasin Gishu", 60),
    ("Elgeyo-Marakwet", 30),
    ("Nandi", 30),
    ("Bomet", 30),
    ("Kericho", 30),
    ("Narok", 30),
    ("Kajiado", 30),
    ("Makueni", 30),
    ("Kitui", 30),
    ("Taita-Taveta", 30),
    ("Kwale", 30),
    ("Tana River", 30),
    ("Homa Bay", 30),
    ("Migori", 30),
    ("Kisii", 30),
    ("Nyamira", 30),
    ("Siaya", 30),
    ("Busia", 30),
    ("Bungoma", 30),
    ("Trans Nzoia", 30),
)


def drawn_county() -> str:
    total = sum(weight for _, weight in COUNTY_WEIGHTS)
    slot = f"{hash_number('l_orderkey', 'l_linenumber', 'product_id')} % {total}"
    cases, bound = [], 0
    for name, weight in COUNTY_WEIGHTS:
        bound += weight
        cases.append(f"WHEN slot < {bound} THEN '{name}'")
    return f"""WITH {SALES},
slots AS (SELECT price, quantity, {slot} AS slot FROM sales),
drawn AS (SELECT price, quantity, CASE {' '.join(cases)} END AS county FROM slots)
{COUNTY_SALES.format('drawn')}"""


TRENDS = f"""WITH {SALES}, {daily('county')},
numbered AS (SELECT county, CAST(date - DATE '1970-01-01' AS BIGINT) AS x, quantity AS y FROM daily),
sums AS (SELECT county, CAST(COUNT(*) AS HUGEINT) AS n, SUM(x) AS sx, SUM(y) AS sy, SUM(x * y) AS sxy,
                SUM(x * x) AS sxx FROM numbered GROUP BY county),
slopes AS (SELECT *, CAST(n * sxy - sx * sy AS DOUBLE) / CAST(n * sxx - sx * sx AS DOUBLE) AS slope FROM sums),
lines AS (SELECT county, slope, (CAST(sy AS DOUBLE) - slope * CAST(sx AS DOUBLE)) / CAST(n AS DOUBLE) AS intercept
          FROM slopes),
future AS (SELECT county, CAST((SELECT max(date) FROM daily) + CAST(k AS INTEGER) AS DATE) AS date, slope, intercept
           FROM lines, range(1, 31) r(k)),
forecasts AS (SELECT county, date,
                     intercept + slope * CAST(CAST(date - DATE '1970-01-01' AS BIGINT) AS DOUBLE) AS prediction
              FROM future)"""


def stock(source: str, value: str) -> str:
    return f"""levels AS (SELECT county, avg({value}) AS d, stddev_samp({value}) * 1.65 AS safety FROM {source}
            GROUP BY county)
SELECT county, round(d, 5) AS avg_daily_demand, round(safety, 5) AS safety_stock,
       round(d * 7 + safety, 5) AS reorder_point,
       round(sqrt(greatest(d * 365, 0) * 100.0 / 2.0), 5) AS economic_order_quantity
FROM levels"""


WINDOWS = """
parsed AS (SELECT event_type AS county, CAST(round(value, 2) AS DECIMAL(18,2)) AS amount,
                  time_bucket(INTERVAL 5 MINUTE, date_trunc('millisecond', ts)) AS window_start FROM events),
windows AS (SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, county,
                   COUNT(*) AS transaction_count, CAST(SUM(amount) AS DOUBLE) AS total_sales
            FROM parsed GROUP BY ALL),
shown AS (SELECT CAST(window_start AS VARCHAR) AS window_start, CAST(window_end AS VARCHAR) AS window_end, county,
                 transaction_count, total_sales FROM windows"""


AUDIT_WEEK = """WITH recent AS (SELECT *, 1 + CAST(props->>'$.k' AS INTEGER) % 4 AS steps FROM events
WHERE event_id % 97 <> 0 AND ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY)
SELECT 7 AS period_days, COUNT(*) FILTER (event_type <> 'signup') AS total_jobs,
COUNT(*) FILTER (event_type NOT IN ('signup', 'error')) AS successful_jobs,
COUNT(*) FILTER (event_type = 'error') AS failed_jobs,
CAST(SUM(steps) FILTER (event_type <> 'signup') AS BIGINT) AS total_transformations,
COUNT(*) FILTER (event_type = 'signup' AND value < 60) AS quality_checks_passed,
COUNT(*) FILTER (event_type = 'signup' AND value >= 60) AS quality_checks_failed FROM recent"""


ORACLES: dict[str, str] = {
    "scan_refined": f"""WITH {SALES} SELECT product_id, CAST(date AS VARCHAR) AS date, county, quantity,
        CAST(price AS DOUBLE) AS price, product_name, category FROM refined""",
    "catalog_view": f"""WITH {SALES} SELECT county, category, COUNT(*) AS sales_count,
        CAST(SUM(price * quantity) AS DOUBLE) AS total_revenue
        FROM refined WHERE category IS NOT NULL GROUP BY ALL""",
    "csv_round_trip": f"WITH {RAW} {COUNTY_SALES.format('cleaned')}",
    "csv_with_schema": f"WITH {RAW} {COUNTY_SALES.format('cleaned')}",
    "partitioned_write": f"""WITH {SALES} SELECT product_id, CAST(date AS VARCHAR) AS date, county, quantity,
        CAST(price AS DOUBLE) AS price, product_name, category FROM refined""",
    "curated_write": f"""WITH {CURATED}, totals AS (
        SELECT 'sales_by_product' AS table_name, total_quantity, total_revenue FROM by_product
        UNION ALL SELECT 'sales_by_county', SUM(total_quantity), SUM(total_revenue) FROM view GROUP BY county
        UNION ALL SELECT 'sales_by_category', SUM(total_quantity), SUM(total_revenue) FROM view GROUP BY category
        UNION ALL SELECT 'top_items_per_county', total_quantity, total_revenue FROM top_items
        UNION ALL SELECT 'comprehensive_view', total_quantity, total_revenue FROM view)
        SELECT table_name, COUNT(*) AS row_count, CAST(SUM(total_quantity) AS BIGINT) AS total_quantity,
               CAST(SUM(total_revenue) AS DOUBLE) AS total_revenue FROM totals GROUP BY table_name""",
    "compacted_write": f"WITH {SALES} {COUNTY_SALES.format('sales')}",
    "compacted_in_place": f"""WITH {SALES}, twice AS (SELECT county, price, quantity FROM sales
        UNION ALL SELECT county, price, 1 FROM sales) {COUNTY_SALES.format('twice')}""",
    "rejected_rows": f"""WITH {RAW}, judged AS (SELECT CASE WHEN TRY_CAST(price AS DECIMAL(12,2)) IS NULL AND price IS NOT NULL
        THEN 'malformed' WHEN product_id = '' THEN 'no product_id' WHEN quantity IS NULL THEN 'no quantity'
        WHEN price IS NULL THEN 'no price' ELSE 'kept' END AS reason FROM raw_sales)
        SELECT reason, COUNT(*) AS row_count FROM judged GROUP BY reason""",
    "external_table": f"WITH {SALES} {COUNTY_SALES.format('sales')}",
    "partition_insert": f"""WITH {SALES}, loaded AS (SELECT county, price,
        CASE WHEN county = '{COUNTY}' THEN quantity + 1 ELSE quantity END AS quantity FROM sales)
        {COUNTY_SALES.format('loaded')}""",
    "table_as_query": f"WITH {SALES} {BY_COUNTY}",
    "bucketed_join": f"""WITH {SALES}, days AS (SELECT product_id, category, date,
        SUM(price * quantity) AS revenue, SUM(quantity) AS quantity FROM refined GROUP BY ALL)
        SELECT category, CAST(SUM(revenue) AS DOUBLE) AS total_revenue,
        CAST(SUM(quantity) AS BIGINT) AS total_quantity, COUNT(*) AS product_days FROM days GROUP BY category""",
    "bucketed_layouts": f"""WITH {SALES},
        bought AS (SELECT o_custkey, SUM(CAST(round(o_totalprice, 2) AS DECIMAL(18,2))) AS amount FROM orders
        WHERE o_custkey IN (SELECT c_custkey FROM customer) GROUP BY o_custkey)
        SELECT 'sales_data' AS layout, CAST(COUNT(DISTINCT product_id) AS BIGINT) AS key_count, COUNT(*) AS row_count,
        CAST(SUM(quantity) AS DOUBLE) AS total FROM sales
        UNION ALL SELECT 'customer_data', COUNT(*), COUNT(*), round(CAST(SUM(amount) AS DOUBLE), 2) FROM bought
        UNION ALL SELECT 'product_data', COUNT(DISTINCT p_partkey), COUNT(*), CAST(COUNT(*) AS DOUBLE) FROM part""",
    "clean_sales": f"""WITH {RAW} SELECT * FROM (SELECT product_id, CAST(TRY_CAST(date AS DATE) AS VARCHAR) AS date,
        county, TRY_CAST(coalesce(quantity, '0') AS INTEGER) AS quantity,
        CAST(TRY_CAST(coalesce(price, '0.0') AS FLOAT) AS DOUBLE) AS price, l_orderkey, l_linenumber FROM raw_sales)
        WHERE price >= 0 AND quantity >= 0""",
    "clean_products": f"WITH {RAW} SELECT * FROM cleaned_products",
    "refine_dirty": f"""WITH {RAW} SELECT product_id, product_name, category, {measures()}, {PRICES}
        FROM refined_dirty GROUP BY ALL""",
    "filter_county": f"""WITH {SALES} SELECT product_id, CAST(date AS VARCHAR) AS date, county, quantity,
        CAST(price AS DOUBLE) AS price FROM sales WHERE county = '{COUNTY}'""",
    "project_rename": f"""WITH {SALES} SELECT product_id, CAST(date AS VARCHAR) AS date, quantity AS units
        FROM sales""",
    "derive_revenue": f"""WITH {SALES} SELECT product_id, CAST(date AS VARCHAR) AS date,
        CAST(price * quantity AS DOUBLE) AS revenue FROM sales""",
    "case_weekend": f"""WITH {SALES} SELECT CASE WHEN dayofweek(date) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
        COUNT(*) AS sales_count, CAST(SUM(quantity) AS BIGINT) AS total_quantity FROM sales GROUP BY ALL""",
    "recent_sales": f"""WITH {SALES} SELECT product_id, CAST(date AS VARCHAR) AS date, quantity,
        CAST(price AS DOUBLE) AS price FROM sales
        WHERE date >= (SELECT CAST(max(date) - INTERVAL 6 MONTH AS DATE) FROM sales)""",
    "enrich_county": drawn_county(),
    "join_sales_products": f"""WITH {RAW} SELECT s.product_id, CAST(date AS VARCHAR) AS date, quantity,
        CAST(price AS DOUBLE) AS price, l_orderkey, l_linenumber, product_name, category
        FROM sales s LEFT JOIN raw_products p ON s.product_id = p.product_id""",
    "inner_join_filter": f"""WITH {RAW} SELECT s.product_id, CAST(date AS VARCHAR) AS date, quantity,
        CAST(price AS DOUBLE) AS price, product_name, category
        FROM sales s JOIN raw_products p ON s.product_id = p.product_id WHERE category = 'ECONOMY'""",
    "join_three_keys": f"""WITH {SALES}, {daily('product_id, county')},
        lagged AS (SELECT product_id, county, date, CAST(quantity AS DOUBLE) AS y,
            CAST(lag(quantity) OVER (PARTITION BY product_id, county ORDER BY date) AS DOUBLE) AS p FROM daily),
        m AS (SELECT * FROM lagged WHERE p IS NOT NULL)
        SELECT COUNT(*) AS n, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse, round(avg(abs(y - p)), 6) AS mae,
               round(1 - SUM((y - p) * (y - p)) / (var_pop(y) * COUNT(*)), 6) AS r2 FROM m""",
    "future_days": f"""WITH {SALES} SELECT county, CAST(CAST((SELECT max(date) FROM sales) + CAST(k AS INTEGER) AS DATE)
        AS VARCHAR) AS date FROM (SELECT DISTINCT county FROM sales), range(1, 8) r(k)""",
    "asof_latest": f"""WITH {SALES}, {daily('product_id, county')} SELECT product_id, county,
        CAST(date AS VARCHAR) AS date, quantity, CAST(price AS DOUBLE) AS price FROM daily
        WHERE date < DATE '{SINCE}'
        QUALIFY row_number() OVER (PARTITION BY product_id, county ORDER BY date DESC) = 1""",
    "asof_join": f"""WITH {SALES}, last AS (SELECT product_id, date, max((price, quantity)) AS x FROM sales GROUP BY ALL),
        lines AS (SELECT CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_shipdate AS DATE) AS date, l_orderkey, l_linenumber FROM lineitem)
        SELECT lines.product_id, CAST(lines.date AS VARCHAR) AS date, l_orderkey, l_linenumber,
        CAST(last.date AS VARCHAR) AS found_date, CAST(x[1] AS DOUBLE) AS price, x[2] AS quantity
        FROM lines ASOF LEFT JOIN last ON lines.product_id = last.product_id AND lines.date > last.date""",
    "distinct_sketched": f"""WITH {SALES}, months AS (SELECT *, strftime(date, '%Y-%m') AS month FROM sales), counted AS (
        SELECT 'county' AS grain, county AS value, product_id, date FROM months
        UNION ALL SELECT 'month', month, product_id, date FROM months UNION ALL SELECT 'all', '', product_id, date FROM months)
        SELECT grain, value, COUNT(DISTINCT product_id) AS products, COUNT(DISTINCT date) AS days, TRUE AS near
        FROM counted GROUP BY grain, value""",
    "sales_by_product": f"WITH {SALES} {BY_PRODUCT}",
    "sales_by_county": f"WITH {SALES} {BY_COUNTY}",
    "sales_by_category": f"WITH {SALES} {BY_CATEGORY}",
    "county_product_sales": f"""WITH {SALES} SELECT county, product_id, product_name, category, {measures()}
        FROM refined GROUP BY ALL""",
    "comprehensive_view": f"WITH {SALES} {VIEW}",
    "aggregate_metrics": f"""WITH {CURATED} SELECT COUNT(*) AS group_count,
        CAST(SUM(total_revenue) AS DOUBLE) AS grand_total,
        CAST(SUM(total_revenue) AS DOUBLE) / COUNT(*) AS mean_group_total FROM by_product""",
    "top_items_metrics": f"""WITH {CURATED} SELECT COUNT(*) AS total_combinations,
        COUNT(DISTINCT county) AS groups_analyzed,
        CAST(COUNT(*) AS DOUBLE) / COUNT(DISTINCT county) AS avg_items_per_group FROM top_items""",
    "distinct_series": f"WITH {SALES} SELECT DISTINCT product_id, county FROM sales",
    "distinct_counts": f"""WITH {SALES} SELECT county, COUNT(DISTINCT product_id) AS products,
        COUNT(DISTINCT date) AS days FROM sales GROUP BY county""",
    "count_non_null": f"""WITH {RAW} SELECT county, COUNT(*) AS row_count, COUNT(price) AS price_count,
        COUNT(quantity) AS quantity_count FROM raw_sales GROUP BY county""",
    "max_date": f"WITH {SALES} SELECT CAST(max(date) AS VARCHAR) AS max_date FROM sales",
    "step_counts": f"""WITH {RAW} SELECT 'sales_raw' AS step, COUNT(*) AS row_count FROM raw_sales
        UNION ALL SELECT 'products_raw', COUNT(*) FROM raw_products
        UNION ALL SELECT 'sales_cleaned', COUNT(*) FROM cleaned
        UNION ALL SELECT 'products_cleaned', COUNT(*) FROM cleaned_products
        UNION ALL SELECT 'joined', COUNT(*) FROM refined_dirty""",
    "top_items_per_county": f"""WITH {CURATED} SELECT county, product_id, product_name, category,
        CAST(total_revenue AS DOUBLE) AS total_revenue, total_quantity, transaction_count, revenue_rank
        FROM top_items""",
    "insight_01": TOP_COUNTIES,
    "insight_02": f"""WITH {CURATED} SELECT category, {TOTALS}, COUNT(DISTINCT county) AS counties_served,
        {MEAN_PRICE} AS avg_category_price FROM view GROUP BY category
        ORDER BY total_revenue DESC, category LIMIT 10""",
    "insight_03": f"""WITH {CURATED} SELECT product_id, product_name, category, {TOTALS},
        CAST(SUM(transaction_count) AS BIGINT) AS total_transactions FROM by_product
        GROUP BY product_id, product_name, category
        ORDER BY total_revenue DESC, product_id, product_name, category LIMIT 10""",
    "insight_04": f"""WITH {CURATED} SELECT county, category, {TOTALS},
        COUNT(DISTINCT product_id) AS unique_products FROM view GROUP BY county, category
        ORDER BY total_revenue DESC, county, category LIMIT 10""",
    "insight_05": REVENUE_SHARE,
    "insight_06": f"""WITH {SALES}, by_county AS ({BY_COUNTY}) SELECT county,
        avg(avg_transaction_value) AS avg_transaction_value, SUM(total_revenue) AS total_revenue,
        COUNT(*) AS transaction_count FROM by_county GROUP BY county""",
    "insight_07": f"""WITH {CURATED}, numbered AS (SELECT county, product_id, product_name, category,
        CAST(total_revenue AS DOUBLE) AS total_revenue, CAST(row_number() OVER (PARTITION BY county
        ORDER BY total_revenue DESC, product_id, product_name, category) AS INTEGER) AS rank_in_county
        FROM top_items) SELECT * FROM numbered WHERE rank_in_county <= 5""",
    "insight_08": f"""WITH {CURATED} SELECT category, COUNT(DISTINCT county) AS counties_available, {TOTALS},
        {MEAN_PRICE} AS avg_price, COUNT(DISTINCT product_id) AS unique_products FROM view GROUP BY category""",
    "insight_09": f"""WITH {SALES}, by_product AS (SELECT product_id, product_name, category,
        CAST(SUM(price) AS DOUBLE) / COUNT(price) AS avg_price, MIN(price) AS min_price, MAX(price) AS max_price
        FROM refined GROUP BY ALL)
        SELECT category, CAST(MIN(min_price) AS DOUBLE) AS lowest_price, {MEAN_PRICE} AS avg_price,
        CAST(MAX(max_price) AS DOUBLE) AS highest_price,
        CAST(MAX(max_price) - MIN(min_price) AS DOUBLE) AS price_range FROM by_product GROUP BY category""",
    "insight_10": f"""WITH {CURATED} SELECT county, COUNT(DISTINCT category) AS categories_served,
        COUNT(DISTINCT product_id) AS unique_products_offered, {TOTALS} FROM view GROUP BY county""",
    "insight_11": f"""WITH {SALES} SELECT CAST(CAST(date_trunc('month', date) AS DATE) AS VARCHAR) AS month, county,
        CAST(SUM(price * quantity) AS DOUBLE) AS monthly_revenue, CAST(SUM(quantity) AS BIGINT) AS monthly_quantity
        FROM sales WHERE date >= (SELECT CAST(max(date) - INTERVAL 6 MONTH AS DATE) FROM sales) GROUP BY ALL""",
    "insight_12": f"""WITH {CURATED} SELECT product_name, category, CAST(total_revenue AS DOUBLE) AS total_revenue,
        total_quantity FROM view WHERE county = '{COUNTY}'
        ORDER BY view.total_revenue DESC, product_id, category LIMIT 100""",
    "insight_13": f"""WITH {RAW}, view AS (SELECT county, category, product_id, product_name, {measures()}
        FROM refined_dirty GROUP BY ALL) {issues('view')}""",
    "insight_14": f"WITH {SALES} {COUNTY_SALES.format('sales')}",
    "insight_15": f"""WITH {SALES} SELECT s.product_id, p.product_name, county, quantity
        FROM sales s JOIN products p ON s.product_id = p.product_id WHERE county = '{COUNTY}'""",
    "insight_16": f"""WITH {SALES} SELECT county, CAST(SUM(quantity) AS BIGINT) AS total_sales FROM sales
        WHERE date >= DATE '{SINCE}' GROUP BY county""",
    "sql_top_counties": TOP_COUNTIES,
    "sql_revenue_share": REVENUE_SHARE,
    "sql_quality_issues": f"WITH {CURATED} {issues('view')}",
    "quality_checks": f'{CHECKS} SELECT * FROM checks',
    "quality_verdict": f"""{CHECKS} SELECT bool_and(passed) AS passed,
        CASE WHEN bool_and(passed) THEN 'PASSED' ELSE 'FAILED' END AS overall_status,
        COUNT(*) FILTER (NOT passed) AS failed_checks FROM checks""",
    "profile_nulls": f"""WITH {RAW}, joined AS (SELECT r.product_id, date, county, quantity, price, product_name,
        category FROM raw_sales r LEFT JOIN raw_products p ON r.product_id = p.product_id)
        """ + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) AS total_records, COUNT(*) - COUNT({c}) AS null_count FROM joined"
        for c in ("product_id", "date", "county", "quantity", "price", "product_name", "category")
    ),
    "duplicate_count": f"""WITH {SALES}, d AS (SELECT product_id, county, quantity, COUNT(*) AS n FROM sales
        GROUP BY ALL) SELECT CAST(SUM(n) AS BIGINT) AS total_records, COUNT(*) AS distinct_records,
        CAST(SUM(n) - COUNT(*) AS BIGINT) AS duplicate_count FROM d""",
    "schema_changes": f"WITH {SNAPSHOTS} SELECT * FROM changes",
    "schema_compatibility": f"""WITH {SNAPSHOTS} SELECT t.table_name,
        COUNT(*) FILTER (change = 'REMOVED') AS removed_fields,
        COUNT(*) FILTER (change = 'TYPE_CHANGED') AS changed_types, COUNT(change) = 0 AS backward_compatible
        FROM (SELECT DISTINCT table_name FROM old) t LEFT JOIN changes c ON t.table_name = c.table_name
        GROUP BY t.table_name""",
    "audit_summary": AUDIT_WEEK,
    "audit_by_day": AUDIT_WEEK,
    "run_records": f"""WITH {RAW} SELECT job_name, status, CAST(steps AS INTEGER) AS steps, error,
        CASE WHEN counted THEN (SELECT COUNT(*) FROM lineitem) END AS sales_raw,
        CASE WHEN counted THEN (SELECT COUNT(*) FROM part) END AS products_raw,
        CASE WHEN counted THEN (SELECT COUNT(*) FROM refined_dirty) END AS joined,
        CASE WHEN job_name = 'curate' THEN (SELECT COUNT(DISTINCT COALESCE(county, '')) FROM refined_dirty) END
            AS sales_by_county_group_count
        FROM (VALUES ('refine', 'FAILED', 4, 'QualityError', false), ('refine', 'SUCCESS', 4, NULL, true),
        ('curate', 'SUCCESS', 5, NULL, false)) r(job_name, status, steps, error, counted)""",
    "quality_record": f"""{CHECKS} SELECT 'refine' AS job_name, 'data_quality' AS quality_type,
        CASE WHEN (SELECT bool_and(passed) FROM checks) THEN 'PASSED' ELSE 'FAILED' END AS overall_status,
        true AS data_governance, (SELECT bool_and(passed) FROM checks) AS quality_standards,
        NOT (SELECT bool_and(passed) FROM checks) AS audit_required, "check" AS check_name, passed, actual, threshold
        FROM checks""",
    "features": features("product_id, county", "sales", "ROWS", "date"),
    "features_by_group": features(
        "category, county", "refined", "RANGE", "CAST(date - DATE '1970-01-01' AS INTEGER)"
    ),
    "hash_split": f"""WITH {SALES}, {daily('product_id, county')}, sides AS (SELECT quantity,
        CASE WHEN {hash_number('product_id', 'county', 'date', salt='42')} % 1000000 < 800000
        THEN 'train' ELSE 'test' END AS side FROM daily)
        SELECT side, COUNT(*) AS row_count, CAST(SUM(quantity) AS BIGINT) AS total_quantity
        FROM sides GROUP BY side""",
    "rolling_split": f"""WITH {SALES}, {daily('product_id, county')}, bounds AS (SELECT CAST(f AS INTEGER) AS fold,
        (SELECT max(date) FROM sales) - CAST(f * 60 + 60 AS INTEGER) AS start FROM range(3) r(f)),
        used AS (SELECT fold, CASE WHEN date <= start THEN 'train' ELSE 'test' END AS side, quantity, date
        FROM daily, bounds WHERE date <= start + 60)
        SELECT fold, side, COUNT(*) AS row_count, CAST(SUM(quantity) AS BIGINT) AS total_quantity,
        CAST(min(date) AS VARCHAR) AS first_day, CAST(max(date) AS VARCHAR) AS last_day FROM used GROUP BY fold, side""",
    "category_means": f"""WITH {SALES}, {daily('product_id, county')}, marked AS (SELECT county, quantity,
        {hash_number('product_id', 'county', 'date', salt='42')} % 1000000 < 800000 AS train,
        CAST({hash_number('product_id', 'county', 'date', salt='fold')} % 5 AS INTEGER) AS part FROM daily),
        used AS (SELECT county, CASE WHEN train THEN part ELSE -1 END AS fold, COUNT(*) AS row_count FROM marked GROUP BY ALL),
        base AS (SELECT county, part, SUM(quantity) AS total, COUNT(*) AS n FROM marked WHERE train GROUP BY ALL),
        made AS (SELECT used.county, fold, any_value(row_count) AS row_count,
        round((SUM(CASE WHEN base.county = used.county THEN total ELSE 0 END) + 10 * CAST(SUM(total) AS DOUBLE) / SUM(n))
        / (SUM(CASE WHEN base.county = used.county THEN n ELSE 0 END) + 10), 6) AS mean
        FROM used JOIN base ON base.part <> fold GROUP BY used.county, fold)
        SELECT county, fold, row_count, mean AS lowest, mean AS highest FROM made""",
    "fitted_line": f"""WITH {SALES}, {daily('product_id, county')}, marked AS (SELECT CAST(quantity AS DOUBLE) AS y, CAST(price AS DOUBLE) AS x,
        {hash_number('product_id', 'county', 'date', salt='42')} % 1000000 < 800000 AS train FROM daily),
        fit AS (SELECT regr_slope(y, x) AS slope, regr_intercept(y, x) AS base, avg(y) AS mean FROM marked WHERE train),
        predicted AS (SELECT 'line' AS model, y, base + slope * x AS p FROM marked, fit WHERE NOT train
        UNION ALL SELECT 'flat', y, mean FROM marked, fit WHERE NOT train),
        errors AS (SELECT model, COUNT(*) AS n, sqrt(avg((y - p) ** 2)) AS rmse, avg(abs(y - p)) AS mae,
        1 - sum((y - p) ** 2) / (var_pop(y) * COUNT(*)) AS r2 FROM predicted GROUP BY model)
        SELECT model, n, round(rmse, 5) AS rmse, round(mae, 5) AS mae, round(r2, 5) AS r2,
        rmse = min(rmse) OVER () AS is_best FROM errors""",
    "step_accuracy": f"""WITH {SALES}, days AS (SELECT DISTINCT product_id, county, date FROM sales),
        known AS (SELECT * FROM days WHERE date <= (SELECT MAX(date) FROM sales) - INTERVAL 30 DAY),
        matched AS (SELECT CAST(product_id AS BIGINT) % 3 AS miss,
        CASE WHEN dayofweek(date) IN (0, 6) THEN 7 ELSE 3 END + CAST(product_id AS BIGINT) % 3 AS quantity
        FROM days SEMI JOIN (SELECT DISTINCT product_id, county FROM known) USING (product_id, county)
        WHERE date > (SELECT MAX(date) FROM known) AND date <= (SELECT MAX(date) FROM known) + INTERVAL 30 DAY)
        SELECT COUNT(*) AS n, round(sqrt(AVG(miss * miss)), 5) AS rmse, round(AVG(miss), 5) AS mae,
        round(1 - SUM(miss * miss) / (VAR_POP(quantity) * COUNT(*)), 5) AS r2 FROM matched""",
    "step_forecast": f"""WITH {SALES}, last AS (SELECT DISTINCT product_id, county FROM sales), future AS (
        SELECT last.*, CAST((SELECT max(date) FROM sales) + CAST(k AS INTEGER) AS DATE) AS date FROM last, range(1, 15) r(k))
        SELECT product_id, county, CAST(date AS VARCHAR) AS date,
        CASE WHEN dayofweek(date) IN (0, 6) THEN 7.0::DOUBLE ELSE 3.0::DOUBLE END AS forecast_quantity FROM future""",
    "step_importance": """SELECT feature, CASE WHEN feature = 'is_weekend' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS importance
        FROM (VALUES ('is_weekend'), ('day_of_month'), ('month')) f(feature)""",
    "forecast_frame": f"""WITH {SALES}, {daily('product_id, county')},
        last AS (SELECT product_id, county, quantity, CAST(price AS DOUBLE) AS price FROM daily
                 QUALIFY row_number() OVER (PARTITION BY product_id, county ORDER BY date DESC) = 1),
        future AS (SELECT last.*, CAST((SELECT max(date) FROM daily) + CAST(k AS INTEGER) AS DATE) AS date
                   FROM last, range(1, 31) r(k))
        SELECT product_id, county, CAST(date AS VARCHAR) AS date,
        CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week, CAST(day(date) AS INTEGER) AS day_of_month,
        CAST(month(date) AS INTEGER) AS month, CAST(quarter(date) AS INTEGER) AS quarter,
        CAST(year(date) AS INTEGER) AS year, CASE WHEN dayofweek(date) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
        quantity AS prev_day_quantity, quantity AS prev_week_quantity, quantity AS prev_month_quantity,
        CAST(quantity AS DOUBLE) AS rolling_3d_avg, CAST(quantity AS DOUBLE) AS rolling_7d_avg,
        CAST(quantity AS DOUBLE) AS rolling_30d_avg, CAST(0 AS DOUBLE) AS rolling_7d_std,
        CAST(0 AS DOUBLE) AS rolling_30d_std, price, price AS avg_price_7d FROM future""",
    "naive_errors": f"""WITH {SALES}, {daily('product_id, county')}, errors AS (
        SELECT quantity, quantity - lag(quantity, 1, 0) OVER (PARTITION BY product_id, county ORDER BY date) AS error
        FROM daily)
        SELECT COUNT(*) AS n, round(sqrt(avg(error * error)), 6) AS rmse, round(avg(abs(error)), 6) AS mae,
        round(1 - sum(error * error) / (var_pop(quantity) * COUNT(*)), 6) AS r2 FROM errors""",
    "demand_trend": f"""{TRENDS} SELECT county, CAST(date AS VARCHAR) AS date, round(prediction, 6) AS prediction
        FROM forecasts""",
    "inventory": f"{TRENDS}, {stock('forecasts', 'prediction')}",
    "inventory_observed": f"WITH {SALES}, {daily('county')}, {stock('daily', 'quantity')}",
    "rfm": """WITH p AS (SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS date,
        CAST(round(o_totalprice, 2) AS DECIMAL(18,2)) AS amount FROM orders)
        SELECT customer_id, CAST(max(date) AS VARCHAR) AS last_purchase_date, COUNT(*) AS frequency,
        CAST(SUM(amount) AS DOUBLE) AS monetary_value,
        CAST((SELECT max(date) FROM p) - max(date) AS INTEGER) AS recency FROM p GROUP BY customer_id""",
    "kmeans_separated": """WITH p AS (SELECT o_custkey AS id, CAST(max(o_orderdate) AS DATE) AS last, COUNT(*) AS frequency,
        SUM(CAST(round(o_totalprice, 2) AS DECIMAL(18,2))) AS monetary FROM orders GROUP BY o_custkey)
        SELECT COUNT(*) AS customer_count,
        round(avg((DATE '2002-01-01' - last) % 30 + id % 3 * 1000), 6) AS avg_recency,
        round(avg(frequency + id % 3 * 5000), 6) AS avg_frequency,
        round(avg(CAST(floor(monetary) AS BIGINT) % 1000 + id % 3 * 1000000), 6) AS avg_monetary FROM p GROUP BY id % 3""",
    "parse_json_events": """SELECT event_type AS county, COUNT(ts) AS event_count,
        CAST(SUM(CAST(round(value, 2) AS DECIMAL(18,2))) AS DOUBLE) AS total_amount FROM events GROUP BY event_type""",
    "tumbling_window_batch": f"WITH {WINDOWS}) SELECT * FROM shown",
    "stream_window": f"""WITH {WINDOWS}
        WHERE window_end <= (SELECT max(date_trunc('millisecond', ts)) - INTERVAL 1 HOUR FROM events))
        SELECT * FROM shown""",
    "stream_arrivals": """WITH arrived AS (SELECT event_type AS county, date_trunc('millisecond', ts) AS ts,
        CAST(round(value, 2) AS DECIMAL(18,2)) AS amount, CAST(least(2, date_diff('day', CAST((SELECT min(ts) FROM events)
        AS DATE), CAST(ts AS DATE)) // 10 + CAST(event_id % 5 = 0 AS INTEGER)) AS INTEGER) AS arrival FROM events),
        marks AS (SELECT CAST(k AS INTEGER) AS arrival,
        (SELECT max(ts) FROM arrived WHERE arrived.arrival < k) - INTERVAL 1 HOUR AS mark FROM range(3) r(k)),
        placed AS (SELECT county, amount, time_bucket(INTERVAL 5 MINUTE, ts) AS start,
        COALESCE(time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE <= mark, false) AS late
        FROM arrived JOIN marks USING (arrival))
        SELECT CAST(start AS VARCHAR) AS window_start, county,
        nullif(COUNT(*) FILTER (NOT late), 0) AS transaction_count,
        CAST(SUM(amount) FILTER (NOT late) AS DOUBLE) AS total_sales, COUNT(*) FILTER (late) AS late_count FROM placed
        WHERE start + INTERVAL 5 MINUTE <= (SELECT max(ts) FROM arrived) - INTERVAL 1 HOUR GROUP BY start, county""",
    "encrypt_round_trip": """SELECT c_custkey, c_name, c_acctbal, true AS was_hidden FROM customer""",
}
