"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written directly from the reference's SQL semantics and FIXTURES.md, not from the Spark code.
The driver's TPC-H views (region, nation, customer, part, orders, lineitem) are inputs; the
warehouse tables are CTEs with names that do not clash with those views.

are cast to DECIMAL(18,2), rounded averages use integer arithmetic
``(2*units + n) // (2*n)``, REAL columns are cast from the exact total last.
"""

from __future__ import annotations

# Parameters shared with the Spark registrations in __spark_entry__.py.
AS_OF = "2001-09-01"  # load date for seeded addresses and validated inserts
SCD2_STEP_DAYS = 30  # days between address change batches
SALES_DAY = "1998-08-02"  # E6
LOOKUP_CATEGORY = "PROMO"  # C8
DIM_DATE_CUTOFF = "2000-01-01"  # I3: dim_date loaded with dates before this
LATE_YEAR = 1997  # late sales have invoice dates from this year on
QUESTION_YEAR = 1997  # B1 for one year
QUESTION_DAYS = ("1996-11-05", "1997-02-10")  # B1 for a range of days
FEED_DAY = "1997-05-05"  # load date of the late stream feed
MOVE_MULTIPLIERS = (7919, 104729, 7927, 104723)  # seed, the two moves of one batch, the late move
ADDRESS_MULTIPLIERS = (7919, 104729, 7927, 7919)  # seed, then three change batches (last moves back)

BASE = r"""
rs AS (
  SELECT CAST(l.l_orderkey * 8 + l.l_linenumber AS BIGINT) AS transaction_id,
         strftime(o.o_orderdate, '%Y-%m-%d %H:%M:%S') AS "timestamp",
         CAST(o.o_custkey AS BIGINT) AS customer_id,
         CAST(l.l_partkey AS BIGINT) AS product_id,
         p.p_type AS product_category,
         CAST(l.l_quantity AS INTEGER) AS quantity,
         CAST(p.p_retailprice AS DECIMAL(10,2)) AS price,
         CAST(l.l_discount AS DECIMAL(4,2)) AS discount,
         CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Credit Card' WHEN '2-HIGH' THEN 'Debit Card'
              WHEN '3-MEDIUM' THEN 'Gift Card' WHEN '4-NOT SPECIFIED' THEN 'PayPal'
              WHEN '5-LOW' THEN 'Credit Card' END AS payment_method,
         CAST(18 + c.c_custkey % 60 AS INTEGER) AS customer_age,
         CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'Male' WHEN 'BUILDING' THEN 'Male'
              WHEN 'FURNITURE' THEN 'Female' WHEN 'HOUSEHOLD' THEN 'Female'
              WHEN 'MACHINERY' THEN 'Other' END AS customer_gender,
         r.r_name AS customer_location,
         CAST(l.l_extendedprice AS DECIMAL(10,2)) AS total_amount,
         l.l_returnflag AS l_returnflag
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
pm_lk AS (
  SELECT CAST(row_number() OVER (ORDER BY v) AS INTEGER) AS method_id, v AS payment_method, TRUE AS is_active
  FROM (SELECT DISTINCT payment_method AS v FROM rs WHERE payment_method IS NOT NULL)
),
rg_lk AS (
  SELECT CAST(row_number() OVER (ORDER BY v NULLS LAST) AS INTEGER) AS region_id, v AS region_name
  FROM (SELECT DISTINCT customer_location AS v FROM rs)
),
pc_lk AS (
  SELECT CAST(row_number() OVER (ORDER BY v NULLS LAST) AS INTEGER) AS category_id, v AS category
  FROM (SELECT DISTINCT product_category AS v FROM rs)
),
cust_lk AS (
  SELECT CAST(row_number() OVER (ORDER BY customer_no NULLS LAST, gender NULLS LAST) AS INTEGER) AS customer_id,
         customer_no, gender
  FROM (SELECT DISTINCT 'C-' || CAST(customer_id AS VARCHAR) AS customer_no,
               CASE customer_gender WHEN 'Male' THEN 'M' WHEN 'Female' THEN 'F' WHEN 'Other' THEN 'F' END AS gender
        FROM rs)
),
sd_all AS (
  SELECT cu.customer_id, pc.category_id, rs.price AS unit_price, rs.quantity, rs.discount,
         rs.total_amount AS amount, pm.method_id AS payment_method_id,
         TRY_CAST(TRY_CAST(rs."timestamp" AS TIMESTAMP) AS DATE) AS invoice_date, rg.region_id,
         rs.l_returnflag
  FROM rs
  LEFT JOIN cust_lk cu ON concat('C-', CAST(rs.customer_id AS VARCHAR)) = cu.customer_no
  LEFT JOIN pc_lk pc ON rs.product_category = pc.category
  LEFT JOIN pm_lk pm ON rs.payment_method = pm.payment_method
  LEFT JOIN rg_lk rg ON rs.customer_location = rg.region_name
),
sd AS (
  SELECT * FROM sd_all
  WHERE customer_id IS NOT NULL AND category_id IS NOT NULL AND quantity IS NOT NULL AND amount IS NOT NULL
    AND payment_method_id IS NOT NULL AND invoice_date IS NOT NULL AND region_id IS NOT NULL AND quantity > 0
),
dd AS (
  SELECT CAST(row_number() OVER (ORDER BY full_date) AS INTEGER) AS date_key, full_date,
         CAST(year(full_date) AS INTEGER) AS year, CAST(quarter(full_date) AS INTEGER) AS quarter,
         CASE quarter(full_date) WHEN 1 THEN 'First' WHEN 2 THEN 'Second' WHEN 3 THEN 'Third' ELSE 'Fourth' END AS quarter_name,
         CAST(month(full_date) AS INTEGER) AS month, rpad(monthname(full_date), 9, ' ') AS month_name,
         CAST(day(full_date) AS INTEGER) AS day_of_month, CAST(isodow(full_date) AS INTEGER) AS day_of_week,
         rpad(dayname(full_date), 9, ' ') AS day_name, FALSE AS is_holiday
  FROM (SELECT DISTINCT invoice_date AS full_date FROM sd)
),
dcu AS (
  SELECT customer_id AS customer_key, customer_no, CAST(NULL AS VARCHAR) AS first_name, CAST(NULL AS VARCHAR) AS last_name,
         gender, CAST(NULL AS VARCHAR) AS email
  FROM cust_lk WHERE customer_id IN (SELECT customer_id FROM sd)
),
dpc AS (SELECT category_id AS category_key, category AS product_category FROM pc_lk WHERE category_id IN (SELECT category_id FROM sd)),
drg AS (SELECT region_id AS region_key, region_name AS region FROM rg_lk WHERE region_id IN (SELECT region_id FROM sd)),
dpm AS (SELECT method_id AS payment_method_key, payment_method FROM pm_lk WHERE method_id IN (SELECT payment_method_id FROM sd)),
fs AS (
  SELECT d.date_key, s.customer_id AS customer_key, c.category_key AS product_category_key,
         s.quantity AS product_quantity, CAST(s.amount AS DECIMAL(18,2)) AS sale_amount, s.discount AS sale_discount,
         r.region_key, m.payment_method_key
  FROM sd s
  JOIN dpc c ON s.category_id = c.category_key
  JOIN drg r ON s.region_id = r.region_key
  JOIN dpm m ON s.payment_method_id = m.payment_method_key
  JOIN dcu u ON s.customer_id = u.customer_key
  JOIN dd d ON s.invoice_date = d.full_date
),
raw_addr AS (
  SELECT '[''' || CAST(c.c_custkey AS VARCHAR) || ' Main St\n' || n.n_name || ', ' || printf('%05d', c.c_custkey) || ''']'
         AS customer_address
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
),
parsed_addr AS (
  SELECT street_number, string_split(nullif(city_zip, ''), ',')[1] AS city,
         string_split(nullif(city_zip, ''), ',')[2] AS zip_code
  FROM (
    SELECT string_split(nullif(raw, ''), '\n')[1] AS street_number, string_split(nullif(raw, ''), '\n')[2] AS city_zip
    FROM (SELECT replace(replace(replace(customer_address, '[', ''), ']', ''), '''', '') AS raw FROM raw_addr)
  )
  WHERE street_number IS NOT NULL
),
addr AS (
  SELECT CAST(row_number() OVER (ORDER BY street_number NULLS LAST, city NULLS LAST, zip_code NULLS LAST) AS INTEGER)
         AS address_id, street_number, city, zip_code
  FROM parsed_addr
),
n_addr AS (SELECT COUNT(*) AS n FROM addr),
max_year AS (SELECT CAST(MAX(year(invoice_date)) AS INTEGER) AS y FROM sd),
cy_stats AS (
  SELECT customer_id, CAST(year(invoice_date) AS INTEGER) AS y, SUM(discount) AS disc, SUM(amount) AS amt,
         SUM(quantity) AS qty
  FROM sd GROUP BY 1, 2
),
cy_first AS (SELECT customer_id, MIN(y) AS fy FROM cy_stats GROUP BY 1),
cy_spine AS (
  SELECT f.customer_id, CAST(g.y AS INTEGER) AS current_year
  FROM cy_first f, max_year m, LATERAL range(f.fy, m.y + 1) g(y)
)
"""

ROUND_AVG_2 = "CAST(CAST(((2 * CAST({s} * 100 AS HUGEINT) + {n}) // (2 * {n})) AS DECIMAL(38,0)) * 0.01 AS DECIMAL(18,2))"


def _avg2(sum_expr: str, n_expr: str) -> str:
    return ROUND_AVG_2.format(s=sum_expr, n=n_expr)


def _avg4(sum_expr: str, n_expr: str, value_scale: int) -> str:
    mult = 10 ** (4 - value_scale)
    return (
        f"CAST(CAST(((2 * CAST({sum_expr} * {10 ** value_scale} AS HUGEINT) * {mult} + {n_expr}) // (2 * {n_expr}))"
        f" AS DECIMAL(38,0)) * 0.0001 AS DECIMAL(22,4))"
    )


def _with(body: str) -> str:
    return f"WITH {BASE.strip()}\n{body}"


SALES_DETAIL_COLS = "customer_id, category_id, unit_price, quantity, discount, amount, payment_method_id, invoice_date, region_id"


def _addr_for(mult: int) -> str:
    return f"CAST((c.customer_id * {mult}) % na.n + 1 AS INTEGER)"


def _scd2_history() -> str:
    seed, m1, m2, m3 = ADDRESS_MULTIPLIERS
    events = " UNION ALL ".join(
        f"SELECT c.customer_id, {k} AS k, {_addr_for(m)} AS address_id, DATE '{AS_OF}' + {k * SCD2_STEP_DAYS} AS d "
        f"FROM cust_lk c, n_addr na"
        for k, m in enumerate((seed, m1, m2, m3))
    )
    return f"""
, ev AS ({events}),
ch AS (SELECT *, lag(address_id) OVER (PARTITION BY customer_id ORDER BY k) AS prev FROM ev),
ver AS (SELECT customer_id, address_id, d AS start_date FROM ch WHERE prev IS NULL OR prev <> address_id)
SELECT customer_id, address_id, start_date,
       CAST(lead(start_date) OVER (PARTITION BY customer_id ORDER BY start_date) - 1 AS DATE) AS end_date,
       lead(start_date) OVER (PARTITION BY customer_id ORDER BY start_date) IS NULL AS is_current
FROM ver
"""


def _scd2_moves() -> str:
    """Seed, moves after one and three steps, and for even customers a move after two steps."""
    events = " UNION ALL ".join(
        f"SELECT c.customer_id, {_addr_for(m)} AS address_id, DATE '{AS_OF}' + {k * SCD2_STEP_DAYS} AS d FROM cust_lk c, n_addr na"
        + (" WHERE c.customer_id % 2 = 0" if k == 2 else "")
        for m, k in zip(MOVE_MULTIPLIERS, (0, 1, 3, 2), strict=True)
    )
    return f"""
, ev AS ({events}),
ch AS (SELECT *, lag(address_id) OVER (PARTITION BY customer_id ORDER BY d) AS prev FROM ev),
ver AS (SELECT customer_id, address_id, d AS start_date FROM ch WHERE prev IS NULL OR prev <> address_id)
SELECT customer_id, address_id, start_date,
       CAST(lead(start_date) OVER (PARTITION BY customer_id ORDER BY start_date) - 1 AS DATE) AS end_date,
       lead(start_date) OVER (PARTITION BY customer_id ORDER BY start_date) IS NULL AS is_current
FROM ver
"""


def _cum_yearly(keys: list[str], sums: dict[str, str], names_join: str, name_cols: str, where: str = "") -> str:
    """Closed form of a yearly cumulative table: every key from its first year to the last year."""
    k = ", ".join(keys)
    sum_defs = ", ".join(f"SUM({src}) AS {out}" for out, src in sums.items())
    run_defs = ", ".join(
        f"SUM(a.{out}) OVER (PARTITION BY {', '.join('sp.' + x for x in keys)} ORDER BY sp.current_year "
        f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {out}"
        for out in sums
    )
    on = " AND ".join(f"a.{x} = sp.{x}" for x in keys)
    return f"""
, agg AS (SELECT {k}, CAST(year(invoice_date) AS INTEGER) AS y, {sum_defs} FROM sd GROUP BY ALL),
fst AS (SELECT {k}, MIN(y) AS fy FROM agg GROUP BY ALL),
sp AS (SELECT {', '.join('f.' + x for x in keys)}, CAST(g.y AS INTEGER) AS current_year
       FROM fst f, max_year m, LATERAL range(f.fy, m.y + 1) g(y)),
run AS (SELECT {', '.join('sp.' + x for x in keys)}, sp.current_year, {run_defs}
        FROM sp LEFT JOIN agg a ON {on} AND a.y = sp.current_year)
SELECT {name_cols} FROM run {names_join} {where}
"""


def _transitions(keys: list[str], where: str = "") -> str:
    """States of every key from its first year to the last one, from the years that it has sales in."""
    k = ", ".join(keys)
    on = lambda a, y: " AND ".join(f"{a}.{x} = sp.{x}" for x in keys) + f" AND {a}.y = {y}"
    return f"""
, act AS (SELECT DISTINCT {k}, CAST(year(invoice_date) AS INTEGER) AS y FROM sd),
fst AS (SELECT {k}, MIN(y) AS fy FROM act GROUP BY ALL),
sp AS (SELECT {k}, fy, CAST(g.y AS INTEGER) AS current_year FROM fst f, max_year m, LATERAL range(f.fy, m.y + 1) g(y))
SELECT {', '.join('sp.' + x for x in keys)}, current_year,
  CASE WHEN current_year = fy THEN 'New' WHEN a.y IS NOT NULL AND p.y IS NOT NULL THEN 'Retained' WHEN a.y IS NOT NULL THEN 'Resurrected'
    WHEN p.y IS NOT NULL THEN 'Churned' ELSE 'Stale' END AS transition_state
FROM sp LEFT JOIN act a ON {on("a", "current_year")} LEFT JOIN act p ON {on("p", "current_year - 1")} {where}
"""


def _trend(keys: list[str], measures: dict[str, tuple[str, str]], names_join: str, name_cols: str) -> str:
    """``measures``: output -> (column, type). Gains per year from the sales, zero in a year without; growth in percent."""
    k = ", ".join(keys)
    w = f"(PARTITION BY {', '.join('sp.' + x for x in keys)} ORDER BY current_year)"
    sums = ", ".join(f"CAST(SUM({src}) AS {t}) AS {out}" for out, (src, t) in measures.items())
    gains = ", ".join(f"CAST(coalesce(a.{out}, 0) AS {t}) AS {out}" for out, (_, t) in measures.items())
    lags = ", ".join(f"lag(coalesce(a.{out}, 0)) OVER {w} AS {out}_p" for out in measures)
    cents = {out: 100 if t.startswith("DECIMAL") else 1 for out, (_, t) in measures.items()}
    growth = ", ".join(
        f"{out} AS {out}_gain, CASE WHEN {out}_p > 0 THEN CAST((CASE WHEN {out} < {out}_p THEN -1 ELSE 1 END * "
        f"((2 * 10000 * abs(CAST(({out} - {out}_p) * {c} AS HUGEINT)) + CAST({out}_p * {c} AS HUGEINT)) // (2 * CAST({out}_p * {c} AS HUGEINT)))) "
        f"AS DECIMAL(38,0)) * 0.01 END::DECIMAL(20,2) AS {out}_growth"
        for out, c in cents.items()
    )
    on = " AND ".join(f"a.{x} = sp.{x}" for x in keys)
    return f"""
, agg AS (SELECT {k}, CAST(year(invoice_date) AS INTEGER) AS y, {sums} FROM sd GROUP BY ALL),
fst AS (SELECT {k}, MIN(y) AS fy FROM agg GROUP BY ALL),
sp AS (SELECT {k}, CAST(g.y AS INTEGER) AS current_year FROM fst f, max_year m, LATERAL range(f.fy, m.y + 1) g(y)),
gain AS (SELECT {', '.join('sp.' + x for x in keys)}, current_year, {gains}, {lags} FROM sp LEFT JOIN agg a ON {on} AND a.y = current_year)
SELECT {name_cols}, current_year, {growth} FROM gain {names_join}
"""


def _lines(source: str, plain: str, case: str, faults: dict[int, tuple[str, list[str]]]) -> str:
    """Rejected lines: per faulty case its lines (one text split at line breaks) with their reason; feed = case % 3."""
    parts = " UNION ALL ".join(
        f"SELECT CAST(({case}) % 3 AS INTEGER) AS feed, unnest(string_split({text}, chr(10))) AS raw_line, '{reason}' AS reject_reason "
        f"FROM {source} WHERE ({case}) % 97 = {n}"
        for n, (text, reason) in faults.items()
    )
    return parts


def queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["retail_sales"] = _with(
        "SELECT transaction_id, \"timestamp\", customer_id, product_id, product_category, quantity, price, discount, "
        "payment_method, customer_age, customer_gender, customer_location, total_amount FROM rs"
    )
    q["staging_csv_roundtrip"] = q["retail_sales"]
    q["customer_names_csv"] = "SELECT c_name AS customer_name FROM customer"
    q["customer_address_csv"] = _with("SELECT street_number, city, zip_code FROM parsed_addr")
    q["payment_method_lookup"] = _with("SELECT method_id, payment_method, is_active FROM pm_lk")
    q["region_lookup"] = _with("SELECT region_id, region_name FROM rg_lk")
    q["product_category_lookup"] = _with("SELECT category_id, category FROM pc_lk")
    q["parsed_addresses"] = _with("SELECT street_number, city, zip_code FROM parsed_addr")
    q["address_table"] = _with("SELECT address_id, street_number, city, zip_code FROM addr")
    q["address_count"] = _with("SELECT COUNT(*) AS address_count FROM addr")
    q["customer_table"] = _with(
        "SELECT customer_id, customer_no, CAST(NULL AS VARCHAR) AS first_name, CAST(NULL AS VARCHAR) AS last_name, "
        "gender, CAST(NULL AS VARCHAR) AS email, CAST(NULL AS DATE) AS date_of_birth, "
        "CAST(NULL AS VARCHAR) AS phone_number FROM cust_lk"
    )
    q["sales_details"] = _with(f"SELECT {SALES_DETAIL_COLS} FROM sd")
    q["rejected_sales"] = _with(
        f"SELECT {SALES_DETAIL_COLS} FROM sd_all WHERE NOT (customer_id IS NOT NULL AND category_id IS NOT NULL "
        "AND quantity IS NOT NULL AND amount IS NOT NULL AND payment_method_id IS NOT NULL AND invoice_date IS NOT NULL "
        "AND region_id IS NOT NULL AND quantity > 0)"
    )
    seed = ADDRESS_MULTIPLIERS[0]
    q["seed_customer_address"] = _with(
        f"SELECT c.customer_id, {_addr_for(seed)} AS address_id, DATE '{AS_OF}' AS start_date, "
        "CAST(NULL AS DATE) AS end_date, TRUE AS is_current FROM cust_lk c, n_addr na"
    )
    q["customer_address_history"] = _with(_scd2_history())
    q["customer_address_moves"] = _with(_scd2_moves())
    # E1
    for col in ("customer_location", "product_category", "customer_gender", "payment_method"):
        q[f"distinct_{col}"] = _with(f"SELECT DISTINCT {col} FROM rs")
    # E2
    q["numeric_profile"] = _with(
        "SELECT MIN(quantity) AS min_quantity, MAX(quantity) AS max_quantity, "
        f"{_avg4('SUM(quantity)', 'COUNT(quantity)', 0)} AS avg_quantity, "
        "MIN(price) AS min_price, MAX(price) AS max_price, "
        f"{_avg4('SUM(price)', 'COUNT(price)', 2)} AS avg_price, "
        "MIN(total_amount) AS min_total_amount, MAX(total_amount) AS max_total_amount, "
        f"{_avg4('SUM(total_amount)', 'COUNT(total_amount)', 2)} AS avg_total_amount FROM rs"
    )
    q["customer_preview"] = _with(
        "SELECT customer_id, customer_no, CAST(NULL AS VARCHAR) AS first_name, CAST(NULL AS VARCHAR) AS last_name, "
        "gender, CAST(NULL AS VARCHAR) AS email, CAST(NULL AS DATE) AS date_of_birth, "
        "CAST(NULL AS VARCHAR) AS phone_number FROM cust_lk ORDER BY customer_id LIMIT 100"
    )
    q["retail_sales_preview"] = _with(
        "SELECT transaction_id, \"timestamp\", customer_id, product_id, product_category, quantity, price, discount, "
        "payment_method, customer_age, customer_gender, customer_location, total_amount FROM rs "
        "ORDER BY transaction_id, \"timestamp\", customer_id, product_id, product_category, quantity, price, discount, "
        "payment_method, customer_age, customer_gender, customer_location, total_amount LIMIT 100"
    )
    q["sales_count_by_customer"] = _with("SELECT customer_id, COUNT(customer_id) AS num_recs FROM sd GROUP BY customer_id")
    q["sales_by_region"] = _with(
        "SELECT r.region_name, CAST(ROUND(SUM(s.amount), 2) AS DECIMAL(28,2)) AS total_amount "
        "FROM sd s LEFT JOIN rg_lk r ON s.region_id = r.region_id GROUP BY r.region_name"
    )
    q["invoice_date_range"] = _with(
        "SELECT MIN(invoice_date) AS first_invoice_date, MAX(invoice_date) AS last_invoice_date FROM sd"
    )
    q["sales_on_date"] = _with(f"SELECT {SALES_DETAIL_COLS} FROM sd WHERE invoice_date = DATE '{SALES_DAY}'")
    # K4-K7
    q["duplicate_transaction_ids"] = _with(
        "SELECT transaction_id, COUNT(*) AS row_count, "
        "CASE WHEN transaction_id IS NULL THEN 'null_key' ELSE 'duplicate_key' END AS violation "
        "FROM rs GROUP BY transaction_id HAVING COUNT(*) > 1 OR transaction_id IS NULL"
    )
    q["quality_report"] = _with(
        """
SELECT check_name, CAST(violations AS BIGINT) AS violations FROM (
  SELECT 'pk:customer(customer_id)' AS check_name,
         (SELECT COUNT(*) FROM (SELECT customer_id FROM cust_lk GROUP BY 1 HAVING COUNT(*) > 1 OR customer_id IS NULL)) AS violations
  UNION ALL SELECT 'pk:retail_sales(transaction_id)',
         (SELECT COUNT(*) FROM (SELECT transaction_id FROM rs GROUP BY 1 HAVING COUNT(*) > 1 OR transaction_id IS NULL))
  UNION ALL SELECT 'fk:sales_details(customer_id)->customer',
         (SELECT COUNT(*) FROM sd WHERE customer_id IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM cust_lk))
  UNION ALL SELECT 'fk:sales_details(category_id)->product_category',
         (SELECT COUNT(*) FROM sd WHERE category_id IS NOT NULL AND category_id NOT IN (SELECT category_id FROM pc_lk))
  UNION ALL SELECT 'fk:sales_details(payment_method_id)->payment_method',
         (SELECT COUNT(*) FROM sd WHERE payment_method_id IS NOT NULL AND payment_method_id NOT IN (SELECT method_id FROM pm_lk))
  UNION ALL SELECT 'fk:sales_details(region_id)->region',
         (SELECT COUNT(*) FROM sd WHERE region_id IS NOT NULL AND region_id NOT IN (SELECT region_id FROM rg_lk))
  UNION ALL SELECT 'check:sales_details(quantity>0)', (SELECT COUNT(*) FROM sd WHERE quantity <= 0)
  UNION ALL SELECT 'not_null:sales_details', (SELECT COUNT(*) FROM sd WHERE customer_id IS NULL OR category_id IS NULL
         OR quantity IS NULL OR amount IS NULL OR payment_method_id IS NULL OR invoice_date IS NULL OR region_id IS NULL)
  UNION ALL SELECT 'not_null:payment_method', (SELECT COUNT(*) FROM pm_lk WHERE payment_method IS NULL)
  UNION ALL SELECT 'dup:customer(customer_no)',
         (SELECT COUNT(*) FROM (SELECT customer_no FROM cust_lk WHERE customer_no IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1))
)"""
    )
    # star
    q["dim_date"] = _with(
        "SELECT date_key, full_date, year, quarter, quarter_name, month, month_name, day_of_month, day_of_week, "
        "day_name, is_holiday FROM dd"
    )
    q["dim_customer"] = _with("SELECT customer_key, customer_no, first_name, last_name, gender, email FROM dcu")
    q["dim_product_category"] = _with("SELECT category_key, product_category FROM dpc")
    q["dim_region"] = _with("SELECT region_key, region FROM drg")
    q["dim_payment_method"] = _with("SELECT payment_method_key, payment_method FROM dpm")
    q["fact_sales"] = _with(
        "SELECT date_key, customer_key, product_category_key, product_quantity, sale_amount, sale_discount, "
        "region_key, payment_method_key FROM fs"
    )
    # questions
    q["avg_quarterly_revenue"] = _with(
        f"SELECT d.year, d.quarter_name, r.region, c.product_category, {_avg2('SUM(f.sale_amount)', 'COUNT(f.sale_amount)')} AS avg_sales "
        "FROM fs f JOIN drg r ON f.region_key = r.region_key JOIN dpc c ON f.product_category_key = c.category_key "
        "JOIN dd d ON f.date_key = d.date_key GROUP BY d.year, d.quarter_name, r.region, c.product_category"
    )
    q["avg_of_quarter_totals"] = _with(
        ", qt AS (SELECT r.region, c.product_category, d.year, d.quarter, SUM(f.sale_amount) AS total "
        "FROM fs f JOIN drg r ON f.region_key = r.region_key JOIN dpc c ON f.product_category_key = c.category_key "
        "JOIN dd d ON f.date_key = d.date_key GROUP BY ALL) "
        f"SELECT region, product_category, COUNT(*) AS quarters, {_avg2('SUM(total)', 'COUNT(*)')} AS avg_quarterly_revenue "
        "FROM qt GROUP BY region, product_category"
    )
    q["payment_mix_by_region"] = _with(
        ", pm AS (SELECT r.region, m.payment_method, COUNT(*) AS n_sales, CAST(SUM(f.sale_amount) AS DECIMAL(18,2)) AS revenue "
        "FROM fs f JOIN drg r ON f.region_key = r.region_key JOIN dpm m ON f.payment_method_key = m.payment_method_key GROUP BY ALL) "
        "SELECT region, payment_method, n_sales, revenue, "
        "CAST(CAST(((2 * CAST(revenue * 100 AS HUGEINT) * 10000 + CAST(SUM(revenue) OVER (PARTITION BY region) * 100 AS HUGEINT)) "
        "// (2 * CAST(SUM(revenue) OVER (PARTITION BY region) * 100 AS HUGEINT))) AS DECIMAL(38,0)) * 0.0001 AS DECIMAL(9,4)) "
        "AS revenue_share FROM pm"
    )
    q["christmas_sales_by_payment_method"] = _with(
        "SELECT r.region_name, s.invoice_date AS christmas_day, "
        + ", ".join(
            f"CAST(SUM(CASE WHEN s.payment_method_id = {k} THEN s.amount ELSE 0 END) AS DECIMAL(18,2)) AS {name}"
            for name, k in (("credit_card", 1), ("debit_card", 2), ("gift_card", 3), ("paypal", 4))
        )
        + " FROM sd s LEFT JOIN rg_lk r ON s.region_id = r.region_id "
        "WHERE CAST(s.invoice_date AS VARCHAR) LIKE '%-12-25' GROUP BY r.region_name, s.invoice_date"
    )
    q["discount_prices"] = _with(
        "SELECT unit_price, discount, CAST(ROUND(unit_price - unit_price * discount, 2) AS DECIMAL(10,2)) AS discount_price FROM sd"
    )
    # cumulative tables (closed forms)
    q["cum_product_sales"] = _with(
        """
, agg AS (SELECT category_id, invoice_date AS d, SUM(quantity) AS q, SUM(amount) AS s FROM sd GROUP BY ALL),
fst AS (SELECT category_id, MIN(d) AS fd FROM agg GROUP BY ALL),
sp AS (SELECT f.category_id, CAST(g.d AS DATE) AS present_date
       FROM fst f, LATERAL generate_series(CAST(f.fd AS TIMESTAMP), CAST((SELECT MAX(invoice_date) FROM sd) AS TIMESTAMP), INTERVAL 1 DAY) g(d)),
run AS (SELECT sp.category_id, sp.present_date,
               SUM(a.q) OVER (PARTITION BY sp.category_id ORDER BY sp.present_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS q,
               SUM(a.s) OVER (PARTITION BY sp.category_id ORDER BY sp.present_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s
        FROM sp LEFT JOIN agg a ON a.category_id = sp.category_id AND a.d = sp.present_date)
SELECT run.category_id, pc.category AS product_category, CAST(q AS BIGINT) AS cumulative_quantity,
       CAST(s AS DECIMAL(18,2)) AS cumulative_sales, present_date
FROM run LEFT JOIN pc_lk pc ON run.category_id = pc.category_id
"""
    )
    q["cum_region_product_sales"] = _with(
        _cum_yearly(
            ["region_id", "category_id"],
            {"s": "amount"},
            "LEFT JOIN rg_lk r ON run.region_id = r.region_id LEFT JOIN pc_lk pc ON run.category_id = pc.category_id",
            "run.region_id, r.region_name AS region, run.category_id, pc.category AS product_category, "
            "CAST(s AS DECIMAL(18,2)) AS cumulative_sales, current_year",
        )
    )
    q["cum_customer_product_engage"] = _with(
        _cum_yearly(
            ["customer_id", "category_id"],
            {"q": "quantity", "s": "amount"},
            "LEFT JOIN pc_lk pc ON run.category_id = pc.category_id",
            "run.customer_id, run.category_id, pc.category AS product_category, CAST(q AS BIGINT) AS cum_purchase_count, "
            "CAST(s AS DECIMAL(18,2)) AS cumulative_sales, current_year",
        )
    )
    q["cum_customer_revenue"] = _with(
        _cum_yearly(
            ["customer_id"], {"s": "amount"}, "", "customer_id, CAST(s AS DECIMAL(18,2)) AS cum_amount_spent, current_year"
        )
    )
    q["cum_customer_revenue_step"] = _with(
        _cum_yearly(
            ["customer_id"],
            {"s": "amount"},
            "",
            "customer_id, CAST(s AS DECIMAL(18,2)) AS cum_amount_spent, current_year",
            where="WHERE current_year = (SELECT y FROM max_year)",
        )
    )
    for name in ("cum_region_product_sales", "cum_customer_product_engage"):
        q[f"{name}_chain"] = q[name]
    revenue = q["cum_customer_revenue"]
    q["cum_customer_revenue_stored"] = (
        f"SELECT * FROM ({revenue}) WHERE current_year = (SELECT max(current_year) FROM ({revenue}))"
    )
    q["cum_customer_revenue_chain"] = q["cum_customer_revenue"]
    q["cum_customer_product_engage_as_of"] = _with(
        _cum_yearly(
            ["customer_id", "category_id"],
            {"q": "quantity", "s": "amount"},
            "LEFT JOIN pc_lk pc ON run.category_id = pc.category_id",
            "run.customer_id, run.category_id, pc.category AS product_category, CAST(q AS BIGINT) AS cum_purchase_count, "
            "CAST(s AS DECIMAL(18,2)) AS cumulative_sales, current_year",
            where="WHERE current_year = (SELECT y FROM max_year)",
        )
    )
    q["cum_customer_sales_exploded"] = _with(
        "SELECT sp.customer_id, c.customer_no, sp.current_year, "
        "CAST(row_number() OVER (PARTITION BY sp.customer_id, sp.current_year ORDER BY s.y) - 1 AS INTEGER) AS pos, "
        "s.y AS sales_year, CAST(s.disc AS FLOAT) AS total_discount, CAST(s.amt AS FLOAT) AS total_amount_spent, "
        "CAST(s.qty AS BIGINT) AS total_qty_purchased "
        "FROM cy_spine sp JOIN cy_stats s ON s.customer_id = sp.customer_id AND s.y <= sp.current_year "
        "JOIN cust_lk c ON c.customer_id = sp.customer_id"
    )
    q["cum_region_sales_for_category"] = q["cum_region_product_sales"].rstrip() + f"\nWHERE pc.category = '{LOOKUP_CATEGORY}'"
    q["cum_customer_sales_flat"] = _with(
        "SELECT c.customer_no, s.y AS sales_year, CAST(s.disc AS FLOAT) AS total_discount, "
        "CAST(s.amt AS FLOAT) AS total_amount_spent, CAST(s.qty AS BIGINT) AS total_qty_purchased "
        "FROM cy_stats s JOIN cust_lk c ON s.customer_id = c.customer_id"
    )
    q["customer_transitions"] = _with(
        """
SELECT sp.customer_id, sp.current_year,
       CASE WHEN sp.current_year = f.fy THEN 'New'
            WHEN a.y IS NOT NULL AND p.y IS NOT NULL THEN 'Retained'
            WHEN a.y IS NOT NULL THEN 'Resurrected'
            WHEN p.y IS NOT NULL THEN 'Churned'
            ELSE 'Stale' END AS transition_state
FROM cy_spine sp JOIN cy_first f ON sp.customer_id = f.customer_id
LEFT JOIN cy_stats a ON a.customer_id = sp.customer_id AND a.y = sp.current_year
LEFT JOIN cy_stats p ON p.customer_id = sp.customer_id AND p.y = sp.current_year - 1
"""
    )
    # ingestion
    sub = (
        ", sub AS (SELECT customer_id, category_id, quantity, discount, "
        "CASE WHEN l_returnflag = 'R' THEN unit_price ELSE CAST(ROUND(unit_price - unit_price * discount, 2) AS DECIMAL(10,2)) END AS amount, "
        "payment_method_id, region_id, unit_price FROM sd), "
        "chk AS (SELECT *, CASE "
        "WHEN amount <> CAST(ROUND(unit_price - unit_price * discount, 2) AS DECIMAL(10,2)) THEN 'amount_mismatch' "
        "WHEN customer_id IS NULL THEN 'not_null:customer_id' WHEN category_id IS NULL THEN 'not_null:category_id' "
        "WHEN quantity IS NULL THEN 'not_null:quantity' WHEN amount IS NULL THEN 'not_null:amount' "
        "WHEN payment_method_id IS NULL THEN 'not_null:payment_method_id' WHEN region_id IS NULL THEN 'not_null:region_id' "
        "WHEN quantity <= 0 THEN 'check:quantity>0' "
        "WHEN customer_id NOT IN (SELECT customer_id FROM cust_lk) THEN 'fk:customer_id' "
        "WHEN category_id NOT IN (SELECT category_id FROM pc_lk) THEN 'fk:category_id' "
        "WHEN payment_method_id NOT IN (SELECT method_id FROM pm_lk) THEN 'fk:payment_method_id' "
        "WHEN region_id NOT IN (SELECT region_id FROM rg_lk) THEN 'fk:region_id' END AS reject_reason FROM sub) "
    )
    accepted = (
        sub
        + "SELECT customer_id, category_id, unit_price, quantity, discount, amount, payment_method_id, "
        f"DATE '{AS_OF}' AS invoice_date, region_id FROM chk WHERE reject_reason IS NULL"
    )
    q["ingest_accepted"] = _with(accepted)
    q["stream_ingest"] = _with(accepted)
    q["stream_sales_ids"] = (
        f"SELECT a.n + b.n AS n_rows, a.n + b.n AS n_ids FROM (SELECT count(*) AS n FROM ({_with(accepted)})) a, "
        f"(SELECT count(*) AS n FROM ({q['sales_details']})) b"
    )
    q["ingest_rejected"] = _with(
        sub
        + "SELECT customer_id, category_id, quantity, discount, amount, payment_method_id, region_id, unit_price, "
        "reject_reason FROM chk WHERE reject_reason IS NOT NULL"
    )
    # the same checks on inputs with faults: every 97th case of a row's values misses or breaks one column
    q["quarantined_sales"] = _with(
        """
, bad AS (
  SELECT CASE WHEN transaction_id % 97 <> 0 THEN customer_id END AS customer_id,
         CASE WHEN transaction_id % 97 = 1 THEN 'no such category' ELSE product_category END AS product_category,
         CASE WHEN transaction_id % 97 = 2 THEN NULL WHEN transaction_id % 97 = 7 THEN 0 ELSE quantity END AS quantity,
         CASE WHEN transaction_id % 97 <> 3 THEN total_amount END AS amount,
         CASE WHEN transaction_id % 97 = 4 THEN 'no such method' ELSE payment_method END AS payment_method,
         CASE WHEN transaction_id % 97 = 5 THEN 'no date' ELSE "timestamp" END AS "timestamp",
         CASE WHEN transaction_id % 97 <> 6 THEN customer_location END AS customer_location, price, discount
  FROM rs),
bad_sd AS (
  SELECT cu.customer_id, pc.category_id, bad.price AS unit_price, bad.quantity, bad.discount, bad.amount,
         pm.method_id AS payment_method_id, TRY_CAST(TRY_CAST(bad."timestamp" AS TIMESTAMP) AS DATE) AS invoice_date, rg.region_id
  FROM bad
  LEFT JOIN cust_lk cu ON concat('C-', CAST(bad.customer_id AS VARCHAR)) = cu.customer_no
  LEFT JOIN pc_lk pc ON bad.product_category = pc.category
  LEFT JOIN pm_lk pm ON bad.payment_method = pm.payment_method
  LEFT JOIN rg_lk rg ON bad.customer_location = rg.region_name)
SELECT * FROM (
  SELECT *, CASE WHEN customer_id IS NULL THEN 'not_null:customer_id' WHEN category_id IS NULL THEN 'not_null:category_id'
    WHEN quantity IS NULL THEN 'not_null:quantity' WHEN amount IS NULL THEN 'not_null:amount'
    WHEN payment_method_id IS NULL THEN 'not_null:payment_method_id' WHEN invoice_date IS NULL THEN 'not_null:invoice_date'
    WHEN region_id IS NULL THEN 'not_null:region_id' WHEN quantity <= 0 THEN 'check:quantity>0' END AS reject_reason
  FROM bad_sd)
WHERE reject_reason IS NOT NULL"""
    )
    pick, check = sub.split(", chk AS ")
    bad_sub = pick + """
, n_sub AS (SELECT *, (CAST(customer_id AS BIGINT) * 31 + category_id * 7 + quantity) % 97 AS n FROM sub),
bad_sub AS (
  SELECT CASE n WHEN 0 THEN NULL WHEN 7 THEN -customer_id ELSE customer_id END AS customer_id,
         CASE n WHEN 1 THEN NULL WHEN 8 THEN -category_id ELSE category_id END AS category_id,
         CASE n WHEN 2 THEN NULL WHEN 6 THEN 0 ELSE quantity END AS quantity, discount,
         CASE WHEN n <> 3 THEN amount END AS amount,
         CASE n WHEN 4 THEN NULL WHEN 9 THEN -payment_method_id ELSE payment_method_id END AS payment_method_id,
         CASE n WHEN 5 THEN NULL WHEN 10 THEN -region_id ELSE region_id END AS region_id, unit_price
  FROM n_sub)"""
    q["ingest_rejected_reasons"] = _with(
        bad_sub + ", chk AS " + check.replace("FROM sub)", "FROM bad_sub)")
        + "SELECT customer_id, category_id, quantity, discount, amount, payment_method_id, region_id, unit_price, "
        "reject_reason FROM chk WHERE reject_reason IS NOT NULL"
    )
    q["submission_quality_report"] = _with(
        bad_sub + """
SELECT check_name, CAST(violations AS BIGINT) AS violations FROM (
  SELECT 'not_null:submissions' AS check_name, (SELECT COUNT(*) FROM bad_sub WHERE customer_id IS NULL OR category_id IS NULL
         OR quantity IS NULL OR amount IS NULL OR payment_method_id IS NULL OR region_id IS NULL) AS violations
  UNION ALL SELECT 'check:submissions(quantity>0)', (SELECT COUNT(*) FROM bad_sub WHERE quantity <= 0)
  UNION ALL SELECT 'fk:submissions(customer_id)', (SELECT COUNT(*) FROM bad_sub WHERE customer_id NOT IN (SELECT customer_id FROM cust_lk))
  UNION ALL SELECT 'fk:submissions(category_id)', (SELECT COUNT(*) FROM bad_sub WHERE category_id NOT IN (SELECT category_id FROM pc_lk))
  UNION ALL SELECT 'fk:submissions(payment_method_id)', (SELECT COUNT(*) FROM bad_sub WHERE payment_method_id NOT IN (SELECT method_id FROM pm_lk))
  UNION ALL SELECT 'fk:submissions(region_id)', (SELECT COUNT(*) FROM bad_sub WHERE region_id NOT IN (SELECT region_id FROM rg_lk))
)"""
    )
    q["load_missing_dates"] = _with(
        f", old AS (SELECT * FROM dd WHERE full_date < DATE '{DIM_DATE_CUTOFF}'), "
        "new_d AS (SELECT DISTINCT invoice_date AS full_date FROM sd WHERE invoice_date NOT IN (SELECT full_date FROM old)) "
        "SELECT CAST((SELECT MAX(date_key) FROM old) + row_number() OVER (ORDER BY full_date) AS INTEGER) AS date_key, "
        "full_date, CAST(year(full_date) AS INTEGER) AS year, CAST(quarter(full_date) AS INTEGER) AS quarter, "
        "CASE quarter(full_date) WHEN 1 THEN 'First' WHEN 2 THEN 'Second' WHEN 3 THEN 'Third' ELSE 'Fourth' END AS quarter_name, "
        "CAST(month(full_date) AS INTEGER) AS month, rpad(monthname(full_date), 9, ' ') AS month_name, "
        "CAST(day(full_date) AS INTEGER) AS day_of_month, CAST(isodow(full_date) AS INTEGER) AS day_of_week, "
        "rpad(dayname(full_date), 9, ' ') AS day_name, FALSE AS is_holiday FROM new_d"
    )
    q["cum_customer_sales_chain"] = q["cum_customer_sales_exploded"]
    # nested outputs in full, as canonical text
    struct_text = (
        "'{sales_year=' || s.y || ',total_discount=' || CAST(floor(CAST(CAST(s.disc AS FLOAT) AS DOUBLE) * 1000000 + 0.5) AS BIGINT) "
        "|| 'u,total_amount_spent=' || CAST(floor(CAST(CAST(s.amt AS FLOAT) AS DOUBLE) * 1000000 + 0.5) AS BIGINT) || 'u,total_qty_purchased=' || s.qty || '}'"
    )
    q["cum_customer_sales"] = _with(
        ", st AS (SELECT sp.customer_id, sp.current_year, s.y, " + struct_text + " AS t, "
        "row_number() OVER (PARTITION BY sp.customer_id, sp.current_year ORDER BY s.y) - 1 AS pos "
        "FROM cy_spine sp JOIN cy_stats s ON s.customer_id = sp.customer_id AND s.y <= sp.current_year) "
        "SELECT st.customer_id, c.customer_no, '[' || string_agg(pos || ':' || t, ',' ORDER BY pos) || ']' AS sales_stats, current_year "
        "FROM st JOIN cust_lk c ON c.customer_id = st.customer_id GROUP BY st.customer_id, c.customer_no, current_year"
    )
    q["cum_customer_sales_unnested"] = _with(
        f"SELECT s.customer_id, c.customer_no, {struct_text} AS sales_stats FROM cy_stats s JOIN cust_lk c ON s.customer_id = c.customer_id"
    )
    # C10 from running totals, trends, segments
    q["region_category_transitions"] = _with(_transitions(["region_id", "category_id"]))
    q["customer_category_transitions"] = _with(_transitions(["customer_id", "category_id"]))
    q["customer_revenue_transitions"] = _with(_transitions(["customer_id"], "WHERE current_year = (SELECT y FROM max_year)"))
    q["region_category_trend"] = _with(
        _trend(
            ["region_id", "category_id"], {"cumulative_sales": ("amount", "DECIMAL(18,2)")},
            "LEFT JOIN rg_lk r ON gain.region_id = r.region_id LEFT JOIN pc_lk pc ON gain.category_id = pc.category_id",
            "gain.region_id, r.region_name AS region, gain.category_id, pc.category AS product_category",
        )
    )
    q["customer_category_trend"] = _with(
        _trend(
            ["customer_id", "category_id"],
            {"cum_purchase_count": ("quantity", "BIGINT"), "cumulative_sales": ("amount", "DECIMAL(18,2)")},
            "", "customer_id, category_id",
        )
    )
    q["customer_segments"] = _with(
        """
, pr AS (
  SELECT customer_id, CAST(max(year(invoice_date)) AS INTEGER) AS last_year, CAST(count(DISTINCT year(invoice_date)) AS INTEGER) AS active_years,
    CAST(sum(quantity) AS BIGINT) AS quantity, CAST(sum(amount) AS DECIMAL(18,2)) AS cum_amount_spent FROM sd GROUP BY customer_id),
b AS (
  SELECT *, CAST(ntile(5) OVER (ORDER BY last_year, customer_id) AS INTEGER) AS recency_band,
    CAST(ntile(5) OVER (ORDER BY quantity, customer_id) AS INTEGER) AS frequency_band,
    CAST(ntile(5) OVER (ORDER BY cum_amount_spent, customer_id) AS INTEGER) AS value_band FROM pr),
m AS (SELECT *, (frequency_band + value_band) / 2.0 AS x FROM b)
SELECT * EXCLUDE (x), CASE WHEN recency_band = 5 AND x >= 4 THEN 'Champions' WHEN recency_band >= 4 AND x >= 3 THEN 'Loyal'
  WHEN recency_band <= 2 AND x >= 3 THEN 'At Risk' WHEN recency_band >= 4 THEN 'Recent' WHEN recency_band <= 2 AND x < 3 THEN 'Lost'
  ELSE 'Regular' END AS segment FROM m
"""
    )
    # rejected lines of faulty feeds
    cols = ["transaction_id", "timestamp", "customer_id", "product_id", "product_category", "quantity", "price", "discount",
            "payment_method", "customer_age", "customer_gender", "customer_location", "total_amount"]

    def line(names=tuple(cols), **changed) -> str:
        return "concat_ws(',', " + ", ".join(changed.get(c, f"coalesce(CAST(\"{c}\" AS VARCHAR), '')") for c in names) + ")"

    q["sales_csv_quarantine"] = _with(_lines("rs", line(), "transaction_id", {
        0: (line(cols[:-1]), "columns:12"),
        1: (line() + " || ',one more'", "columns:14"),
        2: (line(quantity="'many'"), "bad_value:quantity"),
        3: (line(price="'n/a'"), "bad_value:price"),
        4: (line(product_category="'\"' || product_category || chr(10) || 'broken\"'"), "open_quote"),
        5: (line(total_amount="'99999999999.99'"), "bad_value:total_amount"),
    }))
    number = "CAST(regexp_extract({}, '([0-9]+){}', 1) AS BIGINT)"
    q["customer_names_csv_quarantine"] = _lines("customer", "c_name", number.format("c_name", "$"), {
        0: ("c_name || ', Jr'", "columns:2"), 1: ("'\"' || c_name || chr(10) || 'Jr\"'", "open_quote"),
    })
    q["customer_address_csv_quarantine"] = _with(_lines("raw_addr", "customer_address", number.format("customer_address", ""), {
        0: ("customer_address", "columns:2"),
        1: ("'\"' || replace(customer_address, '\\n', chr(10)) || '\"'", "open_quote"),
    }))
    # J9 with its NULL rules: dates not in a date dimension that is partly loaded, holds a NULL, or is empty
    q["dates_not_in"] = _with(
        f", l AS (SELECT DISTINCT invoice_date AS d FROM sd UNION ALL SELECT NULL), old AS (SELECT full_date FROM dd WHERE full_date < DATE '{DIM_DATE_CUTOFF}') "
        "SELECT 'part' AS known, d AS full_date FROM l WHERE d NOT IN (SELECT full_date FROM old) "
        "UNION ALL SELECT 'null', d FROM l WHERE d NOT IN (SELECT full_date FROM old UNION ALL SELECT NULL) "
        "UNION ALL SELECT 'none', d FROM l WHERE d NOT IN (SELECT full_date FROM old WHERE FALSE)"
    )
    # W6 by year: questions that read a part of the fact
    b1 = q["avg_quarterly_revenue"]
    q["avg_quarterly_revenue_of_year"] = b1.replace(" GROUP BY d.year", f" WHERE d.year = {QUESTION_YEAR} GROUP BY d.year")
    first, last = QUESTION_DAYS
    q["avg_quarterly_revenue_between"] = b1.replace(
        " GROUP BY d.year", f" WHERE d.full_date BETWEEN DATE '{first}' AND DATE '{last}' GROUP BY d.year"
    )
    q["customer_address_moves_stored"] = q["customer_address_moves"]
    # keyed upsert: the last row per key, then a batch of changes, moves to another year, inserts and deletions
    q["sales_upsert"] = _with(
        """
, base AS (
  SELECT transaction_id, "timestamp", customer_id, quantity, total_amount FROM rs WHERE transaction_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY "timestamp" DESC NULLS LAST, customer_id DESC NULLS LAST,
    quantity DESC NULLS LAST, total_amount DESC NULLS LAST) = 1),
moved AS (
  SELECT transaction_id, CASE WHEN transaction_id % 22 = 0 THEN CAST(CAST(substr("timestamp", 1, 4) AS INTEGER) + 1 AS VARCHAR) || substr("timestamp", 5)
    ELSE "timestamp" END AS "timestamp", customer_id, CASE WHEN transaction_id % 11 = 0 THEN quantity + 1 ELSE quantity END AS quantity, total_amount
  FROM base WHERE transaction_id % 55 <> 5
  UNION ALL SELECT -transaction_id, "timestamp", customer_id, quantity, total_amount FROM base WHERE transaction_id % 33 = 0)
SELECT *, CAST(substr("timestamp", 1, 4) AS INTEGER) AS sale_year FROM moved
"""
    )
    # I2 all or nothing: batches 0 and 2 hold good rows only; batch 1 has bad ones and is rolled back
    good = accepted[accepted.index("SELECT customer_id, category_id, unit_price, quantity, discount, amount, payment_method_id, DATE"):]
    q["ingest_all_or_nothing"] = _with(
        sub + f", ok AS ({good}) SELECT * REPLACE (CAST(invoice_date + CAST(customer_id % 3 AS INTEGER) AS DATE) AS invoice_date), "
        "CAST(customer_id % 3 AS BIGINT) AS batch_id, TRUE AS has_date FROM ok WHERE customer_id % 3 <> 1"
    )
    # late data: the whole history, whatever came late; the refresh starts at the first year that late sales touch
    late = f"(CAST(customer_id AS BIGINT) * 7 + quantity) % 13 = 0 AND year(invoice_date) >= {LATE_YEAR}"
    q["cum_customer_revenue_late"] = (
        f"SELECT *, current_year >= (SELECT min(y) FROM ({_with(f'SELECT year(invoice_date) AS y FROM sd WHERE {late}')})) AS refreshed "
        f"FROM ({revenue})"
    )
    q["cum_customer_sales_late"] = q["cum_customer_sales_exploded"]
    fed = ", fed AS (SELECT customer_id, invoice_date, amount FROM sd UNION ALL SELECT customer_id, invoice_date, amount FROM streamed)"
    streamed = f", streamed AS ({accepted[len(sub):].replace(AS_OF, FEED_DAY)})"
    q["cum_customer_revenue_streamed"] = _with(
        sub + streamed + fed + """
, agg AS (SELECT customer_id, CAST(year(invoice_date) AS INTEGER) AS y, SUM(amount) AS s FROM fed GROUP BY ALL),
fst AS (SELECT customer_id, MIN(y) AS fy FROM agg GROUP BY ALL),
sp AS (SELECT f.customer_id, CAST(g.y AS INTEGER) AS current_year FROM fst f, max_year m, LATERAL range(f.fy, m.y + 1) g(y))
SELECT sp.customer_id, CAST(SUM(a.s) OVER (PARTITION BY sp.customer_id ORDER BY sp.current_year) AS DECIMAL(18,2)) AS cum_amount_spent,
  sp.current_year
FROM sp LEFT JOIN agg a ON a.customer_id = sp.customer_id AND a.y = sp.current_year
"""
    )
    return q
