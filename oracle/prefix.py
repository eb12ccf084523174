"""Shared CTE prefix: test tables -> six raw retail tables -> dedupe ->
silver (+ quarantine) -> gold star schema, written directly in DuckDB SQL.

Every query's oracle is ``WITH <prefix> <final select>``.  Money stays DECIMAL
until the final select casts it to DOUBLE, exactly as the Spark plans do.
"""

from __future__ import annotations

from lakemart.sources import schemas as S


def initcap(expr: str) -> str:
    """Spark initcap: lower-case, then upper-case the first letter of every
    blank-separated word."""
    return ("array_to_string(list_transform(string_split(" + expr +
            ", ' '), lambda w: concat(upper(w[1:1]), lower(w[2:]))), ' ')")


def title_trim(expr: str) -> str:
    return f"trim({initcap(expr)})"


def domain(col: str, allowed: list[str]) -> str:
    vals = ", ".join(f"'{v}'" for v in allowed)
    return f"CASE WHEN {col} IN ({vals}) THEN {col} ELSE 'Unknown' END"


def bronze_columns(table: str) -> list[str]:
    return [f.name for f in S.SOURCES[table].fields] + ["seq"]


def dedupe_cte(table: str) -> str:
    key = S.KEYS[table]
    rest = [c for c in bronze_columns(table) if c not in (key, "seq")]
    order = ", ".join(["seq DESC"] + [f"{c} DESC NULLS LAST" for c in rest])
    return (f"d_{table} AS (SELECT * EXCLUDE (_rn) FROM (SELECT *, ROW_NUMBER() OVER "
            f"(PARTITION BY {key} ORDER BY {order}) AS _rn FROM b_{table}) WHERE _rn = 1)")


PCT = "CAST('0.01' AS DECIMAL(2,2))"
F70 = "CAST('0.70' AS DECIMAL(2,2))"


def _ctes() -> list[str]:
    c = []
    c.append("geo AS (SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey)")
    c.append("""b_customers0 AS (
  SELECT printf('CUST%07d', c_custkey) AS customer_id,
         split_part(c_name, '#', 1) AS first_name,
         split_part(c_name, '#', 2) AS last_name,
         CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         CAST(DATE '1950-01-01' + CAST(c_custkey % 18000 AS INTEGER) AS DATE) AS date_of_birth,
         CASE WHEN c_custkey % 50 = 7 THEN NULL WHEN c_custkey % 33 = 5 THEN lower(n_name) ELSE n_name END AS city,
         r_name AS state, 'India' AS country,
         CAST(DATE '2015-01-01' + CAST(c_custkey % 3000 AS INTEGER) AS DATE) AS signup_date,
         c_mktsegment AS customer_segment,
         concat('customer', CAST(c_custkey AS VARCHAR), '@example.com') AS email,
         CASE WHEN c_acctbal < 0 THEN 'Inactive' ELSE 'Active' END AS customer_status,
         c_custkey AS _k
  FROM customer JOIN geo ON c_nationkey = n_nationkey)""")
    c.append("""b_customers AS (
  SELECT * EXCLUDE (_k), 0 AS seq FROM b_customers0
  UNION ALL SELECT * EXCLUDE (_k), 1 AS seq FROM b_customers0 WHERE _k % 100 = 3)""")
    c.append(f"""b_products AS (
  SELECT printf('PROD%06d', p_partkey) AS product_id, p_name AS product_name,
         CASE WHEN p_partkey % 50 = 13 THEN NULL ELSE p_type END AS category,
         split_part(p_name, ' ', 2) AS subcategory, p_brand AS brand,
         concat('Supplier ', chr(CAST(65 + p_partkey % 20 AS INTEGER))) AS supplier,
         CAST(CAST(p_retailprice AS DECIMAL(12,2)) * {F70} AS DECIMAL(14,4)) AS unit_cost,
         CASE WHEN p_partkey % 100 = 11 THEN -CAST(p_retailprice AS DECIMAL(12,2))
              ELSE CAST(p_retailprice AS DECIMAL(12,2)) END AS selling_price,
         CAST(DATE '2018-01-01' + CAST(p_partkey % 1500 AS INTEGER) AS DATE) AS launch_date,
         CASE WHEN p_size <= 45 THEN 'Active' ELSE 'Discontinued' END AS product_status,
         0 AS seq
  FROM part)""")
    c.append("""b_stores AS (
  SELECT printf('STORE%04d', s_suppkey) AS store_id, s_name AS store_name, n_name AS city, n_name AS state,
         r_name AS region,
         CASE s_suppkey % 4 WHEN 0 THEN 'Mall' WHEN 1 THEN 'High Street' WHEN 2 THEN 'Supermarket' ELSE 'Outlet' END AS store_type,
         CAST(DATE '2010-01-01' + CAST(s_suppkey % 3650 AS INTEGER) AS DATE) AS opening_date,
         printf('MGR%05d', s_suppkey) AS manager_id, 0 AS seq
  FROM supplier JOIN geo ON s_nationkey = n_nationkey)""")
    c.append("""lines AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
         CAST(l_quantity AS BIGINT) AS qty,
         CAST(p_retailprice AS DECIMAL(12,2)) AS unit_price,
         CAST(CAST(l_discount AS DECIMAL(5,2)) * 100 AS DECIMAL(5,2)) AS discount_percentage,
         CAST(CAST(l_tax AS DECIMAL(5,2)) * 100 AS DECIMAL(5,2)) AS tax_percentage
  FROM lineitem JOIN part ON l_partkey = p_partkey)""")
    c.append(f"""lines2 AS (
  SELECT *,
         CAST(ROUND(CAST(CAST(qty AS DECIMAL(10,0)) * unit_price * (1 - discount_percentage * {PCT}) AS DECIMAL(24,6))
                    * (1 + tax_percentage * {PCT}), 2) AS DECIMAL(18,2)) AS line_amount,
         CAST(CAST(qty AS DECIMAL(10,0)) * unit_price * {F70} AS DECIMAL(18,4)) AS cost_amount
  FROM lines)""")
    c.append("""totals AS (
  SELECT l_orderkey AS t_orderkey, CAST(ROUND(SUM(line_amount), 2) AS DECIMAL(18,2)) AS total_amount
  FROM lines2 GROUP BY l_orderkey)""")
    c.append("ship AS (SELECT c_custkey, n_name AS shipping_city FROM customer JOIN nation ON c_nationkey = n_nationkey)")
    c.append("""obase AS (
  SELECT o_orderkey AS _k, o_custkey AS _c, printf('ORD%08d', o_orderkey) AS order_id,
         printf('STORE%04d', o_orderkey % (SELECT count(*) FROM supplier)) AS store_id,
         CAST(o_orderdate AS DATE) AS order_date,
         o_orderdate + to_seconds(CAST(o_orderkey % 86400 AS BIGINT)) AS order_timestamp,
         CASE WHEN o_orderstatus = 'F' THEN 'Completed' WHEN o_orderstatus = 'O' THEN 'Pending'
              WHEN o_orderkey % 2 = 0 THEN 'Cancelled' ELSE 'Returned' END AS order_status,
         CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Credit Card' WHEN '2' THEN 'Debit Card'
              WHEN '3' THEN 'UPI' WHEN '4' THEN 'Cash' ELSE 'Wallet' END AS payment_method,
         CASE o_orderkey % 3 WHEN 0 THEN 'Store' WHEN 1 THEN 'Website' ELSE 'Mobile App' END AS order_channel,
         shipping_city, total_amount
  FROM orders LEFT JOIN ship ON o_custkey = c_custkey LEFT JOIN totals ON o_orderkey = t_orderkey)""")
    c.append("""b_orders0 AS (
  SELECT _k, order_id,
         CASE WHEN _k % 100 = 17 THEN printf('NOCUST%06d', _k) ELSE printf('CUST%07d', _c) END AS customer_id,
         store_id, order_date, order_timestamp, order_status, payment_method, order_channel, shipping_city, total_amount
  FROM obase)""")
    c.append("""b_orders AS (
  SELECT * EXCLUDE (_k), 0 AS seq FROM b_orders0
  UNION ALL SELECT * EXCLUDE (_k), 1 AS seq FROM b_orders0 WHERE _k % 200 = 9)""")
    c.append("""b_order_items AS (
  SELECT concat_ws('-', printf('OI%08d', l_orderkey), CAST(l_linenumber AS VARCHAR),
                   CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR)) AS order_item_id,
         printf('ORD%08d', l_orderkey) AS order_id,
         CASE WHEN (l_orderkey + l_suppkey) % 100 = 33 THEN printf('NOPROD%05d', l_partkey)
              ELSE printf('PROD%06d', l_partkey) END AS product_id,
         CASE WHEN (l_orderkey + l_partkey) % 200 = 21 THEN -qty ELSE qty END AS quantity,
         unit_price, discount_percentage, tax_percentage, line_amount, cost_amount, 0 AS seq
  FROM lines2)""")
    c.append("""b_payments0 AS (
  SELECT _k, printf('PAY%08d', _k) AS payment_id, order_id,
         CAST(order_date + CAST(_k % 3 AS INTEGER) AS DATE) AS payment_date, payment_method,
         CASE WHEN _k % 20 = 0 THEN 'Failed' WHEN _k % 33 = 1 THEN 'Refunded' WHEN _k % 50 = 2 THEN 'Pending'
              ELSE 'Successful' END AS payment_status,
         CASE WHEN _k % 100 = 41 THEN -total_amount ELSE total_amount END AS payment_amount,
         CASE WHEN _k % 50 = 43 THEN NULL ELSE concat('TXN', CAST(_k AS VARCHAR)) END AS transaction_reference
  FROM obase)""")
    c.append("""b_payments AS (
  SELECT * EXCLUDE (_k), 0 AS seq FROM b_payments0
  UNION ALL SELECT * EXCLUDE (_k), 1 AS seq FROM b_payments0 WHERE _k % 100 = 57)""")
    for t in S.SOURCES:
        c.append(dedupe_cte(t))
    # ----- silver ----------------------------------------------------------
    c.append(f"""s_customers AS (
  SELECT customer_id, first_name, last_name, gender, date_of_birth,
         COALESCE({title_trim('city')}, 'Unknown') AS city, {title_trim('state')} AS state, country,
         signup_date, customer_segment, email, {domain('customer_status', S.CUSTOMER_STATUSES)} AS customer_status
  FROM d_customers)""")
    c.append("""c_products AS (
  SELECT *, CASE WHEN selling_price IS NULL THEN 'null_selling_price'
                 WHEN selling_price <= 0 THEN 'invalid_selling_price' END AS rejected_reason
  FROM d_products)""")
    c.append(f"""s_products AS (
  SELECT product_id, product_name, COALESCE({title_trim('category')}, 'Unknown') AS category,
         {title_trim('subcategory')} AS subcategory, brand, supplier, unit_cost, selling_price, launch_date,
         {domain('product_status', S.PRODUCT_STATUSES)} AS product_status
  FROM c_products WHERE rejected_reason IS NULL)""")
    c.append(f"""s_stores AS (
  SELECT store_id, store_name, {title_trim('city')} AS city, {title_trim('state')} AS state, region, store_type,
         opening_date, manager_id
  FROM d_stores)""")
    c.append("""c_orders AS (
  SELECT d.*, CASE WHEN sc.customer_id IS NULL THEN 'invalid_customer_fk' END AS rejected_reason
  FROM d_orders d LEFT JOIN (SELECT customer_id FROM s_customers) sc ON d.customer_id = sc.customer_id)""")
    c.append(f"""s_orders AS (
  SELECT order_id, customer_id, store_id, order_date, order_timestamp,
         {domain('order_status', S.ORDER_STATUSES)} AS order_status, payment_method, order_channel, shipping_city,
         COALESCE(total_amount, 0) AS total_amount
  FROM c_orders WHERE rejected_reason IS NULL)""")
    c.append("""c_order_items AS (
  SELECT d.*, so.customer_id AS o_customer_id, so.store_id AS o_store_id, so.order_date AS o_order_date,
         so.order_status AS o_order_status, so.order_channel AS o_order_channel,
         CASE WHEN d.quantity IS NULL THEN 'null_quantity'
              WHEN d.quantity <= 0 THEN 'negative_quantity'
              WHEN so.order_id IS NULL THEN 'invalid_order_fk'
              WHEN sp.product_id IS NULL THEN 'invalid_product_fk' END AS rejected_reason
  FROM d_order_items d
  LEFT JOIN s_orders so ON d.order_id = so.order_id
  LEFT JOIN (SELECT product_id FROM s_products) sp ON d.product_id = sp.product_id)""")
    c.append("""s_order_items AS (
  SELECT order_item_id, order_id, product_id, quantity, unit_price, discount_percentage, tax_percentage,
         line_amount, cost_amount
  FROM c_order_items WHERE rejected_reason IS NULL)""")
    c.append("""c_payments AS (
  SELECT d.*, CASE WHEN d.payment_amount IS NULL THEN 'null_payment_amount'
                   WHEN d.payment_amount <= 0 THEN 'invalid_payment_amount'
                   WHEN so.order_id IS NULL THEN 'invalid_order_fk' END AS rejected_reason
  FROM d_payments d LEFT JOIN (SELECT order_id FROM s_orders) so ON d.order_id = so.order_id)""")
    c.append(f"""s_payments AS (
  SELECT payment_id, order_id, payment_date, payment_method,
         {domain('payment_status', S.PAYMENT_STATUSES)} AS payment_status, payment_amount,
         COALESCE(transaction_reference, 'MISSING_REFERENCE') AS transaction_reference
  FROM c_payments WHERE rejected_reason IS NULL)""")
    # ----- gold ------------------------------------------------------------
    c.append("""dim_customer AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY customer_id) AS INTEGER) AS customer_key, customer_id, first_name,
         last_name, gender, date_of_birth, city, state, country, signup_date, customer_segment, customer_status
  FROM s_customers)""")
    c.append("""dim_product AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY product_id) AS INTEGER) AS product_key, product_id, product_name,
         category, subcategory, brand, supplier, unit_cost, selling_price, launch_date, product_status
  FROM s_products)""")
    c.append("""dim_store AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY store_id) AS INTEGER) AS store_key, store_id, store_name, city, state,
         region, store_type, opening_date, manager_id
  FROM s_stores)""")
    c.append("""cal AS (
  SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS full_date
  FROM (SELECT min(order_date) AS lo, max(order_date) AS hi FROM s_orders))""")
    c.append("""dim_date AS (
  SELECT full_date,
         CAST(year(full_date) * 10000 + month(full_date) * 100 + day(full_date) AS INTEGER) AS date_key,
         CAST(year(full_date) AS INTEGER) AS year, CAST(quarter(full_date) AS INTEGER) AS quarter,
         CAST(month(full_date) AS INTEGER) AS month, monthname(full_date) AS month_name,
         CAST(day(full_date) AS INTEGER) AS day, dayname(full_date) AS day_of_week,
         dayofweek(full_date) IN (0, 6) AS is_weekend
  FROM cal)""")
    c.append("""items_enriched AS (
  SELECT order_item_id, order_id, product_id, quantity, unit_price, discount_percentage, tax_percentage,
         line_amount, cost_amount, o_customer_id AS customer_id, o_store_id AS store_id,
         o_order_date AS order_date, o_order_status AS order_status, o_order_channel AS order_channel
  FROM c_order_items WHERE rejected_reason IS NULL)""")
    c.append("""fact0 AS (
  SELECT i.*, dc.customer_key, ds.store_key, dp.product_key, dd.date_key,
         CAST(CAST(i.quantity AS DECIMAL(10,0)) * i.unit_price AS DECIMAL(18,2)) AS gross_sales
  FROM items_enriched i
  JOIN dim_customer dc ON i.customer_id = dc.customer_id
  JOIN dim_store ds ON i.store_id = ds.store_id
  JOIN dim_product dp ON i.product_id = dp.product_id
  JOIN dim_date dd ON CAST(year(i.order_date) * 10000 + month(i.order_date) * 100 + day(i.order_date) AS INTEGER) = dd.date_key)""")
    c.append(f"""fact1 AS (
  SELECT *, CAST(gross_sales * discount_percentage * {PCT} AS DECIMAL(22,6)) AS discount_amount FROM fact0)""")
    c.append("""fact2 AS (
  SELECT *, CAST(gross_sales - discount_amount AS DECIMAL(22,6)) AS net_sales,
         CAST(cost_amount AS DECIMAL(18,4)) AS cost4 FROM fact1)""")
    c.append(f"""fact_sales AS (
  SELECT order_id, order_item_id, customer_key, product_key, store_key, date_key, quantity,
         gross_sales, discount_amount,
         CAST(net_sales * tax_percentage * {PCT} AS DECIMAL(26,10)) AS tax_amount,
         net_sales, cost4 AS cost_amount,
         CAST(net_sales - cost4 AS DECIMAL(22,6)) AS profit,
         CASE WHEN net_sales <> 0 THEN CAST(CAST(net_sales - cost4 AS DECIMAL(22,6)) AS DOUBLE) / CAST(net_sales AS DOUBLE)
              WHEN net_sales = 0 THEN 0.0 END AS profit_margin,
         order_status, order_channel,
         CAST(date_key // 10000 AS INTEGER) AS year, CAST((date_key // 100) % 100 AS INTEGER) AS month
  FROM fact2)""")
    return c


PREFIX = "WITH " + ",\n".join(_ctes()) + "\n"


def q(final_select: str) -> str:
    """A full oracle statement: shared prefix + final select."""
    return PREFIX + final_select
