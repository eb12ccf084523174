"""Final SELECT of every registered query, over the shared prefix CTEs."""

from __future__ import annotations

from lakemart.sources import schemas as S
from oracle.prefix import PREFIX, bronze_columns, initcap

DECIMALS = {"unit_cost", "selling_price", "total_amount", "unit_price", "discount_percentage", "tax_percentage",
            "line_amount", "cost_amount", "payment_amount", "gross_sales", "discount_amount", "tax_amount",
            "net_sales", "profit"}
SILVER_COLS = {t: [f.name for f in S.SOURCES[t].fields] for t in S.SOURCES}
FACT_COLS = ["order_id", "order_item_id", "customer_key", "product_key", "store_key", "date_key", "quantity",
             "gross_sales", "discount_amount", "tax_amount", "net_sales", "cost_amount", "profit",
             "profit_margin", "order_status", "order_channel", "year", "month"]
SLICE = "year = 1998 AND month = 1"


def cols(names, alias: str = "") -> str:
    a = f"{alias}." if alias else ""
    return ", ".join(f"CAST({a}{n} AS DOUBLE) AS {n}" if n in DECIMALS else f"{a}{n}" for n in names)


def money(expr: str, name: str) -> str:
    return f"CAST({expr} AS DOUBLE) AS {name}"


def ratio(num: str, den: str) -> str:
    return f"CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0)"


def pct_counts(num: str, den: str) -> str:
    """Exact HALF_UP round(100*num/den, 2) as DOUBLE (matches ratios.pct_of_counts)."""
    return (f"CASE WHEN ({den}) <> 0 THEN CAST(CAST(floor((20000 * CAST({num} AS BIGINT) + CAST({den} AS BIGINT)) "
            f"/ (2 * CAST({den} AS BIGINT))) AS BIGINT) AS DOUBLE) / 100.0 END")


def units(x: str) -> str:
    """Exact integer count of 10^-6 units of a money value."""
    return f"CAST(CAST({x} AS DECIMAL(38,6)) * 1000000 AS HUGEINT)"


def round_ratio(num: str, den: str) -> str:
    """HALF_UP(num / den, 2) of exact integers, as DOUBLE (NULL on den 0/NULL)."""
    return (f"CASE WHEN ({den}) <> 0 THEN CAST(sign({num}) * sign({den}) AS DOUBLE) * "
            f"CAST((2 * 100 * abs({num}) + abs({den})) // (2 * abs({den})) AS DOUBLE) / 100.0 END")


def growth(cur: str, prev: str) -> str:
    return round_ratio(f"({units(f'({cur}) - ({prev})')} * 100)", units(prev))


def money_per(total: str, count: str) -> str:
    return round_ratio(units(total), f"(CAST({count} AS HUGEINT) * 1000000)")


Q: dict[str, str] = {}

# ----- sources -----------------------------------------------------------------
Q["scan_parquet"] = ("SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem "
                     "WHERE l_shipdate >= TIMESTAMP '2000-01-01'")
Q["bronze_ingest"] = (f"SELECT {cols(SILVER_COLS['customers'])}, 'customers.csv' AS source_file, "
                      "'20240101000000' AS batch_id FROM b_customers")
Q["bronze_landing"] = "\nUNION ALL ".join(
    f"SELECT '{t}.{S.FORMATS[t]}' AS source_file, '20240101000000' AS batch_id, COUNT(*) AS row_count, "
    f"COUNT(DISTINCT {S.KEYS[t]}) AS key_count, "
    + " + ".join(f"COUNT(NULLIF(CAST({f} AS VARCHAR), ''))" for f in S.SOURCES[t].fieldNames())
    + f" AS value_count FROM b_{t}" for t in S.SOURCES)

_audit = []
for t in S.SOURCES:
    _audit.append(f"SELECT 'bronze' AS layer, '{t}' AS table_name, COUNT(*) AS row_count FROM b_{t}")
for t in S.SOURCES:
    _audit.append(f"SELECT 'silver', '{t}', COUNT(*) FROM s_{t}")
for t in ("products", "orders", "order_items", "payments"):
    _audit.append(f"SELECT 'quarantine', '{t}', COUNT(*) FROM c_{t} WHERE rejected_reason IS NOT NULL")
for t in ("dim_customer", "dim_product", "dim_store", "dim_date", "fact_sales"):
    _audit.append(f"SELECT 'gold', '{t}', COUNT(*) FROM {t}")
Q["row_count_audit"] = "\nUNION ALL ".join(_audit)


def _recon(table, src, tgt, measure):
    tot = (lambda t: f"(SELECT CAST(CAST(SUM({measure}) AS DECIMAL(38,6)) AS DOUBLE) FROM {t})") if measure \
        else (lambda t: "CAST(NULL AS DOUBLE)")
    return (f"SELECT '{table}' AS table_name, (SELECT COUNT(*) FROM {src}) AS source_rows, "
            f"(SELECT COUNT(*) FROM {tgt}) AS target_rows, {tot(src)} AS source_total, {tot(tgt)} AS target_total")


Q["handoff_reconcile"] = ("SELECT *, (source_rows = target_rows) AND (source_total IS NOT DISTINCT FROM target_total) "
                          "AS matched FROM (" + "\nUNION ALL ".join([
                              _recon("fact_sales", "s_order_items", "fact_sales", "quantity"),
                              _recon("dim_customer", "s_customers", "dim_customer", None),
                              _recon("dim_product", "s_products", "dim_product", "selling_price"),
                              _recon("dim_store", "s_stores", "dim_store", None)]) + ")")

Q["handoff_drift"] = (
    "SELECT order_item_id, CAST(1 AS BIGINT) AS source_rows, CASE right(order_id, 2) WHEN '77' THEN CAST(1 AS BIGINT) WHEN '13' THEN 0 ELSE 2 END "
    "AS target_rows, CASE right(order_id, 2) WHEN '77' THEN 'values' WHEN '13' THEN 'missing' ELSE 'count' END AS change, "
    "CASE right(order_id, 2) WHEN '77' THEN 'net_sales' ELSE '' END AS columns FROM fact_sales "
    "WHERE right(order_id, 2) IN ('77', '13', '51')")

_z = " + ".join(f"((({v} >> {i}) & 1) << {2 * i + j})"
                for i in range(31) for j, v in enumerate(["CAST(store_key - 1 AS BIGINT)",
                                                          "CAST(product_key - 1 AS BIGINT)"]))
Q["zorder_value"] = f"SELECT order_item_id, store_key, product_key, CAST({_z} AS BIGINT) AS z_value FROM fact_sales"

# ----- silver, quarantine, joins ---------------------------------------------------
for t in S.SOURCES:
    Q[f"silver_{t}"] = f"SELECT {cols(SILVER_COLS[t])} FROM s_{t}"
for t in ("products", "orders", "order_items", "payments"):
    Q[f"{t}_rejected"] = (f"SELECT {cols(bronze_columns(t))}, rejected_reason FROM c_{t} "
                          "WHERE rejected_reason IS NOT NULL")
Q["rejection_summary"] = "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, rejected_reason, COUNT(*) AS rejected_rows FROM c_{t} "
    "WHERE rejected_reason IS NOT NULL GROUP BY rejected_reason"
    for t in ("products", "orders", "order_items", "payments"))
for t in ("orders", "order_items", "payments"):  # whatever the order in which the rows arrived
    Q[f"incremental_{t}"] = Q[f"silver_{t}"]
Q["incremental_rejections"] = Q["rejection_summary"]
Q["fk_valid_orders"] = (f"SELECT {cols(bronze_columns('orders'))} FROM d_orders "
                        "WHERE customer_id IN (SELECT customer_id FROM s_customers)")
Q["fk_invalid_orders"] = (f"SELECT {cols(bronze_columns('orders'), 'd')} FROM d_orders d WHERE NOT EXISTS "
                          "(SELECT 1 FROM s_customers s WHERE s.customer_id = d.customer_id)")
_li_rest = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
            "l_linestatus"]
Q["dedupe_latest"] = ("SELECT * EXCLUDE (_rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, "
                      "l_linenumber ORDER BY l_shipdate DESC NULLS LAST, "
                      + ", ".join(f"{c} DESC NULLS LAST" for c in _li_rest) + ") AS _rn FROM lineitem) WHERE _rn = 1")
Q["orders_shipping_city"] = "SELECT order_id, shipping_city FROM b_orders WHERE seq = 0"
Q["orders_total_rollup"] = ("SELECT printf('ORD%08d', t_orderkey) AS order_id, CAST(total_amount AS DOUBLE) "
                            "AS total_amount FROM totals")

# ----- gold ------------------------------------------------------------------------
Q["dim_customer"] = "SELECT * FROM dim_customer"
_early = "coalesce(customer_segment IN ('BUILDING', 'MACHINERY'), false)"
Q["dim_customer_lasting"] = (
    f"SELECT * REPLACE (CAST(row_number() OVER (PARTITION BY {_early} ORDER BY customer_id) + CASE WHEN {_early} THEN 0 "
    f"ELSE (SELECT COUNT(*) FROM dim_customer WHERE {_early}) END AS INTEGER) AS customer_key) FROM dim_customer")
Q["dim_product"] = ("SELECT " + cols(["product_key", "product_id", "product_name", "category", "subcategory",
                                      "brand", "supplier", "unit_cost", "selling_price", "launch_date",
                                      "product_status"]) + " FROM dim_product")
Q["dim_store"] = "SELECT * FROM dim_store"
Q["dim_date"] = "SELECT * FROM dim_date"
Q["fact_sales"] = f"SELECT {cols(FACT_COLS)} FROM fact_sales"
Q["fact_join_audit"] = ("SELECT order_item_id FROM s_order_items WHERE order_item_id NOT IN "
                       "(SELECT order_item_id FROM fact_sales)")
Q["fact_store_product"] = (f"SELECT {cols(FACT_COLS)} FROM fact_sales WHERE store_key = 7 AND product_key BETWEEN 100 AND 900 "
                           "AND year BETWEEN 1996 AND 1999")
Q["star_wide"] = (f"SELECT {cols(FACT_COLS, 'f')}, c.customer_id, c.customer_segment, c.city AS customer_city, "
                  "c.state AS customer_state, c.gender, c.customer_status, p.product_id, p.product_name, p.category, "
                  "p.subcategory, p.brand, p.supplier, s.store_id, s.store_name, s.city AS store_city, "
                  "s.state AS store_state, s.region, s.store_type, d.full_date, d.quarter, d.month_name, "
                  "d.day_of_week, d.is_weekend FROM fact_sales f "
                  "LEFT JOIN dim_customer c ON f.customer_key = c.customer_key "
                  "LEFT JOIN dim_product p ON f.product_key = p.product_key "
                  "LEFT JOIN dim_store s ON f.store_key = s.store_key "
                  "LEFT JOIN dim_date d ON f.date_key = d.date_key")
Q["month_slice"] = f"SELECT {cols(FACT_COLS)} FROM fact_sales WHERE {SLICE}"
Q["distinct_orders_in_month"] = f"SELECT DISTINCT order_id FROM fact_sales WHERE {SLICE}"

# ----- business metrics (the reference SQL shapes) -----------------------------------
FD = "fact_sales f JOIN dim_date d ON f.date_key = d.date_key"
FP = "fact_sales f JOIN dim_product p ON f.product_key = p.product_key"
FS = "fact_sales f JOIN dim_store s ON f.store_key = s.store_key"
FC = "fact_sales f JOIN dim_customer c ON f.customer_key = c.customer_key"

Q["bm01_total_revenue"] = "SELECT CAST(SUM(net_sales) AS DOUBLE) AS total_revenue FROM fact_sales"
Q["bm02_monthly_growth"] = (
    "SELECT year, month, CAST(rev AS DOUBLE) AS monthly_revenue, CAST(prev AS DOUBLE) AS prev_month_revenue, "
    f"{growth('rev', 'prev')} AS mom_growth_pct FROM (SELECT *, LAG(rev) OVER (ORDER BY year, month) AS prev FROM "
    f"(SELECT d.year, d.month, SUM(f.net_sales) AS rev FROM {FD} GROUP BY d.year, d.month))")
Q["bm03_avg_order_value"] = (f"SELECT {money_per('SUM(net_sales)', 'COUNT(DISTINCT order_id)')} "
                             "AS avg_order_value FROM fact_sales")
Q["bm04_top_months"] = (f"SELECT d.year, d.month, d.month_name, {money('SUM(f.net_sales)', 'monthly_revenue')} "
                        f"FROM {FD} GROUP BY d.year, d.month, d.month_name "
                        "ORDER BY monthly_revenue DESC, d.year, d.month LIMIT 10")
Q["bm05_revenue_by_category"] = (f"SELECT p.category, {money('SUM(f.net_sales)', 'total_revenue')} FROM {FP} "
                                 "GROUP BY p.category")
Q["bm06_top_profit_products"] = (f"SELECT p.product_id, p.product_name, {money('SUM(f.profit)', 'total_profit')} "
                                 f"FROM {FP} GROUP BY p.product_id, p.product_name "
                                 "ORDER BY total_profit DESC, p.product_id LIMIT 20")
Q["bm07_declining_products"] = (
    "SELECT product_id, product_name, year, month, CAST(revenue AS DOUBLE) AS revenue, "
    f"CAST(prev_revenue AS DOUBLE) AS prev_revenue, {growth('revenue', 'prev_revenue')} AS mom_change_pct FROM ("
    "SELECT *, LAG(revenue) OVER (PARTITION BY product_id ORDER BY year, month) AS prev_revenue FROM ("
    "SELECT p.product_id, p.product_name, d.year, d.month, SUM(f.net_sales) AS revenue FROM fact_sales f "
    "JOIN dim_product p ON f.product_key = p.product_key JOIN dim_date d ON f.date_key = d.date_key "
    "GROUP BY p.product_id, p.product_name, d.year, d.month)) "
    "WHERE prev_revenue IS NOT NULL AND revenue < prev_revenue")
Q["bm08_revenue_by_store"] = (f"SELECT s.store_id, s.store_name, s.region, "
                              f"{money('SUM(f.net_sales)', 'total_revenue')} FROM {FS} "
                              "GROUP BY s.store_id, s.store_name, s.region")
Q["bm09_top_margin_stores"] = (f"SELECT s.store_id, s.store_name, {ratio('SUM(f.profit)', 'SUM(f.net_sales)')} "
                               f"AS profit_margin FROM {FS} GROUP BY s.store_id, s.store_name "
                               "ORDER BY profit_margin DESC NULLS LAST, s.store_id LIMIT 20")
Q["bm10_region_revenue_per_store"] = (
    f"SELECT s.region, COUNT(DISTINCT s.store_id) AS store_count, {money('SUM(f.net_sales)', 'total_revenue')}, "
    f"{ratio('SUM(f.net_sales)', 'COUNT(DISTINCT s.store_id)')} AS revenue_per_store FROM {FS} GROUP BY s.region")
Q["bm11_revenue_by_segment"] = (f"SELECT c.customer_segment, {money('SUM(f.net_sales)', 'total_revenue')} "
                                f"FROM {FC} GROUP BY c.customer_segment")
Q["bm12_repeat_customer_rate"] = (
    f"SELECT {pct_counts('SUM(CASE WHEN order_count > 1 THEN 1 ELSE 0 END)', 'COUNT(*)')} "
    "AS repeat_customer_rate_pct FROM (SELECT customer_key, COUNT(DISTINCT order_id) AS order_count "
    "FROM fact_sales GROUP BY customer_key)")
Q["bm13_avg_customer_value"] = (f"SELECT {money_per('SUM(net_sales)', 'COUNT(DISTINCT customer_key)')} "
                                "AS avg_customer_value FROM fact_sales")
_cancelled = "SUM(CASE WHEN order_status = 'Cancelled' THEN 1 ELSE 0 END)"
_returned = "SUM(CASE WHEN order_status = 'Returned' THEN 1 ELSE 0 END)"
Q["bm14_cancellation_rate"] = f"SELECT {pct_counts(_cancelled, 'COUNT(*)')} AS cancellation_rate_pct FROM s_orders"
Q["bm15_return_rate"] = f"SELECT {pct_counts(_returned, 'COUNT(*)')} AS return_rate_pct FROM s_orders"
_failed = "SUM(CASE WHEN payment_status = 'Failed' THEN 1 ELSE 0 END)"
Q["bm16_payment_failure_rate"] = (
    f"SELECT payment_method, COUNT(*) AS total_payments, CAST({_failed} AS BIGINT) AS failed_payments, "
    f"{pct_counts(_failed, 'COUNT(*)')} AS failure_rate_pct FROM s_payments GROUP BY payment_method")
Q["month_slice_kpis"] = (f"SELECT {money('SUM(net_sales)', 'total_revenue')}, COUNT(DISTINCT order_id) AS "
                         f"total_orders, {money('SUM(profit)', 'total_profit')} FROM fact_sales WHERE {SLICE}")
Q["revenue_profit_by_category"] = (f"SELECT p.category, {money('SUM(f.net_sales)', 'total_net_sales')}, "
                                   f"{money('SUM(f.profit)', 'total_profit')} FROM {FP} GROUP BY p.category")
Q["monthly_net_sales"] = (f"SELECT d.month_name, d.year, d.month, {money('SUM(f.net_sales)', 'monthly_net_sales')} "
                          f"FROM {FD} GROUP BY d.year, d.month, d.month_name")
_unknown = "COALESCE(SUM(CASE WHEN p.category = 'Unknown' THEN f.net_sales END), 0)"
Q["unknown_category_share"] = (
    "SELECT CAST(COALESCE(SUM(CASE WHEN p.category = 'Unknown' THEN f.net_sales END), 0) AS DOUBLE) "
    f"AS unknown_revenue, {money('SUM(f.net_sales)', 'total_revenue')}, "
    f"{ratio(_unknown, 'SUM(f.net_sales)')} AS unknown_share FROM {FP}")

# ----- SQL-text entry point: same answers as the DataFrame metrics ----------------
Q["sql_total_revenue"] = Q["bm01_total_revenue"]
Q["sql_revenue_by_category"] = Q["bm05_revenue_by_category"]
Q["sql_monthly_net_sales"] = Q["monthly_net_sales"]
Q["sql_cancellation_rate"] = Q["bm14_cancellation_rate"]

# ----- BI measures -----------------------------------------------------------------
M = {
    "total_sales": money("SUM(f.net_sales)", "total_sales"),
    "total_profit": money("SUM(f.profit)", "total_profit"),
    "total_orders": "COUNT(DISTINCT f.order_id) AS total_orders",
    "avg_order_value": ratio("SUM(f.net_sales)", "COUNT(DISTINCT f.order_id)") + " AS avg_order_value",
    "profit_margin_pct": ratio("SUM(f.profit)", "SUM(f.net_sales)") + " AS profit_margin_pct",
    "units_sold": "CAST(SUM(f.quantity) AS BIGINT) AS units_sold",
    "avg_selling_price": ratio("SUM(f.net_sales)", "SUM(f.quantity)") + " AS avg_selling_price",
}
KPI = ["total_sales", "total_profit", "total_orders", "avg_order_value", "profit_margin_pct"]
LP = " LEFT JOIN dim_product p ON f.product_key = p.product_key"
LS = " LEFT JOIN dim_store s ON f.store_key = s.store_key"
LC = " LEFT JOIN dim_customer c ON f.customer_key = c.customer_key"


def measures(by: list[str], which: list[str], joins: str = "", where: str = "") -> str:
    sel = ", ".join(by + [M[w] for w in which])
    grp = f" GROUP BY {', '.join(by)}" if by else ""
    return f"SELECT {sel} FROM fact_sales f{joins}{where}{grp}"


Q["kpi_overview"] = measures([], KPI + ["units_sold", "avg_selling_price"])
Q["repeat_customer_ratio"] = (f"SELECT {ratio('SUM(CASE WHEN n > 1 THEN 1 ELSE 0 END)', 'COUNT(*)')} AS "
                              "repeat_customer_ratio FROM (SELECT customer_key, COUNT(DISTINCT order_id) AS n "
                              "FROM fact_sales GROUP BY customer_key)")
Q["customer_count_by_segment"] = ("SELECT customer_segment, COUNT(DISTINCT customer_id) AS customer_count "
                                  "FROM dim_customer GROUP BY customer_segment")
Q["kpi_by_subcategory"] = measures(["p.subcategory"], KPI, LP)
Q["sales_by_region"] = measures(["s.region"], ["total_sales"], LS)
Q["sales_by_store"] = measures(["s.store_id", "s.store_name"], ["total_sales"], LS)
Q["daily_sales_trend"] = ("SELECT d.full_date, COALESCE(CAST(x.rev AS DOUBLE), 0.0) AS total_sales FROM dim_date d "
                          "LEFT JOIN (SELECT date_key, SUM(net_sales) AS rev FROM fact_sales GROUP BY date_key) x "
                          "ON d.date_key = x.date_key")
Q["sales_sliced"] = measures(["s.region"], ["total_sales", "total_orders"], LP + LC + LS,
                             " WHERE p.category IN ('Economy', 'Promo') AND c.customer_segment IN "
                             "('BUILDING', 'MACHINERY')")
Q["profit_by_category"] = measures(["p.category"], ["total_sales", "total_profit"], LP)
Q["sales_by_product"] = measures(["p.product_id", "p.product_name"], ["total_sales"], LP)
Q["sales_by_customer"] = measures(["c.customer_id"], ["total_sales"], LC)
Q["store_performance"] = measures(["s.store_id", "s.store_name"], ["total_sales", "profit_margin_pct"], LS)
Q["units_sold"] = measures([], ["units_sold", "avg_selling_price"])
Q["revenue_by_channel"] = measures(["f.order_channel"], ["total_sales"])
Q["orders_by_status"] = measures(["f.order_status"], ["total_orders", "total_sales"])
Q["product_margin"] = measures(["p.product_id", "p.product_name"], ["profit_margin_pct"], LP)
Q["repeat_vs_new"] = ("SELECT CASE WHEN n > 1 THEN 'Repeat' ELSE 'New' END AS customer_type, COUNT(*) AS customers, "
                      "CAST(SUM(rev) AS DOUBLE) AS total_sales FROM (SELECT customer_key, SUM(net_sales) AS rev, "
                      "COUNT(DISTINCT order_id) AS n FROM fact_sales GROUP BY customer_key) GROUP BY 1")
Q["customer_revenue_histogram"] = (
    "SELECT bucket, COUNT(*) AS customers, CAST(bucket * 250000 AS DOUBLE) AS bucket_start FROM ("
    "SELECT CAST(floor(CAST(SUM(net_sales) AS DOUBLE) / CAST(250000 AS DOUBLE)) AS BIGINT) AS bucket "
    "FROM fact_sales GROUP BY customer_key) GROUP BY bucket")
for _name, _dir in (("top10_products", "DESC"), ("bottom10_products", "ASC")):
    Q[_name] = (measures(["p.product_id", "p.product_name"], ["total_sales"], LP)
                + f" ORDER BY total_sales {_dir}, p.product_id LIMIT 10")
_monthly = ("(SELECT year, month, year * 12 + month AS mi, SUM(net_sales) AS v FROM fact_sales "
            "GROUP BY year, month)")
Q["yoy_sales"] = (f"SELECT a.year, a.month, CAST(a.v AS DOUBLE) AS total_sales, CAST(b.v AS DOUBLE) AS "
                  f"sales_last_year, {growth('a.v', 'b.v')} AS yoy_growth_pct FROM {_monthly} a "
                  f"LEFT JOIN {_monthly} b ON b.mi = a.mi - 12")
Q["mom_growth_gap_aware"] = (f"SELECT a.year, a.month, CAST(a.v AS DOUBLE) AS total_sales, CAST(b.v AS DOUBLE) AS "
                             f"prev_month_sales, {growth('a.v', 'b.v')} AS mom_growth_pct FROM {_monthly} a "
                             f"LEFT JOIN {_monthly} b ON b.mi = a.mi - 1")

# month sums refreshed by partition: the slice's month comes from the second refresh
Q["refreshed_month_sums"] = (
    f"SELECT year, month, CAST(CASE WHEN {SLICE} THEN 1 ELSE 0 END AS INTEGER) AS generation, COUNT(*) AS items, "
    f"{money('SUM(net_sales)', 'net_sales')}, {money('SUM(profit)', 'profit')}, CAST(SUM(quantity) AS BIGINT) AS quantity "
    "FROM fact_sales GROUP BY year, month")
Q["refreshed_monthly_growth"] = Q["bm02_monthly_growth"]
Q["refreshed_monthly_net_sales"] = Q["monthly_net_sales"]
Q["refreshed_mom_growth"] = Q["mom_growth_gap_aware"]
Q["refreshed_yoy_sales"] = Q["yoy_sales"]
Q["refreshed_daily_trend"] = Q["daily_sales_trend"]


# ----- data quality ---------------------------------------------------------------------

def _chk(layer, table, src, name, cond):
    return (f"SELECT '{layer}' AS layer, '{table}' AS table_name, '{name}' AS check_name, COUNT(*) AS total_records, "
            f"COUNT(*) FILTER (WHERE {cond}) AS failed_records FROM {src}")


def _dup(layer, table, src, key):
    return (f"SELECT '{layer}', '{table}', 'Duplicate {key}', CAST(COALESCE(SUM(n), 0) AS BIGINT), "
            f"CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) FROM (SELECT {key}, COUNT(*) AS n FROM {src} GROUP BY {key})")


def _fk(layer, table, child, key, parent, name):
    return (f"SELECT '{layer}', '{table}', '{name}', COUNT(*), COUNT(*) FILTER (WHERE p.k IS NULL) FROM {child} x "
            f"LEFT JOIN (SELECT DISTINCT {key} AS k FROM {parent}) p ON x.{key} = p.k")


def dq_layer(layer: str, p: str, extended: bool = False) -> str:
    os_ = ", ".join(f"'{v}'" for v in S.ORDER_STATUSES)
    ps_ = ", ".join(f"'{v}'" for v in S.PAYMENT_STATUSES)
    parts = [
        _chk(layer, "customers", f"{p}_customers", "Null city", "city IS NULL"),
        _dup(layer, "customers", f"{p}_customers", "customer_id"),
        _chk(layer, "products", f"{p}_products", "Null category", "category IS NULL"),
        _chk(layer, "products", f"{p}_products", "Invalid selling_price", "selling_price <= 0"),
        _dup(layer, "orders", f"{p}_orders", "order_id"),
        _chk(layer, "orders", f"{p}_orders", "Invalid order_date", "order_date IS NULL OR order_date > current_date"),
        _chk(layer, "orders", f"{p}_orders", "Invalid order_status", f"order_status NOT IN ({os_})"),
        _fk(layer, "orders", f"{p}_orders", "customer_id", f"{p}_customers", "Invalid customer_id FK"),
        _chk(layer, "order_items", f"{p}_order_items", "Negative quantity", "quantity < 0"),
        _fk(layer, "order_items", f"{p}_order_items", "product_id", f"{p}_products", "Invalid product_id FK"),
        _dup(layer, "payments", f"{p}_payments", "payment_id"),
        _chk(layer, "payments", f"{p}_payments", "Invalid payment_amount", "payment_amount <= 0"),
        _chk(layer, "payments", f"{p}_payments", "Invalid payment_status", f"payment_status NOT IN ({ps_})"),
        _fk(layer, "payments", f"{p}_payments", "order_id", f"{p}_orders", "Invalid order_id FK"),
    ]
    if extended:
        parts.append(_fk(layer, "orders", f"{p}_orders", "store_id", f"{p}_stores", "Invalid store_id FK"))
        parts.append(_fk(layer, "order_items", f"{p}_order_items", "order_id", f"{p}_orders", "Invalid order_id FK"))
    return "\nUNION ALL ".join(parts)


def _with_status(body: str) -> str:
    return (f"SELECT layer, table_name, check_name, total_records, failed_records, CASE WHEN failed_records = 0 "
            f"THEN 'PASS' ELSE 'FAIL' END AS status FROM ({body})")


DQ_ALL = _with_status(dq_layer("bronze", "b") + "\nUNION ALL " + dq_layer("silver", "s"))
Q["dq_summary"] = DQ_ALL
Q["dq_summary_bronze"] = _with_status(dq_layer("bronze", "b"))
Q["dq_summary_silver"] = _with_status(dq_layer("silver", "s"))
Q["dq_summary_extended"] = _with_status(dq_layer("bronze", "b", True) + "\nUNION ALL " + dq_layer("silver", "s", True))
for _key, _check in {
    "dq_null_city": "Null city", "dq_null_category": "Null category",
    "dq_negative_quantity": "Negative quantity", "dq_invalid_price": "Invalid selling_price",
    "dq_invalid_payment": "Invalid payment_amount", "dq_invalid_dates": "Invalid order_date",
    "dq_invalid_status": "Invalid order_status", "dq_fk_orders_customers": "Invalid customer_id FK",
    "dq_fk_items_products": "Invalid product_id FK", "dq_fk_payments_orders": "Invalid order_id FK",
}.items():
    Q[_key] = f"SELECT * FROM ({DQ_ALL}) WHERE check_name = '{_check}'"
Q["dq_duplicate_excess"] = f"SELECT * FROM ({DQ_ALL}) WHERE check_name LIKE 'Duplicate%'"

Q["dq_duplicate_keys"] = ("SELECT customer_id, COUNT(*) AS occurrences FROM b_customers GROUP BY customer_id "
                          "HAVING COUNT(*) > 1")
def _rv(name, expr, src):
    return f"SELECT '{name}' AS check_name, CAST({expr} AS DOUBLE) AS value FROM {src}"


Q["raw_validation"] = "\nUNION ALL ".join([
    _rv("Duplicate customer IDs", "COUNT(*) - COUNT(DISTINCT customer_id)", "b_customers"),
    _rv("Missing customer city", "COUNT(*) FILTER (WHERE city IS NULL)", "b_customers"),
    _rv("Missing product category", "COUNT(*) FILTER (WHERE category IS NULL)", "b_products"),
    _rv("Negative product price", "COUNT(*) FILTER (WHERE selling_price < 0)", "b_products"),
    _rv("Duplicate order IDs", "COUNT(*) - COUNT(DISTINCT order_id)", "b_orders"),
    _rv("Orders with invalid customer_id FK", "COUNT(*)",
        "b_orders o WHERE NOT EXISTS (SELECT 1 FROM b_customers c WHERE c.customer_id = o.customer_id)"),
    _rv("Order items with negative quantity", "COUNT(*) FILTER (WHERE quantity < 0)", "b_order_items"),
    _rv("Order items with invalid product_id FK", "COUNT(*)",
        "b_order_items i WHERE NOT EXISTS (SELECT 1 FROM b_products p WHERE p.product_id = i.product_id)"),
    _rv("Duplicate payment IDs", "COUNT(*) - COUNT(DISTINCT payment_id)", "b_payments"),
    _rv("Payments with invalid amount", "COUNT(*) FILTER (WHERE payment_amount <= 0)", "b_payments"),
    _rv("Null order total_amount", "COUNT(*) FILTER (WHERE total_amount IS NULL)", "b_orders"),
    "SELECT 'Avg items per order' AS check_name, CAST((SELECT COUNT(*) FROM b_order_items) AS DOUBLE) / "
    "NULLIF(CAST((SELECT COUNT(DISTINCT order_id) FROM b_orders) AS DOUBLE), 0) AS value",
])
Q["dqsql_01"] = ("SELECT COUNT(*) AS total_records, COUNT(*) FILTER (WHERE city IS NULL) AS failed_records, "
                 f"{pct_counts('COUNT(*) FILTER (WHERE city IS NULL)', 'COUNT(*)')} AS failed_pct FROM b_customers")
Q["dqsql_02"] = Q["dq_duplicate_keys"]


def _tf(src, cond):
    return f"SELECT COUNT(*) AS total_records, COUNT(*) FILTER (WHERE {cond}) AS failed_records FROM {src}"


Q["dqsql_03"] = _tf("b_products", "category IS NULL")
Q["dqsql_04"] = _tf("b_order_items", "quantity < 0")
Q["dqsql_05"] = _tf("b_products", "selling_price <= 0")
Q["dqsql_06"] = _tf("b_payments", "payment_amount <= 0")
Q["dqsql_07"] = ("SELECT COUNT(*) AS invalid_fk_count FROM b_orders o WHERE NOT EXISTS "
                 "(SELECT 1 FROM b_customers c WHERE c.customer_id = o.customer_id)")
Q["dqsql_07b"] = ("SELECT COUNT(*) AS invalid_fk_count FROM b_order_items oi WHERE NOT EXISTS "
                  "(SELECT 1 FROM b_products p WHERE p.product_id = oi.product_id)")
Q["dqsql_07c"] = ("SELECT COUNT(*) AS invalid_fk_count FROM b_payments pay WHERE NOT EXISTS "
                  "(SELECT 1 FROM b_orders o WHERE o.order_id = pay.order_id)")
Q["dqsql_08"] = _tf("b_orders", "order_date IS NULL OR order_date > current_date")
Q["dqsql_09a"] = _tf("b_orders", f"order_status NOT IN ({', '.join(repr(v) for v in S.ORDER_STATUSES)})")
Q["dqsql_09b"] = _tf("b_payments", f"payment_status NOT IN ({', '.join(repr(v) for v in S.PAYMENT_STATUSES)})")


# ----- fault injection report: exactly floor(n * pct) rows per issue; a
# duplicates issue grows the table for the issues after it
# Table, rows added before by duplicates (as a fraction), issue, fraction.
_ISSUES = [
    ("customers", None, "Customers landed twice", "0.01"), ("customers", "0.01", "Customers without city", "0.02"),
    ("customers", "0.01", "City spelled in mixed case", "0.03"), ("products", None, "Products without category", "0.02"),
    ("products", None, "Products priced below zero", "0.01"), ("orders", None, "Orders landed twice", "0.005"),
    ("orders", "0.005", "Orders of an unknown customer", "0.01"), ("order_items", None, "Items of negative quantity", "0.005"),
    ("order_items", None, "Items of an unknown product", "0.01"), ("payments", None, "Payments landed twice", "0.01"),
    ("payments", "0.01", "Payments below zero", "0.01"), ("payments", "0.01", "Payments without reference", "0.02"),
]


def _share(n: str, fraction: str) -> str:
    return f"CAST(floor(CAST({n} AS DECIMAL(20,0)) * CAST('{fraction}' AS DECIMAL(10,6))) AS BIGINT)"


def _fault_report() -> str:
    parts = []
    for table, grown, issue, fraction in _ISSUES:
        n = f"(SELECT COUNT(*) FROM s_{table})"
        if grown:
            n = f"({n} + {_share(n, grown)})"
        parts.append(f"SELECT '{table}' AS table_name, '{issue}' AS issue, 100 * CAST({fraction} AS DOUBLE) AS target_pct, {_share(n, fraction)} AS rows_affected")
    return "\nUNION ALL ".join(parts)


Q["fault_injection_report"] = _fault_report()


# ----- injectors: the rows of the smallest MD5 of (seed, key, copy number)
def _md5(seed: int, key: str) -> str:
    return f"md5(concat_ws('|', '{seed}', {key}, '0'))"


def _injected(table: str, key: str, pct: str, col: str | None = None, value: str = "") -> str:
    names = SILVER_COLS[table]
    picked = (f"(SELECT *, row_number() OVER (ORDER BY {_md5(42, key)}, {key}) <= floor(CAST(COUNT(*) OVER () "
              f"AS DECIMAL(20,0)) * CAST('{pct}' AS DECIMAL(10,6))) AS picked FROM s_{table})")
    if col is None:
        return f"SELECT {cols(names)} FROM s_{table} UNION ALL SELECT {cols(names)} FROM {picked} WHERE picked"
    out = ", ".join(f"CASE WHEN picked THEN {value} ELSE {n} END AS {n}" if n == col else cols([n]) for n in names)
    return f"SELECT {out} FROM {picked}"


_style = f"ascii({_md5(43, 'customer_id')}) % 3"
Q["inject_duplicates"] = _injected("customers", "customer_id", "0.01")
Q["inject_nulls"] = _injected("customers", "customer_id", "0.02", "city", "NULL")
Q["inject_inconsistent_case"] = _injected(
    "customers", "customer_id", "0.03", "city",
    f"CASE {_style} WHEN 0 THEN upper(city) WHEN 1 THEN lower(city) ELSE {initcap('city')} END")
Q["inject_invalid_numeric"] = _injected("order_items", "order_item_id", "0.005", "quantity", "-abs(quantity)")
Q["inject_invalid_fk"] = _injected("orders", "order_id", "0.01", "customer_id",
                                   f"'NOCUST-' || upper(substr({_md5(44, 'order_id')}, 1, 16))")


def _step(source: str, key: str, seed: int, fraction: str, change: str) -> str:
    """Rows of ``source`` (with their copy number) changed where picked; ``change`` reads ``picked`` and ``other`` (a digest of the next seed)."""
    return (f"(SELECT * REPLACE ({change}) FROM (SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', '{seed}', {key}, copy)), {key}, copy) <= "
            f"floor(CAST(COUNT(*) OVER () AS DECIMAL(20,0)) * CAST('{fraction}' AS DECIMAL(10,6))) AS picked, md5(concat_ws('|', '{seed + 1}', {key}, copy)) AS other, "
            f"md5(concat_ws('|', '{seed + 2}', {key}, copy)) AS third FROM (SELECT * EXCLUDE (picked, other, third) FROM {source})))")


def _twice(table: str, key: str, seed: int, fraction: str) -> str:
    """The table with its picked rows a second time, as copy 1."""
    one = _step(f"(SELECT *, 0 AS copy, false AS picked, '' AS other, '' AS third FROM s_{table})", key, seed, fraction, "picked AS picked")
    return f"(SELECT * FROM {one} UNION ALL SELECT * REPLACE (1 AS copy) FROM {one} WHERE picked)"


_c = _step(_twice("customers", "customer_id", 42, "0.01"), "customer_id", 143, "0.02", "CASE WHEN picked THEN NULL ELSE city END AS city")
_c = _step(_c, "customer_id", 244, "0.03", f"CASE WHEN NOT picked THEN city ELSE CASE ascii(other) % 3 WHEN 0 THEN upper(city) WHEN 1 THEN lower(city) "
                                           f"ELSE {initcap('city')} END END AS city")
Q["injected_customers"] = f"SELECT {cols(SILVER_COLS['customers'])} FROM {_c}"
_o = _step(_twice("orders", "order_id", 42, "0.005"), "order_id", 143, "0.01",
           "CASE WHEN picked THEN 'NOCUST-' || upper(substr(third, 1, 16)) ELSE customer_id END AS customer_id")
Q["injected_orders"] = f"SELECT {cols(SILVER_COLS['orders'])} FROM {_o}"


# ----- the suite over tables with injected defects, and what the fact lost ---------------
def _once(table: str) -> str:
    return f"(SELECT *, 0 AS copy, false AS picked, '' AS other, '' AS third FROM s_{table})"


def _restyled(col: str) -> str:
    return (f"CASE WHEN NOT picked THEN {col} ELSE CASE ascii(other) % 3 WHEN 0 THEN upper({col}) WHEN 1 THEN lower({col}) "
            f"ELSE {initcap(col)} END END AS {col}")


def _picked(col: str, value: str) -> str:
    return f"CASE WHEN picked THEN {value} ELSE {col} END AS {col}"


def _dq_injected() -> str:
    p = _step(_once("products"), "product_id", 42, "0.02", _picked("category", "NULL"))
    p = _step(p, "product_id", 143, "0.01", _picked("selling_price", "-abs(selling_price)"))
    o = _step(_o, "order_id", 244, "0.01", _picked("order_date", "NULL"))
    o = _step(o, "order_id", 345, "0.005", _picked("order_date", "DATE '2999-12-31'"))
    o = _step(o, "order_id", 446, "0.02", _restyled("order_status"))
    i = _step(_once("order_items"), "order_item_id", 42, "0.005", _picked("quantity", "-abs(quantity)"))
    i = _step(i, "order_item_id", 143, "0.01", _picked("product_id", "'NOPROD-' || upper(substr(third, 1, 16))"))
    pay = _step(_twice("payments", "payment_id", 42, "0.01"), "payment_id", 143, "0.01", _picked("payment_amount", "-abs(payment_amount)"))
    pay = _step(pay, "payment_id", 345, "0.02", _restyled("payment_status"))
    pay = _step(pay, "payment_id", 446, "0.01", _picked("order_id", "'NOORD-' || upper(substr(third, 1, 16))"))
    tables = {"customers": _c, "products": p, "orders": o, "order_items": i, "payments": pay}
    return (f"SELECT * FROM (WITH {', '.join(f'd_{t} AS MATERIALIZED {body}' for t, body in tables.items())} "
            f"{_with_status(dq_layer('injected', 'd'))})")


Q["dq_injected"] = _dq_injected()
Q["fact_lost_items"] = ("SELECT order_item_id FROM b_order_items i WHERE NOT EXISTS "
                        "(SELECT 1 FROM fact_sales f WHERE f.order_item_id = i.order_item_id)")

# ----- the stand-alone checks as SQL text
for _key, _same in {
    "check_null_city": "dqsql_01", "check_repeated_customers": "dqsql_02", "check_missing_category": "dqsql_03",
    "check_negative_quantity": "dqsql_04", "check_prices": "dqsql_05", "check_payment_amounts": "dqsql_06",
    "check_orders_of_unknown_customers": "dqsql_07", "check_items_of_unknown_products": "dqsql_07b",
    "check_payments_of_unknown_orders": "dqsql_07c", "check_order_dates": "dqsql_08", "check_order_statuses": "dqsql_09a",
    "check_payment_statuses": "dqsql_09b",
}.items():
    Q[f"sql_{_key}"] = Q[_same]


def oracle_sql() -> dict[str, str]:
    return {k: PREFIX + v for k, v in Q.items()}
