"""One SQL statement per registered query."""

from __future__ import annotations

from martlens.plans.parameters import TABLE_PARAMETERS
from martlens.plans.queries import ORDER_DIMENSIONS, SHIPMENT_DIMENSIONS, USER_TERMS
from martlens.plans.truths import QUESTIONS, answers
from oracle.tables import over_schema

P = TABLE_PARAMETERS

COLLECTED = """
collected AS (
  SELECT f.*, t.payment_method, t.currency
  FROM fact_orders AS f JOIN fact_transactions AS t ON t.order_id = f.order_id
  WHERE t.status = 'COMPLETED'
)"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


# ---- layers ------------------------------------------------------------------------------------------------------

CUSTOMER_COLUMNS = "customer_id, customer_name, email, segment, signup_date, loyalty_points, birth_date, is_internal"
PRODUCT_COLUMNS = """product_id, product_name, category, subcategory,
  CAST(list_price AS DOUBLE) AS list_price, CAST(standard_cost AS DOUBLE) AS standard_cost"""
GEOGRAPHY_COLUMNS = "geo_id, state_code, region_name, country_code, country_name"
LINE_COLUMNS = """order_id, order_line_id, customer_id, product_id, geo_id, order_date, order_channel, quantity,
  CAST(discount_pct AS DOUBLE) AS discount_pct, CAST(net_amount AS DOUBLE) AS net_amount,
  CAST(cogs_amount AS DOUBLE) AS cogs_amount"""
PAYMENT_COLUMNS = """transaction_id, order_id, customer_id, payment_method, txn_date,
  CAST(amount AS DOUBLE) AS amount, status, currency"""
SHIPMENT_COLUMNS = """shipment_id, order_id, geo_id, carrier, ship_date, delivery_date,
  CAST(shipping_cost AS DOUBLE) AS shipping_cost, delivery_days, on_time_flag"""

RAW_SHIPMENTS = """
bronze_shipments AS (
  SELECT * REPLACE (CASE WHEN order_id % 10 < 3 THEN ' ' || lower(carrier) ELSE carrier END AS carrier)
  FROM fact_shipments
)"""


def _dates_as_text(columns: str, *dates: str) -> str:
    for name in dates:
        columns = columns.replace(name, f"CAST({name} AS VARCHAR) AS {name}")
    return columns


def _layers() -> dict[str, str]:
    gold = {
        "customers": over_schema(f"SELECT {CUSTOMER_COLUMNS} FROM dim_customers"),
        "products": over_schema(f"SELECT {PRODUCT_COLUMNS} FROM dim_products"),
        "geography": over_schema(f"SELECT {GEOGRAPHY_COLUMNS} FROM dim_geography"),
        "orders": over_schema(f"SELECT {LINE_COLUMNS} FROM fact_orders"),
        "transactions": over_schema(f"SELECT {PAYMENT_COLUMNS} FROM fact_transactions"),
        "shipments": over_schema(f"SELECT {SHIPMENT_COLUMNS} FROM fact_shipments"),
    }
    found = {f"p6_silver_{name}": sql for name, sql in gold.items()}
    for name, sql in gold.items():
        kind = "dim" if name in ("customers", "products", "geography") else "fact"
        found[f"p7_gold_{kind}_{name}"] = sql
    found["s3_bronze_customers"] = over_schema(f"SELECT {CUSTOMER_COLUMNS} FROM bronze_customers")
    found["s3_bronze_products"] = gold["products"]
    found["s3_bronze_geography"] = gold["geography"]
    found["s3_bronze_orders"] = over_schema(f"SELECT {LINE_COLUMNS} FROM bronze_orders")
    found["s3_bronze_transactions"] = over_schema(
        f"SELECT {_dates_as_text(PAYMENT_COLUMNS, 'txn_date')} FROM fact_transactions"
    )
    found["s3_bronze_shipments"] = over_schema(
        f"SELECT {_dates_as_text(SHIPMENT_COLUMNS, 'ship_date', 'delivery_date')} FROM bronze_shipments", RAW_SHIPMENTS
    )
    found["s3_landed_matches"] = """
        SELECT 'lineitem' AS left_table, 'orders' AS right_table, count(*) AS rows,
          count(*) FILTER (l_orderkey IN (SELECT o_orderkey FROM orders)) AS matched_rows FROM lineitem
        UNION ALL SELECT 'orders', 'customer', count(*),
          count(*) FILTER (o_custkey IN (SELECT c_custkey FROM customer)) FROM orders
        UNION ALL SELECT 'nation', 'region', count(*),
          count(*) FILTER (n_regionkey IN (SELECT r_regionkey FROM region)) FROM nation"""
    tables = [
        "dim_customers",
        "dim_products",
        "dim_geography",
        "fact_orders",
        "fact_transactions",
        "fact_shipments",
    ]
    found["p7_table_row_counts"] = over_schema(
        "\nUNION ALL ".join(
            f"SELECT '{name}' AS table_name, count(*) AS written_rows, count(*) AS rows FROM {name}" for name in tables
        )
    )
    found["p1_canonical_values"] = over_schema(
        """SELECT 'segment' AS column_name, b.segment AS raw_value, d.segment AS value, count(*) AS rows
        FROM bronze_customers AS b JOIN dim_customers AS d USING (customer_id) GROUP BY b.segment, d.segment
        UNION ALL
        SELECT 'carrier', b.carrier, f.carrier, count(*)
        FROM bronze_shipments AS b JOIN fact_shipments AS f USING (shipment_id) GROUP BY b.carrier, f.carrier""",
        RAW_SHIPMENTS,
    )
    found["s8_line_preview"] = over_schema(f"SELECT {LINE_COLUMNS} FROM fact_orders ORDER BY order_line_id LIMIT 10")
    return found


# ---- declared joins ----------------------------------------------------------------------------------------------

JOINED = [
    ("fact_orders", "dim_products", "product_id"),
    ("fact_orders", "dim_geography", "geo_id"),
    ("fact_orders", "dim_customers", "customer_id"),
    ("fact_orders", "fact_transactions", "order_id"),
    ("fact_orders", "fact_shipments", "order_id"),
    ("fact_transactions", "fact_shipments", "order_id"),
    ("fact_shipments", "dim_geography", "geo_id"),
]


def _edges() -> dict[str, str]:
    matches = [
        f"""SELECT '{left}' AS left_table, '{right}' AS right_table, count(*) AS rows, count(r.{key}) AS matched_rows
        FROM {left} AS l LEFT JOIN {right} AS r ON r.{key} = l.{key}"""
        for left, right, key in JOINED
    ]
    repeats = [
        f"""SELECT '{left}' AS left_table, '{right}' AS right_table, count(*) AS repeated_keys
        FROM (SELECT {key} FROM {right} GROUP BY {key} HAVING count(*) > 1) AS k"""
        for left, right, key in JOINED
    ]
    return {
        "j7_edge_matches": over_schema("\nUNION ALL\n".join(matches)),
        "mvk_edge_repeats": over_schema("\nUNION ALL\n".join(repeats)),
    }


# ---- metric views ------------------------------------------------------------------------------------------------

ORDER_MEASURES = {
    "Total Revenue": "CAST(sum(net_amount) AS DOUBLE)",
    "Total COGS": "CAST(sum(cogs_amount) AS DOUBLE)",
    "Gross Profit": "CAST(sum(net_amount - cogs_amount) AS DOUBLE)",
    "Gross Margin Pct": "CAST(sum(net_amount - cogs_amount) AS DOUBLE) / nullif(CAST(sum(net_amount) AS DOUBLE), 0)",
    "Order Count": "count(DISTINCT order_id)",
    "Units Sold": "CAST(sum(quantity) AS BIGINT)",
    "Average Order Value": "CAST(sum(net_amount) AS DOUBLE) / nullif(CAST(count(DISTINCT order_id) AS DOUBLE), 0)",
}
ORDER_KEYS = {
    "Order Month": "CAST(date_trunc('month', order_date) AS DATE)",
    "Order Channel": "order_channel",
    "Region": "region_name",
    "State": "state_code",
    "Country": "country_name",
    "Category": "category",
    "Subcategory": "subcategory",
    "Product": "product_name",
    "Customer Segment": "segment",
    "Payment Method": "payment_method",
    "Currency": "currency",
}
ORDER_ROWS = """collected
  LEFT JOIN dim_products USING (product_id) LEFT JOIN dim_geography USING (geo_id)
  LEFT JOIN dim_customers USING (customer_id)"""
SHIPMENT_MEASURES = {
    "Shipment Count": "count(*)",
    "On Time Count": "count(*) FILTER (WHERE on_time_flag)",
    "On Time Rate": "CAST(count(*) FILTER (WHERE on_time_flag) AS DOUBLE) / count(*)",
    "Average Delivery Days": "avg(delivery_days)",
    "Total Shipping Cost": "CAST(sum(shipping_cost) AS DOUBLE)",
}
SHIPMENT_KEYS = {
    "Ship Month": "CAST(date_trunc('month', ship_date) AS DATE)",
    "Region": "region_name",
    "State": "state_code",
    "Carrier": "carrier",
}
SHIPMENT_ROWS = "fact_shipments LEFT JOIN dim_geography USING (geo_id)"


def _metric(rows: str, keys: dict[str, str], measures: dict[str, str], dims=(), names=None, where="", tail="") -> str:
    columns = [f'{keys[d]} AS "{d}"' for d in dims]
    columns += [f'{measures[m]} AS "{m}"' for m in (names or measures)]
    grouped = f"GROUP BY {', '.join(keys[d] for d in dims)}" if dims else ""
    return over_schema(f"SELECT {', '.join(columns)} FROM {rows} {where} {grouped} {tail}", COLLECTED)


def _orders(dims=(), names=None, where="", tail="") -> str:
    return _metric(ORDER_ROWS, ORDER_KEYS, ORDER_MEASURES, dims, names, where, tail)


def _shipments(dims=(), names=None, tail="") -> str:
    return _metric(SHIPMENT_ROWS, SHIPMENT_KEYS, SHIPMENT_MEASURES, dims, names, tail=tail)


def _metric_views() -> dict[str, str]:
    found = {"mv1_total": _orders(), "mv2_total": _shipments()}
    found.update({f"mv1_by_{short}": _orders([name]) for short, name in ORDER_DIMENSIONS.items()})
    found.update({f"mv2_by_{short}": _shipments([name]) for short, name in SHIPMENT_DIMENSIONS.items()})
    found["mv1_by_region_segment"] = _orders(["Region", "Customer Segment"])
    found["mv1_web_by_country"] = _orders(
        ["Country", "Currency"],
        ["Total Revenue", "Order Count"],
        where="WHERE order_channel = 'Web' AND subcategory IS NOT NULL",
    )
    found["mvq1_best_subcategories"] = _orders(
        ["Subcategory"],
        ["Gross Margin Pct", "Total Revenue"],
        tail='ORDER BY "Total Revenue" DESC, "Subcategory" LIMIT 5',
    )
    found["mvq2_punctual_regions"] = _shipments(["Region"], ["On Time Rate", "Shipment Count"])
    found["b16_on_time_rate_by_region"] = _shipments(["Region"], ["On Time Rate"])
    found["b17_margin_by_subcategory"] = _orders(["Subcategory"], ["Gross Margin Pct"])
    found["b18_order_value_by_segment"] = _orders(["Customer Segment"], ["Average Order Value"])
    found["b19_revenue_by_month"] = _orders(["Order Month"], ["Total Revenue"], tail='ORDER BY "Order Month"')
    found["b20_margin_by_channel"] = _orders(["Order Channel"], ["Gross Margin Pct"])
    found["b21_delivery_days_by_carrier"] = _shipments(["Carrier"], ["Average Delivery Days"])
    found["b22_gross_profit"] = _orders(names=["Gross Profit"])
    found["b23_completed_orders"] = _orders(names=["Order Count"])
    found["b37_latest_month_summary"] = _orders(
        names=["Total Revenue", "Order Count", "Gross Margin Pct"],
        where="WHERE date_trunc('month', order_date) = (SELECT date_trunc('month', max(order_date)) FROM fact_orders)",
    )
    return found


# ---- bank and worked examples ------------------------------------------------------------------------------------

REVENUE = "CAST(sum(net_amount) AS DOUBLE) AS revenue"
AGE_GROUP = f"""CASE WHEN date_diff('day', birth_date, DATE '{P.age_as_of}') / 365.0 < 25 THEN 'Under 25'
  WHEN date_diff('day', birth_date, DATE '{P.age_as_of}') / 365.0 < 40 THEN '25-39'
  WHEN date_diff('day', birth_date, DATE '{P.age_as_of}') / 365.0 < 60 THEN '40-59' ELSE '60+' END"""
ORDER_SIZE = f"""CASE WHEN net_amount < {P.small_below} THEN 'Small' WHEN net_amount < {P.medium_below} THEN 'Medium'
  ELSE 'Large' END"""
NET_OF_REFUNDS = """sum(amount) FILTER (WHERE status = 'COMPLETED')
  - coalesce(sum(amount) FILTER (WHERE status = 'REFUNDED'), 0)"""
UNSHIPPED = "order_id NOT IN (SELECT order_id FROM fact_shipments)"
FISCAL = "(order_date - INTERVAL 1 MONTH)"

BODIES = {
    "b01_net_amount_total": "SELECT CAST(sum(net_amount) AS DOUBLE) AS total_net_amount FROM fact_orders",
    "b02_orders_per_channel": """SELECT order_channel, count(*) AS orders
        FROM (SELECT DISTINCT order_channel, order_id FROM fact_orders) AS d GROUP BY order_channel""",
    "b03_customers_per_segment": "SELECT segment, count(*) AS customers FROM dim_customers GROUP BY segment",
    "b04_average_delivery_days": "SELECT avg(delivery_days) AS average_days FROM fact_shipments",
    "b05_products_per_subcategory": "SELECT subcategory, count(*) AS products FROM dim_products GROUP BY subcategory",
    "b06_units_total": "SELECT CAST(sum(quantity) AS BIGINT) AS units FROM fact_orders",
    "b07_dearest_product": """SELECT product_name, CAST(list_price AS DOUBLE) AS list_price FROM dim_products
        ORDER BY dim_products.list_price DESC, product_id LIMIT 1""",
    "b08_shipments_per_carrier": "SELECT carrier, count(*) AS shipments FROM fact_shipments GROUP BY carrier",
    "b09_paypal_revenue": """SELECT CAST(sum(amount) AS DOUBLE) AS revenue FROM fact_transactions
        WHERE payment_method = 'PM02' AND status = 'COMPLETED'""",
    "b10_credit_card_orders": """SELECT count(DISTINCT order_id) AS orders FROM fact_transactions
        WHERE payment_method = 'PM01' AND status = 'COMPLETED'""",
    "b11_gift_card_amount": """SELECT CAST(sum(amount) AS DOUBLE) AS revenue FROM fact_transactions
        WHERE payment_method = 'PM03' AND status = 'COMPLETED'""",
    "b12_revenue_california": f"SELECT {REVENUE} FROM collected JOIN dim_geography USING (geo_id) WHERE state_code = 'CA'",
    "b13_orders_to_ontario": """SELECT count(DISTINCT order_id) AS orders
        FROM fact_shipments JOIN dim_geography USING (geo_id) WHERE state_code = 'ON'""",
    "b14_cad_transactions": "SELECT count(*) AS transactions FROM fact_transactions WHERE currency = 'CAD'",
    "b15_refunded_transactions": "SELECT count(*) AS transactions FROM fact_transactions WHERE status = 'REFUNDED'",
    "b24_customers_with_unshipped": f"""SELECT DISTINCT customer_id, customer_name
        FROM fact_orders JOIN dim_customers USING (customer_id) WHERE {UNSHIPPED}""",
    "b25_refunded_but_shipped": """SELECT order_id FROM fact_transactions WHERE status = 'REFUNDED'
        INTERSECT SELECT order_id FROM fact_shipments""",
    "b26_revenue_net_of_refunds": f"SELECT CAST({NET_OF_REFUNDS} AS DOUBLE) AS net_revenue FROM fact_transactions",
    "b27_unshipped_orders": f"SELECT count(DISTINCT order_id) AS orders FROM fact_orders WHERE {UNSHIPPED}",
    "b28_high_value_lines": f"""SELECT order_id, CAST(net_amount AS DOUBLE) AS net_amount
        FROM fact_orders WHERE net_amount > {P.high_value} ORDER BY 2 DESC""",
    "b29_top_customers": f"""SELECT customer_id, {REVENUE} FROM collected
        GROUP BY customer_id ORDER BY sum(net_amount) DESC, customer_id LIMIT 10""",
    "b30_revenue_by_age_group": f"""SELECT {AGE_GROUP} AS age_group, {REVENUE}
        FROM collected JOIN dim_customers USING (customer_id) GROUP BY 1""",
    "b31_refund_rate": """SELECT CAST(count(*) FILTER (WHERE status = 'REFUNDED') AS DOUBLE) / count(*) AS refund_rate
        FROM fact_transactions""",
    "b32_region_most_unshipped": f"""SELECT region_name, count(DISTINCT order_id) AS orders
        FROM fact_orders JOIN dim_geography USING (geo_id) WHERE {UNSHIPPED}
        GROUP BY region_name ORDER BY orders DESC, region_name LIMIT 1""",
    "b33_fiscal_quarter_revenue": f"""SELECT {REVENUE} FROM collected
        WHERE order_date >= DATE '2001-05-01' AND order_date <= DATE '2001-07-31'""",
    "b34_revenue_without_internal": f"""SELECT {REVENUE} FROM collected JOIN dim_customers USING (customer_id)
        WHERE NOT is_internal""",
    "b35_active_customers": f"""SELECT count(DISTINCT customer_id) AS customers
        FROM fact_orders, (SELECT max(order_date) AS latest FROM fact_orders) AS m
        WHERE date_diff('day', order_date, latest) <= {P.active_days}""",
    "b36_revenue_with_internal": f"SELECT {REVENUE} FROM collected",
    "b38_internal_accounts": "SELECT count(*) AS customers FROM dim_customers WHERE is_internal",
    "b39_revenue_by_country": f"""SELECT country_name, {REVENUE}
        FROM collected JOIN dim_customers USING (customer_id) JOIN dim_geography USING (geo_id)
        WHERE NOT is_internal GROUP BY country_name""",
    "b40_corporate_share": """SELECT CAST(sum(net_amount) FILTER (WHERE segment = 'Corporate') AS DOUBLE)
          / CAST(sum(net_amount) AS DOUBLE) AS corporate_share
        FROM collected JOIN dim_customers USING (customer_id)""",
    "x1_unshipped_customers": """SELECT customer_id, customer_name FROM dim_customers
        WHERE customer_id IN (
          SELECT customer_id FROM fact_orders ANTI JOIN fact_shipments USING (order_id))""",
    "x2_refunded_and_shipped": """SELECT DISTINCT order_id, CAST(amount AS DOUBLE) AS amount, ship_date
        FROM fact_transactions JOIN fact_shipments USING (order_id) WHERE status = 'REFUNDED'""",
    "x3_top_products": """SELECT product_name, CAST(round(sum(net_amount), 2) AS DOUBLE) AS revenue
        FROM collected JOIN dim_products USING (product_id)
        GROUP BY product_name ORDER BY revenue DESC, product_name LIMIT 5""",
    "x4_monthly_revenue": """SELECT CAST(date_trunc('month', order_date) AS DATE) AS month,
          CAST(round(sum(net_amount), 2) AS DOUBLE) AS revenue
        FROM collected GROUP BY 1 ORDER BY 1""",
    "x5_monthly_net_revenue": f"""SELECT CAST(date_trunc('month', txn_date) AS DATE) AS month,
          CAST(round(coalesce({NET_OF_REFUNDS}, 0), 2) AS DOUBLE) AS net_revenue
        FROM fact_transactions GROUP BY 1 ORDER BY 1""",
    "x6_margin_without_internal": """SELECT subcategory,
          round(CAST(sum(net_amount - cogs_amount) AS DOUBLE) / CAST(sum(net_amount) AS DOUBLE) * 100, 1) AS margin_pct
        FROM fact_orders JOIN dim_products USING (product_id) JOIN dim_customers USING (customer_id)
        WHERE NOT is_internal GROUP BY subcategory""",
    "x7_punctuality_by_carrier": """SELECT carrier,
          round(CAST(count(*) FILTER (WHERE on_time_flag) AS DOUBLE) / count(*) * 100, 1) AS on_time_pct,
          count(*) AS shipments
        FROM fact_shipments GROUP BY carrier""",
    "x8_repeat_customers": """SELECT customer_id, count(DISTINCT order_id) AS orders,
          CAST(round(sum(net_amount), 2) AS DOUBLE) AS spend
        FROM collected GROUP BY customer_id HAVING count(DISTINCT order_id) > 1""",
    "xf1_high_value_summary": f"""SELECT order_channel, count(*) AS lines, CAST(sum(net_amount) AS DOUBLE) AS net_amount
        FROM fact_orders WHERE net_amount > {P.high_value} GROUP BY order_channel""",
    "xf2_refunds_by_method": """SELECT payment_method, count(*) AS transactions, CAST(sum(amount) AS DOUBLE) AS amount
        FROM fact_transactions WHERE status = 'REFUNDED' GROUP BY payment_method""",
    "xm1_net_revenue_by_currency": f"""SELECT currency, CAST({NET_OF_REFUNDS} AS DOUBLE) AS net_revenue
        FROM fact_transactions GROUP BY currency""",
    "xm2_customers_by_channel": """SELECT order_channel, count(DISTINCT customer_id) AS customers
        FROM fact_orders GROUP BY order_channel""",
    "xe1_customers_by_age_group": f"SELECT {AGE_GROUP} AS age_group, count(*) AS customers FROM dim_customers GROUP BY 1",
    "xe2_lines_by_order_size": f"""SELECT {ORDER_SIZE} AS order_size, count(*) AS lines,
          CAST(sum(net_amount) AS DOUBLE) AS net_amount
        FROM fact_orders GROUP BY 1""",
    "r1_revenue_by_fiscal_quarter": f"""SELECT CAST(year({FISCAL}) AS BIGINT) AS fiscal_year,
          CAST(quarter({FISCAL}) AS BIGINT) AS fiscal_quarter,
          CAST(date_trunc('quarter', {FISCAL}) + INTERVAL 1 MONTH AS DATE) AS starts_on, {REVENUE}
        FROM collected GROUP BY 1, 2, 3""",
    "r2_revenue_by_account_kind": f"""SELECT is_internal, {REVENUE}
        FROM collected JOIN dim_customers USING (customer_id) GROUP BY is_internal""",
    "r3_revenue_definitions": f"""SELECT CAST(year(txn_date) AS BIGINT) AS year,
          CAST(sum(amount) FILTER (WHERE status = 'COMPLETED') AS DOUBLE) AS revenue_completed,
          CAST({NET_OF_REFUNDS} AS DOUBLE) AS revenue_net_of_refunds
        FROM fact_transactions GROUP BY 1""",
    "r6_revenue_by_currency": """SELECT currency, CAST(sum(amount) AS DOUBLE) AS revenue
        FROM fact_transactions WHERE status = 'COMPLETED' GROUP BY currency""",
    "qa1_half_year_by_subcategory": f"""SELECT subcategory, CAST(sum(net_amount) AS DOUBLE) AS net_revenue
        FROM fact_orders JOIN dim_products USING (product_id)
        WHERE order_date >= DATE '{P.half_year[0]}' AND order_date <= DATE '{P.half_year[1]}' GROUP BY subcategory""",
    "qa2_slowest_carrier_to_canada": """SELECT carrier, avg(delivery_days) AS average_days
        FROM fact_shipments JOIN dim_geography USING (geo_id) WHERE country_name = 'Canada'
        GROUP BY carrier ORDER BY average_days DESC, carrier LIMIT 1""",
    "qa3_best_customers": """SELECT customer_id, customer_name, segment, CAST(sum(net_amount) AS DOUBLE) AS order_value
        FROM fact_orders JOIN dim_customers USING (customer_id)
        GROUP BY customer_id, customer_name, segment ORDER BY sum(net_amount) DESC, customer_id LIMIT 5""",
}


# ---- words for codes ---------------------------------------------------------------------------------------------


def _rows_of(values: list[tuple[str | None, ...]]) -> str:
    return ", ".join("(" + ", ".join("NULL" if v is None else _text(v) for v in row) + ")" for row in values)


# What each word of the business stands for, stated apart from the package.
VOCABULARY = """
vocabulary(term, column_name, code) AS (VALUES
  ('credit card', 'payment_method', 'PM01'), ('paypal', 'payment_method', 'PM02'),
  ('gift card', 'payment_method', 'PM03'), ('debit card', 'payment_method', 'PM04'),
  ('us dollars', 'currency', 'USD'), ('canadian dollars', 'currency', 'CAD'),
  ('california', 'state_code', 'CA'), ('new york', 'state_code', 'NY'), ('texas', 'state_code', 'TX'),
  ('illinois', 'state_code', 'IL'), ('washington', 'state_code', 'WA'), ('florida', 'state_code', 'FL'),
  ('massachusetts', 'state_code', 'MA'), ('ontario', 'state_code', 'ON'), ('quebec', 'state_code', 'QC'),
  ('british columbia', 'state_code', 'BC'), ('alberta', 'state_code', 'AB'),
  ('enterprise', 'segment', 'Corporate'), ('b2b', 'segment', 'Corporate'), ('small business', 'segment', 'SMB'),
  ('individual', 'segment', 'Consumer'), ('retail', 'segment', 'Consumer'),
  ('payment type', 'payment_method', NULL), ('payment method', 'payment_method', NULL),
  ('state', 'state_code', NULL), ('province', 'state_code', NULL)
)"""
LABELS = {
    "payment_method": ("fact_transactions", "PM01 Credit Card, PM02 PayPal, PM03 Gift Card, PM04 Debit Card"),
    "currency": ("fact_transactions", "USD US Dollars, CAD Canadian Dollars"),
    "state_code": (
        "dim_geography",
        "CA California, NY New York, TX Texas, IL Illinois, WA Washington, FL Florida, MA Massachusetts, ON Ontario,"
        " QC Quebec, BC British Columbia, AB Alberta",
    ),
    "segment": ("dim_customers", "Corporate Enterprise, SMB Small Business, Consumer Individual"),
}

INDEX = """
stored AS (
  SELECT 'payment_method' AS column_name, payment_method AS value, count(*) AS rows FROM fact_transactions GROUP BY 2
  UNION ALL SELECT 'currency', currency, count(*) FROM fact_transactions GROUP BY 2
  UNION ALL SELECT 'state_code', state_code, count(*) FROM dim_geography GROUP BY 2
  UNION ALL SELECT 'segment', segment, count(*) FROM dim_customers GROUP BY 2
)"""

# Every term against every word, as a plain definition of what resolving has to find.
RESOLVED = f"""
asked AS (SELECT DISTINCT lower(trim(t)) AS term FROM (VALUES {_rows_of([(t,) for t in USER_TERMS])}) AS v(t)),
known AS (
  SELECT v.term, v.column_name, v.code FROM vocabulary AS v
  JOIN stored AS s ON s.column_name = v.column_name AND s.value = v.code
  UNION SELECT lower(trim(value)), column_name, value FROM stored
),
compared AS (
  SELECT a.term, k.column_name, k.code, levenshtein(a.term, k.term) AS distance,
         min(levenshtein(a.term, k.term)) OVER (PARTITION BY a.term) AS nearest,
         CASE WHEN length(a.term) <= 2 THEN 0 WHEN length(a.term) <= 5 THEN 1 ELSE 2 END AS allowed
  FROM asked AS a CROSS JOIN known AS k
),
resolved AS (
  SELECT DISTINCT term, column_name, code, 0 AS distance FROM compared WHERE distance = 0
  UNION ALL
  SELECT term, column_name, code, CAST(distance AS INTEGER) FROM (
    SELECT *, row_number() OVER (PARTITION BY term, column_name ORDER BY distance, code) AS place
    FROM compared WHERE nearest > 0 AND distance <= allowed
  ) AS c WHERE place = 1
)"""


def _words() -> dict[str, str]:
    found = {}
    for at, (column, (table, listed)) in enumerate(LABELS.items(), start=1):
        pairs = [item.strip().split(" ", 1) for item in listed.split(",")]
        labels = " ".join(f"WHEN {_text(code)} THEN {_text(label)}" for code, label in pairs)
        found[f"v{at}_decoded_{column}"] = over_schema(
            f"SELECT {column}, count(*) AS rows, CASE {column} {labels} END AS label FROM {table} GROUP BY {column}"
        )
    found["v5_words_in_use"] = over_schema(
        """SELECT v.term, v.column_name, v.code, CAST(sum(s.rows) AS BIGINT) AS rows
        FROM vocabulary AS v JOIN stored AS s
          ON s.column_name = v.column_name AND (v.code IS NULL OR s.value = v.code)
        GROUP BY v.term, v.column_name, v.code""",
        VOCABULARY,
        INDEX,
    )
    found["v5_numbers_by_term"] = over_schema(
        f"""SELECT 'big orders' AS term, 'filter' AS kind, 'is_high_value' AS name,
          CAST(count(*) FILTER (net_amount > {P.high_value}) AS DOUBLE) AS number FROM fact_orders
        UNION ALL SELECT 'large order', 'filter', 'is_high_value',
          CAST(count(*) FILTER (net_amount > {P.high_value}) AS DOUBLE) FROM fact_orders
        UNION ALL SELECT 'refunds only', 'filter', 'is_refunded',
          CAST(count(*) FILTER (status = 'REFUNDED') AS DOUBLE) FROM fact_transactions
        UNION ALL SELECT t, 'measure', 'net_of_refunds',
          CAST(sum(CASE status WHEN 'COMPLETED' THEN amount WHEN 'REFUNDED' THEN -amount ELSE 0 END) AS DOUBLE)
          FROM fact_transactions, (VALUES ('net revenue'), ('revenu after refunds')) AS v(t) GROUP BY t
        UNION ALL SELECT 'unique customers', 'measure', 'distinct_customers',
          CAST(count(DISTINCT customer_id) AS DOUBLE) FROM fact_orders
        UNION ALL SELECT 'age bracket', 'field', 'age_group', CAST(count(DISTINCT {AGE_GROUP}) AS DOUBLE) FROM dim_customers
        UNION ALL SELECT 'basket sise', 'field', 'order_size', CAST(count(DISTINCT {ORDER_SIZE}) AS DOUBLE) FROM fact_orders""",
    )
    found["v6_stored_values"] = over_schema(
        "SELECT column_name, value, lower(trim(value)) AS term, rows FROM stored", INDEX
    )
    found["v7_resolved_terms"] = over_schema(
        "SELECT term, column_name, code, distance FROM resolved", VOCABULARY, INDEX, RESOLVED
    )
    found["v8_payments_by_term"] = over_schema(
        """SELECT payment_method, status, count(*) AS transactions, CAST(sum(amount) AS DOUBLE) AS amount
        FROM fact_transactions
        WHERE payment_method IN (SELECT code FROM resolved WHERE column_name = 'payment_method')
        GROUP BY payment_method, status""",
        VOCABULARY,
        INDEX,
        RESOLVED,
    )
    found["v8_orders_by_term"] = over_schema(
        """SELECT state_code, count(*) AS lines, CAST(sum(net_amount) AS DOUBLE) AS net_amount
        FROM fact_orders JOIN dim_geography USING (geo_id)
        WHERE state_code IN (SELECT code FROM resolved WHERE column_name = 'state_code')
        GROUP BY state_code""",
        VOCABULARY,
        INDEX,
        RESOLVED,
    )
    return found


# ---- truths and answer tables ------------------------------------------------------------------------------------


NUMBER, WHOLE, SHARE = "{:,.2f}", "{:,}", "{:,.1f}0"

# Answer -> (column, how it is shown, statement), stated apart from the package.
TRUTHS = {
    "q01_paypal_revenue": ("revenue", NUMBER, """SELECT sum(amount) FROM fact_transactions
        WHERE payment_method = 'PM02' AND status = 'COMPLETED'"""),
    "q02_gift_card_revenue": ("revenue", NUMBER, """SELECT sum(amount) FROM fact_transactions
        WHERE payment_method = 'PM03' AND status = 'COMPLETED'"""),
    "q03_enterprise_spend": ("spend", NUMBER, """SELECT sum(net_amount) FROM fact_orders
        JOIN dim_customers USING (customer_id) WHERE segment = 'Corporate'"""),
    "q04_cad_revenue": ("revenue", NUMBER, """SELECT sum(amount) FROM fact_transactions
        WHERE currency = 'CAD' AND status = 'COMPLETED'"""),
    "q05_completed_revenue": ("revenue", NUMBER, "SELECT sum(net_amount) FROM collected"),
    "t05_all_orders": ("total_net_amount", NUMBER, "SELECT sum(net_amount) FROM fact_orders"),
    "q06_order_value": ("average_order_value", NUMBER, """SELECT sum(net_amount)::DOUBLE / count(DISTINCT order_id)
        FROM fact_orders"""),
    "t06_line_average": ("average_order_value", NUMBER, "SELECT sum(net_amount)::DOUBLE / count(*) FROM fact_orders"),
    "q07_margin_pct": ("margin_pct", SHARE, """SELECT sum(net_amount - cogs_amount)::DOUBLE / sum(net_amount)::DOUBLE * 100
        FROM fact_orders"""),
    "t07_mean_line_margin": ("margin_pct", SHARE, """SELECT round(avg((net_amount::DOUBLE - cogs_amount::DOUBLE)
        / nullif(net_amount::DOUBLE, 0)) * 100, 4) FROM fact_orders"""),
    "q08_on_time_rate": ("on_time_pct", SHARE, """SELECT avg(CASE WHEN on_time_flag THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100
        FROM fact_shipments"""),
    "q09_net_of_refunds": ("net_revenue", NUMBER, """SELECT coalesce(sum(amount) FILTER (status = 'COMPLETED'), 0)
        - coalesce(sum(amount) FILTER (status = 'REFUNDED'), 0) FROM fact_transactions"""),
    "t09_refunds_ignored": ("net_revenue", NUMBER, "SELECT sum(amount) FROM fact_transactions WHERE status = 'COMPLETED'"),
    "q10_unshipped_orders": ("orders", WHOLE, """SELECT count(DISTINCT order_id) FROM fact_orders
        WHERE order_id NOT IN (SELECT order_id FROM fact_shipments)"""),
    "q11_refunded_and_shipped": ("orders", WHOLE, """SELECT count(DISTINCT t.order_id) FROM fact_transactions AS t
        JOIN fact_shipments AS s ON s.order_id = t.order_id WHERE t.status = 'REFUNDED'"""),
    "q12_fiscal_quarter": ("revenue", NUMBER, """SELECT sum(net_amount) FROM collected
        WHERE order_date >= DATE '2001-05-01' AND order_date < DATE '2001-08-01'"""),
    "t12_calendar_quarter": ("revenue", NUMBER, """SELECT sum(net_amount) FROM collected
        WHERE order_date >= DATE '2001-04-01' AND order_date < DATE '2001-07-01'"""),
    "q13_active_customers": ("customers", WHOLE, """SELECT count(DISTINCT customer_id) FROM fact_orders
        WHERE date_diff('day', order_date, (SELECT max(order_date) FROM fact_orders)) <= 90"""),
    "t13_customers_ever": ("customers", WHOLE, "SELECT count(DISTINCT customer_id) FROM fact_orders"),
    "q14_without_internal": ("revenue", NUMBER, """SELECT sum(net_amount) FROM collected
        JOIN dim_customers USING (customer_id) WHERE NOT is_internal"""),
    "t14_with_internal": ("revenue", NUMBER, "SELECT sum(net_amount) FROM collected"),
}


def _truths() -> dict[str, str]:
    return {
        id: over_schema(f"SELECT CAST(({sql}) AS {'BIGINT' if shown == WHOLE else 'DOUBLE'}) AS {column}", COLLECTED)
        for id, (column, shown, sql) in TRUTHS.items()
    }


def _answer_tables() -> dict[str, str]:
    """The wording of questions and of the SQL shown beside them is the package's own; the numbers are not."""
    known = answers(P)

    def number(id: str) -> str:
        _, shown, sql = TRUTHS[id]
        if shown == WHOLE:
            return f"format('{WHOLE}', ({sql}))"
        return f"format('{shown}', CAST(round(({sql}), {2 if shown == NUMBER else 1}) AS DOUBLE))"

    found = {}
    for step in sorted({q.step for q in QUESTIONS}):
        rows = []
        for q in QUESTIONS:
            if q.step != step:
                continue
            right = number(q.right) if q.right else _text(q.note)
            wrong = f"{number(q.wrong)} || {_text(f'  ({q.mistake})')}" if q.wrong else _text(q.mistake)
            rows.append(
                f"""SELECT {_text(q.group)} AS "set", {_text(q.text)} AS question, {right} AS correct_answer,
                {_text(known[q.right].sql if q.right else '')} AS correct_sql, {wrong} AS naive_or_trap_answer,
                {_text(q.why)} AS why_agent_fails"""
            )
        found[f"e2_answers_step{step}"] = over_schema("\nUNION ALL\n".join(rows), COLLECTED)
    return found


def statements() -> dict[str, str]:
    found = {name: over_schema(body, COLLECTED) for name, body in BODIES.items()}
    for part in (_layers, _edges, _metric_views, _words, _truths, _answer_tables):
        found.update(part())
    return found
