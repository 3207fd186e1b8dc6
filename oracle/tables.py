"""Common table expressions that spell out the raw tables' binding to the star schema."""

BRONZE = """
bronze_customers AS (
  SELECT c_custkey AS customer_id,
         c_name AS customer_name,
         CASE WHEN c_custkey % 33 = 0 THEN NULL ELSE 'user' || CAST(c_custkey AS VARCHAR) || '@example.com' END AS email,
         CASE WHEN c_custkey % 10 < 3 THEN ' ' || lower(market_segment) ELSE market_segment END AS segment,
         CAST(CAST(DATE '1994-01-01' + CAST(c_custkey * 11 % 365 AS INTEGER) AS DATE) AS VARCHAR) AS signup_date,
         c_custkey * 17 % 5001 AS loyalty_points,
         CAST(CAST(DATE '1965-01-01' + CAST(c_custkey * 37 % 14244 AS INTEGER) AS DATE) AS VARCHAR) AS birth_date,
         c_custkey % 25 = 0 AS is_internal
  FROM (
    SELECT *,
           CASE c_mktsegment WHEN 'MACHINERY' THEN 'Corporate' WHEN 'BUILDING' THEN 'Corporate'
                             WHEN 'HOUSEHOLD' THEN 'Consumer' ELSE 'SMB' END AS market_segment
    FROM customer
  ) AS c
),
bronze_orders AS (
  SELECT l.l_orderkey AS order_id,
         l.l_orderkey * 10 + l.l_linenumber AS order_line_id,
         o.o_custkey AS customer_id,
         l.l_partkey AS product_id,
         c.c_nationkey AS geo_id,
         CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) AS order_date,
         CASE l.l_orderkey % 4 WHEN 0 THEN 'Mobile' WHEN 1 THEN 'Web' WHEN 2 THEN 'Store' ELSE 'Partner' END
           AS order_channel,
         CAST(l.l_quantity AS BIGINT) AS quantity,
         CAST(l.l_discount AS DECIMAL(4,2)) AS discount_pct,
         CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4))
           AS net_amount,
         CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(0.01 AS DECIMAL(3,2))
              * CAST(30 + l.l_partkey % 31 AS DECIMAL(3,0)) AS DECIMAL(18,4)) AS cogs_amount,
         ROW_NUMBER() OVER (
           PARTITION BY l.l_orderkey, l.l_linenumber
           ORDER BY l.l_shipdate, l.l_partkey, l.l_suppkey, l.l_extendedprice, l.l_quantity, l.l_discount, l.l_tax,
                    l.l_returnflag, l.l_linestatus
         ) AS copy_number
  FROM lineitem AS l
  JOIN orders AS o ON o.o_orderkey = l.l_orderkey
  JOIN customer AS c ON c.c_custkey = o.o_custkey
)"""

GOLD = """
dim_customers AS (
  SELECT customer_id, customer_name, email,
         CASE upper(trim(segment)) WHEN 'SMB' THEN 'SMB' WHEN 'CONSUMER' THEN 'Consumer'
                                   WHEN 'CORPORATE' THEN 'Corporate' ELSE segment END AS segment,
         CAST(signup_date AS DATE) AS signup_date, loyalty_points, CAST(birth_date AS DATE) AS birth_date, is_internal
  FROM bronze_customers
),
dim_products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, 'Electronics' AS category, p_type AS subcategory,
         CAST(p_retailprice AS DECIMAL(18,2)) AS list_price,
         CAST(CAST(p_retailprice AS DECIMAL(18,2)) * CAST(0.45 AS DECIMAL(3,2)) AS DECIMAL(18,4)) AS standard_cost
  FROM part
),
dim_geography AS (
  SELECT n_nationkey AS geo_id,
         CASE n_nationkey % 11 WHEN 0 THEN 'CA' WHEN 1 THEN 'NY' WHEN 2 THEN 'TX' WHEN 3 THEN 'IL' WHEN 4 THEN 'WA'
                               WHEN 5 THEN 'FL' WHEN 6 THEN 'MA' WHEN 7 THEN 'ON' WHEN 8 THEN 'QC' WHEN 9 THEN 'BC'
                               ELSE 'AB' END AS state_code,
         r_name AS region_name,
         CASE WHEN n_nationkey % 11 >= 7 THEN 'CA' ELSE 'US' END AS country_code,
         CASE WHEN n_nationkey % 11 >= 7 THEN 'Canada' ELSE 'United States' END AS country_name
  FROM nation JOIN region ON r_regionkey = n_regionkey
),
fact_orders AS (
  SELECT order_id, order_line_id, customer_id, product_id, geo_id, CAST(order_date AS DATE) AS order_date,
         order_channel, quantity, discount_pct, net_amount, cogs_amount
  FROM bronze_orders WHERE copy_number = 1
),
order_headers AS (
  SELECT order_id, min(customer_id) AS customer_id, min(geo_id) AS geo_id, min(order_date) AS order_date,
         sum(net_amount) AS amount
  FROM fact_orders GROUP BY order_id
),
fact_transactions AS (
  SELECT order_id AS transaction_id, order_id, customer_id,
         CASE (order_id // 4) % 4 WHEN 0 THEN 'PM01' WHEN 1 THEN 'PM02' WHEN 2 THEN 'PM03' ELSE 'PM04' END
           AS payment_method,
         order_date AS txn_date, amount,
         CASE WHEN order_id * 37 % 100 < 80 THEN 'COMPLETED' WHEN order_id * 37 % 100 < 90 THEN 'REFUNDED'
              WHEN order_id * 37 % 100 < 96 THEN 'FAILED' ELSE 'PENDING' END AS status,
         CASE WHEN geo_id % 11 >= 7 THEN 'CAD' ELSE 'USD' END AS currency
  FROM order_headers
),
fact_shipments AS (
  SELECT order_id + 1000000000 AS shipment_id, order_id, geo_id,
         CASE (order_id // 16) % 4 WHEN 0 THEN 'USPS' WHEN 1 THEN 'FedEx' WHEN 2 THEN 'UPS' ELSE 'DHL' END AS carrier,
         CAST(order_date + CAST(order_id % 4 AS INTEGER) AS DATE) AS ship_date,
         CAST(order_date + CAST(order_id % 4 + 2 + order_id * 7 % 9 AS INTEGER) AS DATE) AS delivery_date,
         CAST(CAST(675 + order_id * 13 % 1741 AS DECIMAL(10,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2))
           AS shipping_cost,
         2 + order_id * 7 % 9 AS delivery_days,
         2 + order_id * 7 % 9 <= 6 AS on_time_flag
  FROM order_headers WHERE (order_id // 100) % 25 >= 3
)"""


def over_schema(body: str, *more: str) -> str:
    """A statement over the star schema; ``more`` are further common table expressions."""
    return f"WITH {','.join([BRONZE, GOLD, *more])}\n{body}"
