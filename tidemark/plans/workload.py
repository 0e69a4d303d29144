"""Retail tables derived from the driver's tables. The texts run on Spark, and in DuckDB as common table expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

AS_OF = "1999-01-01 00:00:00"

TABLES = {
    "w_orders": """SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_custkey % 25 AS int) AS store_id,
        CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'cancelled' ELSE 'picking' END AS status,
        CASE WHEN o_orderstatus = 'O' THEN CASE o_orderkey % 4 WHEN 0 THEN 'customer_cancelled' WHEN 1 THEN 'payment_failed' WHEN 2 THEN 'items_unavailable' ELSE 'system_recovery' END END AS cancel_reason,
        CASE WHEN o_orderkey % 3 = 0 THEN concat('PROMO', CAST(o_orderkey % 5 AS string)) END AS promo_code,
        CAST(o_totalprice AS decimal(18,2)) AS subtotal, CAST(CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 50 ELSE 0 END AS decimal(18,2)) AS discount, CAST(25 AS decimal(18,2)) AS delivery_fee,
        CAST(CAST(o_totalprice AS decimal(18,2)) - CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 50 ELSE 0 END + 25 AS decimal(18,2)) AS total,
        CAST(CASE WHEN o_orderkey % 4 = 0 THEN 5 END AS decimal(8,2)) AS tip_amount, 'upi' AS payment_method, CAST(10 + o_orderkey % 20 AS int) AS promised_minutes, CAST(o_orderkey % 9 AS double) AS distance_km,
        o_orderdate AS placed_at,
        CASE WHEN o_orderstatus <> 'O' OR o_orderkey % 2 = 0 THEN o_orderdate + INTERVAL '1' MINUTE * (1 + o_orderkey % 3) END AS accepted_at,
        CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL '1' MINUTE * (4 + o_orderkey % 3) END AS picking_started_at,
        CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL '1' MINUTE * (7 + o_orderkey % 4) END AS packed_at,
        CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL '1' MINUTE * (12 + o_orderkey % 3) END AS dispatched_at,
        CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL '1' MINUTE * (14 + o_orderkey % 23) END AS delivered_at,
        CASE WHEN o_orderstatus = 'O' THEN o_orderdate + INTERVAL '1' MINUTE * 3 END AS cancelled_at, o_orderdate AS _ingested_at
        FROM orders""",
    "w_items": """SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS bigint) AS quantity, CAST(l_extendedprice AS decimal(18,2)) AS line_total, CAST(l_extendedprice AS decimal(18,2)) AS unit_price,
        CAST(l_extendedprice AS decimal(18,2)) AS mrp, CASE WHEN l_linenumber % 5 = 0 THEN l_suppkey END AS substituted_for_product_id, l_shipdate AS _ingested_at FROM lineitem""",
    "w_refunds": "SELECT o_orderkey AS order_id, CAST(5 + o_orderkey % 7 AS decimal(18,2)) AS amount, o_orderdate AS _ingested_at FROM orders WHERE o_orderkey % 11 = 0",
    "w_payments": "SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 13 = 0 THEN 'failed' ELSE 'captured' END AS payment_status FROM orders",
    "w_assignments": """SELECT o_orderkey AS order_id, CAST(o_orderkey % 40 AS int) AS rider_id, o_orderdate + INTERVAL '1' MINUTE * (7 + o_orderkey % 4) AS assigned_at,
        o_orderdate + INTERVAL '1' MINUTE * (14 + o_orderkey % 23) AS delivered_at, CAST(o_orderkey % 9 AS double) AS distance_km FROM orders WHERE o_orderstatus = 'F'""",
    "w_shifts": """SELECT DISTINCT CAST(o_orderkey % 40 AS int) AS rider_id, CAST(o_custkey % 25 AS int) AS store_id, date_trunc('day', o_orderdate) AS started_at,
        CASE WHEN o_orderkey % 40 < 35 THEN date_trunc('day', o_orderdate) + INTERVAL '1' MINUTE * 480 END AS ended_at FROM orders WHERE o_orderkey % 8 < 5""",
    "w_products": """SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS brand, p_size % 10 AS category_id, CAST(p_retailprice AS decimal(18,2)) AS mrp,
        CAST(CAST(p_retailprice AS decimal(18,2)) * CAST(0.9 AS decimal(3,2)) AS decimal(18,2)) AS selling_price, CASE WHEN p_partkey % 3 = 0 THEN 'open_food_facts' ELSE 'simulated' END AS catalogue_source,
        CASE WHEN p_partkey % 4 = 0 THEN 'open_prices' ELSE 'simulated' END AS price_source,
        concat(CAST(p_size AS string), ' g') AS unit, p_partkey % 9 <> 0 AS is_active, CASE p_partkey % 6 WHEN 0 THEN 'a' WHEN 1 THEN 'c' END AS nutriscore_grade FROM part""",
    "w_categories": "SELECT DISTINCT p_size % 10 AS category_id, concat('category ', CAST(p_size % 10 AS string)) AS category_name, p_size % 10 < 3 AS is_perishable FROM part",
    "w_stores": "SELECT n_nationkey AS store_id, n_name AS store_name, n_regionkey AS city_id FROM nation",
    "w_cities": "SELECT r_regionkey AS city_id, r_name AS city_name, r_name AS state FROM region",
    "w_customers": "SELECT c_custkey AS customer_id, c_nationkey AS city_id, CAST('1992-01-01 00:00:00' AS timestamp) AS signup_at FROM customer",
    "w_prices": """SELECT l_orderkey * 10 + l_linenumber AS price_id, min(l_partkey) AS market_product_id, CAST(min(l_suppkey) % 3 AS int) AS location_id, CAST(min(l_partkey) AS string) AS product_code,
        min(l_returnflag) AS currency, CAST(min(l_extendedprice) AS decimal(14,2)) AS price, min(l_discount) > 0.05 AS is_discounted, CAST(min(l_shipdate) AS date) AS observed_on, min(l_shipdate) AS source_created_at
        FROM lineitem GROUP BY l_orderkey * 10 + l_linenumber""",
    "w_market_products": "SELECT p_partkey AS market_product_id, CAST(p_partkey AS string) AS product_code, p_name AS product_name, p_brand AS brand, CASE WHEN p_partkey % 10 > 0 THEN p_type END AS category_tag FROM part",
    "w_locations": "SELECT n_nationkey AS location_id, n_name AS shop_name, concat('city ', n_name) AS city, substring(n_name, 1, 2) AS country_code FROM nation",
    # a change log: one key for each user; the first event of a user may be of any kind
    "w_log": """SELECT user_id AS id, event_id AS _lsn, CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS _op, CASE WHEN event_type <> 'error' THEN event_type END AS kind,
        CASE WHEN event_type <> 'error' THEN CAST(floor(value) AS bigint) END AS amount, ts AS _source_ts, ts AS _ingested_at FROM events""",
    "w_stock": """SELECT CAST(user_id % 10 AS int) AS store_id, user_id AS product_id, event_id AS _lsn, CASE WHEN event_type = 'error' THEN 'd' WHEN event_type = 'signup' THEN 'c' ELSE 'u' END AS _op,
        CASE WHEN event_type <> 'error' THEN CASE WHEN value < 5 THEN 0 ELSE CAST(floor(value) AS int) END END AS on_hand, 10 AS reorder_point, ts AS updated_at, ts AS _source_ts FROM events""",
}


BASES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


class Frames:
    """The derived tables by name; each is analysed, and its given tables opened, when it is first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self.made = spark, sf_dir, {}

    def base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        """A text over the given tables."""
        used = [n for n in BASES if f"FROM {n}" in text]
        for n in used:
            text = text.replace(f"FROM {n}", f"FROM {{{n}}}")
        return self.spark.sql(text, **{n: self.base(n) for n in used})

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.made:
            self.made[name] = self.sql(TABLES[name])
        return self.made[name]


def tables(spark: SparkSession, sf_dir: str) -> Frames:
    return Frames(spark, sf_dir)


def duckdb(*names: str) -> str:
    """The derived tables as the start of a DuckDB query."""
    return "WITH " + ",\n".join(f"{n} AS ({TABLES[n].replace('AS string', 'AS varchar')})" for n in names)
