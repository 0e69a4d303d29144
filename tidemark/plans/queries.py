"""Queries of the library's operators over tables derived from the driver's, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import cdc, history, incremental, quality
from tidemark.plans import models
from tidemark.plans.workload import AS_OF, Frames, duckdb, tables

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def rounded(df: DataFrame) -> DataFrame:
    """Decimals as DOUBLE, six places: both engines then agree on sums in any order."""
    six = lambda f: F.round(F.col(f"`{f.name}`").cast("double"), 6).alias(f.name)
    return df.select(*(six(f) if isinstance(f.dataType, (T.DecimalType, T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`") for f in df.schema))


def query(name: str, sql: str | None = None, uses: str = ""):
    """Register a function of the derived tables; ``uses`` names those that the SQL begins with."""

    def put(f: Callable) -> Callable:
        QUERIES[name] = lambda spark, sf_dir: rounded(f(tables(spark, sf_dir)))
        if sql:
            ORACLE[name] = sql if not uses else f"{duckdb(*uses.split())}{', ' if sql.lstrip().startswith('#') else ' '}{sql.lstrip().lstrip('#')}"
        return f

    return put


def as_of():
    return F.to_timestamp(F.lit(AS_OF))


def _orders(t: Frames) -> DataFrame:
    return models.fct_orders(t["w_orders"], t["w_items"], t["w_refunds"], t["w_assignments"], t["w_payments"])


def _products(t: Frames) -> DataFrame:
    return models.dim_product(t["w_products"], t["w_categories"])


def _items(t: Frames) -> DataFrame:
    return models.fct_order_items(t["w_items"], t["w_orders"], t["w_products"])


def _stores(t: Frames) -> DataFrame:
    return models.dim_store(t["w_stores"], t["w_cities"])


def _customers(t: Frames) -> DataFrame:
    return models.dim_customer(t["w_customers"], _orders(t))


def _shuffled(log: DataFrame) -> DataFrame:
    """The log with a third of it sent twice."""
    return log.unionByName(log.filter(F.col("_lsn") % 3 == 0))


_FACT = "#f AS (SELECT o.*, coalesce(l.n, 0) AS line_count, coalesce(l.u, 0) AS units, coalesce(l.s, 0) AS substituted_lines, coalesce(r.a, 0) AS refunded_amount, o.total - coalesce(r.a, 0) AS net_revenue, a.rider_id, p.payment_status, o.promo_code IS NOT NULL AS used_promo, CAST(o.placed_at + INTERVAL 330 MINUTE AS date) AS order_date, CAST(hour(o.placed_at + INTERVAL 330 MINUTE) AS int) AS order_hour, date_diff('millisecond', o.placed_at, o.delivered_at) / 60000.0 AS delivery_minutes FROM w_orders o LEFT JOIN (SELECT order_id, count(*) n, sum(quantity) u, count(substituted_for_product_id) s FROM w_items GROUP BY 1) l USING (order_id) LEFT JOIN (SELECT order_id, sum(amount) a FROM w_refunds GROUP BY 1) r USING (order_id) LEFT JOIN (SELECT order_id, rider_id FROM w_assignments) a USING (order_id) LEFT JOIN w_payments p USING (order_id)) "
_FACT_USES = "w_orders w_items w_refunds w_assignments w_payments"


@query("fct_orders", _FACT + "SELECT order_id, customer_id, store_id, rider_id, status, cancel_reason, payment_status, promo_code, used_promo, order_date, order_hour, CAST(line_count AS bigint) AS line_count, CAST(units AS bigint) AS units, CAST(substituted_lines AS bigint) AS substituted_lines, round(CAST(refunded_amount AS double), 6) AS refunded_amount, round(CAST(net_revenue AS double), 6) AS net_revenue, round(delivery_minutes, 6) AS delivery_minutes, CASE WHEN status = 'delivered' THEN delivery_minutes <= promised_minutes END AS sla_met FROM f", _FACT_USES)
def _(t):
    return _orders(t).select("order_id", "customer_id", "store_id", "rider_id", "status", "cancel_reason", "payment_status", "promo_code", "used_promo", "order_date", "order_hour", "line_count", "units", "substituted_lines", "refunded_amount", "net_revenue", "delivery_minutes", "sla_met")


@query("fct_order_items", "SELECT i.order_id, o.store_id, CAST(o.placed_at + INTERVAL 330 MINUTE AS date) AS order_date, o.status AS order_status, i.product_id, p.category_id, i.quantity, round(CAST(i.unit_price AS double), 6) AS unit_price, round(CAST(i.mrp AS double), 6) AS mrp, round(CAST(i.line_total AS double), 6) AS line_total, i.substituted_for_product_id, i.substituted_for_product_id IS NOT NULL AS is_substitution, i._ingested_at FROM w_items i JOIN w_orders o USING (order_id) JOIN w_products p USING (product_id)", "w_items w_orders w_products")
def _(t):
    return _items(t)


@query("dim_store", "SELECT s.store_id, s.city_id, s.store_name, c.city_name, c.state FROM w_stores s JOIN w_cities c USING (city_id)", "w_stores w_cities")
def _(t):
    return _stores(t)


@query("dim_product", "SELECT product_id, product_name, category_name, is_perishable, brand, category_id, unit, is_active, nutriscore_grade, round(CAST(mrp AS double), 6) AS mrp, round(CAST(selling_price AS double), 6) AS selling_price, round(1 - CAST(selling_price AS double) / CAST(mrp AS double), 4) AS discount_rate, catalogue_source, price_source FROM w_products JOIN w_categories USING (category_id)", "w_products w_categories")
def _(t):
    return _products(t)


_CUSTOMER = _FACT + ", c AS (SELECT w.customer_id, w.city_id, d.a AS first_order_date, CAST(date_trunc('week', d.a) AS date) AS cohort_week, d.b AS last_order_date, coalesce(d.n, 0) AS delivered_orders, coalesce(d.r, 0) AS lifetime_net_revenue FROM w_customers w LEFT JOIN (SELECT customer_id, min(order_date) a, max(order_date) b, count(*) n, sum(net_revenue) r FROM f WHERE status = 'delivered' GROUP BY 1) d USING (customer_id)) "


@query("dim_customer", _CUSTOMER + "SELECT customer_id, city_id, first_order_date, cohort_week, last_order_date, delivered_orders, round(CAST(lifetime_net_revenue AS double), 6) AS lifetime_net_revenue FROM c", _FACT_USES + " w_customers")
def _(t):
    return _customers(t).drop("signup_at")


@query("mart_customer_retention_weekly", _CUSTOMER + ", a AS (SELECT DISTINCT c.cohort_week, f.customer_id, date_diff('day', c.cohort_week, CAST(date_trunc('week', f.order_date) AS date)) // 7 AS week_number FROM f JOIN c USING (customer_id) WHERE f.status = 'delivered'), z AS (SELECT cohort_week, count(DISTINCT customer_id) AS cohort_size FROM a GROUP BY 1) SELECT cohort_week, week_number, cohort_size, count(*) AS active_customers, round(count(*) / CAST(cohort_size AS double), 6) AS retention_rate FROM a JOIN z USING (cohort_week) GROUP BY 1, 2, 3", _FACT_USES + " w_customers")
def _(t):
    return models.mart_customer_retention_weekly(_orders(t), _customers(t))


@query("mart_order_funnel_daily", _FACT + "SELECT order_date, store_id, count(*) AS orders_placed, count(accepted_at) AS orders_accepted, count(picking_started_at) AS orders_picking_started, count(packed_at) AS orders_packed, count(dispatched_at) AS orders_dispatched, count(*) FILTER (WHERE status = 'delivered') AS orders_delivered, count(*) FILTER (WHERE status = 'cancelled') AS orders_cancelled, count(*) FILTER (WHERE cancel_reason = 'customer_cancelled') AS cancelled_by_customer, count(*) FILTER (WHERE cancel_reason = 'payment_failed') AS cancelled_payment_failed, count(*) FILTER (WHERE cancel_reason = 'items_unavailable') AS cancelled_items_unavailable, count(*) FILTER (WHERE cancel_reason = 'system_recovery') AS cancelled_system_recovery, count(*) FILTER (WHERE status NOT IN ('delivered', 'cancelled')) AS orders_in_flight, round(count(*) FILTER (WHERE status = 'delivered') / CAST(count(*) AS double), 6) AS placed_to_delivered_rate FROM f GROUP BY 1, 2", _FACT_USES)
def _(t):
    return models.mart_order_funnel_daily(_orders(t))


def _sla_sql(group: str = "order_date, order_hour, store_id") -> str:
    m = "date_diff('millisecond', {}, {}) / 60000.0"
    return _FACT + f"SELECT {group}, count(*) AS delivered_orders, max(promised_minutes) AS promised_minutes_max, round(avg(delivery_minutes), 6) AS avg_delivery_minutes, round(quantile_cont(delivery_minutes, 0.5), 6) AS p50_delivery_minutes, round(quantile_cont(delivery_minutes, 0.9), 6) AS p90_delivery_minutes, round(count(*) FILTER (WHERE delivery_minutes <= promised_minutes) / CAST(count(*) AS double), 6) AS pct_within_promise, round(avg(CASE WHEN delivery_minutes > promised_minutes THEN delivery_minutes - promised_minutes END), 6) AS avg_minutes_late_when_breached, round(avg({m.format('placed_at', 'accepted_at')}), 6) AS avg_minutes_to_accept, round(avg({m.format('picking_started_at', 'packed_at')}), 6) AS avg_minutes_to_pick, round(avg({m.format('packed_at', 'dispatched_at')}), 6) AS avg_minutes_waiting_for_rider, round(avg({m.format('dispatched_at', 'delivered_at')}), 6) AS avg_minutes_in_transit FROM f WHERE status = 'delivered' GROUP BY ALL"


@query("mart_delivery_sla_hourly", _sla_sql(), _FACT_USES)
def _(t):
    return models.mart_delivery_sla_hourly(_orders(t), exact=True)


@query("mart_delivery_sla_hourly_approx")
def _(t):
    return models.mart_delivery_sla_hourly(_orders(t))


@query("mart_basket_daily", _FACT + ", l AS (SELECT order_id, sum(line_total) v, sum(CASE WHEN price_source = 'open_prices' THEN line_total ELSE 0 END) vp, sum(CASE WHEN catalogue_source = 'open_food_facts' THEN line_total ELSE 0 END) vc FROM w_items JOIN w_products USING (product_id) GROUP BY 1) SELECT order_date, c.city_name, count(*) AS delivered_orders, round(CAST(sum(subtotal) AS double), 6) AS gross_merchandise_value, round(CAST(sum(discount) AS double), 6) AS discounts, round(CAST(sum(refunded_amount) AS double), 6) AS refunds, round(CAST(sum(net_revenue) AS double), 6) AS net_revenue, round(CAST(sum(coalesce(tip_amount, 0)) AS double), 6) AS tips, round(CAST(sum(delivery_fee) AS double), 6) AS delivery_fees, round(avg(CAST(total AS double)), 6) AS average_order_value, round(avg(line_count), 6) AS avg_lines_per_order, round(avg(units), 6) AS avg_units_per_order, round(CAST(sum(discount) AS double) / nullif(CAST(sum(subtotal) AS double), 0), 6) AS discount_share, round(count(*) FILTER (WHERE substituted_lines > 0) / CAST(count(*) AS double), 6) AS share_orders_with_substitution, round(CAST(sum(vc) AS double) / nullif(CAST(sum(v) AS double), 0), 6) AS real_product_value_share, round(CAST(sum(vp) AS double) / nullif(CAST(sum(v) AS double), 0), 6) AS real_price_value_share FROM f JOIN w_stores s USING (store_id) JOIN w_cities c USING (city_id) LEFT JOIN l USING (order_id) WHERE status = 'delivered' GROUP BY 1, 2", _FACT_USES + " w_products w_stores w_cities")
def _(t):
    return models.mart_basket_daily(_orders(t), _items(t), _products(t), _stores(t))


@query("mart_category_mix_daily", "SELECT CAST(o.placed_at + INTERVAL 330 MINUTE AS date) AS order_date, category_name, CAST(sum(quantity) AS bigint) AS units, round(CAST(sum(line_total) AS double), 6) AS revenue, round(CAST(sum(line_total) AS double) / CAST(sum(sum(line_total)) OVER (PARTITION BY CAST(o.placed_at + INTERVAL 330 MINUTE AS date)) AS double), 6) AS revenue_share FROM w_items i JOIN w_orders o USING (order_id) JOIN w_products USING (product_id) JOIN w_categories USING (category_id) WHERE o.status = 'delivered' GROUP BY 1, 2", "w_items w_orders w_products w_categories")
def _(t):
    return models.mart_category_mix_daily(_items(t), _products(t))


@query("mart_promo_effectiveness", _FACT + ", d AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY placed_at, order_id) = 1 AS is_first FROM f WHERE status = 'delivered'), b AS (SELECT order_date, avg(CAST(subtotal AS double)) AS usual FROM d WHERE NOT used_promo GROUP BY 1) SELECT promo_code, count(*) AS orders, count(DISTINCT customer_id) AS customers, count(*) FILTER (WHERE is_first) AS first_orders, round(CAST(sum(subtotal) AS double), 6) AS gross_merchandise_value, round(CAST(sum(discount) AS double), 6) AS discount_cost, round(avg(CAST(subtotal AS double)), 6) AS avg_basket_with_promo, round(avg(usual), 6) AS avg_basket_without_promo_same_days, round(avg(CAST(subtotal AS double)) - avg(usual), 6) AS basket_uplift, round(CAST(sum(discount) AS double) / nullif(CAST(sum(subtotal) AS double), 0), 6) AS discount_rate FROM d LEFT JOIN b USING (order_date) WHERE used_promo GROUP BY 1", _FACT_USES)
def _(t):
    return models.mart_promo_effectiveness(_orders(t))


@query("mart_rider_utilisation_daily", f"#s AS (SELECT rider_id, store_id, CAST(started_at + INTERVAL 330 MINUTE AS date) AS shift_date, sum(date_diff('millisecond', started_at, coalesce(ended_at, TIMESTAMP '{AS_OF}')) / 60000.0) AS m FROM w_shifts GROUP BY 1, 2, 3), t AS (SELECT rider_id, CAST(assigned_at + INTERVAL 330 MINUTE AS date) AS shift_date, count(*) AS a, count(delivered_at) AS d, sum(date_diff('millisecond', assigned_at, delivered_at) / 60000.0) AS b, avg(distance_km) AS k FROM w_assignments GROUP BY 1, 2) SELECT shift_date, store_id, rider_id, round(m, 6) AS logged_in_minutes, coalesce(a, 0) AS assignments, coalesce(d, 0) AS deliveries, round(coalesce(b, 0), 6) AS busy_minutes, round(k, 6) AS avg_distance_km, round(least(1.0, coalesce(b, 0) / nullif(m, 0)), 6) AS utilisation, round(coalesce(d, 0) / nullif(m / 60.0, 0), 6) AS deliveries_per_hour FROM s LEFT JOIN t USING (rider_id, shift_date)", "w_shifts w_assignments")
def _(t):
    return models.mart_rider_utilisation_daily(t["w_shifts"], t["w_assignments"], as_of())


_PERIODS = f"#e AS (SELECT *, CASE WHEN _op = 'd' THEN 'delisted' WHEN on_hand = 0 THEN 'out' ELSE 'in' END AS st FROM w_stock), g AS (SELECT *, CASE WHEN lag(st) OVER (PARTITION BY store_id, product_id ORDER BY _lsn) = st THEN 0 ELSE 1 END AS x FROM e), h AS (SELECT *, sum(x) OVER (PARTITION BY store_id, product_id ORDER BY _lsn ROWS UNBOUNDED PRECEDING) AS island FROM g), s AS (SELECT store_id, product_id, island, min(st) AS st, min(updated_at) AS started_at FROM h GROUP BY 1, 2, 3), b AS (SELECT *, lead(started_at) OVER (PARTITION BY store_id, product_id ORDER BY island) AS ended_at FROM s), periods AS (SELECT store_id, product_id, started_at, ended_at, ended_at IS NULL AS is_ongoing, ((epoch_us(coalesce(ended_at, TIMESTAMP '2024-03-01')) - epoch_us(started_at)) // 1000) / 60000.0 AS stockout_minutes FROM b WHERE st = 'out') "
_STOCK_END = "2024-03-01 00:00:00"


def _periods(t: Frames) -> DataFrame:
    return models.stockout_periods(t["w_stock"].withColumns({"updated_at": F.col("updated_at").cast("timestamp"), "_source_ts": F.col("_source_ts").cast("timestamp")}), F.to_timestamp(F.lit(_STOCK_END)))


@query("int_inventory_stockout_periods", _PERIODS + "SELECT store_id, product_id, started_at, ended_at, is_ongoing, round(stockout_minutes, 6) AS stockout_minutes FROM periods", "w_stock")
def _(t):
    return _periods(t)


@query("mart_inventory_health_daily", _PERIODS + ", n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY store_id, product_id ORDER BY _lsn DESC) AS r FROM w_stock) WHERE r = 1 AND _op <> 'd'), c AS (SELECT store_id, count(*) AS skus_listed, count(*) FILTER (WHERE on_hand = 0) AS skus_at_zero_now, count(*) FILTER (WHERE on_hand <= reorder_point) AS skus_below_reorder_point FROM n GROUP BY 1), d AS (SELECT p.store_id, CAST(started_at + INTERVAL 330 MINUTE AS date) AS activity_date, count(*) AS stockout_events, count(DISTINCT p.product_id) AS skus_stocked_out, count(DISTINCT n.product_id) AS l, count(*) FILTER (WHERE is_ongoing) AS stockouts_ongoing, sum(stockout_minutes) AS m FROM periods p LEFT JOIN n ON n.store_id = p.store_id AND n.product_id = p.product_id GROUP BY 1, 2) SELECT store_id, activity_date, skus_listed, skus_at_zero_now, skus_below_reorder_point, stockout_events, skus_stocked_out, stockouts_ongoing, round(m, 6) AS stockout_minutes, round(l / CAST(nullif(skus_listed, 0) AS double), 6) AS stockout_rate FROM d LEFT JOIN c USING (store_id)", "w_stock")
def _(t):
    stock = history.latest_per_key(t["w_stock"], ["store_id", "product_id"], ["_lsn"]).filter("_op <> 'd'")
    gone = t["w_items"].filter("quantity = 50").select("order_id", "line_total").join(t["w_orders"].select("order_id", F.col("cancelled_at").alias("removed_at")), "order_id")
    out = models.mart_inventory_health_daily(_periods(t), t["w_items"].withColumn("store_id", (F.col("order_id") % 25).cast("int")), t["w_orders"], stock, gone)
    return out.select("store_id", "activity_date", "skus_listed", "skus_at_zero_now", "skus_below_reorder_point", "stockout_events", "skus_stocked_out", "stockouts_ongoing", "stockout_minutes", "stockout_rate")


_CHANGES = "#o AS (SELECT *, lag(price) OVER w AS pp, lag(observed_on) OVER w AS po FROM w_prices WINDOW w AS (PARTITION BY product_code, location_id, currency ORDER BY observed_on, source_created_at, price_id)), ch AS (SELECT o.price_id, o.product_code, m.product_name, m.brand, coalesce(m.category_tag, 'en:unknown') AS category_tag, o.location_id, l.shop_name, l.city, l.country_code, o.currency, o.po AS previous_observed_on, o.observed_on, CAST(o.pp AS double) AS previous_price, CAST(o.price AS double) AS price, o.is_discounted, CAST(o.price - o.pp AS double) AS price_change, CAST(o.price - o.pp AS double) / CAST(o.pp AS double) AS change_pct FROM o LEFT JOIN (SELECT product_code, max(product_name) AS product_name, max(brand) AS brand, max(category_tag) AS category_tag FROM w_market_products GROUP BY 1) m USING (product_code) LEFT JOIN w_locations l USING (location_id) WHERE o.pp IS NOT NULL) "
_MARKET = "w_prices w_market_products w_locations"


def _changes(t: Frames) -> DataFrame:
    return models.mart_price_changes(t["w_prices"], t["w_market_products"], t["w_locations"])


@query("mart_price_changes", _CHANGES + "SELECT * REPLACE (round(price_change, 6) AS price_change, round(change_pct, 6) AS change_pct) FROM ch", _MARKET)
def _(t):
    return _changes(t)


@query("mart_price_volatility", _CHANGES + ", n AS (SELECT product_code, location_id, currency, count(*) AS observations FROM w_prices GROUP BY 1, 2, 3), g AS (SELECT product_code, location_id, currency, count(*) FILTER (WHERE change_pct <> 0) AS k, avg(abs(change_pct)) AS a, max(abs(change_pct)) AS m, stddev_samp(ln(1 + change_pct)) AS s FROM ch GROUP BY 1, 2, 3) SELECT product_code, location_id, currency, observations, coalesce(k, 0) AS price_changes, round(coalesce(a, 0), 6) AS avg_abs_change_pct, round(coalesce(m, 0), 6) AS max_abs_change_pct, round(coalesce(s, 0), 6) AS log_change_stddev, coalesce(k, 0) >= 2 AND (coalesce(m, 0) > 0.30 OR coalesce(s, 0) > 0.15) AS is_volatile FROM n LEFT JOIN g USING (product_code, location_id, currency)", _MARKET)
def _(t):
    return models.mart_price_volatility(t["w_prices"], _changes(t))


_INDEX = "#s AS (SELECT p.*, coalesce(m.category_tag, 'en:unknown') AS tag, first_value(price) OVER (PARTITION BY product_code, location_id, currency ORDER BY observed_on, source_created_at, price_id) AS base, row_number() OVER (PARTITION BY product_code, location_id, currency, observed_on ORDER BY source_created_at DESC, price_id DESC) AS n FROM w_prices p LEFT JOIN (SELECT product_code, max(category_tag) AS category_tag FROM w_market_products GROUP BY 1) m USING (product_code)), ix AS (SELECT tag AS category_tag, currency, observed_on, count(*) AS series_observed, 100 * exp(avg(ln(CAST(price AS double) / CAST(base AS double)))) AS price_index FROM s WHERE n = 1 GROUP BY 1, 2, 3) "


@query("mart_category_price_index_daily", _INDEX + "SELECT * REPLACE (round(price_index, 6) AS price_index) FROM ix", "w_prices w_market_products")
def _(t):
    return models.mart_category_price_index_daily(t["w_prices"], t["w_market_products"])


@query("report_index", _INDEX + "SELECT category_tag, currency, observed_on, series_observed, round(price_index, 6) AS price_index FROM (SELECT *, row_number() OVER (PARTITION BY category_tag, currency ORDER BY observed_on DESC) AS r FROM ix WHERE category_tag <> 'en:unknown') WHERE r = 1 AND series_observed >= 3 ORDER BY series_observed DESC, category_tag, currency LIMIT 15", "w_prices w_market_products")
def _(t):
    return models.report_index(models.mart_category_price_index_daily(t["w_prices"], t["w_market_products"]))


@query("mart_store_price_dispersion", "SELECT product_code, currency, week_start, count(*) AS shops, round(CAST(min(price) AS double), 6) AS min_price, round(CAST(max(price) AS double), 6) AS max_price, round(avg(CAST(price AS double)), 6) AS avg_price, round(stddev_samp(CAST(price AS double)) / nullif(avg(CAST(price AS double)), 0), 6) AS coefficient_of_variation, round(CAST(max(price) AS double) / nullif(CAST(min(price) AS double), 0), 6) AS max_to_min_ratio FROM (SELECT product_code, currency, CAST(date_trunc('week', observed_on) AS date) AS week_start, location_id, arg_max(price, (source_created_at, price_id)) AS price FROM w_prices GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3 HAVING count(*) >= 2", "w_prices")
def _(t):
    return models.mart_store_price_dispersion(t["w_prices"])


_COVER = "SELECT category_name, count(*) AS products, count(*) FILTER (WHERE catalogue_source = 'open_food_facts') AS real_products, count(*) FILTER (WHERE price_source = 'open_prices') AS real_priced_products{} FROM w_products JOIN w_categories USING (category_id) GROUP BY 1"


@query("mart_catalogue_coverage", _COVER.format(", round(count(*) FILTER (WHERE catalogue_source = 'open_food_facts') / CAST(count(*) AS double), 6) AS real_product_share"), "w_products w_categories")
def _(t):
    return models.mart_catalogue_coverage(_products(t))


@query("report_coverage", _COVER.format("") + " ORDER BY 3 DESC, 1", "w_products w_categories")
def _(t):
    return models.report_coverage(models.mart_catalogue_coverage(_products(t)))


@query("report_meta", f"SELECT count(*) AS observations, max(source_created_at) AS latest, count(*) FILTER (WHERE source_created_at > TIMESTAMP '{AS_OF}' - INTERVAL 1 DAY) AS last_day, count(DISTINCT currency) AS currencies, count(DISTINCT product_code) AS products FROM w_prices", "w_prices")
def _(t):
    return models.report_meta(t["w_prices"], as_of())


@query("report_by_currency", f"SELECT currency, count(*) AS observations, count(DISTINCT product_code) AS products, count(DISTINCT location_id) AS shops FROM w_prices WHERE source_created_at > TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 12", "w_prices")
def _(t):
    return models.report_by_currency(t["w_prices"], as_of())


@query("report_movers", _CHANGES + f"SELECT price_id, product_name, brand, shop_name, city, country_code, currency, round(previous_price, 6) AS previous_price, round(price, 6) AS price, round(change_pct, 6) AS change_pct, observed_on FROM ch WHERE change_pct <> 0 AND observed_on >= DATE '1998-12-02' ORDER BY abs(change_pct) DESC, observed_on DESC, price_id LIMIT 15", _MARKET)
def _(t):
    return models.report_movers(_changes(t), as_of())


@query("report_india", "SELECT p.price_id, coalesce(m.product_name, p.product_code) AS product, m.brand, l.city, round(CAST(p.price AS double), 6) AS price, p.observed_on FROM w_prices p LEFT JOIN w_market_products m USING (market_product_id) LEFT JOIN w_locations l USING (location_id) WHERE currency = 'N' ORDER BY p.source_created_at DESC, p.price_id DESC LIMIT 12", _MARKET)
def _(t):
    return models.report_india(t["w_prices"], t["w_market_products"], t["w_locations"], "N")


@query("report_ops", _FACT + f", s AS (SELECT order_date, order_hour, store_id, count(*) AS n, count(*) FILTER (WHERE delivery_minutes <= promised_minutes) / CAST(count(*) AS double) AS p, quantile_cont(delivery_minutes, 0.9) AS q FROM f WHERE status = 'delivered' GROUP BY 1, 2, 3) SELECT CAST(sum(n) AS bigint) AS delivered_orders, round(sum(p * n) / nullif(sum(n), 0), 6) AS pct_within_promise, round(max(q), 6) AS worst_p90 FROM s WHERE order_date >= DATE '1995-01-01' - INTERVAL 7 DAY", _FACT_USES)
def _(t):
    return models.report_ops(models.mart_delivery_sla_hourly(_orders(t), exact=True), F.to_timestamp(F.lit("1995-01-01 00:00:00")))


@query("report_sla_by_store", _FACT + "SELECT store_id, count(*) AS delivered_orders, round(count(*) FILTER (WHERE delivery_minutes <= promised_minutes) / CAST(count(*) AS double), 6) AS pct_within_promise FROM f WHERE status = 'delivered' GROUP BY 1", _FACT_USES)
def _(t):
    return models.report_sla_by_store(models.mart_delivery_sla_hourly(_orders(t), exact=True))


_STATE = "SELECT id, kind, amount, _lsn, is_deleted FROM (SELECT l.id, k.kind, k.amount, l._lsn, l._op = 'd' AS is_deleted FROM (SELECT id, max(_lsn) AS _lsn, arg_max(_op, _lsn) AS _op FROM {0} GROUP BY 1) l LEFT JOIN (SELECT id, arg_max(kind, _lsn) AS kind, arg_max(amount, _lsn) AS amount FROM {0} WHERE _op <> 'd' GROUP BY 1) k USING (id))"


def _state(df: DataFrame) -> DataFrame:
    return df.select("id", "kind", "amount", "_lsn", F.col("_is_deleted").alias("is_deleted"))


@query("cdc_fold_latest", _STATE.format("w_log"), "w_log")
def _(t):
    """Two batches in order, the second with replays of the first: the state is that of the whole log."""
    log = t["w_log"]
    first = cdc.fold_latest(None, log.filter("_lsn % 10000 < 6000 and _lsn < 6000"), ["id"])
    return _state(cdc.fold_latest(first, log.filter("_lsn >= 5000"), ["id"]))


@query("cdc_fold_log", _STATE.format("w_log"), "w_log")
def _(t):
    return _state(cdc.fold_log(_shuffled(t["w_log"]), ["id"]))


@query("src_silver_live", f"SELECT id, kind, amount FROM ({_STATE.format('w_log')}) WHERE NOT is_deleted", "w_log")
def _(t):
    return cdc.live(cdc.fold_log(_shuffled(t["w_log"]), ["id"])).select("id", "kind", "amount")


@query("cdc_apply_truncate", "#c AS (SELECT * FROM w_log WHERE _lsn > 3000) SELECT coalesce(a.id, b.id) AS id, CASE WHEN b.id IS NOT NULL THEN b._lsn WHEN a.is_deleted THEN a._lsn ELSE 3000 END AS _lsn, coalesce(b.is_deleted, true) AS is_deleted FROM (" + _STATE.format("(SELECT * FROM w_log WHERE _lsn < 2000)") + ") a FULL JOIN (" + _STATE.format("c") + ") b ON a.id = b.id", "w_log")
def _(t):
    log = t["w_log"]
    silver = cdc.fold_log(log.filter("_lsn < 2000"), ["id"])
    cut = log.filter("_lsn >= 2000").agg(F.lit(3000).cast("long").alias("t_lsn"), F.min("_source_ts").alias("t_ts"))
    return cdc.fold_latest(silver, log.filter("_lsn >= 2000"), ["id"], cut).select("id", "_lsn", F.col("_is_deleted").alias("is_deleted"))


@query("cdc_toast_guard", "#x AS (SELECT id, _lsn, _op, CASE WHEN _lsn % 4 = 0 THEN NULL ELSE kind END AS kind FROM w_log WHERE _op <> 'd') SELECT l.id, k.kind FROM (SELECT DISTINCT id FROM w_log) l LEFT JOIN (SELECT id, arg_max(kind, _lsn) AS kind FROM x WHERE kind IS NOT NULL GROUP BY 1) k USING (id)", "w_log")
def _(t):
    lost = F.when((F.col("_op") != "d") & (F.col("_lsn") % 4 == 0), F.lit(cdc.UNAVAILABLE)).otherwise(F.col("kind"))
    return cdc.fold_log(t["w_log"].withColumn("kind", lost), ["id"]).select("id", "kind")


def _raw(t: Frames) -> DataFrame:
    """The log as self-describing envelopes; every 50th is broken, every 70th lacks its position."""
    field = lambda n, k, o: f'{{"type":"{k}","optional":{o},"field":"{n}"}}'
    row = f'{field("id", "int64", "false")},{field("kind", "string", "true")},{field("amount", "double", "true")}'
    schema = F.lit(f'{{"type":"struct","fields":[{{"type":"struct","fields":[{row}],"optional":true,"field":"after"}}]}}')
    key_schema = F.lit(f'{{"type":"struct","fields":[{field("id", "int64", "false")}]}}')

    after = F.when(F.col("_op") != "d", F.struct("id", "kind", F.col("amount").cast("double").alias("amount")))
    lsn = F.when(F.col("_lsn") % 70 != 0, F.col("_lsn"))
    payload = F.to_json(F.struct(F.col("_op").alias("op"), F.lit(0).cast("long").alias("ts_ms"), F.struct(lsn.alias("lsn"), F.lit(0).cast("long").alias("ts_ms")).alias("source"), after.alias("after")))
    value = F.when(F.col("_lsn") % 50 == 0, F.lit("this is not json")).otherwise(F.concat(F.lit('{"schema":'), schema, F.lit(',"payload":'), payload, F.lit("}")))
    key = F.concat(F.lit('{"schema":'), key_schema, F.lit(',"payload":'), F.to_json(F.struct("id")), F.lit("}"))

    return t["w_log"].select(F.lit("shop.public.users").alias("topic"), F.lit(0).cast("long").alias("partition"), F.col("_lsn").alias("offset"), key.alias("key"), value.alias("value"))


def _decoded(t: Frames) -> DataFrame:
    raw = cdc.raw_projection(_raw(t))
    return cdc.decode_changes(raw, cdc.first_schema(raw), 1, F.to_timestamp(F.lit(AS_OF)))


@query("cdc_parse_envelope", "SELECT id, kind, CAST(amount AS double) AS amount, _op, _lsn FROM w_log WHERE _lsn % 50 <> 0 AND _lsn % 70 <> 0", "w_log")
def _(t):
    return cdc.valid_changes(_decoded(t)).select("id", "kind", "amount", "_op", "_lsn")


@query("cdc_dead_letters", "SELECT _lsn AS offset, CASE WHEN _lsn % 50 = 0 THEN 'unparseable_envelope' ELSE 'missing_lsn' END AS reason FROM w_log WHERE _lsn % 50 = 0 OR _lsn % 70 = 0", "w_log")
def _(t):
    return cdc.dead_letters(_decoded(t)).select("offset", "reason")


@query("ops_dead_letter_summary", "SELECT CASE WHEN _lsn % 50 = 0 THEN 'unparseable_envelope' ELSE 'missing_lsn' END AS reason, count(*) AS records FROM w_log WHERE _lsn % 50 = 0 OR _lsn % 70 = 0 GROUP BY 1", "w_log")
def _(t):
    return cdc.dead_letters(_decoded(t)).groupBy("reason").agg(F.count("*").alias("records"))


@query("cdc_survey", "SELECT CASE WHEN _lsn % 50 <> 0 THEN _op END AS op, count(*) AS records, count(*) FILTER (WHERE _lsn % 50 <> 0 AND _lsn % 70 <> 0) AS with_lsn, min(_lsn) AS first_offset FROM w_log GROUP BY 1", "w_log")
def _(t):
    return cdc.survey(cdc.raw_projection(_raw(t))).select("op", "records", "with_lsn", "first_offset")


@query("win_dedupe_changes", "SELECT id, _lsn, _op, kind FROM w_log", "w_log")
def _(t):
    return cdc.dedupe_changes(_shuffled(t["w_log"]), ["id"]).select("id", "_lsn", "_op", "kind")


@query("cdc_bronze_append", "SELECT id, _lsn, _op FROM w_log WHERE _lsn >= 4000", "w_log")
def _(t):
    log = t["w_log"]
    return cdc.append_unseen(log.filter("_lsn < 4000"), _shuffled(log.filter("_lsn >= 2000")), ["id"], 2000).select("id", "_lsn", "_op")


@query("win_latest_per_key", "SELECT id, max(_lsn) AS _lsn, arg_max(_op, _lsn) AS _op FROM w_log GROUP BY 1", "w_log")
def _(t):
    return history.latest_per_key(_shuffled(t["w_log"]).select("id", "_lsn", "_op"), ["id"], ["_lsn"])


_SCD = "#v AS (SELECT id, kind, _lsn, _source_ts, lag(kind) OVER w AS p, row_number() OVER w AS n FROM w_log WHERE _op <> 'd' WINDOW w AS (PARTITION BY id ORDER BY _lsn)), x AS (SELECT * FROM v WHERE n = 1 OR kind IS DISTINCT FROM p) "


@query("scd2_from_changes", _SCD + "SELECT id, row_number() OVER w AS version, kind, _source_ts AS valid_from, lead(_source_ts) OVER w AS valid_to, lead(_source_ts) OVER w IS NULL AS is_current, _lsn AS source_lsn FROM x WINDOW w AS (PARTITION BY id ORDER BY _lsn)", "w_log")
def _(t):
    return history.scd2(_shuffled(t["w_log"]).filter("_op <> 'd'"), ["id"], ["kind"], "_source_ts")


@query("scd2_validate", "SELECT id, 'current_versions' AS problem FROM w_log WHERE false", "w_log")
def _(t):
    return history.scd2_validate(history.scd2(t["w_log"].filter("_op <> 'd'"), ["id"], ["kind"], "_source_ts"), ["id"])


@query("removed_rows", "SELECT d.id, c.kind, c.amount, d._source_ts AS removed_at FROM w_log d JOIN (SELECT id, arg_min(kind, _lsn) AS kind, arg_min(amount, _lsn) AS amount FROM w_log WHERE _op IN ('r', 'c') GROUP BY 1) c USING (id) WHERE d._op = 'd'", "w_log")
def _(t):
    return history.removed_rows(_shuffled(t["w_log"]), ["id"], ["kind", "amount"])


@query("dq_relisted_keys", "SELECT DISTINCT id FROM (SELECT id, _op, lead(_op) OVER (PARTITION BY id ORDER BY _lsn) AS n FROM w_log) WHERE _op = 'd' AND n = 'c'", "w_log")
def _(t):
    return history.relisted_keys(t["w_log"], ["id"])


@query("incremental_keys", "SELECT DISTINCT order_id FROM (SELECT order_id FROM w_orders WHERE _ingested_at >= TIMESTAMP '1998-01-01' UNION ALL SELECT order_id FROM w_items WHERE _ingested_at >= TIMESTAMP '1998-01-01' UNION ALL SELECT order_id FROM w_refunds WHERE _ingested_at >= TIMESTAMP '1998-01-01')", "w_orders w_items w_refunds")
def _(t):
    return incremental.touched_keys([t["w_orders"], t["w_items"], t["w_refunds"]], "order_id", F.to_timestamp(F.lit("1998-01-01 00:00:00")))


@query("sink_incremental_delete_insert", "SELECT i.order_id, i.product_id, i.quantity FROM w_items i JOIN w_orders o USING (order_id) JOIN w_products p USING (product_id)", "w_items w_orders w_products")
def _(t):
    """Rows of old orders, then the touched ones replaced: equal to a full rebuild."""
    since = F.to_timestamp(F.lit("1996-01-01 00:00:00"))
    touched = incremental.touched_keys([t["w_items"]], "order_id", since)
    old = models.fct_order_items(t["w_items"].filter(F.col("_ingested_at") < since), t["w_orders"], t["w_products"])
    return incremental.replace_keys(old, models.fct_order_items(t["w_items"], t["w_orders"], t["w_products"], touched), "order_id", touched).select("order_id", "product_id", "quantity")


def _perturbed(t: Frames) -> DataFrame:
    changed = F.when(F.col("order_id") % 97 == 0, F.col("total") + 1).otherwise(F.col("total")).cast("decimal(18,2)")
    return t["w_orders"].select("order_id", "status", "total").filter("order_id % 101 <> 0").withColumn("total", changed)


@query("incremental_upsert_changed", "SELECT order_id, CASE WHEN order_id % 101 = 0 THEN 'inserted' WHEN order_id % 97 = 0 THEN 'updated' ELSE 'unchanged' END AS outcome FROM w_orders", "w_orders")
def _(t):
    return incremental.upsert_changed(_perturbed(t), t["w_orders"].select("order_id", "status", "total"), ["order_id"]).select("order_id", F.col("_outcome").alias("outcome"))


@query("rec_row_diff", "SELECT order_id, CASE WHEN order_id % 101 = 0 THEN 'missing' ELSE 'changed' END AS kind FROM w_orders WHERE order_id % 101 = 0 OR order_id % 97 = 0", "w_orders")
def _(t):
    return quality.row_diff(t["w_orders"].select("order_id", "status", "total"), _perturbed(t), ["order_id"])


@query("rec_table", "SELECT 'orders' AS \"table\", false AS ok, count(*) AS rows_source, count(*) FILTER (WHERE order_id % 101 <> 0) AS rows_target FROM w_orders", "w_orders")
def _(t):
    return quality.reconcile(t["w_orders"].select("order_id", "status", "total"), _perturbed(t), "orders").select("table", "ok", "rows_source", "rows_target")


@query("chk_table", "SELECT 'orders' AS \"table\", count(*) AS \"rows\", true AS stable FROM w_orders", "w_orders")
def _(t):
    o = t["w_orders"]
    a, b = quality.checksum(o, "orders"), quality.checksum(o.repartition(7).select(*reversed(o.columns)), "orders")
    return a.join(b.select(F.col("digest").alias("d")), F.lit(True)).select("table", "rows", (F.col("digest") == F.col("d")).alias("stable"))


@query("dq_unique_combination", "SELECT order_id, product_id, count(*) AS n FROM w_items GROUP BY 1, 2 HAVING count(*) > 1", "w_items")
def _(t):
    return quality.check_unique(t["w_items"], "order_id", "product_id")


@query("dq_relationships", "SELECT order_id FROM w_orders WHERE order_id NOT IN (SELECT order_id FROM w_items)", "w_orders w_items")
def _(t):
    return quality.check_relationship(t["w_orders"], "order_id", t["w_items"], "order_id").select("order_id")


@query("dq_accepted_values", "SELECT order_id, status FROM w_orders WHERE status NOT IN ('delivered', 'cancelled')", "w_orders")
def _(t):
    return quality.check_accepted(t["w_orders"], "status", ["delivered", "cancelled"]).select("order_id", "status")


@query("dq_between", "SELECT order_id, quantity FROM w_items WHERE quantity < 2 OR quantity > 49", "w_items")
def _(t):
    return quality.check_between(t["w_items"], "quantity", 2, 49).select("order_id", "quantity")


@query("dq_lifecycle_ordered", "SELECT order_id FROM w_orders WHERE status = 'delivered' AND NOT (placed_at <= accepted_at AND accepted_at <= picking_started_at AND picking_started_at <= packed_at AND packed_at <= dispatched_at AND dispatched_at <= delivered_at)", "w_orders")
def _(t):
    return quality.check_ordered(t["w_orders"].filter("status = 'delivered'"), ["placed_at", "accepted_at", "picking_started_at", "packed_at", "dispatched_at", "delivered_at"]).select("order_id")


@query("dq_lines_match_subtotal", "SELECT o.order_id, round(CAST(o.subtotal AS double), 6) AS subtotal, round(CAST(p.s AS double), 6) AS parts FROM w_orders o LEFT JOIN (SELECT order_id, sum(line_total) AS s FROM w_items GROUP BY 1) p USING (order_id) WHERE coalesce(p.s, 0) <> o.subtotal", "w_orders w_items")
def _(t):
    return quality.check_sums(t["w_items"], "order_id", "line_total", t["w_orders"], "subtotal")


@query("dq_totals_add_up", "SELECT order_id FROM w_orders WHERE total <> subtotal - discount + delivery_fee OR total < 0", "w_orders")
def _(t):
    return t["w_orders"].filter("total <> subtotal - discount + delivery_fee or total < 0").select("order_id")


@query("dq_not_null", "SELECT order_id FROM w_orders WHERE delivered_at IS NULL", "w_orders")
def _(t):
    return quality.check_not_null(t["w_orders"], "delivered_at").select("order_id")


@query("topk_per_category", "SELECT category_id, product_id, catalogue_source FROM (SELECT *, row_number() OVER (PARTITION BY category_id ORDER BY catalogue_source, product_id) AS r FROM w_products) WHERE r <= 60", "w_products")
def _(t):
    return incremental.top_per_group(t["w_products"], ["category_id"], [F.col("catalogue_source"), F.col("product_id")], 60).select("category_id", "product_id", "catalogue_source")


@query("obs_reprice_catalogue", "#l AS (SELECT product_code, arg_max(price, (observed_on, source_created_at, price_id)) AS price FROM w_prices WHERE currency = 'A' GROUP BY 1) SELECT product_id, round(CAST(l.price AS double), 6) AS selling_price, round(CAST(greatest(p.mrp, l.price) AS double), 6) AS mrp FROM w_products p JOIN l ON CAST(p.product_id AS varchar) = l.product_code WHERE (p.selling_price, p.price_source) IS DISTINCT FROM (l.price, 'open_prices')", "w_prices w_products")
def _(t):
    from tidemark.sources.observations import reprice_catalogue

    p = t["w_products"].withColumn("off_code", F.col("product_id").cast("string"))
    return reprice_catalogue(p, t["w_prices"].withColumn("price_without_discount", F.lit(None).cast("decimal(14,2)")), "A").select("product_id", "selling_price", "mrp")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["cdc_fold_log"](spark, sf_dir)


from tidemark.plans import engine_queries, staging_queries  # noqa: E402,F401  (register their queries beside these)
