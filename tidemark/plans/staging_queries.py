"""Queries of staging views, change views, histories and further checks; registered beside those of :mod:`tidemark.plans.queries`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import history, quality
from tidemark.plans import models
from tidemark.plans.queries import _FACT, _FACT_USES, _SCD, AS_OF, ORACLE, QUERIES, as_of, query, rounded
from tidemark.plans.workload import tables

#: Where the rows of each current-state table come from: a given table and its key. Columns follow by rule.
BASES = {
    "categories": ("region", "r_regionkey"), "cities": ("nation", "n_nationkey"), "customers": ("customer", "c_custkey"), "dark_stores": ("supplier", "s_suppkey"), "delivery_assignments": ("orders", "o_orderkey"),
    "inventory": ("part", "p_partkey"), "mandi_prices": ("lineitem", "l_orderkey"), "market_locations": ("supplier", "s_suppkey"), "market_prices": ("lineitem", "l_partkey"), "market_products": ("part", "p_partkey"),
    "order_items": ("lineitem", "l_orderkey"), "order_status_history": ("orders", "o_orderkey"), "orders": ("orders", "o_orderkey"), "payments": ("orders", "o_orderkey"), "products": ("part", "p_partkey"),
    "promotions": ("customer", "c_custkey"), "refunds": ("orders", "o_orderkey"), "rider_shifts": ("orders", "o_orderkey"), "riders": ("supplier", "s_suppkey"),
}


def _silver_sql(name: str) -> str:
    """The current-state table under its own column names; every fifth key is a tombstone."""
    table, key = BASES[name]
    own = [c[0] if isinstance(c, tuple) else c for c in models.STAGING[name]]
    cols = ", ".join(f"CAST(({key} * {7 + j} + {j}) % 1009 AS bigint) AS {c}" for j, c in enumerate(own))
    return f"SELECT {cols}, {key} % 5 = 0 AS _is_deleted FROM {table}"


def _staging(name: str) -> None:
    own = [c if isinstance(c, tuple) else (c, c) for c in models.STAGING[name]]
    late = {"orders": "CAST(NULL AS decimal(8,2)) AS tip_amount", "products": "CAST(NULL AS varchar) AS off_code, 'simulated' AS catalogue_source, 'simulated' AS price_source, CAST(NULL AS varchar) AS nutriscore_grade"}
    table = BASES[name][0]

    def run(spark, sf_dir):
        silver = spark.sql(_silver_sql(name).replace(f"FROM {table}", "FROM {base}"), base=spark.read.parquet(f"{sf_dir}/{table}.parquet"))
        return rounded(models.stage(name, silver))

    QUERIES[f"stg_{name}"] = run
    cols = ", ".join([f"{a} AS {b}" for a, b in own] + ([late[name].replace("decimal(8,2)", "double")] if name in late else []))
    ORACLE[f"stg_{name}"] = f"SELECT {cols} FROM ({_silver_sql(name)}) WHERE NOT _is_deleted"


def _changes_sql(name: str) -> str:
    keys, cols, _ = models.CHANGES[name]
    k = ", ".join(f"{'user_id % 10' if c == 'store_id' and len(keys) > 1 else 'user_id'} AS {c}" for c in keys)
    v = ", ".join("ts AS updated_at" if c == "updated_at" else f"CAST(floor(value) AS bigint) % {3 + j} AS {c}" for j, c in enumerate(cols))
    return f"SELECT {k}, {v}, CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS _op, event_id AS _lsn, ts AS _source_ts, ts AS _ingested_at FROM events"


def _changes(spark, sf_dir: str, name: str) -> DataFrame:
    """The change view of a log in which a third of the events came twice."""
    log = spark.sql(_changes_sql(name).replace("FROM events", "FROM {e}"), e=spark.read.parquet(f"{sf_dir}/events.parquet"))
    return models.stage_changes(name, log.unionByName(log.filter("_lsn % 3 = 0")))


def _change_view(name: str) -> None:
    keys, cols, deletes = models.CHANGES[name]
    QUERIES[f"stg_{name}__changes"] = lambda spark, sf_dir: _changes(spark, sf_dir, name)
    ORACLE[f"stg_{name}__changes"] = f"SELECT {', '.join([*keys, *cols])}, _op, _lsn, _source_ts FROM ({_changes_sql(name)})" + ("" if deletes else " WHERE _op <> 'd'")


def _history(name: str, source: str, model, key: str, tracked: list[str]) -> None:
    QUERIES[name] = lambda spark, sf_dir: model(_changes(spark, sf_dir, source))
    lags = ", ".join(f"lag({c}) OVER w AS p{i}" for i, c in enumerate(tracked))
    differs = " OR ".join(f"{c} IS DISTINCT FROM p{i}" for i, c in enumerate(tracked))
    ORACLE[name] = f"""WITH c AS (SELECT * FROM ({_changes_sql(source)}) WHERE _op <> 'd'), v AS (SELECT *, row_number() OVER w AS n, {lags} FROM c WINDOW w AS (PARTITION BY {key} ORDER BY _lsn)), x AS (SELECT * FROM v WHERE n = 1 OR {differs})
        SELECT {key}, row_number() OVER w AS version, {', '.join(tracked)}, updated_at AS valid_from, lead(updated_at) OVER w AS valid_to, lead(updated_at) OVER w IS NULL AS is_current, _lsn AS source_lsn FROM x WINDOW w AS (PARTITION BY {key} ORDER BY _lsn)"""


for _name in BASES:
    _staging(_name)
for _name in models.CHANGES:
    _change_view(_name)
_history("dim_product_price_history", "products", models.dim_product_price_history, "product_id", ["mrp", "selling_price"])
_history("dim_store_history", "dark_stores", models.dim_store_history, "store_id", ["service_radius_km", "max_concurrent_orders", "status"])

QUERIES["int_order_items_removed_at_picking"] = lambda spark, sf_dir: models.removed_items(_changes(spark, sf_dir, "order_items"))
ORACLE["int_order_items_removed_at_picking"] = f"""WITH c AS ({_changes_sql('order_items')}), f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_item_id ORDER BY _lsn) AS n FROM c WHERE _op IN ('r', 'c')) WHERE n = 1)
    SELECT f.order_item_id, f.order_id, f.product_id, f.quantity, f.unit_price, f.line_total, d._source_ts AS removed_at FROM f JOIN (SELECT * FROM c WHERE _op = 'd') d USING (order_item_id)"""


@query("dq_refund_not_over_total", "SELECT order_id, round(CAST(total AS double), 6) AS total, round(CAST(a AS double), 6) AS parts FROM (SELECT order_id, sum(amount * 2000) AS a FROM w_refunds GROUP BY 1) JOIN w_orders USING (order_id) WHERE a > total", "w_orders w_refunds")
def _(t):
    """Refunds two thousand times as large, so that some are too large."""
    return quality.check_not_over(t["w_refunds"].withColumn("amount", F.col("amount") * 2000), "order_id", "amount", t["w_orders"], "total")


@query("dq_non_negative", "SELECT order_id, round(CAST(subtotal - 100000 AS double), 6) AS subtotal FROM w_orders WHERE subtotal < 100000", "w_orders")
def _(t):
    return quality.check_non_negative(t["w_orders"].select("order_id", (F.col("subtotal") - 100_000).alias("subtotal")), "subtotal")


@query("dq_lifecycle_disordered", "SELECT order_id FROM w_orders WHERE order_id % 17 = 0 AND accepted_at IS NOT NULL", "w_orders")
def _(t):
    late = F.when(F.col("order_id") % 17 == 0, F.col("accepted_at") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("placed_at"))
    return quality.check_ordered(t["w_orders"].withColumn("placed_at", late), ["placed_at", "accepted_at"]).select("order_id")


@query("scd2_validate_broken", _SCD + ", y AS (SELECT id, n, lead(_source_ts) OVER (PARTITION BY id ORDER BY _lsn) AS valid_to FROM x) SELECT id, 'current_versions' AS problem FROM y WHERE id % 7 = 0 GROUP BY 1 UNION ALL SELECT id, 'negative_interval' FROM y WHERE id % 11 = 0 AND valid_to IS NOT NULL", "w_log")
def _(t):
    """A history in which some keys have no current version, and others end before they begin."""
    h = history.scd2(t["w_log"].filter("_op <> 'd'"), ["id"], ["kind"], "_source_ts")
    h = h.withColumn("is_current", F.col("is_current") & (F.col("id") % 7 != 0))
    backwards = (F.col("id") % 11 == 0) & F.col("valid_to").isNotNull()
    return history.scd2_validate(h.withColumn("valid_to", F.when(backwards, F.col("valid_from") - F.expr("INTERVAL 1 DAY")).otherwise(F.col("valid_to"))), ["id"])


@query("fence_visible", "SELECT max(o_orderkey) IS NOT NULL AS visible FROM orders", "w_orders")
def _(t):
    """A heartbeat row whose token is the number of the last order: every order before it is there."""
    last = t["w_orders"].agg(F.max("order_id").cast("string").alias("token")).select(F.lit(1).alias("id"), "token")
    return quality.fence_visible(last, last.first()["token"])


@query("chk_layer", "SELECT 'orders' AS \"table\", count(*) AS rows FROM w_orders UNION ALL SELECT 'items', count(*) FROM w_items UNION ALL SELECT 'stores', count(*) FROM w_stores", "w_orders w_items w_stores")
def _(t):
    return quality.layer_checksums({"orders": t["w_orders"], "items": t["w_items"], "stores": t["w_stores"], "cdc_heartbeat": t["w_stores"]}).select("table", "rows")


def _whole_orders(spark, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    return rounded(models.fct_orders(t["w_orders"], t["w_items"], t["w_refunds"], t["w_assignments"], t["w_payments"]).drop("_ingested_at"))


QUERIES["fct_orders_whole"] = _whole_orders
_MIN = "round(date_diff('millisecond', {}, {}) / 60000.0, 6) AS {}"
_MONEY = ", ".join(f"round(CAST({c} AS double), 6) AS {c}" for c in ("subtotal", "discount", "delivery_fee", "total", "tip_amount", "refunded_amount", "net_revenue"))
_SPENT = ", ".join(_MIN.format(*x) for x in (("placed_at", "accepted_at", "minutes_to_accept"), ("picking_started_at", "packed_at", "minutes_to_pick"), ("packed_at", "dispatched_at", "minutes_waiting_for_rider"), ("dispatched_at", "delivered_at", "minutes_in_transit")))


@query("_fct_orders_sql", _FACT + f"SELECT order_id, customer_id, store_id, rider_id, status, cancel_reason, payment_method, payment_status, promo_code, used_promo, order_date, order_hour, placed_at, accepted_at, picking_started_at, packed_at, dispatched_at, delivered_at, cancelled_at, promised_minutes, distance_km, CAST(line_count AS bigint) AS line_count, CAST(units AS bigint) AS units, CAST(substituted_lines AS bigint) AS substituted_lines, {_MONEY}, {_SPENT}, round(delivery_minutes, 6) AS delivery_minutes, CASE WHEN status = 'delivered' THEN delivery_minutes <= promised_minutes END AS sla_met FROM f", _FACT_USES)
def _(t):
    return t


ORACLE["fct_orders_whole"] = ORACLE.pop("_fct_orders_sql")
del QUERIES["_fct_orders_sql"]
