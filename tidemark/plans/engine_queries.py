"""Queries of the capture job, stored sketches, digests, as-of lookup, ingestion and operations; registered beside those of :mod:`tidemark.plans.queries`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import local_date, week_start
from tidemark.operators import cdc, history, incremental, quality, sketches
from tidemark.plans import models
from tidemark.plans.queries import _FACT, _FACT_USES, _INDEX, _STATE, AS_OF, Frames, _decoded, _items, _orders, _periods, _PERIODS, _products, _raw, _state, _stores, as_of, query
from tidemark.sources import observations
from tidemark.sources.tables import BUCKET, bucket_of, json_items, workspace
from tidemark.streaming.fold import fold_stream, write_updates
from tidemark.streaming.pipeline import METRICS, CdcPipeline

# the capture job


@query("sch_evolve_table", "#s AS (" + _STATE.format("w_log") + ") SELECT id, kind, CAST(amount AS double) AS amount, _lsn, is_deleted, CAST(1 AS bigint) AS buckets FROM s", "w_log")
def _(t: Frames):
    """A log whose first part was written with a narrow key and a narrow value, read and folded under the schema that holds both."""
    store, log = workspace(t.spark), t["w_log"]
    narrow = log.filter("_lsn % 1000 < 400").withColumns({"id": F.col("id").cast("int"), "amount": F.col("amount").cast("decimal(8,2)")})
    wide = log.filter("_lsn % 1000 >= 400").withColumn("amount", F.col("amount").cast("decimal(14,2)"))
    for part in (narrow, wide):
        store.append("log", part.withColumn(BUCKET, bucket_of(part.schema, ["id"], 16)), [BUCKET])
    merged = cdc.merge_structs([narrow.schema, wide.schema])
    read = store.read("log", T.StructType([*merged, T.StructField(BUCKET, T.IntegerType())]))
    buckets = read.groupBy("id").agg(F.count_distinct(BUCKET).alias("buckets"))
    return _state(cdc.fold_log(read.drop(BUCKET), ["id"])).withColumn("amount", F.col("amount").cast("double")).join(buckets, "id")


def _captured(t: Frames) -> CdcPipeline:
    """The job over the log as envelopes, in two batches; the second brings a part of the first again."""
    p, raw = CdcPipeline(workspace(t.spark)), _raw(t)
    p(raw.filter("offset < 6000"), 0)
    p(raw.filter("offset >= 5000"), 1)
    return p


_TAKEN = "#g AS (SELECT * FROM w_log WHERE _lsn % 50 <> 0 AND _lsn % 70 <> 0) "
_TAKEN_STATE = _TAKEN + "SELECT id, kind, CAST(amount AS double) AS amount, _lsn, is_deleted FROM (" + _STATE.format("g") + ")"


@query("sink_silver", _TAKEN_STATE, "w_log")
def _(t: Frames):
    return _state(_captured(t).state("users"))


@query("sink_bronze", _TAKEN + "SELECT id, _lsn, _op, kind, CAST(amount AS double) AS amount FROM g", "w_log")
def _(t: Frames):
    return _captured(t).log("users").select("id", "_lsn", "_op", "kind", "amount")


@query("cdc_replay", _TAKEN_STATE, "w_log")
def _(t: Frames):
    """The state rebuilt from the change log that the job left."""
    return _state(_captured(t).rebuilt("users"))


@query("sink_dead_letters", "SELECT _lsn AS offset, CASE WHEN _lsn % 50 = 0 THEN 'unparseable_envelope' ELSE 'missing_lsn' END AS reason FROM w_log WHERE _lsn % 50 = 0 OR _lsn % 70 = 0", "w_log")
def _(t: Frames):
    return _captured(t).dead_letters().select("offset", "reason")


@query(
    "cdc_streaming_metrics",
    "#b AS (SELECT CAST(0 AS bigint) AS batch, * FROM w_log WHERE _lsn < 6000 UNION ALL SELECT 1, * FROM w_log WHERE _lsn >= 5000) SELECT batch, 'events' AS measure, CASE WHEN _lsn % 50 <> 0 THEN _op END AS detail, count(*) AS n FROM b GROUP BY ALL UNION ALL SELECT batch, 'dead_letters', CASE WHEN _lsn % 50 = 0 THEN 'unparseable_envelope' ELSE 'missing_lsn' END, count(*) FROM b WHERE _lsn % 50 = 0 OR _lsn % 70 = 0 GROUP BY ALL UNION ALL SELECT 0, 'schema_changes', 'create', 1",
    "w_log",
)
def _(t: Frames):
    return _captured(t).store.read("metrics", METRICS).select("batch", "measure", "detail", "n")


@query("cdc_fold_stream", _STATE.format("w_log"), "w_log")
def _(t: Frames):
    """The state that a stream over the events keeps in its state store."""
    store = workspace(t.spark)
    log = t["w_log"].withColumn("_source_ts", F.col("_source_ts").cast("timestamp"))
    store.append("in", log.select("id", "kind", "amount", "_lsn", "_op", "_source_ts"))
    stream = t.spark.readStream.schema("id long, kind string, amount long, _lsn long, _op string, _source_ts timestamp").parquet(store.path("in"))
    sink = fold_stream(stream, ["id"], "60 days").writeStream.foreachBatch(write_updates(store, "state", ["id"])).outputMode("update")
    sink.option("checkpointLocation", store.path("checkpoint")).trigger(availableNow=True).start().awaitTermination()
    return _state(store.read("state", f"id long, kind string, amount long, _op string, _lsn long, _source_ts timestamp, _is_deleted boolean, {BUCKET} int"))


@query("cdc_parse_variant", "SELECT id, kind, CAST(amount AS double) AS amount, _op, _lsn FROM w_log WHERE _lsn % 50 <> 0 AND _lsn % 70 <> 0", "w_log")
def _(t: Frames):
    raw = cdc.raw_projection(_raw(t))
    return cdc.variant_changes(cdc.as_variant(raw), cdc.first_schema(raw)).select("id", "kind", "amount", "_op", "_lsn")


@query("cdc_drop_kafka_tombstones", "SELECT _lsn AS offset FROM w_log WHERE _lsn % 9 <> 0", "w_log")
def _(t: Frames):
    """Records without a value are neither changes nor letters."""
    raw = cdc.raw_projection(_raw(t)).withColumn("value", F.when(F.col("offset") % 9 != 0, F.col("value")))
    return cdc.decode_changes(raw, cdc.first_schema(raw), 1, as_of()).select(F.col("_kafka_offset").alias("offset"))


@query("cdc_unreadable_topic", "SELECT _lsn AS offset, 'unparseable_envelope' AS reason FROM w_log WHERE _lsn % 4 <> 0", "w_log")
def _(t: Frames):
    raw = cdc.raw_projection(_raw(t)).withColumn("value", F.when(F.col("offset") % 4 != 0, F.lit("no schema")))
    return cdc.unreadable(raw, as_of()).select("offset", "reason")


@query("incremental_cursor", "SELECT price_id, round(CAST(price AS double), 6) AS price, source_created_at FROM w_prices", "w_prices")
def _(t: Frames):
    """Two runs from a cursor, of which the second reads the boundary again, leave each observation once."""
    store, prices = workspace(t.spark), t["w_prices"].select("price_id", "price", F.col("source_created_at").cast("timestamp").alias("source_created_at"))
    put = write_updates(store, "prices", ["price_id"])
    for until in ("1998-01-01 00:00:00", AS_OF.replace("1999", "2099")):
        incremental.run_from_cursor(store, "prices", prices.filter(F.col("source_created_at") <= F.to_timestamp(F.lit(until))), "source_created_at", lambda df: put(df, 0))
    return store.read("prices", T.StructType([*prices.schema, T.StructField(BUCKET, T.IntegerType())])).drop(BUCKET)


# histories, digests, sketches

_PRICE_CHANGES = "SELECT user_id AS product_id, event_id AS _lsn, CAST(floor(value) AS bigint) % 7 AS price, ts FROM events WHERE event_type <> 'error'"
_LINES = "SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey % 200 AS product_id, l_suppkey AS supplier, CAST('2024-01-01 00:00:00' AS timestamp) + INTERVAL '1' MINUTE * ((l_orderkey * 7 + l_linenumber) % 45000) AS sold_at FROM lineitem"


@query("scd2_lookup_asof", f"WITH c AS ({_PRICE_CHANGES}), v AS (SELECT *, lag(price) OVER w AS p, row_number() OVER w AS n FROM c WINDOW w AS (PARTITION BY product_id ORDER BY _lsn)), h AS (SELECT product_id, price, ts AS valid_from FROM v WHERE n = 1 OR price <> p), f AS ({_LINES}) SELECT f.*, h.price FROM f ASOF LEFT JOIN h ON f.product_id = h.product_id AND f.sold_at >= h.valid_from")
def _(t: Frames):
    """Order lines with the price that held when they were sold."""
    h = history.scd2(t.sql(_PRICE_CHANGES), ["product_id"], ["price"], "ts")
    return history.scd2_lookup_asof(t.sql(_LINES), h, ["product_id"], "sold_at", ["price"])


_DIGEST = "CAST(('0x' || substr(md5({}), 1, 15)) AS bigint)"
_ROW = "coalesce('=' || CAST({0} AS varchar), 'null')"
_ORDER_DIGEST = _DIGEST.format(f"concat_ws('|', {', '.join(_ROW.format(c) for c in ('customer_id', 'order_id', 'promo_code', 'status', 'total'))})")
_ORDER_COLUMNS = ("order_id", "customer_id", "promo_code", "status", "total")


@query("chk_layer_digests", f"SELECT 'orders' AS \"table\", count(*) AS rows, CAST(sum(CAST({_ORDER_DIGEST} AS hugeint)) AS varchar) AS digest FROM w_orders UNION ALL SELECT 'stores', count(*), CAST(sum(CAST({_DIGEST.format('concat_ws(chr(124), ' + ', '.join(_ROW.format(c) for c in ('city_id', 'store_id', 'store_name')) + ')')} AS hugeint)) AS varchar) FROM w_stores", "w_orders w_stores")
def _(t: Frames):
    return quality.layer_checksums({"orders": t["w_orders"].select(*_ORDER_COLUMNS), "stores": t["w_stores"]}, portable=True)


@query("chk_ranges", f"SELECT order_id // 1000 AS \"range\", count(*) AS rows, CAST(sum(CAST({_ORDER_DIGEST} AS hugeint)) AS varchar) AS digest FROM w_orders GROUP BY 1", "w_orders")
def _(t: Frames):
    leaves = quality.digest_leaves(t["w_orders"].select(*_ORDER_COLUMNS), "order_id", 1000)
    return leaves.withColumn("digest", F.col("digest").cast("string"))


@query("rec_range_diff", "SELECT order_id, CASE WHEN order_id % 4001 = 0 THEN 'missing' WHEN order_id % 3001 = 7 THEN 'changed' ELSE 'extra' END AS kind FROM w_orders WHERE order_id % 4001 = 0 OR order_id % 3001 = 7 UNION ALL SELECT -1 - order_id, 'extra' FROM w_orders WHERE order_id % 5003 = 11 AND order_id % 4001 <> 0", "w_orders")
def _(t: Frames):
    """Rows that were dropped, changed and added here and there; only their key ranges are compared row by row."""
    o = t["w_orders"].select("order_id", "status", "total")
    changed = F.when(F.col("order_id") % 3001 == 7, F.col("total") + 1).otherwise(F.col("total")).cast("decimal(18,2)")
    other = o.filter("order_id % 4001 <> 0").withColumn("total", changed)
    return quality.diff_by_digests(o, other.unionByName(other.filter("order_id % 5003 = 11").withColumn("order_id", -1 - F.col("order_id"))), "order_id", 100)


@query("agg_approx_percentile", _FACT + "SELECT order_date, count(*) AS delivered_orders, true AS p50_close, true AS p90_close FROM f WHERE status = 'delivered' GROUP BY 1", _FACT_USES)
def _(t: Frames):
    """Daily quantiles merged from stored sketches of each hour and store; whether they stand at their ranks among the day's orders."""
    store, o = workspace(t.spark), _orders(t).filter("status = 'delivered'")
    each = sketches.quantile_sketches(o, ["order_date", "order_hour", "store_id"], "delivery_minutes")
    store.append("sla_sketches", each)
    daily = sketches.merge_quantiles(store.read("sla_sketches", each.schema), ["order_date"], {"p50": 0.5, "p90": 0.9})
    close = o.join(daily.drop("rows"), "order_date").groupBy("order_date").agg(*(sketches.rank_within(F.col("delivery_minutes"), F.col(c), r).alias(f"{c}_close") for c, r in (("p50", 0.5), ("p90", 0.9))))
    return daily.select("order_date", F.col("rows").alias("delivered_orders")).join(close, "order_date")


@query("agg_approx_distinct_span", _FACT + "SELECT CAST(date_trunc('week', order_date) AS date) AS week, count(DISTINCT customer_id) AS customers, true AS close FROM f GROUP BY 1", _FACT_USES)
def _(t: Frames):
    """Active customers of a week from the stored sketches of its days, and whether they are within four standard errors of the exact number."""
    store, o = workspace(t.spark), _orders(t)
    each = sketches.distinct_sketches(o, ["order_date"], "customer_id")
    store.append("active_sketches", each)
    week = week_start(F.col("order_date")).alias("week")
    about = sketches.merge_distinct(store.read("active_sketches", each.schema), [week], "about")
    exact = o.groupBy(week).agg(F.count_distinct("customer_id").alias("customers"))
    off = F.abs(F.col("about") - F.col("customers")) <= 1 + 4 * 0.83 / 2 ** (sketches.HLL_LOG / 2) * F.col("customers")
    return exact.join(about, "week").select("week", "customers", off.alias("close"))


# checks and operations


@query("dq_totals_broken", "SELECT order_id FROM w_orders WHERE order_id % 37 = 0", "w_orders")
def _(t: Frames):
    """One in thirty-seven orders has a total that is off by a hundredth."""
    off = F.when(F.col("order_id") % 37 == 0, F.col("total") + F.lit("0.01").cast("decimal(4,2)")).otherwise(F.col("total")).cast("decimal(18,2)")
    return t["w_orders"].withColumn("total", off).filter("total <> subtotal - discount + delivery_fee or total < 0").select("order_id")


_STEPS = "SELECT o_orderkey AS order_id, i, CASE WHEN i = 3 AND o_orderkey % 6 = 1 THEN 'delivered' WHEN i = 4 AND o_orderkey % 7 = 2 THEN 'cancelled' ELSE {} END AS status FROM orders, {} WHERE i <= 2 + o_orderkey % 4"
_ALLOWED = " OR ".join(f"(before = '{a}' AND status IN ({', '.join(repr(x) for x in b)}))" for a, b in quality.TRANSITIONS.items())


@query("dq_state_transitions", f"WITH h AS ({_STEPS.format('[' + chr(39) + (chr(39) + ', ' + chr(39)).join(['placed', 'accepted', 'picking', 'packed', 'out_for_delivery']) + chr(39) + '][i]', '(SELECT unnest(range(1, 6)) AS i)')}), s AS (SELECT *, lag(status) OVER (PARTITION BY order_id ORDER BY i) AS before FROM h) SELECT order_id, before, status FROM s WHERE before IS NOT NULL AND NOT ({_ALLOWED})")
def _(t: Frames):
    """Histories of two to five steps, some of which skip one or end too late."""
    names = F.array(*(F.lit(x) for x in ("placed", "accepted", "picking", "packed", "out_for_delivery")))
    o = t.base("orders").select(F.col("o_orderkey").alias("order_id"), F.posexplode(names).alias("p", "name")).withColumn("i", F.col("p") + 1).filter(F.col("i") <= 2 + F.col("order_id") % 4)
    status = F.when((F.col("i") == 3) & (F.col("order_id") % 6 == 1), "delivered").when((F.col("i") == 4) & (F.col("order_id") % 7 == 2), "cancelled").otherwise(F.col("name"))
    return quality.check_transitions(o.select("order_id", "i", status.alias("status")), "order_id", "status", ["i"])


def _fresh(t: Frames) -> DataFrame:
    at = F.to_timestamp(F.lit("2001-09-01 00:00:00"))
    return quality.freshness({"orders": t["w_orders"], "stock": t["w_stock"].withColumn("_ingested_at", F.lit(None).cast("timestamp")), "items": t["w_items"].filter("order_id < 100")}, at, 60 * 24 * 10, 60 * 24 * 60)


_FRESH = "#n AS (SELECT 'orders' AS \"table\", max(_ingested_at) AS newest FROM w_orders UNION ALL SELECT 'stock', NULL UNION ALL SELECT 'items', max(_ingested_at) FROM w_items WHERE order_id < 100), r AS (SELECT *, date_diff('second', newest, TIMESTAMP '2001-09-01') / 60.0 AS age FROM n), fresh AS (SELECT \"table\", newest, round(age, 6) AS minutes_old, CASE WHEN age IS NULL OR age > 86400 THEN 'error' WHEN age > 14400 THEN 'warn' ELSE 'pass' END AS state FROM r) "


@query("dq_freshness", _FRESH + 'SELECT "table", newest, minutes_old, state FROM fresh', "w_orders w_items")
def _(t: Frames):
    return _fresh(t)


@query("ops_health", _FRESH + ", l AS (SELECT count(*) AS n FROM w_log WHERE _lsn % 50 = 0 OR _lsn % 70 = 0), g AS (SELECT 'kind ' || _op AS topic, count(*) AS behind FROM w_log GROUP BY 1) SELECT 'fresh:' || \"table\" AS \"check\", state <> 'error' AS ok FROM fresh UNION ALL SELECT 'dead_letters', n = 0 FROM l UNION ALL SELECT 'behind:' || topic, behind <= 2500 FROM g", "w_orders w_items w_log")
def _(t: Frames):
    behind = t["w_log"].groupBy(F.concat(F.lit("kind "), "_op").alias("topic")).agg(F.count("*").alias("behind"))
    return quality.health(_fresh(t), cdc.dead_letters(_decoded(t)), behind, 2500).select("check", "ok")


def _altered(t: Frames) -> DataFrame:
    """Orders without a column, with one more, and with other totals and statuses here and there."""
    o = t["w_orders"].select("order_id", "status", "total", "placed_at", "tip_amount")
    total = F.when(F.col("order_id") % 97 == 0, F.col("total") + 1).otherwise(F.col("total")).cast("decimal(18,2)")
    return o.withColumns({"total": total, "more": F.lit(1), "_own": F.lit(2)}).drop("tip_amount")


@query("rec_compare", "SELECT label, a IS NOT DISTINCT FROM b AS same FROM (SELECT 'rows' AS label, count(*)::varchar AS a, count(*)::varchar AS b FROM w_orders UNION ALL SELECT 'order_id.count', '', '' UNION ALL SELECT 'order_id.sum', '', '' UNION ALL SELECT 'status.count', '', '' UNION ALL SELECT 'status.length', '', '' UNION ALL SELECT 'total.count', '', '' UNION ALL SELECT 'total.sum', '0', CAST(count(*) AS varchar) FROM w_orders WHERE order_id % 97 = 0 UNION ALL SELECT 'placed_at.count', '', '' UNION ALL SELECT 'placed_at.min', '', '' UNION ALL SELECT 'placed_at.max', '', '')", "w_orders")
def _(t: Frames):
    both = ["order_id", "status", "total", "placed_at"]
    a, b = (quality.profile(df.select(*both)).select("label", F.col("value").alias(n)) for df, n in ((t["w_orders"], "a"), (_altered(t), "b")))
    return a.join(b, "label").select("label", quality.same_value(F.col("label"), F.col("a"), F.col("b")).alias("same"))


@query("rec_modes", "SELECT 'all' AS mode, false AS ok, count(*) AS rows_source, count(*) AS rows_target, 'missing:tip_amount,total.sum' AS mismatches, 'more' AS warnings FROM w_orders UNION ALL SELECT 'settled', count(*) FILTER (WHERE order_id % 97 = 0) = 0 AND false, count(*), count(*), 'missing:tip_amount' || CASE WHEN count(*) FILTER (WHERE order_id % 97 = 0) > 0 THEN ',total.sum' ELSE '' END, 'more' FROM w_orders WHERE placed_at < TIMESTAMP '1998-01-01'", "w_orders")
def _(t: Frames):
    """All rows, and those settled before a cut; columns that only one side has are named."""
    o = t["w_orders"].select("order_id", "status", "total", "placed_at", "tip_amount")
    cut = F.col("placed_at") < F.to_timestamp(F.lit("1998-01-01 00:00:00"))
    runs = [quality.reconcile(o, _altered(t), mode, c).withColumnRenamed("table", "mode") for mode, c in (("all", None), ("settled", cut))]
    return runs[0].unionByName(runs[1])


@query("set_checksum_diff", "SELECT 'items' AS \"table\" UNION ALL SELECT 'new' WHERE EXISTS (SELECT 1 FROM w_stores)", "w_stores")
def _(t: Frames):
    """Of four tables one lost rows and one is new."""
    before = quality.layer_checksums({"orders": t["w_orders"], "items": t["w_items"], "stores": t["w_stores"]})
    after = quality.layer_checksums({"orders": t["w_orders"].repartition(5), "items": t["w_items"].filter("quantity > 1"), "stores": t["w_stores"], "new": t["w_stores"]})
    return quality.checksum_diff(before, after)


@query("mnt_purge_tombstones", "#s AS (SELECT id, max(_lsn) AS _lsn, arg_max(_op, _lsn) AS op, arg_max(_source_ts, _lsn) AS seen FROM w_log GROUP BY 1) SELECT id, op = 'd' AS is_deleted FROM s WHERE NOT (op = 'd' AND seen < TIMESTAMP '2024-01-31' - INTERVAL 2 DAY)", "w_log")
def _(t: Frames):
    state = cdc.fold_log(t["w_log"], ["id"]).withColumn("_source_ts", F.col("_source_ts").cast("timestamp"))
    return quality.purge_tombstones(state, 2, F.to_timestamp(F.lit("2024-01-31 00:00:00"))).select("id", F.col("_is_deleted").alias("is_deleted"))


# reports and marts whole


@query("report_index_monthly", "#m AS (SELECT * REPLACE (CAST(date_trunc('month', observed_on) AS date) AS observed_on) FROM w_prices), " + _INDEX.lstrip("#").replace("w_prices", "m") + "SELECT category_tag, currency, observed_on, series_observed, round(price_index, 6) AS price_index FROM (SELECT *, row_number() OVER (PARTITION BY category_tag, currency ORDER BY observed_on DESC) AS r FROM ix WHERE category_tag <> 'en:unknown') WHERE r = 1 AND series_observed >= 3 ORDER BY series_observed DESC, category_tag, currency LIMIT 15", "w_prices w_market_products")
def _(t: Frames):
    """Observations by month, so that the newest of a category has several series."""
    monthly = t["w_prices"].withColumn("observed_on", F.trunc("observed_on", "month"))
    return models.report_index(models.mart_category_price_index_daily(monthly, t["w_market_products"]))


@query("report_basket", _FACT + ", l AS (SELECT order_id, sum(line_total) v, sum(CASE WHEN price_source = 'open_prices' THEN line_total ELSE 0 END) vp, sum(CASE WHEN catalogue_source = 'open_food_facts' THEN line_total ELSE 0 END) vc FROM w_items JOIN w_products USING (product_id) GROUP BY 1), b AS (SELECT order_date, c.city_name, count(*) AS n, CAST(sum(subtotal) AS double) AS g, CAST(sum(vp) AS double) / CAST(sum(v) AS double) AS p, CAST(sum(vc) AS double) / CAST(sum(v) AS double) AS c FROM f JOIN w_stores USING (store_id) JOIN w_cities c USING (city_id) LEFT JOIN l USING (order_id) WHERE status = 'delivered' GROUP BY 1, 2) SELECT round(sum(g) / sum(n), 6) AS average_basket, round(sum(p * g) / sum(g), 6) AS real_price_share, round(sum(c * g) / sum(g), 6) AS real_product_share FROM b WHERE order_date >= DATE '1998-12-25'", _FACT_USES + " w_products w_stores w_cities")
def _(t: Frames):
    """The report's days are asked for below the joins: every table is read whole, rows of other days' orders are not sorted for them."""
    orders = t["w_orders"].filter(local_date(F.col("placed_at")) >= F.to_date(as_of()) - F.expr("INTERVAL 7 DAYS"))
    of = lambda name: t[name].join(orders.select("order_id"), "order_id", "left_semi")
    items = of("w_items")
    facts = models.fct_orders(orders, items, of("w_refunds"), of("w_assignments"), of("w_payments"))
    return models.report_basket(models.mart_basket_daily(facts, models.fct_order_items(items, orders, t["w_products"]), _products(t), _stores(t)), as_of())


_GONE = "SELECT i.order_id, i.line_total, TIMESTAMP '2024-01-01' + INTERVAL '1' DAY * (i.order_id % 30) AS removed_at FROM w_items i WHERE quantity = 50"
_ITEM_STORES = "SELECT order_id, product_id, quantity, line_total, CAST(order_id % 10 AS int) AS store_id FROM w_items"


@query(
    "mart_inventory_health_whole",
    _PERIODS + f", o AS (SELECT order_id, status, CAST(order_id % 10 AS int) AS store_id, placed_at FROM w_orders), i AS ({_ITEM_STORES}), sold AS (SELECT store_id, product_id, CAST(sum(quantity) AS double) / nullif(date_diff('millisecond', min(placed_at), max(placed_at)) / 60000.0, 0) AS rate, CAST(sum(line_total) AS double) / nullif(sum(quantity), 0) AS price FROM i JOIN o USING (order_id, store_id) WHERE status = 'delivered' GROUP BY 1, 2), n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY store_id, product_id ORDER BY _lsn DESC) AS r FROM w_stock) WHERE r = 1 AND _op <> 'd'), c AS (SELECT store_id, count(*) AS skus_listed, count(*) FILTER (WHERE on_hand = 0) AS skus_at_zero_now, count(*) FILTER (WHERE on_hand <= reorder_point) AS skus_below_reorder_point FROM n GROUP BY 1), d AS (SELECT p.store_id, CAST(started_at + INTERVAL 330 MINUTE AS date) AS activity_date, count(*) AS stockout_events, count(DISTINCT p.product_id) AS skus_stocked_out, count(DISTINCT n.product_id) AS l, count(*) FILTER (WHERE is_ongoing) AS stockouts_ongoing, sum(stockout_minutes) AS m, sum(stockout_minutes * coalesce(rate, 0)) AS lu, sum(stockout_minutes * coalesce(rate, 0) * coalesce(price, 0)) AS ls FROM periods p LEFT JOIN sold s ON s.store_id = p.store_id AND s.product_id = p.product_id LEFT JOIN n ON n.store_id = p.store_id AND n.product_id = p.product_id GROUP BY 1, 2), gone AS (SELECT o.store_id, CAST(removed_at + INTERVAL 330 MINUTE AS date) AS activity_date, count(*) AS k, sum(line_total) AS v FROM ({_GONE}) JOIN o USING (order_id) GROUP BY 1, 2) SELECT store_id, activity_date, skus_listed, skus_at_zero_now, skus_below_reorder_point, stockout_events, skus_stocked_out, stockouts_ongoing, round(m, 6) AS stockout_minutes, round(l / CAST(nullif(skus_listed, 0) AS double), 6) AS stockout_rate, round(lu, 6) AS estimated_lost_units, round(ls, 2) AS estimated_lost_sales, coalesce(k, 0) AS lines_removed_at_picking, round(CAST(coalesce(v, 0) AS double), 6) AS value_removed_at_picking FROM d LEFT JOIN c USING (store_id) LEFT JOIN gone USING (store_id, activity_date)",
    "w_stock w_orders w_items",
)
def _(t: Frames):
    """All columns, with sales of the stores that the stock has, and removals in its days."""
    stock = history.latest_per_key(t["w_stock"], ["store_id", "product_id"], ["_lsn"]).filter("_op <> 'd'")
    store = (F.col("order_id") % 10).cast("int")
    gone = t["w_items"].filter("quantity = 50").select("order_id", "line_total", F.timestamp_add("DAY", (F.col("order_id") % 30).cast("int"), F.to_timestamp(F.lit("2024-01-01 00:00:00"))).alias("removed_at"))
    return models.mart_inventory_health_daily(_periods(t), t["w_items"].withColumn("store_id", store), t["w_orders"].withColumn("store_id", store), stock, gone)


# ingestion

_SEEN = "o_orderkey % 17 <> 0 AND o_orderkey % 29 <> 0 AND o_orderkey % 23 <> 0 AND o_orderkey % 5 <> 3"
_ITEM_SQL = """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 17 = 0 THEN 'n/a' ELSE concat(CAST(o_orderkey % 1000 AS string), '.25') END AS price, element_at(array('inr', 'EUR', 'usd', 'RUPEE', 'Gbp'), CAST(o_orderkey % 5 AS int) + 1) AS currency,
    CASE WHEN o_orderkey % 29 = 0 THEN '' ELSE concat(CAST(CAST(o_orderdate AS date) AS string), 'T00:00') END AS date, concat(CAST(CAST(o_orderdate AS date) AS string), 'T01:02:03Z') AS created, CASE WHEN o_orderkey % 23 = 0 THEN o_orderkey + 1 ELSE 0 END AS duplicate_of,
    concat('  code ', CAST(o_custkey AS string), ' ') AS product_code, 'unused' AS product_name, 'en:x' AS category_tag, 'KILOGRAM' AS price_per, o_orderkey % 2 = 0 AS price_is_discounted, CASE WHEN o_orderkey % 2 = 0 THEN '12.5' END AS price_without_discount, o_custkey % 40 AS location_id,
    named_struct('osm_name', concat(' Shop   ', CAST(o_custkey % 40 AS string)), 'osm_brand', '', 'osm_address_city', 'Pune', 'osm_address_country_code', 'in', 'osm_lat', CAST(1.5 AS double), 'osm_lon', CAST(2.5 AS double)) AS location, o_custkey AS product_id,
    named_struct('code', CAST(o_custkey AS string), 'product_name', concat('Item  ', CAST(o_custkey AS string)), 'brands', concat('Brand', CAST(o_custkey % 7 AS string), ', Other'), 'categories_tags', array('fr:x', element_at(array('en:teas', 'en:milks', 'en:chips-and-fries', 'en:unknown-things'), CAST(o_custkey % 4 AS int) + 1)),
        'product_quantity', CAST(o_custkey AS double) / 8, 'product_quantity_unit', 'g', 'nutriscore_grade', element_at(array('a', 'b', 'z'), CAST(o_custkey % 3 AS int) + 1)) AS product FROM orders"""
_CATEGORY = "['Tea, Coffee & Breakfast', 'Dairy, Bread & Eggs', 'Snacks & Munchies', NULL][CAST({0} % 4 AS int) + 1]"


@query("obs_normalise", f"SELECT o_orderkey AS price_id, o_custkey AS market_product_id, o_custkey % 40 AS location_id, 'code ' || o_custkey AS product_code, CAST(o_orderkey % 1000 AS double) + 0.25 AS price, upper(['inr', 'EUR', 'usd', 'RUPEE', 'Gbp'][CAST(o_orderkey % 5 AS int) + 1]) AS currency, o_orderkey % 2 = 0 AS is_discounted, CASE WHEN o_orderkey % 2 = 0 THEN 12.5::double END AS price_without_discount, CAST(o_orderdate AS date) AS observed_on, CAST(CAST(o_orderdate AS date) AS timestamp) + INTERVAL 3723 SECOND AS source_created_at FROM orders WHERE {_SEEN}")
def _(t: Frames):
    """Prices out of items of which some repeat others, or have no price, currency or date."""
    p = observations.normalise_observations(t.sql(_ITEM_SQL))["prices"]
    return p.select("price_id", "market_product_id", "location_id", "product_code", "price", "currency", "is_discounted", "price_without_discount", "observed_on", F.col("source_created_at").cast("timestamp_ntz").alias("source_created_at"))


@query("obs_category_map", f"SELECT o_custkey AS market_product_id, CAST(o_custkey AS varchar) AS code, 'Item ' || o_custkey AS name, 'Brand' || (o_custkey % 7) AS brand, ['en:teas', 'en:milks', 'en:chips-and-fries', 'en:unknown-things'][CAST(o_custkey % 4 AS int) + 1] AS category_tag, {_CATEGORY.format('o_custkey')} AS store_category, round(round_even(CAST(o_custkey AS decimal(18,6)) / 8, 3)::double, 6) AS quantity, ['a', 'b', NULL][CAST(o_custkey % 3 AS int) + 1] AS nutriscore_grade FROM orders WHERE {_SEEN} GROUP BY o_custkey")
def _(t: Frames):
    p = observations.normalise_observations(t.sql(_ITEM_SQL))["products"]
    return p.select("market_product_id", "code", "name", "brand", "category_tag", "store_category", "quantity", "nutriscore_grade")


@query("obs_rejected", f"SELECT o_orderkey AS id FROM orders WHERE NOT ({_SEEN})")
def _(t: Frames):
    return observations.normalise_observations(t.sql(_ITEM_SQL))["rejected"].select("id")


@query("mandi_parse", "SELECT 'Market ' || (o_custkey % 50) AS market, CAST(o_orderdate AS date) AS arrival_date, CAST(o_orderkey % 500 AS double) AS min_price, CAST(o_orderkey % 500 + 10 AS double) AS max_price, CAST(o_orderkey % 500 + 5 AS double) AS modal_price, 'Onion' AS commodity FROM orders WHERE o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0 AND o_orderkey % 19 <> 0")
def _(t: Frames):
    """Wholesale records of which some have no market, a date in another form, or a price below zero."""
    o = t.base("orders")
    k, text = F.col("o_orderkey"), lambda c: c.cast("string")
    records = o.select(
        F.lit("KA").alias("state"), F.lit("B").alias("district"), F.when(k % 11 == 0, " ").otherwise(F.concat(F.lit("  Market  "), text(F.col("o_custkey") % 50))).alias("market"), F.lit("Onion").alias("commodity"), F.lit("v").alias("variety"), F.lit("g").alias("grade"),
        F.when(k % 13 == 0, text(F.to_date("o_orderdate"))).otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("arrival_date"), F.when(k % 19 == 0, "-1").otherwise(text(k % 500)).alias("min_price"), text(k % 500 + 10).alias("max_price"), text(k % 500 + 5).alias("modal_price"),
    )
    return observations.parse_mandi(records).select("market", "arrival_date", "min_price", "max_price", "modal_price", "commodity")


_CATALOGUE = "SELECT CAST(8900000 + p_partkey AS string) AS code, p_name AS product_name, CASE WHEN p_partkey % 3 = 0 THEN concat(p_name, ' (en)') END AS product_name_en, CASE WHEN p_partkey % 10 > 0 THEN concat(p_brand, ',x') END AS brands, CASE WHEN p_partkey % 2 = 0 THEN '1 kg' END AS quantity, array(element_at(array('en:teas', 'en:milks', 'en:chips-and-fries', 'en:unknown-things'), CAST(p_partkey % 4 AS int) + 1)) AS categories_tags, element_at(array('A', 'b', 'z'), CAST(p_partkey % 3 AS int) + 1) AS nutriscore_grade, 'http://x' AS image_front_small_url, p_partkey % 7 = 0 AS priced FROM part"


@query("cat_select_products", f"WITH c AS (SELECT CAST(8900000 + p_partkey AS varchar) AS code, substr(CASE WHEN p_partkey % 3 = 0 THEN p_name || ' (en)' ELSE p_name END, 1, 120) AS name, p_brand AS brand, CASE WHEN p_partkey % 2 = 0 THEN '1 kg' ELSE '1 pack' END AS quantity, {_CATEGORY.format('p_partkey')} AS category, ['a', 'b', NULL][CAST(p_partkey % 3 AS int) + 1] AS nutriscore_grade, p_partkey % 7 = 0 AS has_inr_price FROM part WHERE p_partkey % 10 > 0 AND p_partkey % 4 <> 3) SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY category ORDER BY has_inr_price DESC, code) <= 60")
def _(t: Frames):
    return observations.select_catalogue(t.sql(_CATALOGUE)).drop("image_url")


@query("obs_link_catalogue", "SELECT p_partkey AS product_id, CAST(8900000 + p_partkey AS varchar) AS off_code, CASE WHEN p_partkey % 10 > 0 THEN ['A', 'b', 'z'][CAST(p_partkey % 3 AS int) + 1] END AS nutriscore_grade, 'open_food_facts' AS catalogue_source FROM part WHERE p_partkey % 2 = 0")
def _(t: Frames):
    products = t.base("part").select(F.col("p_partkey").alias("product_id"), F.concat(F.when(F.col("p_partkey") % 2 == 0, "OFF-").otherwise("SIM-"), (8900000 + F.col("p_partkey")).cast("string")).alias("sku"))
    catalogue = t.sql(_CATALOGUE).filter("brands is not null").select("code", "nutriscore_grade", F.col("image_front_small_url").alias("image_url"))
    return observations.link_catalogue(products, catalogue).select("product_id", "off_code", "nutriscore_grade", "catalogue_source")


@query("src_json_pages", "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 17 = 0 THEN 'n/a' ELSE (o_orderkey % 1000) || '.25' END AS price, CAST(o_custkey AS varchar) AS code, 'en:x' AS category_tag FROM orders")
def _(t: Frames):
    """The items as gzipped pages of nested JSON, read back."""
    store = workspace(t.spark)
    pages = t.sql(_ITEM_SQL).groupBy((F.col("id") % 64).alias("page")).agg(F.collect_list(F.struct("id", "price", "currency", "product", "category_tag")).alias("items"))
    pages.write.option("compression", "gzip").json(store.path("pages"))
    return json_items(t.spark, store.path("pages"), observations.ITEM, "items", lines=True).select("id", "price", F.col("product.code").alias("code"), "category_tag")


@query("sink_gold_table", "SELECT category_name, count(*) AS products FROM w_products JOIN w_categories USING (category_id) WHERE product_id % 2 = 0 GROUP BY 1", "w_products w_categories")
def _(t: Frames):
    """A mart built twice as a table: the second run takes the place of the first."""
    store = workspace(t.spark)
    for part in ("product_id > 0", "product_id % 2 = 0"):
        mart = models.mart_catalogue_coverage(_products(t).filter(part))
        store.rebuild("mart_catalogue_coverage", mart)
    return store.read("mart_catalogue_coverage", mart.schema).select("category_name", "products")


@query("sink_report_json", "#c AS (SELECT category_name, count(*) AS products, count(*) FILTER (WHERE catalogue_source = 'open_food_facts') AS real_products, count(*) FILTER (WHERE price_source = 'open_prices') AS real_priced_products FROM w_products JOIN w_categories USING (category_id) GROUP BY 1), j AS (SELECT CAST(to_json({category_name: category_name, products: products, real_products: real_products, real_priced_products: real_priced_products}) AS varchar) AS r FROM c) SELECT 'coverage' AS report, '[' || string_agg(r, ',' ORDER BY r) || ']' AS body FROM j", "w_products w_categories")
def _(t: Frames):
    return models.report_json({"coverage": models.report_coverage(models.mart_catalogue_coverage(_products(t)))})
