"""Retail models over current-state tables and change logs: staging, core, marts and reports, each a function of frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import local_date, local_ts, minutes_between, optional_col, ratio, week_start
from tidemark.operators import history
from tidemark.operators.cdc import dedupe_changes, live

#: Columns of each staging view; a pair renames (old, new).
STAGING: dict[str, list] = {
    "categories": ["category_id", ("name", "category_name"), "is_perishable"],
    "cities": ["city_id", ("name", "city_name"), "state", "center_lat", "center_lng"],
    "customers": ["customer_id", "city_id", "signup_at"],
    "dark_stores": ["store_id", "city_id", ("name", "store_name"), "lat", "lng", "service_radius_km", "max_concurrent_orders", "status", "opened_at", "updated_at"],
    "delivery_assignments": ["assignment_id", "order_id", "rider_id", "assigned_at", "picked_up_at", "delivered_at", "distance_km"],
    "inventory": ["store_id", "product_id", "on_hand", "reorder_point", "max_stock", "last_restocked_at", "updated_at"],
    "mandi_prices": ["state", "district", "market", "commodity", "variety", "grade", "arrival_date", "min_price", "max_price", "modal_price"],
    "market_locations": ["location_id", ("osm_name", "shop_name"), ("brand", "shop_brand"), "city", "country_code", "lat", "lon"],
    "market_prices": ["price_id", "market_product_id", "location_id", "product_code", "category_tag", "price", "currency", "is_discounted", "price_without_discount", "price_per", "observed_on", "source_created_at", "_ingested_at"],
    "market_products": ["market_product_id", ("code", "product_code"), ("name", "product_name"), "brand", "category_tag", "store_category", "quantity", "quantity_unit", "nutriscore_grade"],
    "order_items": ["order_item_id", "order_id", "product_id", "quantity", "unit_price", "mrp", "line_total", "substituted_for_product_id", "updated_at", "_ingested_at"],
    "order_status_history": ["status_event_id", "order_id", "status", "actor", "occurred_at"],
    "orders": ["order_id", "customer_id", "store_id", "address_id", "distance_km", "status", "promo_code", "items_count", "subtotal", "discount", "delivery_fee", "total", "payment_method", "promised_minutes", "placed_at", "accepted_at", "picking_started_at", "packed_at", "dispatched_at", "delivered_at", "cancelled_at", "cancel_reason", "updated_at", "_ingested_at"],
    "payments": ["payment_id", "order_id", "method", "amount", ("status", "payment_status"), "created_at", "updated_at", "_ingested_at"],
    "products": ["product_id", "sku", ("name", "product_name"), "brand", "category_id", "unit", "mrp", "selling_price", "is_active", "updated_at"],
    "promotions": ["promo_id", ("code", "promo_code"), "discount_type", "discount_value", "max_discount", "min_order_value", "starts_at", "ends_at"],
    "refunds": ["refund_id", "order_id", "payment_id", "amount", "reason", ("status", "refund_status"), "created_at", "_ingested_at"],
    "rider_shifts": ["shift_id", "rider_id", "store_id", "started_at", "ended_at"],
    "riders": ["rider_id", "store_id", "vehicle_type", "status", "joined_at"],
}
#: Columns of each change view, its key, and whether deletes stay in it.
CHANGES = {
    "products": (["product_id"], ["mrp", "selling_price", "is_active", "updated_at"], False),
    "dark_stores": (["store_id"], ["service_radius_km", "max_concurrent_orders", "status", "updated_at"], False),
    "inventory": (["store_id", "product_id"], ["on_hand", "updated_at"], True),
    "order_items": (["order_item_id"], ["order_id", "product_id", "quantity", "unit_price", "line_total", "updated_at"], True),
}


def stage(name: str, silver: DataFrame) -> DataFrame:
    """The live rows of a current-state table under the names that models use; columns that came later are typed nulls until then."""
    cols = [F.col(c[0]).alias(c[1]) if isinstance(c, tuple) else F.col(c) for c in STAGING[name]]
    if name == "orders":
        cols.append(optional_col(silver, "tip_amount", "decimal(8,2)"))
    if name == "products":
        given = lambda c: F.coalesce(optional_col(silver, c, "string"), F.lit("simulated")).alias(c)
        cols += [optional_col(silver, "off_code", "string"), given("catalogue_source"), given("price_source"), optional_col(silver, "nutriscore_grade", "string")]
    return live(silver).select(*cols)


def stage_changes(name: str, bronze: DataFrame) -> DataFrame:
    keys, cols, deletes = CHANGES[name]
    once = dedupe_changes(bronze, keys)
    return (once if deletes else once.filter(F.col("_op").isin("r", "c", "u"))).select(*keys, *cols, "_op", "_lsn", "_source_ts")


def stockout_periods(inventory_changes: DataFrame, as_of: Column) -> DataFrame:
    state = F.when(F.col("_op") == "d", "delisted").when(F.col("on_hand") == 0, "out").otherwise("in")
    found = history.state_periods(inventory_changes, ["store_id", "product_id"], state, F.coalesce("updated_at", "_source_ts"), "out", as_of)
    return found.withColumnRenamed("minutes", "stockout_minutes")


def removed_items(item_changes: DataFrame) -> DataFrame:
    return history.removed_rows(item_changes, ["order_item_id"], ["order_id", "product_id", "quantity", "unit_price", "line_total"])


def dim_store(stores: DataFrame, cities: DataFrame) -> DataFrame:
    return stores.join(cities.select("city_id", "city_name", "state"), "city_id").drop("updated_at")


def dim_store_history(changes: DataFrame) -> DataFrame:
    return history.scd2(changes, ["store_id"], ["service_radius_km", "max_concurrent_orders", "status"], "updated_at")


def dim_product(products: DataFrame, categories: DataFrame) -> DataFrame:
    p = products.join(categories.select("category_id", "category_name", "is_perishable"), "category_id")
    return p.withColumn("discount_rate", F.round(1 - ratio(F.col("selling_price"), F.col("mrp")), 4)).drop("updated_at")


def dim_product_price_history(changes: DataFrame) -> DataFrame:
    return history.scd2(changes, ["product_id"], ["mrp", "selling_price"], "updated_at")


def dim_customer(customers: DataFrame, orders: DataFrame) -> DataFrame:
    done = orders.filter("status = 'delivered'").groupBy("customer_id").agg(
        F.min("order_date").alias("first_order_date"), F.max("order_date").alias("last_order_date"), F.count("*").alias("n"), F.sum("net_revenue").alias("r")
    )
    c = customers.select("customer_id", "city_id", "signup_at").join(done, "customer_id", "left")
    return c.select(
        "customer_id", "city_id", "signup_at", "first_order_date", week_start(F.col("first_order_date")).alias("cohort_week"), "last_order_date",
        F.coalesce("n", F.lit(0)).cast("long").alias("delivered_orders"), F.coalesce("r", F.lit(0)).alias("lifetime_net_revenue"),
    )


def fct_orders(orders: DataFrame, items: DataFrame, refunds: DataFrame, assignments: DataFrame, payments: DataFrame) -> DataFrame:
    """Lines and refunds are added up before they meet the orders, so no join multiplies rows."""
    lines = items.groupBy("order_id").agg(F.count("*").alias("l"), F.sum("quantity").alias("u"), F.count("substituted_for_product_id").alias("s"))
    back = refunds.groupBy("order_id").agg(F.sum("amount").alias("r"))
    o = orders.join(lines, "order_id", "left").join(back, "order_id", "left").join(assignments.select("order_id", "rider_id"), "order_id", "left").join(payments.select("order_id", "payment_status"), "order_id", "left")
    m = lambda a, b: minutes_between(F.col(a), F.col(b))
    refunded, delivery = F.coalesce("r", F.lit(0)), m("placed_at", "delivered_at")
    return o.select(
        "order_id", "customer_id", "store_id", "rider_id", "status", "cancel_reason", "payment_method", "payment_status", "promo_code", F.col("promo_code").isNotNull().alias("used_promo"),
        local_date(F.col("placed_at")).alias("order_date"), F.hour(local_ts(F.col("placed_at"))).alias("order_hour"),
        "placed_at", "accepted_at", "picking_started_at", "packed_at", "dispatched_at", "delivered_at", "cancelled_at", "promised_minutes", "distance_km",
        *(F.coalesce(c, F.lit(0)).cast("long").alias(n) for c, n in (("l", "line_count"), ("u", "units"), ("s", "substituted_lines"))),
        "subtotal", "discount", "delivery_fee", "total", "tip_amount", refunded.alias("refunded_amount"), (F.col("total") - refunded).alias("net_revenue"),
        m("placed_at", "accepted_at").alias("minutes_to_accept"), m("picking_started_at", "packed_at").alias("minutes_to_pick"), m("packed_at", "dispatched_at").alias("minutes_waiting_for_rider"),
        m("dispatched_at", "delivered_at").alias("minutes_in_transit"), delivery.alias("delivery_minutes"), F.when(F.col("status") == "delivered", delivery <= F.col("promised_minutes")).alias("sla_met"), "_ingested_at",
    )


def fct_order_items(items: DataFrame, orders: DataFrame, products: DataFrame, touched: DataFrame | None = None) -> DataFrame:
    i = items if touched is None else items.join(touched, "order_id", "left_semi")
    o = orders.select("order_id", "store_id", "placed_at", F.col("status").alias("order_status"))
    return i.join(o, "order_id").join(products.select("product_id", "category_id"), "product_id").select(
        *(c for c in ("order_item_id",) if c in items.columns), "order_id", "store_id", local_date(F.col("placed_at")).alias("order_date"), "order_status", "product_id", "category_id", "quantity", "unit_price", "mrp", "line_total",
        "substituted_for_product_id", F.col("substituted_for_product_id").isNotNull().alias("is_substitution"), "_ingested_at",
    )


def mart_order_funnel_daily(orders: DataFrame) -> DataFrame:
    stages = {"accepted_at": "orders_accepted", "picking_started_at": "orders_picking_started", "packed_at": "orders_packed", "dispatched_at": "orders_dispatched"}
    reasons = {"customer_cancelled": "cancelled_by_customer", "payment_failed": "cancelled_payment_failed", "items_unavailable": "cancelled_items_unavailable", "system_recovery": "cancelled_system_recovery"}
    status = F.col("status")
    return orders.groupBy("order_date", "store_id").agg(
        F.count("*").alias("orders_placed"), *(F.count(c).alias(n) for c, n in stages.items()), F.count_if(status == "delivered").alias("orders_delivered"), F.count_if(status == "cancelled").alias("orders_cancelled"),
        *(F.count_if(F.col("cancel_reason") == r).alias(n) for r, n in reasons.items()), F.count_if(~status.isin("delivered", "cancelled")).alias("orders_in_flight"),
        ratio(F.count_if(status == "delivered"), F.count("*")).alias("placed_to_delivered_rate"),
    )


def mart_delivery_sla_hourly(orders: DataFrame, exact: bool = False) -> DataFrame:
    pct = (lambda p: F.percentile("delivery_minutes", p)) if exact else (lambda p: F.percentile_approx("delivery_minutes", p, 10000))
    late = F.when(~F.col("sla_met"), F.col("delivery_minutes") - F.col("promised_minutes"))
    return orders.filter("status = 'delivered'").groupBy("order_date", "order_hour", "store_id").agg(
        F.count("*").alias("delivered_orders"), F.max("promised_minutes").alias("promised_minutes_max"), F.avg("delivery_minutes").alias("avg_delivery_minutes"),
        pct(0.5).alias("p50_delivery_minutes"), pct(0.9).alias("p90_delivery_minutes"), ratio(F.count_if("sla_met"), F.count("*")).alias("pct_within_promise"), F.avg(late).alias("avg_minutes_late_when_breached"),
        *(F.avg(c).alias(f"avg_{c}") for c in ("minutes_to_accept", "minutes_to_pick", "minutes_waiting_for_rider", "minutes_in_transit")),
    )


def mart_basket_daily(orders: DataFrame, items: DataFrame, products: DataFrame, stores: DataFrame) -> DataFrame:
    amount = lambda c: F.sum(F.when(c, F.col("line_total")).otherwise(0))
    lines = items.join(products.select("product_id", "price_source", "catalogue_source"), "product_id").groupBy("order_id").agg(
        F.sum("line_total").alias("v"), amount(F.col("price_source") == "open_prices").alias("vp"), amount(F.col("catalogue_source") == "open_food_facts").alias("vc")
    )
    o = orders.filter("status = 'delivered'").join(stores.select("store_id", "city_name"), "store_id").join(lines, "order_id", "left")
    sums = {"subtotal": "gross_merchandise_value", "discount": "discounts", "delivery_fee": "delivery_fees", "refunded_amount": "refunds", "net_revenue": "net_revenue"}
    return o.groupBy("order_date", "city_name").agg(
        F.count("*").alias("delivered_orders"), *(F.sum(c).alias(n) for c, n in sums.items()), F.sum(F.coalesce("tip_amount", F.lit(0))).alias("tips"),
        F.avg(F.col("total").cast("double")).alias("average_order_value"), F.avg("line_count").alias("avg_lines_per_order"), F.avg("units").alias("avg_units_per_order"),
        ratio(F.sum("discount"), F.sum("subtotal")).alias("discount_share"), ratio(F.count_if(F.col("substituted_lines") > 0), F.count("*")).alias("share_orders_with_substitution"),
        ratio(F.sum("vc"), F.sum("v")).alias("real_product_value_share"), ratio(F.sum("vp"), F.sum("v")).alias("real_price_value_share"),
    )


def mart_category_mix_daily(items: DataFrame, products: DataFrame) -> DataFrame:
    each = items.filter("order_status = 'delivered'").join(products.select("product_id", "category_name"), "product_id").groupBy("order_date", "category_name").agg(F.sum("quantity").alias("units"), F.sum("line_total").alias("revenue"))
    return each.withColumn("revenue_share", ratio(F.col("revenue"), F.sum("revenue").over(Window.partitionBy("order_date"))))


def mart_customer_retention_weekly(orders: DataFrame, customers: DataFrame) -> DataFrame:
    week = (F.datediff(week_start(F.col("order_date")), F.col("cohort_week")) / 7).cast("long")
    active = orders.filter("status = 'delivered'").join(customers.select("customer_id", "cohort_week"), "customer_id").select("cohort_week", "customer_id", week.alias("week_number")).distinct()
    size = active.groupBy("cohort_week").agg(F.count_distinct("customer_id").alias("cohort_size"))
    # activity is distinct, so counting rows counts customers
    return active.groupBy("cohort_week", "week_number").agg(F.count("*").alias("active_customers")).join(size, "cohort_week").select(
        "cohort_week", "week_number", "cohort_size", "active_customers", ratio(F.col("active_customers"), F.col("cohort_size")).alias("retention_rate")
    )


def mart_rider_utilisation_daily(shifts: DataFrame, assignments: DataFrame, as_of: Column) -> DataFrame:
    s = shifts.groupBy("rider_id", "store_id", local_date(F.col("started_at")).alias("shift_date")).agg(F.sum(minutes_between(F.col("started_at"), F.coalesce("ended_at", as_of))).alias("logged_in_minutes"))
    t = assignments.groupBy("rider_id", local_date(F.col("assigned_at")).alias("shift_date")).agg(
        F.count("*").alias("a"), F.count("delivered_at").alias("d"), F.sum(minutes_between(F.col("assigned_at"), F.col("delivered_at"))).alias("b"), F.avg("distance_km").cast("double").alias("avg_distance_km")
    )
    busy, done = F.coalesce("b", F.lit(0.0)), F.coalesce("d", F.lit(0))
    return s.join(t, ["rider_id", "shift_date"], "left").select(
        "shift_date", "store_id", "rider_id", "logged_in_minutes", F.coalesce("a", F.lit(0)).alias("assignments"), done.alias("deliveries"), busy.alias("busy_minutes"), "avg_distance_km",
        F.least(F.lit(1.0), ratio(busy, F.col("logged_in_minutes"))).alias("utilisation"), ratio(done, F.col("logged_in_minutes") / 60.0).alias("deliveries_per_hour"),
    )


def mart_promo_effectiveness(orders: DataFrame) -> DataFrame:
    done = orders.filter("status = 'delivered'").withColumn("first", F.row_number().over(Window.partitionBy("customer_id").orderBy("placed_at", "order_id")) == 1)
    basket = F.col("subtotal").cast("double")
    base = done.filter("not used_promo").groupBy("order_date").agg(F.avg(basket).alias("usual"))
    return done.filter("used_promo").join(base, "order_date", "left").groupBy("promo_code").agg(
        F.count("*").alias("orders"), F.count_distinct("customer_id").alias("customers"), F.count_if("first").alias("first_orders"), F.sum("subtotal").alias("gross_merchandise_value"), F.sum("discount").alias("discount_cost"),
        F.avg(basket).alias("avg_basket_with_promo"), F.avg("usual").alias("avg_basket_without_promo_same_days"), (F.avg(basket) - F.avg("usual")).alias("basket_uplift"), ratio(F.sum("discount"), F.sum("subtotal")).alias("discount_rate"),
    )


def mart_inventory_health_daily(periods: DataFrame, items: DataFrame, orders: DataFrame, inventory: DataFrame, removed: DataFrame) -> DataFrame:
    sold = items.join(orders.filter("status = 'delivered'").select("order_id", "store_id", "placed_at"), ["order_id", "store_id"]).groupBy("store_id", "product_id").agg(
        ratio(F.sum("quantity"), minutes_between(F.min("placed_at"), F.max("placed_at"))).alias("rate"), ratio(F.sum("line_total"), F.sum("quantity")).alias("price")
    )
    keys = ["store_id", "product_id"]
    out = periods.join(sold, keys, "left").join(inventory.select(*keys, F.lit(True).alias("listed")), keys, "left")
    lost = F.col("stockout_minutes") * F.coalesce("rate", F.lit(0.0))
    daily = out.groupBy("store_id", local_date(F.col("started_at")).alias("activity_date")).agg(
        F.count("*").alias("stockout_events"), F.count_distinct("product_id").alias("skus_stocked_out"), F.count_distinct(F.when(F.col("listed"), F.col("product_id"))).alias("_listed"), F.count_if("is_ongoing").alias("stockouts_ongoing"),
        F.sum("stockout_minutes").alias("stockout_minutes"), F.sum(lost).alias("estimated_lost_units"), F.sum(lost * F.coalesce("price", F.lit(0.0))).alias("estimated_lost_sales"),
    )
    stock = inventory.groupBy("store_id").agg(F.count("*").alias("skus_listed"), F.count_if(F.col("on_hand") == 0).alias("skus_at_zero_now"), F.count_if(F.col("on_hand") <= F.col("reorder_point")).alias("skus_below_reorder_point"))
    gone = removed.join(orders.select("order_id", "store_id"), "order_id").groupBy("store_id", local_date(F.col("removed_at")).alias("activity_date")).agg(F.count("*").alias("n"), F.sum("line_total").alias("v"))
    return daily.join(stock, "store_id", "left").join(gone, ["store_id", "activity_date"], "left").select(
        "store_id", "activity_date", "skus_listed", "skus_at_zero_now", "skus_below_reorder_point", "stockout_events", "skus_stocked_out", "stockouts_ongoing", "stockout_minutes",
        ratio(F.col("_listed"), F.col("skus_listed")).alias("stockout_rate"), "estimated_lost_units", F.round("estimated_lost_sales", 2).alias("estimated_lost_sales"),
        F.coalesce("n", F.lit(0)).alias("lines_removed_at_picking"), F.coalesce("v", F.lit(0)).alias("value_removed_at_picking"),
    )


SERIES = ["product_code", "location_id", "currency"]


def _named(prices: DataFrame, products: DataFrame, *columns: str) -> DataFrame:
    """One row for each product code, so that the join does not multiply observations."""
    one = products.groupBy("product_code").agg(*(F.max(c).alias(c) for c in columns))
    return prices.drop(*columns).join(one, "product_code", "left").withColumn("category_tag", F.coalesce("category_tag", F.lit("en:unknown")))


def _placed(prices: DataFrame) -> DataFrame:
    return prices.filter("product_code is not null and location_id is not null")


def mart_price_changes(prices: DataFrame, products: DataFrame, locations: DataFrame) -> DataFrame:
    w = Window.partitionBy(*SERIES).orderBy("observed_on", "source_created_at", "price_id")
    p = _placed(prices).withColumns({"previous_price": F.lag("price").over(w), "previous_observed_on": F.lag("observed_on").over(w)}).filter("previous_price is not null")
    p = _named(p, products, "product_name", "brand", "category_tag").join(locations.select("location_id", "shop_name", "city", "country_code"), "location_id", "left")
    diff = F.col("price") - F.col("previous_price")
    return p.select(
        "price_id", "product_code", "product_name", "brand", "category_tag", "location_id", "shop_name", "city", "country_code", "currency", "previous_observed_on", "observed_on", "previous_price", "price", "is_discounted",
        diff.alias("price_change"), ratio(diff, F.col("previous_price")).alias("change_pct"),
    )


def mart_category_price_index_daily(prices: DataFrame, products: DataFrame) -> DataFrame:
    base = Window.partitionBy(*SERIES).orderBy("observed_on", "source_created_at", "price_id")
    last = Window.partitionBy(*SERIES, "observed_on").orderBy(F.desc("source_created_at"), F.desc("price_id"))
    p = _placed(prices).withColumns({"base": F.first("price").over(base), "n": F.row_number().over(last)}).filter("n = 1")
    each = _named(p, products, "category_tag")
    return each.groupBy("category_tag", "currency", "observed_on").agg(F.count("*").alias("series_observed"), (100 * F.exp(F.avg(F.log(ratio(F.col("price"), F.col("base")))))).alias("price_index"))


def mart_store_price_dispersion(prices: DataFrame) -> DataFrame:
    week = _placed(prices).groupBy("product_code", "currency", week_start(F.col("observed_on")).alias("week_start"), "location_id").agg(F.max_by("price", F.struct("source_created_at", "price_id")).alias("price"))
    d = F.col("price").cast("double")
    return week.groupBy("product_code", "currency", "week_start").agg(
        F.count("*").alias("shops"), F.min("price").alias("min_price"), F.max("price").alias("max_price"), F.avg(d).alias("avg_price"), ratio(F.stddev_samp(d), F.avg(d)).alias("coefficient_of_variation"), ratio(F.max("price"), F.min("price")).alias("max_to_min_ratio")
    ).filter("shops >= 2")


def mart_price_volatility(prices: DataFrame, changes: DataFrame) -> DataFrame:
    seen = _placed(prices).groupBy(*SERIES).agg(F.count("*").alias("observations"))
    pct = F.col("change_pct")
    c = changes.groupBy(*SERIES).agg(F.count_if(pct != 0).alias("n"), F.avg(F.abs(pct)).alias("a"), F.max(F.abs(pct)).alias("m"), F.stddev_samp(F.log(1 + pct)).alias("s"))
    zero = lambda x: F.coalesce(x, F.lit(0.0))
    n = F.coalesce("n", F.lit(0))
    return seen.join(c, SERIES, "left").select(
        *SERIES, "observations", n.alias("price_changes"), zero("a").alias("avg_abs_change_pct"), zero("m").alias("max_abs_change_pct"), zero("s").alias("log_change_stddev"), ((n >= 2) & ((zero("m") > 0.30) | (zero("s") > 0.15))).alias("is_volatile")
    )


def mart_catalogue_coverage(products: DataFrame) -> DataFrame:
    real = F.col("catalogue_source") == "open_food_facts"
    return products.groupBy("category_name").agg(F.count("*").alias("products"), F.count_if(real).alias("real_products"), F.count_if(F.col("price_source") == "open_prices").alias("real_priced_products"), ratio(F.count_if(real), F.count("*")).alias("real_product_share"))


def report_meta(prices: DataFrame, as_of: Column) -> DataFrame:
    return prices.agg(F.count("*").alias("observations"), F.max("source_created_at").alias("latest"), F.count_if(F.col("source_created_at") > as_of - F.expr("INTERVAL 1 DAY")).alias("last_day"), F.count_distinct("currency").alias("currencies"), F.count_distinct("product_code").alias("products"))


def report_by_currency(prices: DataFrame, as_of: Column) -> DataFrame:
    g = prices.filter(F.col("source_created_at") > as_of - F.expr("INTERVAL 7 DAYS")).groupBy("currency")
    return g.agg(F.count("*").alias("observations"), F.count_distinct("product_code").alias("products"), F.count_distinct("location_id").alias("shops")).orderBy(F.desc("observations"), "currency").limit(12)


def report_movers(changes: DataFrame, as_of: Column) -> DataFrame:
    recent = changes.filter((F.col("change_pct") != 0) & (F.col("observed_on") >= F.to_date(as_of) - F.expr("INTERVAL 30 DAYS")))
    return recent.orderBy(F.desc(F.abs("change_pct")), F.desc("observed_on"), "price_id").limit(15).select("price_id", "product_name", "brand", "shop_name", "city", "country_code", "currency", "previous_price", "price", "change_pct", "observed_on")


def report_index(index: DataFrame) -> DataFrame:
    known = index.filter("category_tag <> 'en:unknown'")
    newest = history.latest_per_key(known, ["category_tag", "currency"], ["observed_on"]).filter("series_observed >= 3")
    return newest.orderBy(F.desc("series_observed"), "category_tag", "currency").limit(15)


def report_india(prices: DataFrame, products: DataFrame, locations: DataFrame, currency: str = "INR") -> DataFrame:
    newest = prices.filter(F.col("currency") == currency).orderBy(F.desc("source_created_at"), F.desc("price_id")).limit(12)
    p = newest.join(products.select("market_product_id", "product_name", "brand"), "market_product_id", "left").join(locations.select("location_id", "city"), "location_id", "left")
    return p.select("price_id", F.coalesce("product_name", "product_code").alias("product"), "brand", "city", "price", "observed_on")


def report_coverage(coverage: DataFrame) -> DataFrame:
    return coverage.select("category_name", "products", "real_products", "real_priced_products").orderBy(F.desc("real_products"), "category_name")


def report_ops(sla: DataFrame, as_of: Column) -> DataFrame:
    s = sla.filter(F.col("order_date") >= F.to_date(as_of) - F.expr("INTERVAL 7 DAYS"))
    n = F.sum("delivered_orders")
    return s.agg(n.alias("delivered_orders"), ratio(F.sum(F.col("pct_within_promise") * F.col("delivered_orders")), n).alias("pct_within_promise"), F.max("p90_delivery_minutes").alias("worst_p90"))


def report_basket(baskets: DataFrame, as_of: Column) -> DataFrame:
    b = baskets.filter(F.col("order_date") >= F.to_date(as_of) - F.expr("INTERVAL 7 DAYS"))
    v = F.col("gross_merchandise_value").cast("double")
    return b.agg(ratio(F.sum(v), F.sum("delivered_orders")).alias("average_basket"), ratio(F.sum(F.col("real_price_value_share") * v), F.sum(v)).alias("real_price_share"), ratio(F.sum(F.col("real_product_value_share") * v), F.sum(v)).alias("real_product_share"))


def report_sla_by_store(sla: DataFrame) -> DataFrame:
    n = F.sum("delivered_orders")
    return sla.groupBy("store_id").agg(n.alias("delivered_orders"), ratio(F.sum(F.col("pct_within_promise") * F.col("delivered_orders")), n).alias("pct_within_promise"))


def report_json(reports: dict[str, DataFrame]) -> DataFrame:
    """(report, body): each report's rows, in order of their text, as one JSON array; reports are small by their own limits."""
    out = None
    for name, df in reports.items():
        rows = df.select(F.to_json(F.struct("*")).alias("r")).agg(F.array_join(F.array_sort(F.collect_list("r")), ",").alias("b"))
        one = rows.select(F.lit(name).alias("report"), F.concat(F.lit("["), "b", F.lit("]")).alias("body"))
        out = one if out is None else out.unionByName(one)
    return out
