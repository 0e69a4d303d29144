"""Seconds of the headline queries, written to the no-op sink, as one JSON line: the median of three runs each."""

import json
import os
import time
from statistics import median

from pyspark.sql import SparkSession

from tidemark.plans.queries import QUERIES

HEADLINE = [
    "cdc_fold_log", "cdc_fold_latest", "cdc_parse_envelope", "scd2_from_changes", "int_inventory_stockout_periods", "removed_rows", "fct_orders", "fct_order_items", "mart_basket_daily",
    "mart_delivery_sla_hourly_approx", "mart_customer_retention_weekly", "mart_promo_effectiveness", "mart_price_changes", "mart_price_volatility", "mart_category_price_index_daily", "incremental_upsert_changed", "rec_table", "rec_row_diff",
]


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    for name in HEADLINE:
        runs = []
        for _ in range(3):
            began = time.time()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - began)
        took[name] = round(median(runs), 3)
    print(json.dumps({"metric": "headline_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
