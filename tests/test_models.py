"""Histories, checks, ingestion and a sample of queries against their SQL."""

import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.operators import history, incremental, quality
from tidemark.plans import queries as plans
from tidemark.sources import observations as obs

SF = "/root/testdata/sf0.001"


def test_price_history_golden_rows(spark):
    at = lambda h: dt.datetime(2026, 9, 1, h)
    rows = [(1, 100.0, 90.0, at(10), 300), (1, 100.0, 95.0, at(8), 100), (1, 100.0, 95.0, at(9), 200), (1, 100.0, 90.0, at(10), 300)]
    h = history.scd2(spark.createDataFrame(rows, "id int, mrp double, price double, at timestamp, _lsn long"), ["id"], ["mrp", "price"], "at").orderBy("version").collect()
    assert [(r["version"], r["price"], r["valid_from"], r["valid_to"], r["is_current"]) for r in h] == [(1, 95.0, at(8), at(10), False), (2, 90.0, at(10), None, True)]


def test_history_closes_on_delete(spark):
    rows = [(1, "a", 1, "c"), (1, None, 2, "d"), (1, "a", 3, "c")]
    df = spark.createDataFrame(rows, "id int, s string, _lsn long, _op string").withColumn("at", F.timestamp_seconds("_lsn"))
    h = history.scd2(df, ["id"], ["s"], "at", close_on_delete=True).orderBy("version").collect()
    assert [(r["version"], r["is_current"], r["valid_to"] is None) for r in h] == [(1, False, False), (2, True, True)]


def test_lookup_as_of(spark):
    h = spark.createDataFrame([(1, 0, 10, "a"), (1, 10, None, "b")], "id int, valid_from int, valid_to int, v string")
    f = spark.createDataFrame([(1, 5), (1, 10), (1, -1), (2, 5)], "id int, at int")
    assert {(r["id"], r["at"]): r["v"] for r in history.scd2_lookup_asof(f, h, ["id"], "at", ["v"]).collect()} == {(1, 5): "a", (1, 10): "b", (1, -1): None, (2, 5): None}


def test_broken_history_is_found(spark):
    h = spark.createDataFrame([(1, 1, 5, 3, False), (1, 2, 4, None, True), (2, 1, 1, 2, False)], "id int, version int, valid_from int, valid_to int, is_current boolean")
    assert {(r["id"], r["problem"]) for r in history.scd2_validate(h, ["id"]).collect()} == {(1, "negative_interval"), (2, "not_contiguous"), (2, "current_versions")}


def test_reconcile(spark):
    a = spark.createDataFrame([(1, "x", 10.5), (2, None, 1.0)], "id int, s string, v double")
    same = quality.reconcile(a, a.withColumn("_extra", F.lit(1)), "t").first()
    assert same["ok"] and same["rows_source"] == same["rows_target"] == 2 and same["warnings"] == ""
    off = quality.reconcile(a, a.withColumn("v", F.col("v") + (F.col("id") == 2).cast("int")), "t").first()
    assert not off["ok"] and off["mismatches"] == "v.sum~"
    assert quality.reconcile(a, a.drop("s").withColumn("z", F.lit(1)), "t").first()["mismatches"] == "missing:s"
    s = quality.same_value
    row = spark.range(1).select(s(F.lit("a"), F.lit("10.50"), F.lit("10.5")), s(F.lit("a"), F.lit("7"), F.lit("8")), s(F.lit("a~"), F.lit("1.0000001"), F.lit("1.0")), s(F.lit("a"), F.lit(None), F.lit("0"))).first()
    assert list(row) == [True, False, True, True]


def test_transitions_and_health(spark):
    h = spark.createDataFrame([(1, "placed", 1), (1, "accepted", 2), (1, "delivered", 3)], "o int, status string, at int")
    assert [(r["before"], r["status"]) for r in quality.check_transitions(h, "o", "status", ["at"]).collect()] == [("accepted", "delivered")]
    fresh = quality.freshness({"t": spark.createDataFrame([(dt.datetime(2026, 1, 1),)], "_ingested_at timestamp")}, F.to_timestamp(F.lit("2026-01-01 01:00:00")), 30, 90)
    assert fresh.first()["state"] == "warn"
    out = quality.health(fresh, spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([("x", 60_000)], "topic string, behind long")).collect()
    assert {r["check"]: r["ok"] for r in out} == {"fresh:t": True, "dead_letters": False, "behind:x": False}


def test_upsert_leaves_unchanged_rows(spark):
    old = spark.createDataFrame([(1, "a"), (2, None)], "id int, s string")
    out = incremental.upsert_changed(old, spark.createDataFrame([(1, "b"), (2, None), (3, "c")], "id int, s string"), ["id"])
    assert {r["id"]: r["_outcome"] for r in out.collect()} == {1: "updated", 2: "unchanged", 3: "inserted"}
    assert sorted(tuple(r) for r in incremental.apply_upsert(old, out, ["id"]).collect()) == [(1, "b"), (2, None), (3, "c")]


def test_observations(spark, tmp_path):
    page = '{"items":[{"id":1,"price":10.005,"currency":"inr","date":"2026-01-02T00","created":"2026-01-02T03:04:05Z","location_id":5,"location":{"osm_name":" A  b "},"product_id":9,"product":{"code":"8901","brands":"Maggi, Nestle","categories_tags":["fr:x","en:instant-noodles"],"nutriscore_grade":"z"}},{"id":2,"price":5,"currency":"INR","date":"2026-01-01","duplicate_of":1},{"id":3,"price":null,"currency":"INR","date":"x"},{"id":4,"price":5,"currency":"RUPEE","date":"x"}]}'
    (tmp_path / "p.json").write_text(page)
    from tidemark.sources.tables import json_items

    out = obs.normalise_observations(json_items(spark, str(tmp_path / "p.json"), obs.ITEM, "items"))
    p, m, loc = out["prices"].first(), out["products"].first(), out["locations"].first()
    assert str(p["price"]) == "10.00" and p["currency"] == "INR" and out["rejected"].count() == 3
    assert (m["brand"], m["category_tag"], m["store_category"], m["nutriscore_grade"], loc["osm_name"]) == ("Maggi", "en:instant-noodles", "Instant & Frozen Food", None, "A b")


def test_mandi(spark):
    cols = "state string, district string, market string, commodity string, variety string, grade string, arrival_date string, min_price string, max_price string, modal_price string"
    rows = [("K", "B", " M ", "Onion", "v", "g", "08/10/2026", "1000", "2000", "1500"), ("K", "B", "M", "Onion", "v", "g", "2026-10-08", "1", "2", "1"), ("K", "B", "", "Onion", "v", "g", "08/10/2026", "1", "2", "1"), ("K", "B", "M", "Onion", "v", "g", "08/10/2026", "-1", "2", "1")]
    out = obs.parse_mandi(spark.createDataFrame(rows, cols)).collect()
    assert len(out) == 1 and out[0]["arrival_date"] == dt.date(2026, 10, 8) and str(out[0]["modal_price"]) == "1500.00" and out[0]["market"] == "M"


@pytest.mark.parametrize("name", ["scd2_lookup_asof", "rec_range_diff", "agg_approx_percentile", "cdc_parse_variant", "cdc_fold_log", "cdc_fold_latest", "scd2_from_changes", "fct_orders", "mart_basket_daily", "mart_price_volatility", "cdc_parse_envelope"])
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "part", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cur = con.execute(plans.ORACLE[name])
    cols = [d[0] for d in cur.description]
    df = plans.QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(cols)
    clean = lambda v: round(float(v), 5) if isinstance(v, float) or type(v).__name__ == "Decimal" else str(v)
    mine = sorted(tuple(clean(r[c]) for c in cols) for r in df.collect())
    theirs = sorted(tuple(clean(v) for v in r) for r in cur.fetchall())
    assert mine == theirs


def test_as_of_lookup_of_hot_keys(spark, monkeypatch):
    """Facts of one key over several parts give the same; equal times, deleted stretches and keys without versions included."""
    h = spark.createDataFrame([(1, 10, 20, 1, "a"), (1, 20, 30, 2, "b"), (1, 40, None, 3, "c"), (2, 10, 10, 1, "x"), (2, 10, None, 2, "y")], "id int, valid_from int, valid_to int, version int, v string")
    f = spark.createDataFrame([(1, t, i) for i, t in enumerate([5, 10, 19, 20, 30, 35, 40, 99] * 40)] + [(2, 10, 0), (3, 10, 0), (None, 10, 0)], "id int, at int, n int")
    plain = {tuple(r) for r in history.scd2_lookup_asof(f, h, ["id"], "at", ["v"]).collect()}
    monkeypatch.setattr(history, "FEW", 10)
    monkeypatch.setattr(history, "SHARES", 50)
    df = history.scd2_lookup_asof(f, h, ["id"], "at", ["v"])
    assert df.columns == ["id", "at", "n", "v"] and {tuple(r) for r in df.collect()} == plain and df.count() == f.count()
    expected = {5: None, 10: "a", 19: "a", 20: "b", 30: None, 35: None, 40: "c", 99: "c"}
    assert all(r[3] == expected[r[1]] for r in plain if r[0] == 1) and (2, 10, 0, "y") in plain and (3, 10, 0, None) in plain


def test_digests_send_only_differing_ranges_to_the_row_comparison(spark, tmp_path):
    big = spark.range(40_000).select(F.col("id"), (F.col("id") % 97).alias("v"))
    big.repartitionByRange(8, "id").sortWithinPartitions("id").write.parquet(str(tmp_path / "a"))
    other = big.filter("id <> 12345").withColumn("v", F.when(F.col("id") == 30_001, -1).otherwise(F.col("v")))
    other.unionByName(spark.createDataFrame([(-7, 1), (None, 2)], "id long, v long")).repartitionByRange(8, "id").sortWithinPartitions("id").write.parquet(str(tmp_path / "b"))
    a, b = spark.read.parquet(str(tmp_path / "a")), spark.read.parquet(str(tmp_path / "b"))
    diff = quality.diff_by_digests(a, b, "id", 100)
    assert {(r["id"], r["kind"]) for r in diff.collect()} == {(12345, "missing"), (30_001, "changed"), (-7, "extra"), (None, "extra")}
    plan = diff._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(" in plan and "GreaterThanOrEqual(id,12300" in plan
    nodes, rows = [diff._jdf.queryExecution().executedPlan().executedPlan()], []
    while nodes:
        n = nodes.pop()
        kids = n.children()
        nodes += [kids.apply(i) for i in range(kids.size())] + ([n.plan()] if "QueryStage" in n.getClass().getSimpleName() else [])
        if "FileSourceScan" in n.getClass().getSimpleName():
            rows.append(n.metrics().apply("numOutputRows").value())
    assert len(rows) == 2 and max(rows) < 20_000  # row groups of the other ranges are skipped
    wide = quality.diff_by_digests(a, a.filter("id % 500 <> 0"), "id", 100)  # more stretches than are pushed down
    assert wide.count() == 80 and quality.diff_by_digests(a, a, "id", 100).count() == 0


def test_basket_report_joins_only_the_rows_of_its_days(spark):
    plan = plans.QUERIES["report_basket"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") >= 3  # both reads of the lines, and the refunds
