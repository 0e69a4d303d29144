"""Change capture: scenarios on envelopes, schema rules, and folds against a sequential model."""

import json
import random
import shutil
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import cdc
from tidemark.sources.tables import Tables, change_stream
from tidemark.streaming.pipeline import METRICS, PROGRESS, SCHEMAS, CdcPipeline, OffsetGap, Progress, levels, run_stream

AT = 1_788_220_800_000
FIELDS = [
    {"field": "order_id", "type": "int64"}, {"field": "status", "type": "string"},
    {"field": "total", "type": "string", "parameters": {"__debezium.source.column.type": "NUMERIC", "__debezium.source.column.length": "10", "__debezium.source.column.scale": "2"}},
    {"field": "placed_at", "type": "string", "name": "io.debezium.time.ZonedTimestamp"}, {"field": "note", "type": "string"},
]
TIP = {"field": "tip", "type": "string", "parameters": {"__debezium.source.column.type": "NUMERIC", "__debezium.source.column.length": "8", "__debezium.source.column.scale": "2"}}


class Topic:
    """Builds raw records with rising offsets."""

    def __init__(self):
        self.rows = []

    def put(self, op, key, lsn, fields=FIELDS, **values):
        row = {"order_id": key, "status": "placed", "total": "100.00", "placed_at": "2026-09-01T10:15:30.123456Z", "note": "ring bell"} | values
        value = {"schema": {"type": "struct", "fields": [{"field": "after", "type": "struct", "fields": fields}]}, "payload": {"op": op, "ts_ms": AT + 5, "source": {"ts_ms": AT, "lsn": lsn, "txId": (lsn or 0) // 10, "snapshot": "false"}, "after": None if op in "dt" else row}}
        k = None if op == "t" else json.dumps({"schema": {"type": "struct", "fields": [FIELDS[0]]}, "payload": {"order_id": key}})
        return self.raw(k, json.dumps(value))

    def raw(self, key, value):
        self.rows.append(("shop.public.orders", 0, len(self.rows), key, value))
        return self

    def take(self, spark):
        rows, self.rows = list(self.rows), self.rows
        return spark.createDataFrame(rows, "topic string, partition long, offset long, key string, value string")


@pytest.fixture
def pipeline(spark, tmp_path):
    return CdcPipeline(Tables(spark, str(tmp_path)), {"orders": []})


def run(spark, pipeline, topic, since=0, batch=0):
    pipeline(topic.take(spark).filter(F.col("offset") >= since), batch)
    return {r["order_id"]: r for r in pipeline.state("orders").collect()}


def test_snapshot_and_stream(spark, pipeline):
    t = Topic().put("r", 1, 100).put("r", 2, 100)
    run(spark, pipeline, t)
    t.put("u", 1, 200, status="packed").put("d", 2, 210).raw('{"payload":{"order_id":2}}', None).put("c", 3, 220)
    s = run(spark, pipeline, t, 2, 1)
    assert s[1]["status"] == "packed" and not s[1]["_is_deleted"]
    assert s[2]["_is_deleted"] and s[2]["_lsn"] == 210 and s[2]["status"] == "placed"
    assert pipeline.log("orders").count() == 5
    assert str(s[3]["total"]) == "100.00" and s[3]["placed_at"].microsecond == 123456


def test_replay_changes_nothing(spark, pipeline):
    t = Topic().put("c", 1, 100).put("u", 1, 110, status="x").put("c", 2, 120).put("d", 2, 130)
    a = run(spark, pipeline, t)
    t.rows.append(t.rows[1][:2] + (9,) + t.rows[1][3:])
    b = run(spark, pipeline, t, 0, 1)
    cut = lambda s: {k: (r["status"], r["_lsn"], r["_is_deleted"]) for k, r in s.items()}
    assert cut(a) == cut(b) and pipeline.log("orders").count() == 4


def test_order_lateness_revival_and_toast(spark, pipeline):
    t = Topic().put("u", 7, 330, status="late").put("c", 7, 310).put("d", 5, 500).put("c", 6, 100).put("d", 6, 200).put("c", 6, 300, note="back").put("c", 8, 100, note="keep").put("u", 8, 200, note=cdc.UNAVAILABLE)
    s = run(spark, pipeline, t)
    assert s[7]["status"] == "late" and s[5]["_is_deleted"] and not s[6]["_is_deleted"] and s[6]["note"] == "back" and s[8]["note"] == "keep"
    t.put("u", 7, 320, status="stale").put("c", 5, 450)
    s = run(spark, pipeline, t, 8, 1)
    assert s[7]["status"] == "late" and s[5]["_is_deleted"] and s[5]["_lsn"] == 500


def test_new_column_and_mixed_versions(spark, pipeline):
    t = Topic().put("c", 1, 100).put("u", 1, 200, [*FIELDS, TIP], tip="20.00").put("c", 2, 210)
    s = run(spark, pipeline, t)
    assert str(s[1]["tip"]) == "20.00" and s[2]["tip"] is None
    t.put("c", 3, 220, [*FIELDS, TIP], tip="1.00")
    assert str(run(spark, pipeline, t, 3, 1)[3]["tip"]) == "1.00"


def test_truncate_alone_and_with_rows(spark, pipeline):
    t = Topic().put("c", 1, 100).put("c", 2, 110)
    run(spark, pipeline, t)
    t.put("t", None, 200)
    s = run(spark, pipeline, t, 2, 1)
    assert all(r["_is_deleted"] and r["_lsn"] == 200 for r in s.values())
    t.put("c", 3, 210)
    assert [k for k, r in run(spark, pipeline, t, 3, 2).items() if not r["_is_deleted"]] == [3]


def test_dead_letters(spark, pipeline):
    t = Topic().put("c", 1, 100).raw('{"payload":{"order_id":4}}', "this is not json").put("x", 2, 120).put("c", 3, None).put("c", None, 130).put("c", 5, 140, total="12,5")
    run(spark, pipeline, t)
    run(spark, pipeline, t, 0, 1)
    got = {r["offset"]: r["reason"] for r in pipeline.dead_letters().collect()}
    assert got == {1: "unparseable_envelope", 2: "unknown_op:x", 3: "missing_lsn", 4: "missing_primary_key", 5: "undecodable:total"}
    assert pipeline.dead_letters().count() == 5


def many(op_rows):
    """The same events for four tables, each with a letter of its own."""
    rows = []
    for i, table in enumerate(("orders", "items", "stores", "cities")):
        t = op_rows()
        t.raw(None, f"broken {table}")
        rows += [(f"shop.public.{table}", i, *r[2:]) for r in t.rows]
    return rows


RAW = "topic string, partition long, offset long, key string, value string"


def test_many_tables_in_one_batch(spark, tmp_path):
    p = CdcPipeline(Tables(spark, str(tmp_path)), {"cities": [], "stores": ["cities"]})
    rows = many(lambda: Topic().put("c", 1, 100).put("c", 2, 110).put("d", 2, 120).put("t", None, 90))
    for batch in (0, 1):  # the second changes nothing
        p(spark.createDataFrame(rows, RAW), batch)
        for table in ("orders", "items", "stores", "cities"):
            assert {r["order_id"]: r["_is_deleted"] for r in p.state(table).collect()} == {1: False, 2: True}
            assert p.log(table).count() == 3 and p.truncates(table).count() == 1
        assert sorted(r["value"] for r in p.dead_letters().collect()) == [f"broken {t}" for t in ("cities", "items", "orders", "stores")]
    again = CdcPipeline(p.store, p.parents)  # a new process: records without a schema are read by the one seen before
    bare = json.dumps({"payload": {"op": "u", "ts_ms": AT, "source": {"ts_ms": AT, "lsn": 300}, "after": {"order_id": 1, "status": "late"}}})
    again(spark.createDataFrame([("shop.public.items", 0, 99, json.dumps({"payload": {"order_id": 1}}), bare)], RAW), 2)
    assert {r["order_id"]: r["status"] for r in again.state("items").collect()}[1] == "late"


def test_crash_before_the_state_is_written(spark, tmp_path, monkeypatch):
    p = CdcPipeline(Tables(spark, str(tmp_path)), {}, parallel=1)
    p(spark.createDataFrame(Topic().put("c", 1, 100).put("c", 2, 100).rows, RAW), 0)
    rows = Topic().put("u", 1, 200, status="packed").rows
    monkeypatch.setattr(p, "_fold", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        p(spark.createDataFrame(rows, RAW), 1)
    monkeypatch.undo()
    state = lambda: {r["order_id"]: r["status"] for r in p.state("orders").collect()}
    assert state() == {1: "placed", 2: "placed"}
    p(spark.createDataFrame(rows, RAW), 1)
    assert state() == {1: "packed", 2: "placed"} and p.log("orders").count() == 3


def test_buckets_that_a_lost_driver_left_missing_come_from_the_log(spark, tmp_path):
    p = CdcPipeline(Tables(spark, str(tmp_path)), {}, buckets=2)
    t = Topic()
    for k in range(12):
        t.put("c", k, 100 + k, note=f"n{k}")
    p(spark.createDataFrame(t.rows, RAW), 0)
    p(spark.createDataFrame(Topic().put("t", None, 105).put("u", 9, 300, status="x").rows, RAW), 1)
    cut = lambda df: {r["order_id"]: (r["status"], r["note"], r["_lsn"], r["_is_deleted"]) for r in df.collect()}
    before = cut(p.state("orders"))
    assert len(before) == 12 and sum(x[3] for x in before.values()) == 5 and cut(p.rebuilt("orders")) == before
    shutil.rmtree(tmp_path / "silver_orders" / "_bucket=1")
    p(spark.createDataFrame([*Topic().put("u", 9, 300, status="x").rows, *(r for k in range(12) for r in Topic().put("u", k, 90, status="stale").rows)], RAW), 1)
    assert cut(p.state("orders")) == before


def test_only_touched_buckets_are_written(spark, tmp_path):
    p = CdcPipeline(Tables(spark, str(tmp_path)), {}, buckets=8)
    t = Topic()
    for k in range(40):
        t.put("c", k, 100 + k)
    p(spark.createDataFrame(t.rows, RAW), 0)
    files = lambda: {f.parent.name: f.name for f in (tmp_path / "silver_orders").glob("_bucket=*/*.parquet")}
    before = files()
    p(spark.createDataFrame(Topic().put("u", 3, 500, status="x").rows, RAW), 1)
    after = files()
    assert len(before) > 3 and before.keys() == after.keys() and sum(before[k] != after[k] for k in before) == 1
    assert p.state("orders").count() == 40 and p.state("orders").filter("status = 'x'").count() == 1


def number(name, digits, scale):
    return {"field": name, "type": "string", "parameters": {"__debezium.source.column.type": "NUMERIC", "__debezium.source.column.length": str(digits), "__debezium.source.column.scale": str(scale)}}


def widening(op, key, lsn, wide, **values):
    """An event of a table whose key and value columns are narrow or wide."""
    whole, real = ("int64", "double") if wide else ("int32", "float")
    key_fields = [{"field": "id", "type": whole}, number("part", 12 if wide else 8, 2)]
    fields = [*key_fields, {"field": "n", "type": whole}, number("price", 14 if wide else 9, 2), {"field": "x", "type": real}]
    row = {"id": key, "part": "1.50", "n": 1, "price": "9.99", "x": 0.5} | values
    value = {"schema": {"fields": [{"field": "after", "type": "struct", "fields": fields}]}, "payload": {"op": op, "ts_ms": AT, "source": {"ts_ms": AT, "lsn": lsn}, "after": None if op == "d" else row}}
    return ("shop.public.things", 0, lsn, json.dumps({"schema": {"fields": key_fields}, "payload": {"id": key, "part": "1.50"}}), json.dumps(value))


def test_columns_and_keys_that_widen(spark, tmp_path):
    """Narrow rows, then wide ones, then narrow ones again: everything stays readable, one row for each key, also for a new process."""
    p = CdcPipeline(Tables(spark, str(tmp_path)), {}, buckets=8)
    p(spark.createDataFrame([widening("c", k, 100 + k, False) for k in range(29)], RAW), 0)
    assert p.state("things").schema["id"].dataType == T.IntegerType()
    wide = [widening("u", 3, 300, True, n=2**40, price="123456789012.34", x=0.1), widening("c", 2**33, 301, True), widening("d", 4, 302, True)]
    later = [widening("u", 5, 400, False, n=7), widening("u", 6, 401, True, n=8)]

    def check(p):
        state = {r["id"]: r for r in p.state("things").collect()}
        assert p.state("things").count() == len(state) == 30
        kinds = {f.name: f.dataType for f in p.state("things").schema}
        assert (kinds["id"], kinds["part"], kinds["n"], kinds["price"], kinds["x"]) == (T.LongType(), T.DecimalType(12, 2), T.LongType(), T.DecimalType(14, 2), T.DoubleType())
        assert state[3]["n"] == 2**40 and str(state[3]["price"]) == "123456789012.34" and state[3]["x"] == 0.1 and state[4]["_is_deleted"] and state[0]["x"] == 0.5
        assert p.log("things").filter("id = 3").count() == 2 and p.state("things").filter("n > 100").count() == 1
        return state

    p(spark.createDataFrame(wide, RAW), 1)
    check(p)
    p = CdcPipeline(p.store, {}, buckets=8)
    p(spark.createDataFrame(later, RAW), 2)
    state = check(p)
    assert (state[5]["n"], state[6]["n"]) == (7, 8)
    p(spark.createDataFrame([widening("c", k, 100 + k, False) for k in range(29)] + wide + later, RAW), 3)  # a replay of all
    assert check(p) == state and p.log("things").count() == 34
    assert {r["id"]: (r["n"], r["_is_deleted"]) for r in p.rebuilt("things").collect()} == {k: (r["n"], r["_is_deleted"]) for k, r in state.items()}
    kinds = {r["detail"] for r in p.store.read("metrics", METRICS).filter("measure = 'schema_changes'").collect()}
    assert kinds == {"create", "widen id bigint", "widen part decimal(12,2)", "widen n bigint", "widen price decimal(14,2)", "widen x double"}


def test_a_change_without_a_lossless_type_fails_before_anything_is_written(spark, tmp_path):
    p = CdcPipeline(Tables(spark, str(tmp_path)), {"orders": []})
    p(spark.createDataFrame(Topic().put("c", 1, 100).rows, RAW), 0)
    with pytest.raises(cdc.NoLosslessType):
        p(spark.createDataFrame(Topic().put("u", 1, 200, [FIELDS[0], {"field": "status", "type": "int64"}], status=4).rows, RAW), 1)
    assert p.log("orders").count() == 1 and p.store.read("schemas", SCHEMAS).count() == 1


def test_a_batch_reads_the_days_of_the_log_that_it_may_overlap(spark, tmp_path):
    p = CdcPipeline(Tables(spark, str(tmp_path)), {})
    for day in range(6):
        p.clock = lambda d=day: F.to_timestamp(F.lit(f"2026-09-0{d + 1} 12:00:00"))
        p(spark.createDataFrame(Topic().put("c", day, 1000 * day + 1).put("u", day, 1000 * day + 500).rows, RAW), day)

    def read(low, high):
        """The days that have rows, if the scan opens no file of another day."""
        part = p.overlapping("orders", low, high)
        if part is None:
            return []
        days = sorted({str(r["_ingest_day"]) for r in part.collect()})
        scan = part._jdf.queryExecution().executedPlan().collectLeaves().head()
        files = sum(len(list((tmp_path / "bronze_orders" / f"_ingest_day={d}").glob("*.parquet"))) for d in days)
        assert scan.metrics().apply("numFiles").value() == files
        return days

    assert read(2100, 2500) == ["2026-09-03"] and read(2100, 3001) == ["2026-09-03", "2026-09-04"] and read(9000, 9999) == []
    p.ranges.clear()  # a new process
    assert read(1, 1) == ["2026-09-01"]
    p(spark.createDataFrame(Topic().put("c", 2, 2001).put("u", 2, 2500).put("u", 2, 2501).rows, RAW), 9)  # late, and partly known
    assert p.log("orders").count() == 13 and read(2501, 3001) == ["2026-09-04", "2026-09-06"]
    plan = p.overlapping("orders", 2100, 2200)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_ingest_day" in plan.split("PartitionFilters: [")[1].split("]")[0] and "GreaterThanOrEqual(_lsn,2100)" in plan


def letters_of(spark, root):
    return CdcPipeline(Tables(spark, str(root)), {}).dead_letters()


def test_letters_of_other_offsets_are_not_read(spark, tmp_path):
    p = CdcPipeline(Tables(spark, str(tmp_path)), {})
    far = [("shop.public.orders", 0, k << 20, None, "broken") for k in range(3)]
    p(spark.createDataFrame([*Topic().put("c", 1, 100).rows, *far], RAW), 0)
    p(spark.createDataFrame(far[1:], RAW), 1)
    assert sorted(r["offset"] for r in letters_of(spark, tmp_path).collect()) == [0, 1 << 20, 2 << 20]
    assert len(list((tmp_path / "dead_letters" / "table=orders").glob("_block=*"))) == 3


def test_stream_equals_batch_and_is_measured(spark, tmp_path):
    """Three files make three batches; the listener's rows and the counts of each batch are tables."""
    t = Topic().put("c", 1, 100).put("u", 1, 200, status="packed").put("c", 2, 210).raw(None, "broken").put("d", 2, 220).put("u", 1, 230, [*FIELDS, TIP], tip="1.00")
    for i in range(3):
        t.take(spark).filter(F.col("offset").between(2 * i, 2 * i + 1)).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    p = CdcPipeline(Tables(spark, str(tmp_path / "tables")), {"orders": []}, gaps_fail=True)
    listener = Progress(p.store)
    try:
        run_stream(change_stream(spark, str(tmp_path / "in"), files_per_trigger=1), p, str(tmp_path / "checkpoint"), listener=listener).awaitTermination()
        s = {r["order_id"]: (r["status"], str(r["tip"]), r["_is_deleted"]) for r in p.state("orders").collect()}
        assert s == {1: ("placed", "1.00", False), 2: ("placed", "None", True)}
        m = {(r["batch"], r["measure"], r["detail"]): r["n"] for r in p.store.read("metrics", METRICS).collect()}
        assert m == {
            (0, "events", "c"): 1, (0, "events", "u"): 1, (0, "schema_changes", "create"): 1, (1, "events", "c"): 1, (1, "events", None): 1, (1, "dead_letters", "unparseable_envelope"): 1,
            (2, "events", "d"): 1, (2, "events", "u"): 1, (2, "schema_changes", "add tip decimal(8,2)"): 1,
        }
        for _ in range(100):
            if (seen := p.store.read("progress", PROGRESS)) is not None and seen.count() == 3:
                break
            time.sleep(0.2)
        rows = sorted((r["batch"], r["records"], r["observed"], r["newest_offset"]) for r in seen.collect())
        assert rows == [(0, 2, 2, 1), (1, 2, 2, 3), (2, 2, 2, 5)]
    finally:
        spark.streams.removeListener(listener)


def test_offsets_behind_the_source(spark, tmp_path):
    class Event:
        class progress:  # noqa: N801
            id, batchId, numInputRows, batchDuration, observedMetrics = "q", 4, 10, 1500, {}
            sources = [type("S", (), {"metrics": {"maxOffsetsBehindLatest": "70000"}}), type("S", (), {"metrics": {}})]

    listener = Progress(Tables(spark, str(tmp_path)))
    listener.onQueryProgress(Event)
    listener.onQueryProgress(Event)
    assert [(r["behind"], r["seconds"], r["batch"]) for r in listener.store.read("progress", PROGRESS).collect()] == [(70000.0, 1.5, 4)]


def test_a_gap_in_the_offsets_fails(spark, tmp_path):
    p = CdcPipeline(Tables(spark, str(tmp_path)), {}, gaps_fail=True)
    rows = Topic().put("c", 1, 100).put("c", 2, 110).put("c", 3, 120).put("c", 4, 130).put("c", 5, 140).rows
    p(spark.createDataFrame(rows[:2], RAW), 0)
    p(spark.createDataFrame(rows[:2], RAW), 0)  # again
    p = CdcPipeline(p.store, {}, gaps_fail=True)
    with pytest.raises(OffsetGap, match="after 1"):
        p(spark.createDataFrame(rows[3:], RAW), 1)
    with pytest.raises(OffsetGap):
        p(spark.createDataFrame([rows[2], rows[4]], RAW), 1)
    p(spark.createDataFrame(rows[2:], RAW), 1)
    assert p.log("orders").count() == 5


def test_levels_put_parents_first():
    assert levels(["b", "a", "z", "c"], {"a": [], "b": ["a"], "c": ["b"]}) == [["a"], ["b"], ["c"], ["z"]]


def test_schema_rules():
    of = lambda **k: cdc.wire({"field": "x", **k}).type
    number = lambda n, s: of(type="string", parameters={cdc.SOURCE_TYPE: "NUMERIC", cdc.SOURCE_LENGTH: n, cdc.SOURCE_SCALE: s})
    assert of(type="int16") == T.IntegerType() and of(type="bytes") == T.BinaryType() and of(type="float") == T.FloatType()
    assert of(type="int32", name="io.debezium.time.Date") == T.DateType() and of(type="int64", name="my.own.Timestamp") == T.LongType()
    assert of(type="string", parameters={cdc.SOURCE_TYPE: "NUMERIC"}) == T.DecimalType(38, 10)
    assert [number(*x) for x in (("10", "2"), ("0", "0"), ("39", "2"), ("4", "6"), ("131089", "0"))] == [T.DecimalType(10, 2)] + [T.DecimalType(38, 10)] * 4
    assert of(type="array", items={"type": "int64"}) == T.ArrayType(T.LongType()) and of(type="map", values={"type": "string"}) == T.MapType(T.StringType(), T.StringType())
    assert of(type="struct", fields=[{"field": "a b", "type": "bytes"}]) == T.StructType([T.StructField("a b", T.BinaryType())])
    for bad in ({"type": "bytes", "name": "org.apache.kafka.connect.data.Decimal"}, {"type": "what"}):
        with pytest.raises(cdc.NoLosslessType):
            of(**bad)
    assert cdc.schema_of('{"type":"struct","fields":[]}', None) is None
    narrow, wide = (cdc.TableLayout({"a": cdc.Wire(k, k)}, key) for k, key in (("int", []), ("bigint", ["a"])))
    assert cdc.merge_schemas([narrow, wide, narrow]) == cdc.TableLayout({"a": cdc.Wire("bigint", "bigint")}, ["a"])
    assert cdc.widen(T.IntegerType(), T.LongType()) == T.LongType() and cdc.widen(T.DecimalType(8, 2), T.DecimalType(10, 2)) == T.DecimalType(10, 2)
    assert cdc.widen(T.StringType(), T.LongType()) is None and cdc.widen(T.DecimalType(8, 2), T.DecimalType(10, 3)) is None
    a, b = T.StructType([T.StructField("a", T.IntegerType())]), T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    assert cdc.schema_changes(a, b) == ["widen a bigint", "add b string"]


def test_nanoseconds_are_exact(spark):
    f = cdc.wire({"field": "x", "type": "int64", "name": "io.debezium.time.NanoTimestamp"})
    ns = 1_788_220_800_123_456_789
    assert spark.createDataFrame([(ns,)], "x long").select(f.read(F.col("x"))).first()[0].microsecond == 123456


def test_fold_is_the_sequential_model(spark):
    rng = random.Random(1)
    for _ in range(2):
        events, state = [], {}
        for lsn in range(60):
            k, op = rng.randrange(6), rng.choice("cuud")
            v, n = rng.choice(["a", "b", None, cdc.UNAVAILABLE]), rng.choice([1, 2, None])
            events.append((k, lsn, op, None if op == "d" else v, None if op == "d" else n))
            old = state.get(k, (None, None, None))
            state[k] = (old[0] if op == "d" or v == cdc.UNAVAILABLE else v, old[1] if op == "d" else n, op == "d")
        rows = events + rng.sample(events, 15)
        rng.shuffle(rows)
        schema = "id long, _lsn long, _op string, s string, n long"
        cut = lambda df: {r["id"]: (r["s"], r["n"], r["_is_deleted"]) for r in df.collect()}
        assert cut(cdc.fold_log(spark.createDataFrame(rows, schema), ["id"])) == state
        half = cdc.fold_latest(None, spark.createDataFrame(events[:30], schema), ["id"])
        assert cut(cdc.fold_latest(half, spark.createDataFrame(events[20:], schema), ["id"])) == state
