"""The fold that a stream keeps, VARIANT records, cursors."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import cdc, incremental
from tidemark.sources.tables import Tables
from tidemark.streaming.fold import fold_stream, write_updates

SCHEMA = "id long, part string, _lsn long, _op string, s string, n long, d decimal(12,2), at timestamp, _source_ts timestamp, _kafka_offset long"
START = dt.datetime(2026, 1, 1)


def events(seed, count=120):
    """Events of a few keys; a third is late, some are deletes, some lack a text."""
    rng, out = random.Random(seed), []
    for lsn in range(count):
        op = rng.choice("cuuud")
        values = (None, None, None, None) if op == "d" else (rng.choice(["a", "b", None, cdc.UNAVAILABLE]), rng.choice([2**60 + 1, 7, None]), rng.choice(["1.25", None]), START + dt.timedelta(microseconds=lsn))
        out.append([rng.randrange(9), f"p{rng.randrange(2)}", lsn, op, *values, START + dt.timedelta(minutes=lsn), lsn])
    return out


def write(spark, rows, path):
    spark.createDataFrame([tuple(r) for r in rows], SCHEMA.replace("d decimal(12,2)", "d string")).withColumn("d", F.col("d").cast("decimal(12,2)")).select(*(c.split()[0] for c in SCHEMA.split(", "))).coalesce(1).write.mode("append").parquet(path)


def run(spark, path, store, checkpoint, horizon="7 days"):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)
    q = fold_stream(stream, ["id", "part"], horizon).writeStream.foreachBatch(write_updates(store, "state", ["id", "part"], 4)).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def rows_of(df):
    return {(r["id"], r["part"]): (r["s"], r["n"], r["d"], r["at"], r["_lsn"], r["_op"], r["_is_deleted"]) for r in df.collect()}


def test_stream_keeps_what_the_whole_log_folds_to(spark, tmp_path):
    """Late, repeated and deleted events in four batches, with a restart after the second."""
    rows, rng = events(3), random.Random(4)
    sent = rows + rng.sample(rows, 40)
    rng.shuffle(sent)
    path, store = str(tmp_path / "in"), Tables(spark, str(tmp_path / "tables"))
    for i in range(4):
        write(spark, sent[i * 40 : (i + 1) * 40], path)
        if i in (1, 3):
            run(spark, path, store, str(tmp_path / "checkpoint"))
    log = spark.read.schema(SCHEMA).parquet(path)
    state = store.read("state", "id long, part string, s string, n long, d decimal(12,2), at timestamp, _op string, _lsn long, _source_ts timestamp, _is_deleted boolean, _bucket int")
    got, expected = rows_of(state), rows_of(cdc.fold_log(log, ["id", "part"]))
    assert got == expected and state.count() == len(got) and {True, False} == {x[-1] for x in got.values()}


def test_old_tombstones_leave_the_state_store(spark, tmp_path):
    path, store = str(tmp_path / "in"), Tables(spark, str(tmp_path / "tables"))
    at = lambda h: START + dt.timedelta(hours=h)
    row = lambda k, lsn, op, h: [k, "p", lsn, op, None if op == "d" else f"v{lsn}", 1, None, at(h), at(h), lsn]
    for batch in ([row(1, 10, "c", 0), row(2, 11, "c", 0), row(1, 20, "d", 1)], [row(3, 30, "c", 9)], [row(3, 31, "u", 9)], [row(1, 15, "u", 0.5), row(2, 40, "u", 10)]):
        write(spark, batch, path)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)
    q = fold_stream(stream, ["id", "part"], "2 hours").writeStream.foreachBatch(write_updates(store, "state", ["id", "part"], 2)).outputMode("update").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in map(lambda p: json.loads(p.json), q.recentProgress) if p["stateOperators"]]
    assert max(kept) == 3 and kept[-1] == 2
    state = {r["id"]: (r["s"], r["_is_deleted"]) for r in store.read("state", "id long, part string, s string, _is_deleted boolean, _bucket int").collect()}
    assert state == {1: ("v10", True), 2: ("v40", False), 3: ("v31", False)}  # what is older than the horizon was dropped, not revived


def test_variant_reads_a_column_that_was_unknown_at_ingestion(spark):
    value = lambda op, lsn, **row: json.dumps({"schema": {}, "payload": {"op": op, "source": {"lsn": lsn}, "after": row or None}})
    key = lambda k: json.dumps({"payload": {"id": k}})
    rows = [(key(1), value("c", 1, id=1, s="a")), (key(1), value("u", 2, id=1, s="b", tip="2.50")), (key(1), value("d", 3)), (key(2), value("c", 4, id=2, s=None, tip="x,y")), ("broken", value("c", 5, id=3)), (key(4), "broken"), (key(5), value("u", None, id=5)), (key(6), None)]
    raw = spark.createDataFrame([("t", 0, i, *r) for i, r in enumerate(rows)], "topic string, partition long, offset long, key string, value string")
    taken = cdc.as_variant(raw).cache()
    layout = cdc.TableLayout({"id": cdc.Wire("bigint", "bigint"), "s": cdc.Wire("string", "string")}, ["id"])
    assert [(r["id"], r["s"], r["_op"], r["_lsn"]) for r in cdc.variant_changes(taken, layout).orderBy("_lsn").collect()] == [(1, "a", "c", 1), (1, "b", "u", 2), (1, None, "d", 3), (2, None, "c", 4)]
    layout.columns["tip"] = cdc.Wire("string", "decimal(8,2)")
    got = [(r["id"], str(r["tip"])) for r in cdc.variant_changes(taken, layout).orderBy("_lsn").collect()]
    plain = [(r["id"], str(r["tip"])) for r in cdc.valid_changes(cdc.decode_changes(raw, layout, 0, F.current_timestamp())).orderBy("_lsn").collect()]
    assert got == plain == [(1, "None"), (1, "2.50"), (1, "None")]


def test_variants_are_parsed_once(spark):
    """Two parses of a record, of its value and of its key, however many columns the filter on them reads."""
    raw = spark.createDataFrame([("t", 0, 1, "{}", "{}")], "topic string, partition long, offset long, key string, value string")
    layout = cdc.TableLayout({"id": cdc.wire({"type": "int64", "field": "id"}), "amount": cdc.wire({"type": "double", "field": "amount"})}, ["id"])
    plan = cdc.variant_changes(cdc.as_variant(raw), layout)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parsejson") == 2


def test_a_run_that_is_lost_before_its_cursor_is_repeated(spark, tmp_path):
    store, schema = Tables(spark, str(tmp_path)), "id int, s string, created timestamp"
    at = lambda h: dt.datetime(2026, 1, 1, h)
    rows = spark.createDataFrame([(1, "a", at(1)), (2, "b", at(2)), (3, "c", at(2))], schema)
    done, seen = {}, []

    def upsert(df):
        seen.append(sorted(r["id"] for r in df.collect()))
        done.update({r["id"]: r["s"] for r in df.collect()})

    def lost(df):
        upsert(df)
        raise OSError("lost")

    with pytest.raises(OSError):
        incremental.run_from_cursor(store, "prices", rows, "created", lost)
    assert incremental.read_cursor(store, "prices") is None
    assert incremental.run_from_cursor(store, "prices", rows, "created", upsert) == "2026-01-01 02:00:00"
    more = rows.unionByName(spark.createDataFrame([(2, "b2", at(2)), (4, "d", at(2)), (5, "e", at(3))], schema))  # rows at the boundary came later
    incremental.run_from_cursor(store, "prices", more, "created", upsert)
    incremental.run_from_cursor(store, "other", rows, "created", upsert)
    assert seen == [[1, 2, 3], [1, 2, 3], [2, 2, 3, 4, 5], [1, 2, 3]] and done.keys() == {1, 2, 3, 4, 5}
    assert incremental.read_cursor(store, "prices") == "2026-01-01 03:00:00" and incremental.run_from_cursor(store, "prices", rows.limit(0), "created", lost) == "2026-01-01 03:00:00"
