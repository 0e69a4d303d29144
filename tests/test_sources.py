"""Sources and sinks besides the capture job, and columns of every wire form."""

import base64
import gzip
import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import columns
from tidemark.operators import cdc, incremental, quality
from tidemark.plans import models
from tidemark.sources import observations
from tidemark.sources.tables import Tables, json_items, optional_table


def test_optional_table_is_empty_until_it_exists(spark, tmp_path):
    store, schema = Tables(spark, str(tmp_path)), "id int, s string"
    assert optional_table(store, "t", schema).count() == 0 and store.read("t", schema) is None
    store.append("t", spark.createDataFrame([(1, "a")], schema))
    assert [tuple(r) for r in optional_table(store, "t", schema).collect()] == [(1, "a")]


def test_partitions_are_replaced_and_others_stay(spark, tmp_path):
    store, schema = Tables(spark, str(tmp_path)), "id int, s string, p int"
    store.replace("t", spark.createDataFrame([(1, "a", 1), (2, "b", 2)], schema), ["p"])
    store.replace("t", store.read("t", schema).filter("p = 2").withColumn("s", F.lit("c")), ["p"])  # reads what it replaces
    assert sorted(tuple(r) for r in store.read("t", schema).collect()) == [(1, "a", 1), (2, "c", 2)]
    assert sorted(store.values("t", "p")) == ["1", "2"]


def test_pages_and_snapshots_of_json(spark, tmp_path):
    page = {"items": [{"id": 1, "price": "2.50", "currency": "INR"}, {"id": 2, "price": None, "currency": "EUR"}], "total": 2}
    (tmp_path / "a.json").write_text(json.dumps(page, indent=1))
    with gzip.open(tmp_path / "b.json.gz", "wt") as f:
        f.write(json.dumps({"items": [{"id": 3, "price": "1"}]}))
    for name, ids in (("a.json", [1, 2]), ("b.json.gz", [3]), ("*", [1, 2, 3])):
        assert sorted(r["id"] for r in json_items(spark, f"{tmp_path}/{name}", observations.ITEM, "items").collect()) == ids


def test_reports_as_json(spark):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "n int, s string")
    got = {r["report"]: json.loads(r["body"]) for r in models.report_json({"two": df, "none": df.limit(0)}).collect()}
    assert got == {"two": [{"n": 1, "s": "a"}, {"n": 2, "s": "b"}], "none": []}


def test_every_wire_form_is_decoded(spark):
    fields = [
        {"field": "id", "type": "int32"}, {"field": "b", "type": "bytes"}, {"field": "m", "type": "map", "keys": {"type": "string"}, "values": {"type": "int64"}}, {"field": "l", "type": "array", "items": {"type": "string"}},
        {"field": "r", "type": "struct", "fields": [{"field": "x", "type": "int32"}]}, {"field": "ms", "type": "int64", "name": "io.debezium.time.Timestamp"}, {"field": "us", "type": "int64", "name": "io.debezium.time.MicroTimestamp"},
        {"field": "d", "type": "int32", "name": "io.debezium.time.Date"}, {"field": "f", "type": "float"}, {"field": "ok", "type": "boolean"},
    ]
    row = {"id": 1, "b": base64.b64encode(b"\x00\xff").decode(), "m": {"k": 2**40}, "l": ["a", None], "r": {"x": 3}, "ms": 1_500, "us": 1_500_001, "d": 365, "f": 0.5, "ok": True}
    value = {"schema": {"fields": [{"field": "after", "fields": fields}]}, "payload": {"op": "c", "source": {"lsn": 1}, "after": row}}
    key = {"schema": {"fields": fields[:1]}, "payload": {"id": 1}}
    raw = spark.createDataFrame([("t", 0, 0, json.dumps(key), json.dumps(value))], "topic string, partition long, offset long, key string, value string")
    layout = cdc.first_schema(raw)
    r = cdc.valid_changes(cdc.decode_changes(raw, layout, 0, F.current_timestamp())).first()
    assert (bytes(r["b"]), r["m"], r["l"], r["r"]["x"], r["f"], r["ok"], str(r["d"])) == (b"\x00\xff", {"k": 2**40}, ["a", None], 3, 0.5, True, "1971-01-01")
    assert (r["ms"].isoformat(), r["us"].isoformat()) == ("1970-01-01T00:00:01.500000", "1970-01-01T00:00:01.500001")
    assert cdc.first_schema(raw.withColumn("value", F.lit("no schema"))) is None


def test_schema_versions_of_frames(spark):
    a = spark.createDataFrame([(1, "x")], "id int, s string")
    b = spark.createDataFrame([(2**40, 1.5)], "id long, v double")
    out = cdc.union_versions([a, b])
    assert out.schema == T.StructType([T.StructField("id", T.LongType()), T.StructField("s", T.StringType()), T.StructField("v", T.DoubleType())])
    assert sorted(map(str, out.collect())) == sorted(["Row(id=1, s='x', v=None)", f"Row(id={2**40}, s=None, v=1.5)"])


def test_checksum_differences(spark):
    df = spark.range(10).withColumn("s", F.lit("a"))
    one = quality.layer_checksums({"a": df, "b": df, "cdc_heartbeat": df})
    two = quality.layer_checksums({"a": df.repartition(3).select("s", "id"), "b": df.filter("id > 0"), "c": df})
    assert sorted(r["table"] for r in quality.checksum_diff(one, two).collect()) == ["b", "c"]
    same, other = (quality.layer_checksums({"a": x}, portable=True).first()["digest"] for x in (df.select("s", "id"), df.withColumn("s", F.lit(None).cast("string"))))
    assert same == quality.layer_checksums({"a": df}, portable=True).first()["digest"] != other


def test_text_and_category_columns(spark):
    row = spark.createDataFrame([(" a \n b ", ["fr:x", "en:teas"], "  ")], "t string, tags array<string>, e string")
    got = row.select(columns.clean_text(F.col("t")), columns.clean_text(F.col("t"), 2), columns.category_of(F.col("tags")), columns.first_en_tag(F.col("tags")), columns.clean_text(F.col("e"))).first()
    assert list(got) == ["a b", "a ", "Tea, Coffee & Breakfast", "en:teas", None]


def test_top_rows_of_each_group_are_limited_before_the_shuffle(spark):
    df = spark.range(100).withColumn("g", F.col("id") % 3)
    out = incremental.top_per_group(df, ["g"], [F.desc("id")], 2)
    assert sorted(r["id"] for r in out.collect()) == [94, 95, 96, 97, 98, 99] and "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()
