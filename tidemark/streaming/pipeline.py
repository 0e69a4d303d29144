"""The change-capture job: one function for each micro-batch, tables of one dependency level at a time."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from tidemark.operators import cdc
from tidemark.sources.tables import BLOCK, BLOCK_OFFSETS, BUCKET, DAY, Tables, bucket_of

STATE_META = "_op string, _lsn long, _tx_id long, _source_ts timestamp, _ingested_at timestamp, _is_deleted boolean"
LOG_META = "_op string, _lsn long, _tx_id long, _source_ts timestamp, _event_ts timestamp, _snapshot string, _kafka_partition long, _kafka_offset long, _batch_id long, _ingested_at timestamp"
LETTERS = f"topic string, partition long, offset long, key string, value string, reason string, _ingested_at timestamp, table string, {BLOCK} long"
SCHEMAS = "table string, value_schema string, key_schema string, batch long, first_offset long"
TRUNCATES = "lsn long, at timestamp"
RANGES = f"low long, high long, {DAY} date"
METRICS = "table string, measure string, detail string, n long, batch long"
PROGRESS = "query string, records long, seconds double, behind double, observed long, newest_offset long, batch long"
#: What the reader of observed rows is called.
OBSERVED = "change_records"


class OffsetGap(ValueError):
    """Records between two batches of a topic's partition were never delivered."""


def levels(tables: list[str], parents: dict[str, list[str]]) -> list[list[str]]:
    """Tables so that none comes before a parent; unknown tables last, by name."""
    left, out = sorted(tables), []
    while left:
        ready = [t for t in left if t in parents and not any(p in left for p in parents[t])] or [t for t in left if t not in parents] or left
        out.append(ready)
        left = [t for t in left if t not in ready]
    return out


@dataclass
class CdcPipeline:
    """Writes the change log, current state and dead letters of each table that a batch touches; a repeated batch changes nothing.

    The log is partitioned by day of ingestion, the state by hash buckets of the key, of which only touched ones are written again. New versions of
    a schema are written down before the first row under them, so every file can be read by the merge of the known versions. What a batch reads of
    what earlier ones wrote is bounded by its own keys, offsets and log positions, except for schema versions and truncates, which are few.
    """

    store: Tables
    parents: dict[str, list[str]] = field(default_factory=dict)
    ignored: tuple = ("cdc_signal",)
    schemas: dict[str, cdc.TableLayout] = field(default_factory=dict)
    parallel: int = 4
    buckets: int = 16
    metrics: deque = field(default_factory=lambda: deque(maxlen=10_000))  # the newest; all are in the table of that name
    clock: Callable[[], Column] = F.current_timestamp
    gaps_fail: bool = False  # whether offsets must follow each other without a gap; compacted topics have gaps of their own
    ranges: dict[str, dict] = field(default_factory=dict)
    offsets: dict[tuple, int] | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        raw = cdc.raw_projection(batch).persist()
        try:
            if self.gaps_fail:
                self._check_offsets(raw, batch_id)
            found = cdc.survey(raw).withColumn("table", cdc.table_of(F.col("topic"))).orderBy("first_offset").collect()  # rows follow schemas, not events
            by_table: dict[str, list] = {}
            for r in found:
                if r["table"] not in self.ignored:
                    by_table.setdefault(r["table"], []).append(r)
            counts = [m for t, rows in by_table.items() for m in self._evolve(t, rows, batch_id)]
            for level in levels(list(by_table), self.parents):
                with ThreadPoolExecutor(self.parallel) as pool:
                    for more in pool.map(lambda t: self._table(raw, t, by_table[t], batch_id), level):
                        counts += more
            for t, rows in by_table.items():
                counts += [(t, "events", r["op"], r["records"]) for r in rows]
            self.metrics.extend({"batch": batch_id, "table": t, "measure": m, "detail": d, "n": n} for t, m, d, n in counts)
            if counts:
                rows = self.store.spark.createDataFrame([(*c, batch_id) for c in counts], METRICS)
                self.store.replace("metrics", rows.groupBy("table", "measure", "detail", "batch").agg(F.sum("n").alias("n")).coalesce(1), ["batch"])
        finally:
            raw.unpersist()

    # what the tables hold

    def schema(self, table: str) -> cdc.TableLayout | None:
        """The merge of all versions seen so far; after a restart, of those that earlier batches wrote down."""
        if table not in self.schemas and (log := self.store.read("schemas", SCHEMAS)) is not None:
            rows = log.filter(F.col("table") == table).orderBy("batch", "first_offset").collect()  # as many as schema versions
            if rows:
                self.schemas[table] = cdc.merge_schemas([cdc.schema_of(r["value_schema"], r["key_schema"]) for r in rows])
        return self.schemas.get(table)

    def state(self, table: str) -> DataFrame | None:
        """The current state, tombstones marked, under the schema that holds now."""
        known = self.schema(table)
        return known and self.store.read(f"silver_{table}", _with(known.struct(), STATE_META, f"{BUCKET} int"))

    def log(self, table: str) -> DataFrame | None:
        """The change log under the schema that holds now. A filter on key columns skips row groups by their Bloom filters."""
        known = self.schema(table)
        return known and self.store.read(f"bronze_{table}", _with(known.struct(), LOG_META, f"{DAY} date"))

    def dead_letters(self) -> DataFrame | None:
        return self.store.read("dead_letters", LETTERS)

    def truncates(self, table: str) -> DataFrame | None:
        return self.store.read(f"truncates/table={table}", TRUNCATES)

    def rebuilt(self, table: str) -> DataFrame | None:
        """The state from the change log alone, as a replay of it would leave it."""
        log, cuts = self.log(table), self.truncates(table)
        cut = cuts and cuts.agg(F.max("lsn").alias("t_lsn"), F.max_by("at", "lsn").alias("t_ts"))
        return log and cdc.replay(log, self.schema(table).key, cut)

    # one batch

    def _check_offsets(self, raw: DataFrame, batch_id: int) -> None:
        """Offsets of each topic's partition must begin where an earlier batch ended, or before, and have no gap inside."""
        if self.offsets is None:
            past = self.store.read("offsets", "topic string, partition long, last long, batch long")
            self.offsets = {} if past is None else {(r["topic"], r["partition"]): r["last"] for r in past.groupBy("topic", "partition").agg(F.max("last").alias("last")).collect()}
        ends = raw.groupBy("topic", "partition").agg(F.min("offset").alias("first"), F.max("offset").alias("last"), F.count_distinct("offset").alias("n")).collect()  # a row for each partition
        for r in ends:
            before = self.offsets.get((r["topic"], r["partition"]))
            if (before is not None and r["first"] > before + 1) or r["last"] - r["first"] + 1 != r["n"]:
                raise OffsetGap(f"{r['topic']}-{r['partition']}: {r['n']} records from {r['first']} to {r['last']} after {before}")
        if ends:
            rows = [(r["topic"], r["partition"], max(r["last"], self.offsets.get((r["topic"], r["partition"]), -1))) for r in ends]
            self.offsets |= {(t, p): last for t, p, last in rows}
            every = [(t, p, last, batch_id) for (t, p), last in self.offsets.items()]
            self.store.replace("offsets", self.store.spark.createDataFrame(every, "topic string, partition long, last long, batch long").coalesce(1), ["batch"])

    def _evolve(self, table: str, rows: list, batch_id: int) -> list[tuple]:
        """Takes in the batch's schema versions and writes new ones down; gives what changed."""
        known = self.schema(table)
        versions = [(s, r) for r in rows if r["value_schema"] and (s := cdc.schema_of(r["value_schema"], r["key_schema"])) is not None]
        merged = cdc.merge_schemas(([known] if known else []) + [s for s, _ in versions]) if known or versions else None
        if merged is None or merged == known or not merged.key:
            return []
        new = [(table, r["value_schema"], r["key_schema"], batch_id, r["first_offset"]) for _, r in versions]
        self.store.append("schemas", self.store.spark.createDataFrame(new, SCHEMAS).dropDuplicates(["table", "value_schema", "key_schema"]).coalesce(1))
        self.schemas[table] = merged
        changes = cdc.schema_changes(known.struct(), merged.struct()) if known else ["create"]
        return [(table, "schema_changes", c, 1) for c in changes]

    def _table(self, raw: DataFrame, table: str, rows: list, batch_id: int) -> list[tuple]:
        """Writes letters, log and state; gives counts of letters."""
        own = raw.filter(F.col("topic").isin(sorted({r["topic"] for r in rows})))
        schema, now = self.schemas.get(table), self.clock()
        if schema is None:
            return self._letters(table, cdc.unreadable(own, now))
        decoded = cdc.decode_changes(own, schema, batch_id, now).persist()
        try:
            letters = self._letters(table, cdc.dead_letters(decoded))
            changes = cdc.valid_changes(decoded)
            with_log = bool(self.store.parts(f"bronze_{table}"))
            fine, lsn = F.col("_reason").isNull(), F.col("_lsn")
            valid, gone = fine & F.col("_op").isin(*cdc.OPS), fine & (F.col("_op") == "t")
            bucket = bucket_of(schema.struct(), schema.key, self.buckets)
            span = decoded.agg(
                F.min(F.when(valid, lsn)).alias("low"), F.max(F.when(valid, lsn)).alias("high"), F.collect_set(F.when(valid, bucket)).alias("buckets"), F.max(F.when(gone, lsn)).alias("cut"), F.max_by(F.when(gone, F.col("_source_ts")), F.when(gone, lsn)).alias("at")
            ).first()  # one row, with at most so many buckets as there are
            if span["low"] is not None:
                self._append_log(table, changes, span["low"], span["high"])
            touched = set(range(self.buckets)) if span["cut"] is not None else set(span["buckets"])
            if touched:
                self._fold(table, changes, cdc.truncates(decoded), touched, with_log)
            if span["cut"] is not None:
                known, row = self.truncates(table), self.store.spark.createDataFrame([(span["cut"], span["at"])], TRUNCATES)
                if known is None or known.filter(F.col("lsn") == span["cut"]).isEmpty():
                    self.store.append(f"truncates/table={table}", row)
            return letters
        finally:
            decoded.unpersist()

    def _letters(self, table: str, letters: DataFrame) -> list[tuple]:
        """Appends the letters that are not there; reads only the folders of their offsets."""
        letters = letters.withColumn(BLOCK, F.floor(F.col("offset") / BLOCK_OFFSETS)).persist()
        try:
            found = letters.groupBy("reason", BLOCK).count().collect()  # a row for each reason and block
            if found:
                name, keys = f"dead_letters/table={table}", ["topic", "partition", "offset"]
                known = self.store.read(name, LETTERS.replace(", table string", ""))
                fresh = letters.dropDuplicates(keys)
                if known is not None:
                    fresh = fresh.join(known.filter(F.col(BLOCK).isin(sorted({r[BLOCK] for r in found}))).select(*keys), keys, "left_anti")
                if not fresh.isEmpty():
                    self.store.append(name, fresh.coalesce(1) if len(found) < 100 else fresh, [BLOCK])
            return [(table, "dead_letters", r["reason"], r["count"]) for r in found]
        finally:
            letters.unpersist()

    def _days(self, table: str) -> dict:
        """The least and greatest log position of each day of the log: read once, then kept."""
        if table not in self.ranges:
            known = self.store.read(f"ranges/table={table}", RANGES)
            self.ranges[table] = {} if known is None else {r[DAY]: (r["low"], r["high"]) for r in known.collect()}
        return self.ranges[table]

    def overlapping(self, table: str, low: int, high: int) -> DataFrame | None:
        """Of the log, what may hold positions from ``low`` to ``high``: the days whose range does, and in their files the row groups."""
        log, days = self.log(table), self._days(table)
        if log is None:
            return None
        known = {str(d) for d in days}
        near = [str(d) for d, (a, b) in days.items() if a <= high and low <= b] + [d for d in self.store.values(f"bronze_{table}", DAY) if d not in known]
        return log.filter(F.col(DAY).isin([F.to_date(F.lit(d)) for d in near]) & F.col("_lsn").between(low, high)) if near else None

    def _append_log(self, table: str, changes: DataFrame, low: int, high: int) -> None:
        key, days = self.schemas[table].key, self._days(table)
        fresh = cdc.append_unseen(self.overlapping(table, low, high), changes, key).withColumn(DAY, F.to_date("_ingested_at")).persist()
        try:
            each = fresh.groupBy(DAY).agg(F.min("_lsn").alias("low"), F.max("_lsn").alias("high")).collect()  # a day or two
            if each:
                wider = [(min(r["low"], days.get(r[DAY], (r["low"],))[0]), max(r["high"], days.get(r[DAY], (0, r["high"]))[1]), r[DAY]) for r in each]
                days |= {d: (a, b) for a, b, d in wider}
                self.store.replace(f"ranges/table={table}", self.store.spark.createDataFrame(wider, RANGES).coalesce(1), [DAY])  # before the rows: too wide does no harm
                self.store.append(f"bronze_{table}", fresh.sortWithinPartitions("_lsn"), [DAY], key)
        finally:
            fresh.unpersist()

    def _fold(self, table: str, changes: DataFrame, cut: DataFrame, touched: set[int], with_log: bool) -> None:
        """Writes the touched buckets of the state again. A bucket that a lost driver left missing comes from the log."""
        schema, name = self.schemas[table], f"silver_{table}"
        bucket, own = bucket_of(schema.struct(), schema.key, self.buckets), F.col(BUCKET)
        present = {int(b) for b in self.store.values(name, BUCKET)}
        current = self.state(table)
        current = current and current.filter(own.isin(sorted(touched & present))).drop(BUCKET)
        if with_log and (lost := sorted(touched - present)):
            again = self.rebuilt(table).filter(bucket.isin(lost))
            current = again if current is None else current.unionByName(again.select(*current.columns))
        folded = cdc.fold_latest(current, changes, schema.key, cut)
        self.store.replace(name, folded.withColumn(BUCKET, bucket).repartition(BUCKET), [BUCKET])


def _with(struct: T.StructType, *more: str) -> T.StructType:
    return T.StructType([*struct, *T._parse_datatype_string(", ".join(more))])


class Progress(StreamingQueryListener):
    """Writes a row for each micro-batch: how many records it had, by the source and as observed on their way, and how far it is behind the source."""

    def __init__(self, store: Tables, keep: int = 1000):
        self.store, self.batches = store, deque(maxlen=keep)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        behind = [float(s.metrics.get("maxOffsetsBehindLatest", 0)) for s in p.sources]
        seen = p.observedMetrics.get(OBSERVED)
        row = (str(p.id), p.numInputRows, p.batchDuration / 1000, max(behind, default=0.0), seen and seen["records"], seen and seen["newest_offset"], p.batchId)
        self.batches.append(dict(zip((c.split()[0] for c in PROGRESS.split(", ")), row, strict=True)))
        if p.numInputRows:
            self.store.replace("progress", self.store.spark.createDataFrame([row], PROGRESS).coalesce(1), ["batch"])

    def onQueryTerminated(self, event) -> None:
        pass


def run_stream(source: DataFrame, pipeline: CdcPipeline, checkpoint: str, available_now: bool = True, every: str = "15 seconds", listener: Progress | None = None):
    """Start the job: drain what is there and end, or go on at an interval. A listener is registered with the session and gets what is observed."""
    if listener is not None:
        pipeline.store.spark.streams.addListener(listener)
        source = source.observe(OBSERVED, F.count(F.lit(1)).alias("records"), F.max(F.col("offset").cast("long")).alias("newest_offset"))
    writer = source.writeStream.foreachBatch(pipeline).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)).start()
