"""Current state of each key kept by the stream itself: a state store in place of a table that every batch reads and writes again."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from tidemark.operators import cdc
from tidemark.sources.tables import BUCKET, Tables, bucket_of

_PACKED, _JSON = "_packed", {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
_ORDER = [T.StructField("lsn", T.LongType()), T.StructField("offset", T.LongType())]


def fold_stream(changes: DataFrame, keys: list[str], horizon: str = "7 days") -> DataFrame:
    """A stream, in update mode, of the state of each key whose events came: its values, ``_op``, ``_lsn``, ``_source_ts``, ``_is_deleted``.

    The state is that of :func:`~tidemark.operators.cdc.fold_log` over all events so far, whatever their order and however often they come; that
    takes, beside the values, where each came from: the newest event for the row, for each text the newest that had it. Events that are ``horizon``
    older than the newest are dropped by the watermark, so a tombstone that old can change no more, and its state is freed by a timer.
    """
    schema = changes.schema
    values = [f.name for f in schema if f.name not in keys and not f.name.startswith("_")]
    lazy = [c for c in values if isinstance(schema[c].dataType, T.StringType)]
    plain = [schema[c] for c in values if c not in lazy]
    meta = [schema[c] for c in ("_op", "_source_ts")]
    # what changes together: its position, then its columns; those that are no texts travel as one JSON text, in which every value is exact
    groups = {"row": meta, _PACKED: [T.StructField(_PACKED, T.StringType())], **{c: [schema[c]] for c in lazy}}
    held = T.StructType([T.StructField(f"{g}__{f.name}", f.dataType) for g, fields in groups.items() for f in [*_ORDER, *fields]])
    out = T.StructType([*(schema[c] for c in keys), *(f for g in groups.values() for f in g), T.StructField("_lsn", T.LongType()), T.StructField("_is_deleted", T.BooleanType())])

    def take(known: dict, group: str, rows: pd.DataFrame) -> None:
        if len(rows):
            at = rows.sort_values(["_lsn", "_kafka_offset"], kind="stable").iloc[-1]  # of equal positions the later record
            order = (int(at["_lsn"]), int(at["_kafka_offset"]))
            if known[group][0] is None or order >= tuple(known[group][:2]):
                known[group] = [*order, *(None if pd.isna(at[f.name]) else at[f.name] for f in groups[group])]

    def update(key, frames, state):
        if state.hasTimedOut:
            state.remove()
            return
        known, left = {}, list(state.get) if state.exists else [None] * len(held)
        for g, fields in groups.items():
            known[g], left = left[: len(fields) + 2], left[len(fields) + 2 :]
        for rows in frames:
            take(known, "row", rows)
            live = rows[rows["_op"] != "d"]
            take(known, _PACKED, live)
            for c in lazy:
                take(known, c, live[live[c] != cdc.UNAVAILABLE])
        state.update(tuple(x.to_pydatetime() if isinstance(x, pd.Timestamp) else x for g in groups for x in known[g]))
        lsn, _, op, at = known["row"]
        if op == "d":
            state.setTimeoutTimestamp(max(int(pd.Timestamp(at).timestamp() * 1000) if at else 0, state.getCurrentWatermarkMs()) + 1)
        yield pd.DataFrame([[*key, *(x for g in groups for x in known[g][2:]), lsn, op == "d"]], columns=out.names)

    offset = F.col("_kafka_offset") if "_kafka_offset" in changes.columns else F.lit(0)
    packed = F.to_json(F.struct(*(f.name for f in plain)), _JSON) if plain else F.lit("{}")
    events = changes.select(*keys, *lazy, "_op", "_lsn", "_source_ts", offset.cast("long").alias("_kafka_offset"), packed.alias(_PACKED)).withWatermark("_source_ts", horizon)
    folded = events.groupBy(*keys).applyInPandasWithState(update, out, held, "update", GroupStateTimeout.EventTimeTimeout)
    value = F.from_json(_PACKED, T.StructType(plain), _JSON)
    return folded.withColumn(_PACKED, value).select(*keys, *(F.col(c) if c in lazy else F.col(f"{_PACKED}.{c}").alias(c) for c in values), "_op", "_lsn", "_source_ts", "_is_deleted")


def write_updates(store: Tables, name: str, keys: list[str], buckets: int = 16) -> Callable[[DataFrame, int], None]:
    """A sink for :func:`fold_stream`: rows take the place of their key's in a table of hash buckets, of which only touched ones are read and written."""

    def put(batch: DataFrame, batch_id: int) -> None:
        batch = batch.withColumn(BUCKET, bucket_of(batch.schema, keys, buckets)).persist()
        try:
            touched = [b for (b,) in batch.select(BUCKET).distinct().collect()]  # at most so many as buckets
            if touched:
                known = store.read(name, batch.schema)
                rest = known and known.filter(F.col(BUCKET).isin(touched)).join(batch.select(*keys), keys, "left_anti").select(*batch.columns)
                store.replace(name, (batch if rest is None else rest.unionByName(batch)).repartition(BUCKET), [BUCKET])
        finally:
            batch.unpersist()

    return put
