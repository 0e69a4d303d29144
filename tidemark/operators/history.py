"""Histories from a change log: newest rows, slowly changing versions, state periods, removed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import minutes_between


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key that is newest by ``order``; a partial maximum, so a hot key is reduced before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    out = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r"))
    return out.select(*(F.col(c) if c in keys else F.col(f"r.{c}").alias(c) for c in df.columns))


def scd2(changes: DataFrame, keys: list[str], tracked: list[str], valid_from: str, order_by: str = "_lsn", close_on_delete: bool = False) -> DataFrame:
    """Versions of each key: one for each change of a tracked column, with validity and number. Repeated events make none.

    With ``close_on_delete`` a delete event ends the last version; else deletes must not be among the changes.
    """
    w = Window.partitionBy(*keys).orderBy(order_by)
    state = F.struct(*tracked, *([(F.col("_op") == "d").alias("_gone")] if close_on_delete else []))
    seen = changes.withColumns({"_now": state, "_before": F.lag(state).over(w)})
    versions = seen.filter(F.col("_before").isNull() | ~F.col("_now").eqNullSafe(F.col("_before")))
    versions = versions.withColumn("valid_to", F.lead(valid_from).over(w)).withColumn("_last", F.lead(F.lit(1)).over(w).isNull())
    if close_on_delete:
        versions = versions.filter(~F.col("_now._gone"))
    return versions.select(
        *keys, F.row_number().over(w).alias("version"), *tracked, F.col(valid_from).alias("valid_from"), "valid_to", F.col("_last").alias("is_current"), F.col(order_by).alias("source_lsn")
    )


#: A key with more than one in ``SHARES`` of all facts, and with more than ``FEW``, is dealt over several tasks.
SHARES, FEW = 1_000, 100_000


def scd2_lookup_asof(facts: DataFrame, history: DataFrame, keys: list[str], at: str, columns: list[str]) -> DataFrame:
    """Each fact with the version that was valid at its time, null where none was.

    Facts and versions are put into one order of time for each key, in which each fact takes the last version before it: no fact ever meets all
    versions of its key. Facts of a hot key are dealt over parts, each with the key's versions; such keys are fewer than ``SHARES``.
    """
    counts = facts.groupBy(*keys).agg(F.count("*").alias("_n"))
    total, most = counts.agg(F.sum("_n"), F.max("_n")).first()
    limit = max(FEW, (total or 0) // SHARES)
    version = F.struct("valid_from", "valid_to", *columns)
    rows = facts.select(*keys, F.col(at).alias("_at"), F.lit(1).alias("_kind"), F.lit(0).alias("_turn"), F.lit(0).cast("long").alias("_part"), F.struct("*").alias("_fact"), F.lit(None).cast(history.select(version.alias("v")).schema["v"].dataType).alias("_version"))
    turn = F.col("version") if "version" in history.columns else F.lit(0)
    past = history.select(*keys, F.col("valid_from").alias("_at"), F.lit(0).alias("_kind"), turn.alias("_turn"), F.lit(0).cast("long").alias("_part"), F.lit(None).cast(facts.select(F.struct("*").alias("f")).schema["f"].dataType).alias("_fact"), version.alias("_version"))
    if (most or 0) > limit:
        hot = counts.filter(F.col("_n") > limit).select(*keys, (F.floor(F.col("_n") / limit) + 1).alias("_parts"))
        parts, zero = F.coalesce("_parts", F.lit(1)), F.lit(0).cast("long")
        dealt = lambda df, part: df.join(F.broadcast(hot), keys, "left").withColumn("_part", part).drop("_parts")
        rows = dealt(rows, F.pmod(F.xxhash64("_fact"), parts))
        past = dealt(past, F.explode(F.sequence(zero, parts.cast("long") - 1)))
    w = Window.partitionBy(*keys, "_part").orderBy("_at", "_kind", "_turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = rows.unionByName(past).withColumn("_last", F.last("_version", ignorenulls=True).over(w)).filter("_kind = 1")
    valid = F.col("_last.valid_to").isNull() | (F.col("_at") < F.col("_last.valid_to"))
    return seen.select("_fact.*", *(F.when(valid, F.col(f"_last.{c}")).alias(c) for c in columns))


def scd2_validate(history: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, problem): keys without exactly one current version, gaps or overlaps, intervals that run backwards."""
    w = Window.partitionBy(*keys).orderBy("version")
    bad = history.withColumn("_next", F.lead("valid_from").over(w))
    problem = F.when(F.col("valid_to") < F.col("valid_from"), "negative_interval").when(~F.col("valid_to").eqNullSafe(F.col("_next")), "not_contiguous")
    rows = bad.withColumn("problem", problem).filter("problem is not null").select(*keys, "problem")
    counts = history.groupBy(*keys).agg(F.count_if("is_current").alias("c")).filter("c <> 1").select(*keys, F.lit("current_versions").alias("problem"))
    return rows.unionByName(counts)


def state_periods(changes: DataFrame, keys: list[str], state: Column, changed_at: Column, target: str, as_of: Column, order_by: str = "_lsn") -> DataFrame:
    """Unbroken periods in the ``target`` state: started_at, ended_at (null while it lasts), is_ongoing, minutes up to ``as_of``."""
    w = Window.partitionBy(*keys).orderBy(order_by)
    events = changes.select(*keys, order_by, changed_at.alias("_at"), state.alias("_state"))
    starts = events.withColumn("_start", (~F.lag("_state").over(w).eqNullSafe(F.col("_state"))).cast("int"))
    islands = starts.withColumn("_island", F.sum("_start").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    spans = islands.groupBy(*keys, "_island").agg(F.min("_state").alias("_state"), F.min("_at").alias("started_at"))
    ended = spans.withColumn("ended_at", F.lead("started_at").over(Window.partitionBy(*keys).orderBy("_island"))).filter(F.col("_state") == target)
    return ended.select(*keys, "started_at", "ended_at", F.col("ended_at").isNull().alias("is_ongoing"), minutes_between(F.col("started_at"), F.coalesce("ended_at", as_of)).alias("minutes"))


def removed_rows(changes: DataFrame, keys: list[str], carry: list[str]) -> DataFrame:
    """Rows deleted at the source, with what their first version had. One pass: both sides are aggregates of one grouping."""
    made = F.col("_op").isin("r", "c")
    one = changes.groupBy(*keys).agg(
        F.min_by(F.when(made, F.struct(*carry)), F.when(made, F.col("_lsn"))).alias("first"),
        F.collect_set(F.when(F.col("_op") == "d", F.struct("_lsn", "_source_ts"))).alias("gone"),
    )
    return one.filter("first is not null").select(*keys, *(F.col(f"first.{c}").alias(c) for c in carry), F.explode("gone").alias("g")).select(*keys, *carry, F.col("g._source_ts").alias("removed_at"))


def relisted_keys(changes: DataFrame, keys: list[str]) -> DataFrame:
    """Keys created again after a delete."""
    w = Window.partitionBy(*keys).orderBy("_lsn")
    return changes.withColumn("_next", F.lead("_op").over(w)).filter("_op = 'd' and _next = 'c'").select(*keys).distinct()
