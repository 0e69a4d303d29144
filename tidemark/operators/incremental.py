"""Incremental maintenance of tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import distinct_from
from tidemark.sources.tables import Tables


def touched_keys(frames: list[DataFrame], key: str, since: Column, seen: str = "_ingested_at") -> DataFrame:
    """Keys of rows taken in since then, of any of the tables; tombstones included, so that deletes count as changes."""
    each = [df.filter(F.col(seen) >= since).select(key) for df in frames]
    return reduce(DataFrame.unionByName, each).distinct()


def replace_keys(existing: DataFrame, rebuilt: DataFrame, key: str, touched: DataFrame | None = None) -> DataFrame:
    """``existing`` with all rows of the touched (else: rebuilt) keys replaced; new columns are added."""
    keys = (rebuilt if touched is None else touched).select(key).distinct()
    return existing.join(keys, key, "left_anti").unionByName(rebuilt, allowMissingColumns=True)


def upsert_changed(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows with ``_outcome``: inserted, updated or unchanged, by null-safe comparison of the columns that they bring."""
    values = [c for c in incoming.columns if c not in keys]
    old = existing.select(*keys, *(F.col(c).alias(f"_old_{c}") for c in values if c in existing.columns), F.lit(True).alias("_known"))
    joined = incoming.join(old, keys, "left")
    both = [c for c in values if c in existing.columns]
    changed = distinct_from([F.col(c) for c in both], [F.col(f"_old_{c}") for c in both]) if both else F.lit(False)
    outcome = F.when(F.col("_known").isNull(), "inserted").when(changed, "updated").otherwise("unchanged")
    return joined.select(*incoming.columns, outcome.alias("_outcome"))


def apply_upsert(existing: DataFrame, outcome: DataFrame, keys: list[str]) -> DataFrame:
    """The table after :func:`upsert_changed`; unchanged rows are not touched."""
    new = outcome.filter("_outcome <> 'unchanged'").drop("_outcome")
    return existing.join(new.select(*keys), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def after_cursor(df: DataFrame, column: str, cursor: Column) -> DataFrame:
    """Rows from the cursor on, the cursor's own included: a boundary row is read again rather than missed."""
    return df.filter(F.col(column) >= cursor)


CURSORS = "cursor string, source string"


def read_cursor(store: Tables, source: str) -> str | None:
    """How far a source was read by the last run that ended."""
    known = store.read("cursors", CURSORS)
    row = known and known.filter(F.col("source") == source).first()
    return row and row["cursor"]


def run_from_cursor(store: Tables, source: str, rows: DataFrame, column: str, apply: Callable[[DataFrame], None]) -> str | None:
    """Gives ``apply`` the rows from the cursor on, the cursor's own included, then moves the cursor to the newest of them; gives the cursor.

    The cursor is written after the data: a run that is lost in between is repeated from the old cursor, so nothing is missed, and nothing is
    doubled if ``apply`` is idempotent, as an upsert by key is. The cursor's text must be in the order of the column's values, as ISO times are.
    """
    since = read_cursor(store, source)
    fresh = rows if since is None else after_cursor(rows, column, F.lit(since).cast(rows.schema[column].dataType))
    newest = fresh.agg(F.max(column).cast("string").alias("c")).first()["c"]
    if newest is None:
        return since
    apply(fresh)
    store.replace("cursors", store.spark.createDataFrame([(newest, source)], CURSORS).coalesce(1), ["source"])
    return newest


def top_per_group(df: DataFrame, group: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group; the order must be total. The plan limits groups before their shuffle."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= n).drop("_rank")
