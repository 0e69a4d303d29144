"""Data checks as frames of violations, reconciliation, fingerprints, freshness, health, maintenance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Columns that differ between two equal loads.
VOLATILE = ("_ingested_at", "_batch_id", "_kafka_partition", "_kafka_offset")
#: What an order's status may become.
TRANSITIONS = {"placed": ("accepted", "cancelled"), "accepted": ("picking", "cancelled"), "picking": ("packed", "cancelled"), "packed": ("out_for_delivery",), "out_for_delivery": ("delivered",)}


def check_unique(df: DataFrame, *columns: str) -> DataFrame:
    """Value combinations found more than once."""
    return df.groupBy(*columns).agg(F.count("*").alias("n")).filter("n > 1")


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def check_accepted(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.filter(~F.col(column).isin(*values))


def check_relationship(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose value no parent has; nulls pass."""
    return df.filter(F.col(column).isNotNull()).join(parent.select(F.col(parent_column).alias(column)), column, "left_anti")


def check_non_negative(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column) < 0)


def check_between(df: DataFrame, column: str, low, high) -> DataFrame:
    return df.filter((F.col(column) < low) | (F.col(column) > high))


def check_ordered(df: DataFrame, columns: list[str], strict: bool = False) -> DataFrame:
    """Rows whose times are out of order; a missing time passes unless ``strict``."""
    fine = reduce(lambda a, b: a & b, (F.col(a) <= F.col(b) for a, b in zip(columns, columns[1:], strict=False)))
    return df.filter(~F.coalesce(fine, F.lit(False)) if strict else ~fine)


def check_transitions(history: DataFrame, key: str, status: str, order: list[str], allowed: dict = TRANSITIONS) -> DataFrame:
    """(key, before, status): steps that the map does not have."""
    steps = history.withColumn("before", F.lag(status).over(Window.partitionBy(key).orderBy(*order))).filter("before is not null")
    fine = reduce(lambda a, b: a | b, ((F.col("before") == a) & F.col(status).isin(*b) for a, b in allowed.items()))
    return steps.filter(~fine).select(key, "before", status)


def check_sums(parts: DataFrame, key: str, part: str, wholes: DataFrame, whole: str) -> DataFrame:
    """Wholes whose parts do not add up to them; no parts count as 0."""
    sums = parts.groupBy(key).agg(F.sum(part).alias("parts"))
    return wholes.select(key, whole).join(sums, key, "left").filter(F.coalesce("parts", F.lit(0)) != F.col(whole))


def _measures(f: T.StructField) -> list[tuple[str, Column]]:
    c, n = F.col(f"`{f.name}`"), f.name
    out = [(f"{n}.count", F.count(c).cast("decimal(38,6)").cast("string"))]
    if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
        out.append((f"{n}.sum~", F.sum(c).cast("string")))
    elif isinstance(f.dataType, T.NumericType):
        out.append((f"{n}.sum", F.sum(c.cast("decimal(38,6)")).cast("string")))
    elif isinstance(f.dataType, T.BooleanType):
        out.append((f"{n}.true", F.count_if(c).cast("decimal(38,6)").cast("string")))
    elif isinstance(f.dataType, (T.TimestampType, T.DateType, T.TimestampNTZType)):
        out += [(f"{n}.min", F.min(c).cast("string")), (f"{n}.max", F.max(c).cast("string"))]
    elif isinstance(f.dataType, T.StringType):
        out.append((f"{n}.length", F.sum(F.char_length(c)).cast("decimal(38,6)").cast("string")))
    return out


def profile(df: DataFrame) -> DataFrame:
    """(label, value): row count and, for each column by type, non-null count, sum, text length, true count or extremes; one pass."""
    made = [("rows", F.count("*").cast("decimal(38,6)").cast("string")), *(m for f in df.schema for m in _measures(f))]
    one = df.agg(*(e.alias(f"m{i}") for i, (_, e) in enumerate(made)))
    pairs = F.array(*(F.struct(F.lit(label).alias("label"), F.col(f"m{i}").alias("value")) for i, (label, _) in enumerate(made)))
    return one.select(F.explode(pairs).alias("p")).select("p.label", "p.value")


def same_value(label: Column, a: Column, b: Column) -> Column:
    """Null equals 0; sums of floating numbers (label ends in ~) by 1e-6 relative; numbers by value; else equality."""
    x, y = a.try_cast("double"), b.try_cast("double")
    near = F.abs(x - y) <= F.lit(1e-6) * F.greatest(F.abs(x), F.abs(y), F.lit(1.0))
    zero = lambda v, w: v.isNull() & (w.try_cast("double") == 0)
    numbers = a.try_cast("decimal(38,6)") == b.try_cast("decimal(38,6)")
    return F.coalesce(a.eqNullSafe(b) | zero(a, b) | zero(b, a) | F.when(label.endswith("~"), near).otherwise(numbers), F.lit(False))


def reconcile(source: DataFrame, target: DataFrame, name: str, cut: Column | None = None) -> DataFrame:
    """One row: table, ok, rows_source, rows_target, mismatches, warnings. ``cut`` limits both sides to settled rows."""
    missing = [c for c in source.columns if c not in target.columns]
    extra = [c for c in target.columns if c not in source.columns and not c.startswith("_")]
    both = [c for c in source.columns if c in target.columns]
    s, t = (df.filter(cut) if cut is not None else df for df in (source, target))
    p = profile(s.select(*both)).select("label", F.col("value").alias("a")).join(profile(t.select(*both)).select("label", F.col("value").alias("b")), "label", "full_outer")
    bad = ~same_value(F.col("label"), F.col("a"), F.col("b"))
    out = p.agg(
        F.max(F.when(F.col("label") == "rows", F.col("a"))).cast("double").cast("long").alias("rows_source"),
        F.max(F.when(F.col("label") == "rows", F.col("b"))).cast("double").cast("long").alias("rows_target"),
        F.array_sort(F.collect_list(F.when(bad, F.col("label")))).alias("differing"),
    )
    wrong = F.concat(F.array(*(F.lit(f"missing:{c}") for c in missing)).cast("array<string>"), F.col("differing"))
    return out.select(F.lit(name).alias("table"), (F.size(wrong) == 0).alias("ok"), "rows_source", "rows_target", F.array_join(wrong, ",").alias("mismatches"), F.lit(",".join(extra)).alias("warnings"))


def row_diff(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, kind): rows missing, extra or changed, by a full outer join; offsetting errors cannot hide."""
    values = [c for c in source.columns if c not in keys and c in target.columns]
    pack = lambda df, n: df.select(*keys, F.struct(F.lit(1).alias("_"), *values).alias(n))
    j = pack(source, "a").join(pack(target, "b"), keys, "full_outer")
    kind = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").when(~F.col("a").eqNullSafe(F.col("b")), "changed")
    return j.select(*keys, kind.alias("kind")).filter("kind is not null")


def checksum(df: DataFrame, name: str, exclude: tuple = VOLATILE) -> DataFrame:
    """(table, rows, digest): whatever the row order. Decimal sums of row hashes do not overflow."""
    cols = sorted(c for c in df.columns if c not in exclude)
    return df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.xxhash64(F.struct(*cols)).cast("decimal(20,0)")), F.lit(0)).cast("string").alias("digest")).select(F.lit(name).alias("table"), "rows", "digest")


def layer_checksums(tables: dict[str, DataFrame], leave_out: tuple = ("cdc_heartbeat",), portable: bool = False) -> DataFrame:
    """:func:`checksum` of every table of a layer, by name; ``portable`` ones add up :func:`row_digest`, which other engines can state."""
    one = lambda df, n: df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(row_digest(df)), F.lit(0)).cast("decimal(38,0)").cast("string").alias("digest")).select(F.lit(n).alias("table"), "rows", "digest")
    return reduce(DataFrame.unionByName, [(one if portable else checksum)(df, n) for n, df in sorted(tables.items()) if n not in leave_out])


def fence_visible(heartbeat: DataFrame, token: str, fence_id: int = 1) -> DataFrame:
    """One row: whether the current state of the heartbeat table shows the token, so that all events before it are there."""
    return heartbeat.filter(F.col("id") == fence_id).agg(F.coalesce(F.bool_or(F.col("token").eqNullSafe(token)), F.lit(False)).alias("visible"))


def check_not_over(parts: DataFrame, key: str, part: str, wholes: DataFrame, whole: str) -> DataFrame:
    """Wholes whose parts add up to more than them, as refunds of an order must not."""
    sums = parts.groupBy(key).agg(F.sum(part).alias("parts"))
    return wholes.select(key, whole).join(sums, key).filter(F.col("parts") > F.col(whole))


def row_digest(df: DataFrame, exclude: tuple = VOLATILE) -> Column:
    """60 bits of the MD5 of a row's columns as texts, by name; null differs from every text. Any engine with MD5 can state the same."""
    text = lambda c: F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("null"))
    whole = F.concat_ws("|", *(text(c) for c in sorted(df.columns) if c not in exclude))
    return F.conv(F.substring(F.md5(whole), 1, 15), 16, 10).cast("decimal(20,0)")


def key_range(key: Column, width: int) -> Column:
    """The range of ``width`` whole numbers that a key is in, exact for every long."""
    return F.call_function("div", key - F.pmod(key, F.lit(width)), F.lit(width)).cast("long")


def digest_leaves(df: DataFrame, key: str, width: int, exclude: tuple = VOLATILE) -> DataFrame:
    """(range, rows, digest): a digest for each range of ``width`` values of a whole-number key, whatever the row order; null keys have the null range.

    Small enough to store beside a table, and to be compared with another system's.
    """
    each = df.select(key_range(F.col(f"`{key}`"), width).alias("range"), row_digest(df, exclude).alias("d"))
    return each.groupBy("range").agg(F.count("*").alias("rows"), F.sum("d").cast("decimal(38,0)").alias("digest"))


def digest_tree(leaves: DataFrame, fan: int = 16, levels: int = 2) -> list[DataFrame]:
    """The leaves and the levels above them, each digest the sum of ``fan`` below it; the root last."""
    tree = [leaves]
    for i in range(levels):
        up = key_range(F.col("range"), fan) if i + 1 < levels else F.lit(0).cast("long")
        tree.append(tree[-1].groupBy(up.alias("range")).agg(F.sum("rows").alias("rows"), F.sum("digest").cast("decimal(38,0)").alias("digest")))
    return tree


def differing_ranges(source: list[DataFrame], target: list[DataFrame], fan: int = 16) -> DataFrame:
    """(range): leaves whose rows or digest differ, going down from the root only where a level differs."""
    below = None
    for i in reversed(range(len(source))):
        a, b = (t[i].select("range", F.struct("rows", "digest").alias(n)) for t, n in ((source, "a"), (target, "b")))
        if below is not None:
            up = key_range(F.col("range"), fan) if i + 2 < len(source) else F.lit(0).cast("long")
            a, b = (x.join(below.select(F.col("range").alias("_up")), up.eqNullSafe(F.col("_up")), "left_semi") for x in (a, b))
        both = a.withColumnRenamed("range", "_r").join(b, F.col("_r").eqNullSafe(F.col("range")), "full_outer")
        below = both.filter(~F.col("a").eqNullSafe(F.col("b"))).select(F.coalesce("range", "_r").alias("range"))
    return below


#: So many stretches of differing ranges are pushed down to the scan as one filter; more are joined.
PUSHED = 200


def diff_by_digests(source: DataFrame, target: DataFrame, key: str, width: int, fan: int = 16, levels: int = 2) -> DataFrame:
    """:func:`row_diff` by a unique whole-number key, of only the key ranges whose digests differ; both sides must have the same columns.

    Digests take one pass with a small result. Rows are then read of the differing ranges alone: neighbours are merged, and the stretches go down to
    the scan, which skips the files and row groups of all others where the table is laid out by its key.
    """
    trees = [digest_tree(digest_leaves(df.select(*source.columns), key, width, ()), fan, levels) for df in (source, target)]
    bad = differing_ranges(*trees, fan)
    stretches = bad.filter("range is not null").groupBy(key_range(F.col("range"), 4096).alias("_b")).agg(F.sort_array(F.collect_set("range")).alias("r"))  # at most 4,096 ranges each
    runs = stretches.select("_b", F.posexplode("r").alias("i", "range")).groupBy("_b", (F.col("range") - F.col("i")).alias("_run")).agg(F.min("range").alias("low"), F.max("range").alias("high"))
    few = runs.limit(PUSHED + 1).collect()
    nulls = not bad.filter("range is null").isEmpty()
    k = F.col(f"`{key}`")
    if len(few) <= PUSHED:
        keep = reduce(lambda a, b: a | b, [k.between(r["low"] * width, r["high"] * width + width - 1) for r in few] + ([k.isNull()] if nulls else []), F.lit(False))
        pick = lambda df: df.filter(keep)
    else:
        pick = lambda df: df.join(bad.select(F.col("range").alias("_range")), key_range(k, width).eqNullSafe(F.col("_range")), "left_semi")
    return row_diff(pick(source), pick(target.select(*source.columns)), [key])


def checksum_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Tables whose rows or digest differ, or that only one side has."""
    a, b = before.select("table", F.struct("rows", "digest").alias("a")), after.select("table", F.struct("rows", "digest").alias("b"))
    return a.join(b, "table", "full_outer").filter(~F.col("a").eqNullSafe(F.col("b"))).select("table")


def freshness(tables: dict[str, DataFrame], as_of: Column, warn_minutes: int, error_minutes: int, column: str = "_ingested_at") -> DataFrame:
    each = [df.agg(F.max(column).alias("newest")).select(F.lit(n).alias("table"), "newest") for n, df in tables.items()]
    age = F.timestamp_diff("SECOND", F.col("newest").cast("timestamp"), as_of.cast("timestamp")) / 60.0
    state = F.when(age.isNull() | (age > error_minutes), "error").when(age > warn_minutes, "warn").otherwise("pass")
    return reduce(DataFrame.unionByName, each).select("table", "newest", age.alias("minutes_old"), state.alias("state"))


def health(fresh: DataFrame, letters: DataFrame, behind: DataFrame, most_behind: int = 50_000) -> DataFrame:
    """(check, ok, detail): stale tables, dead letters, offsets behind the source (topic, behind)."""
    a = fresh.select(F.concat(F.lit("fresh:"), "table").alias("check"), (F.col("state") != "error").alias("ok"), F.coalesce(F.col("minutes_old").cast("string"), F.lit("never")).alias("detail"))
    b = letters.agg(F.count("*").alias("n")).select(F.lit("dead_letters").alias("check"), (F.col("n") == 0).alias("ok"), F.col("n").cast("string").alias("detail"))
    c = behind.select(F.concat(F.lit("behind:"), "topic").alias("check"), (F.col("behind") <= most_behind).alias("ok"), F.col("behind").cast("string").alias("detail"))
    return a.unionByName(b).unionByName(c)


def purge_tombstones(state: DataFrame, older_than_days: int, as_of: Column) -> DataFrame:
    """The state without tombstones older than the replay horizon."""
    return state.filter(~(F.col("_is_deleted") & (F.col("_source_ts") < as_of - F.make_interval(days=F.lit(older_than_days)))))
