"""Mergeable sketches: quantiles and distinct counts that are stored once for each small group and merged to larger ones without the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of quantile sketches; ranks are then off by at most ``RANK_ERROR`` with 99 % confidence.
KLL_K, RANK_ERROR = 400, 0.0066 + 0.0005
#: Registers of distinct-count sketches, as a power of two; the relative standard error is 0.83 / sqrt(2 ** HLL_LOG).
HLL_LOG = 12


def quantile_sketches(df: DataFrame, group: list[Column | str], value: str) -> DataFrame:
    """(group, rows, sketch): one sketch of ``value`` for each group; nulls do not count."""
    v = F.col(value).cast("double")
    return df.groupBy(*group).agg(F.count(v).alias("rows"), F.kll_sketch_agg_double(v, KLL_K).alias("sketch"))


def merge_quantiles(sketches: DataFrame, group: list[Column | str], ranks: dict[str, float]) -> DataFrame:
    """(group, rows, a column for each rank): quantiles of larger groups from the sketches of smaller ones."""
    merged = sketches.filter("rows > 0").groupBy(*group).agg(F.sum("rows").alias("rows"), F.kll_merge_agg_double("sketch", KLL_K).alias("_s"))
    return merged.withColumns({n: F.kll_sketch_get_quantile_double("_s", F.lit(float(r))) for n, r in ranks.items()}).drop("_s")


def distinct_sketches(df: DataFrame, group: list[Column | str], value: str) -> DataFrame:
    """(group, sketch): one sketch of the distinct values for each group."""
    return df.groupBy(*group).agg(F.hll_sketch_agg(F.col(value), F.lit(HLL_LOG)).alias("sketch"))


def merge_distinct(sketches: DataFrame, group: list[Column | str], name: str) -> DataFrame:
    """(group, name): how many distinct values the sketches of a group have seen together."""
    return sketches.groupBy(*group).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))


def rank_within(value: Column, exact: Column, rank: float, error: float = RANK_ERROR) -> Column:
    """An aggregate over the rows themselves: whether ``exact`` (the same in a group) stands at a rank that differs from ``rank`` by at most ``error``, or by one row."""
    n, slack = F.count(value), F.lit(error)
    below, upto = F.count_if(value < exact), F.count_if(value <= exact)
    return (below <= (rank + slack) * n + 1) & (upto >= (rank - slack) * n - 1)
