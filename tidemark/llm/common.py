"""Shared helpers: scratch tables in the cluster's shared folder, null-safe document keys."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six ASCII white-space characters that end a word.
SPACES = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def scratch_dir(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share.

    Without the setting a temporary folder serves a local session, whose one process is driver and executor; on a
    cluster the setting must be there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.tidemark.scratch", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.tidemark.scratch", base)
    return f"{base.rstrip('/')}/tidemark-{uuid.uuid4().hex}"


_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Written tables that cut lineage: a lost executor costs a re-read, never a recomputation."""

    def __init__(self, spark: SparkSession):
        self.spark, self.base, self.n = spark, scratch_dir(spark), 0
        self.paths: dict[int, tuple[DataFrame, str]] = {}

    def table(self, df: DataFrame, name: str) -> DataFrame:
        self.n += 1
        path = f"{self.base}/{self.n:02d}-{name}"
        before = self.spark.conf.get(_CLEAN, None)
        self.spark.conf.set(_CLEAN, "true")  # what was shuffled for a written table is not needed again
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            self.spark.conf.unset(_CLEAN) if before is None else self.spark.conf.set(_CLEAN, before)
        back = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(back)] = back, path
        return back

    def drop(self, df: DataFrame) -> None:
        """Free a written table that no later result reads."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(df))[1])
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: A key with more than one in ``SHARES`` of all rows is hot, so fewer than ``SHARES`` keys are; small keys never are.
SHARES, FEW = 10_000, 4_096
_PARTS, _PART = "__tidemark_parts", "__tidemark_part"


def rows_with(rows: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose ``keys`` are in ``found``, which has each of its keys once with ``n``, the number of rows that have it.

    Rows of a hot key are dealt by their hash over as many parts as leave each a small share of all rows, and the key is
    repeated for every part. Hot keys and their parts are bounded in number whatever the input, so they are broadcast.
    """
    total, most = found.agg(F.sum("n"), F.max("n")).first()
    limit = max(FEW, (total or 0) // SHARES)
    if (most or 0) <= limit:
        return rows.join(found.select(*keys).hint("shuffle_hash"), keys)
    parts = F.floor(F.col("n") / limit).cast("long") + 1
    hot = found.filter(F.col("n") > limit).select(*keys, parts.alias(_PARTS))
    dealt = rows.join(F.broadcast(hot), keys, "left").withColumn(_PART, F.coalesce(F.pmod(F.xxhash64(*rows.columns), F.col(_PARTS)), F.lit(0).cast("long")))
    each = found.select(*keys, F.explode(F.when(F.col("n") > limit, F.sequence(F.lit(0).cast("long"), parts - 1)).otherwise(F.array(F.lit(0).cast("long")))).alias(_PART))
    return dealt.join(each.hint("shuffle_hash"), [*keys, _PART]).select(*rows.columns)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def doc_text(docs: DataFrame) -> DataFrame:
    """Only ``doc_id`` and ``text``: other columns, whatever their names, never meet the operator's own."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def row_key(prefix: str = "") -> list[Column]:
    """Names one row without failing on nulls: the id (a null id counts as the least long), and the text's hash."""
    return [
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias(f"{prefix}id"),
        F.xxhash64(F.col("text").cast("string")).alias(f"{prefix}text_hash"),
    ]


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)
