"""Tables as partitioned Parquet folders, read by one stated schema whatever types their files were written with."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Names of partition columns.
BUCKET, DAY, BLOCK = "_bucket", "_ingest_day", "_block"
#: Offsets of a topic's partition that share a folder of dead letters.
BLOCK_OFFSETS = 1 << 20


def canonical(c: Column, kind: T.DataType) -> Column:
    """A key column in a form that a legal widening of its type does not change."""
    if isinstance(kind, T.IntegralType):
        return c.cast("long")
    if isinstance(kind, T.FractionalType):
        return c.cast(T.DecimalType(38, kind.scale) if isinstance(kind, T.DecimalType) else "double")
    return c


def bucket_of(schema: T.StructType, keys: list[str], buckets: int) -> Column:
    """The hash bucket of a key, the same under every version of the table's schema."""
    return F.pmod(F.xxhash64(*(canonical(F.col(f"`{k}`"), schema[k].dataType) for k in keys)), F.lit(buckets)).cast("int").alias(BUCKET)


class Tables:
    """Named tables below one folder of any file system that Spark writes; one writer for each name.

    Files keep the types that they were written with. The reader is given the schema that holds now: Parquet's reader widens integers, floats and
    decimals, and columns that a file lacks are null. No footers are merged.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def parts(self, name: str) -> list[str]:
        """The folders and files of a table; none while it does not exist."""
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path(name))
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return [n for s in (fs.listStatus(p) if fs.exists(p) else []) if not (n := s.getPath().getName()).startswith((".", "_temporary", "_SUCCESS"))]

    def values(self, name: str, partition: str) -> list[str]:
        return [n.partition("=")[2] for n in self.parts(name) if n.startswith(f"{partition}=")]

    def read(self, name: str, schema: T.StructType | str) -> DataFrame | None:
        """The table by a schema that names its partition columns too; None while it does not exist."""
        return self.spark.read.schema(schema).parquet(self.path(name)) if self.parts(name) else None

    def append(self, name: str, df: DataFrame, partition_by: list[str] = (), keys: list[str] = ()) -> None:
        """More rows. Row groups get Bloom filters on ``keys``, for later reads of single keys."""
        w = df.write.mode("append").option("compression", "zstd")
        for k in keys:
            w = w.option(f"parquet.bloom.filter.enabled#{k}", "true")
        (w.partitionBy(*partition_by) if partition_by else w).parquet(self.path(name))

    def rebuild(self, name: str, df: DataFrame) -> None:
        """The frame in place of the whole table, which it must not read."""
        df.write.mode("overwrite").option("compression", "zstd").parquet(self.path(name))

    def replace(self, name: str, df: DataFrame, partition_by: list[str]) -> None:
        """The frame in place of those partitions of which it has rows. It may read the table: what goes is deleted once all is written.

        Each partition is replaced whole. A driver lost while it replaces them may leave one missing, never one in part.
        """
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(*partition_by).parquet(self.path(name))


def workspace(spark: SparkSession) -> Tables:
    """Tables in a new folder below ``spark.checkpoint.dir``, which driver and executors share; only a local session may do without the setting."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="tidemark-")
    return Tables(spark, f"{base.rstrip('/')}/tables-{uuid.uuid4().hex}")


def optional_table(tables: Tables, name: str, schema: str) -> DataFrame:
    """The table, or an empty one of the schema while it does not exist."""
    found = tables.read(name, schema)
    return tables.spark.createDataFrame([], T._parse_datatype_string(schema)) if found is None else found


def json_items(spark: SparkSession, path: str, schema: str, items: str, lines: bool = False) -> DataFrame:
    """Items of pages of nested JSON, gzip or plain, one page in a file or, with ``lines``, in a line; ``schema`` is that of one item."""
    pages = spark.read.schema(f"{items} array<{schema}>").option("multiLine", not lines).json(path)
    return pages.select(F.explode(items).alias("item")).select("item.*")


def change_stream(spark: SparkSession, path: str | None = None, kafka: dict | None = None, per_trigger: int = 100_000, topics: str = r"[^.]+\.[^.]+\.[^.]+", files_per_trigger: int | None = None) -> DataFrame:
    """A stream of raw records: from the Kafka topics that match (server.schema.table), at most ``per_trigger`` offsets a batch,
    or from files of the five raw columns, oldest first and at most ``files_per_trigger`` a batch."""
    if kafka:
        options = {"startingOffsets": "earliest", "failOnDataLoss": "true", "maxOffsetsPerTrigger": str(per_trigger), "subscribePattern": topics} | kafka
        return spark.readStream.format("kafka").options(**options).load()
    reader = spark.readStream.schema("topic string, partition long, offset long, key string, value string")
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).json(path)
