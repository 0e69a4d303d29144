"""Reversible, incremental line deduplication: sharded cuckoo filters before exact reference-count tables.

State is three tables, written anew each time they change:

* ``postings`` (shard, key_a, key_b, doc_id): which document holds which line key;
* ``counts`` (shard, key_a, key_b, n_docs, keeper): exact reference counts, and the smallest doc_id;
* ``filters`` (shard, buckets): a cuckoo filter of a shard's keys, as bytes.

A batch of new documents asks the filters first. Keys that no filter has are new: they are counted from the batch
alone. Only the others meet the exact counts. Deleting documents takes their references away, and their last one
takes the key out of its filter, so dropped lines come back. Shards are chosen by key hash and number so many that
each holds a bounded number of keys; a line that many documents share is one row there. When the keys outgrow the
shards, the index is dealt over twice as many as it needs, and the filters are built again from the exact counts.
``save`` and ``load`` hand an index from one job to the next.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACES, Scratch, ascii_lower
from .words import U, mix

#: Most keys that a shard has on average; the number of shards follows from it.
KEYS_PER_SHARD = 1 << 13
SLOTS = 4
MIN_CHARS = 10
KEY = ["key_a", "key_b"]
_FILTER = "shard int, buckets binary"
_STATE = {"postings": "key_a long, key_b long, doc_id long", "counts": "shard int, key_a long, key_b long, n_docs long, keeper long", "filters": _FILTER}
_SHAPE = "shards long, min_chars long, keys_per_shard long"


class CuckooFilter:
    """16-bit fingerprints in buckets of four; inserts and deletes whole arrays of keys at once.

    A fingerprint that finds no place after many moves goes to an overflow list, so no key is ever missed.
    """

    def __init__(self, buckets: int, table: np.ndarray | None = None, over: np.ndarray | None = None):
        self.table = np.zeros((buckets, SLOTS), np.uint16) if table is None else table
        self.over = np.zeros((0, 2), np.int64) if over is None else over

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        return cls(1 << max(4, int(np.ceil(np.log2(max(1, keys) / SLOTS / 0.8)))))

    @classmethod
    def from_bytes(cls, raw: bytes) -> CuckooFilter:
        n, m = np.frombuffer(raw[:16], np.int64)
        cut = 16 + 2 * SLOTS * int(n)
        return cls(int(n), np.frombuffer(raw[16:cut], np.uint16).reshape(-1, SLOTS).copy(), np.frombuffer(raw[cut:], np.int64).reshape(int(m), 2).copy())

    def to_bytes(self) -> bytes:
        return np.array([len(self.table), len(self.over)], np.int64).tobytes() + self.table.tobytes() + self.over.tobytes()

    def _place(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h = mix(keys.view(U))
        mark = ((h >> U(48)).astype(np.int64) % 65535 + 1).astype(np.uint16)
        one = (h & U(len(self.table) - 1)).astype(np.int64)
        return mark, one, self._other(one, mark)

    def _other(self, at: np.ndarray, mark: np.ndarray) -> np.ndarray:
        return at ^ (mix(mark.astype(U)) & U(len(self.table) - 1)).astype(np.int64)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        mark, one, two = self._place(keys)
        hit = ((self.table[one] == mark[:, None]) | (self.table[two] == mark[:, None])).any(1)
        if len(self.over):
            over = np.unique(self.over[:, 0] << 16 | self.over[:, 1])
            hit |= np.isin(one << 16 | mark, over) | np.isin(two << 16 | mark, over)
        return hit

    def insert(self, keys: np.ndarray) -> None:
        """Distinct keys. Every turn each waiting fingerprint takes a free slot or, if there is none, another's."""
        mark, at, two = self._place(keys)
        rng = np.random.default_rng(len(keys))
        for turn in range(64):
            for _ in range(SLOTS):
                if not len(mark):
                    return
                free = self.table[at] == 0
                can = np.flatnonzero(free.any(1))
                _, first = np.unique(at[can], return_index=True)
                go = can[first]
                self.table[at[go], free[go].argmax(1)] = mark[go]
                wait = np.ones(len(mark), bool)
                wait[go] = False
                mark, at, two = mark[wait], at[wait], two[wait]
            if turn == 0:
                at = two
                continue
            _, first = np.unique(at, return_index=True)
            slot = rng.integers(SLOTS, size=len(first))
            out = self.table[at[first], slot].copy()
            self.table[at[first], slot] = mark[first]
            wait = np.ones(len(mark), bool)
            wait[first] = False
            moved = self._other(at[first], out)
            mark, at = np.concatenate([mark[wait], out]), np.concatenate([self._other(at[wait], mark[wait]), moved])
            two = at
        self.over = np.concatenate([self.over, np.column_stack([at, mark.astype(np.int64)])])

    def delete(self, keys: np.ndarray) -> None:
        """Keys that are in the filter, one fingerprint each."""
        for mark, one, two in zip(*(x.tolist() for x in self._place(keys)), strict=True):
            for at in (one, two):
                slots = np.flatnonzero(self.table[at] == mark)
                if len(slots):
                    self.table[at, slots[0]] = 0
                    break
            else:
                found = np.flatnonzero((self.over[:, 1] == mark) & ((self.over[:, 0] == one) | (self.over[:, 0] == two)))
                self.over = np.delete(self.over, found[:1], axis=0)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def _postings(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row for each document and distinct line key long enough."""
    keys = F.array_distinct(F.filter(F.transform(lines_of(F.col("text")), line_key), lambda k: F.char_length(k) >= min_chars))
    each = docs.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.explode(keys).alias("key"))
    return each.select(*_key(F.col("key")), "doc_id")


def _key(key: Column) -> list[Column]:
    """128 bits of a key."""
    return [F.xxhash64(key).alias("key_a"), F.xxhash64(F.lit(41), key, F.lit(7)).alias("key_b")]


class LineIndex:
    """The index of one corpus. ``insert`` and ``delete`` change it, ``apply`` drops lines by it."""

    def __init__(self, spark: SparkSession, shards: int, min_chars: int = MIN_CHARS, keys_per_shard: int = KEYS_PER_SHARD):
        self.spark, self.shards, self.min_chars, self.keys_per_shard, self.scratch = spark, shards, min_chars, keys_per_shard, Scratch(spark)
        self.postings = self.counts = self.filters = None

    @classmethod
    def for_docs(cls, docs: DataFrame, min_chars: int = MIN_CHARS, keys_per_shard: int = KEYS_PER_SHARD) -> LineIndex:
        """An empty index with as many shards as these documents' lines (an upper bound of their keys) ask for."""
        n = docs.select(F.sum(F.size(lines_of(F.col("text"))))).first()[0] or 0
        return cls(docs.sparkSession, max(1, -(-int(n) // keys_per_shard)), min_chars, keys_per_shard)

    def save(self, path: str) -> None:
        """Write the index to a new folder; an existing one is an error. What is written last marks it as whole."""
        for name, schema in _STATE.items():
            table = getattr(self, name)
            (self.spark.createDataFrame([], schema) if table is None else table).write.parquet(f"{path}/{name}")
        self.spark.createDataFrame([(self.shards, self.min_chars, self.keys_per_shard)], _SHAPE).write.parquet(f"{path}/shape")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LineIndex:
        """The index that :meth:`save` wrote; fails where the writing did not end. The folder is read, never changed."""
        index = cls(spark, *spark.read.schema(_SHAPE).parquet(f"{path}/shape").first())
        for name, schema in _STATE.items():
            setattr(index, name, spark.read.schema(schema).parquet(f"{path}/{name}"))
        return index

    def _grow(self) -> None:
        """Deal keys that outgrew the shards over more of them. Fingerprints do not tell their keys; the counts do."""
        n = self.counts.count()
        if n <= self.shards * self.keys_per_shard:
            return
        self.shards, room = -(-2 * n // self.keys_per_shard), self.keys_per_shard

        def build(key: tuple, rows: pa.Table) -> pa.Table:
            keys = np.unique(rows["key_a"].to_numpy())
            f = CuckooFilter.sized(max(len(keys), room))
            f.insert(keys)
            return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "buckets": pa.array([f.to_bytes()], pa.binary())})

        self.counts = self.scratch.table(self._sharded(self.counts.drop("shard")).select("shard", *KEY, "n_docs", "keeper"), "counts")
        self.filters = self.scratch.table(self.counts.select("shard", "key_a").groupBy("shard").applyInArrow(build, _FILTER), "filters")

    def _sharded(self, df: DataFrame) -> DataFrame:
        return df.withColumn("shard", F.pmod(F.col("key_a"), F.lit(self.shards)).cast("int"))

    def insert(self, docs: DataFrame) -> None:
        """Documents whose doc_id the index does not hold yet."""
        new = self.scratch.table(_postings(docs, self.min_chars).distinct(), "postings")
        batch = self._sharded(new.groupBy(*KEY).agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("keeper")))
        filters = self.filters if self.filters is not None else self.spark.createDataFrame([], _FILTER)
        room = self.keys_per_shard

        def ask(key: tuple, rows: pa.Table, old: pa.Table) -> pa.Table:
            f = CuckooFilter.from_bytes(old["buckets"][0].as_py()) if len(old) else CuckooFilter.sized(max(len(rows), room))
            keys = rows["key_a"].to_numpy()
            seen = f.contains(keys)
            f.insert(np.unique(keys[~seen]))
            cols = {c: rows[c].cast(t) for c, t in (("shard", pa.int32()), ("key_a", pa.int64()), ("key_b", pa.int64()), ("n_docs", pa.int64()), ("keeper", pa.int64()))}
            out = pa.table(cols | {"seen": pa.array(seen), "buckets": pa.nulls(len(rows), pa.binary())})
            own = {c: [None] for c in out.column_names} | {"shard": [key[0].as_py()], "buckets": [f.to_bytes()]}
            return pa.concat_tables([out, pa.table(own, schema=out.schema)])

        asked = batch.groupBy("shard").cogroup(filters.groupBy("shard")).applyInArrow(ask, "shard int, key_a long, key_b long, n_docs long, keeper long, seen boolean, buckets binary")
        asked = self.scratch.table(asked, "asked")
        self.filters = asked.filter("buckets is not null").select("shard", "buckets")
        counted = ["shard", *KEY, "n_docs", "keeper"]
        fresh, seen = (asked.filter(f"key_a is not null and {'' if s else 'not '}seen").select(*counted) for s in (False, True))
        if self.counts is None:
            # the filters were empty: what they have seen are chance meetings of two new keys
            self.counts, self.postings = fresh.unionByName(seen), new
            self._grow()
            return
        # keys that the filters claim by chance get fingerprints of their own, or a deletion would take another key's
        chance = self.scratch.table(seen.join(self.counts, ["shard", *KEY], "left_anti").select("shard", "key_a"), "chance")
        if not chance.isEmpty():

            def add(key: tuple, rows: pa.Table, old: pa.Table) -> pa.Table:
                f = CuckooFilter.from_bytes(old["buckets"][0].as_py())
                f.insert(np.unique(rows["key_a"].to_numpy()))
                return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "buckets": [f.to_bytes()]})

            self.filters = self.scratch.table(chance.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInArrow(add, _FILTER), "filters")
        both = self.counts.unionByName(seen).unionByName(fresh).groupBy("shard", *KEY).agg(F.sum("n_docs").alias("n_docs"), F.min("keeper").alias("keeper"))
        self.counts = self.scratch.table(both, "counts")
        self.postings = self.scratch.table(self.postings.unionByName(new), "all-postings")
        self._grow()

    def delete(self, doc_ids: DataFrame) -> None:
        """Take back every reference of these documents (doc_id)."""
        ids = doc_ids.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
        gone = self.postings.join(ids, "doc_id", "left_semi").select(*KEY).distinct()
        left = self.scratch.table(self.postings.join(ids, "doc_id", "left_anti"), "all-postings")
        again = left.join(gone, KEY, "left_semi").groupBy(*KEY).agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("keeper"))
        dead = self._sharded(gone.join(again, KEY, "left_anti"))
        self.counts = self.scratch.table(self.counts.join(gone, KEY, "left_anti").unionByName(self._sharded(again).select("shard", *KEY, "n_docs", "keeper")), "counts")

        def forget(key: tuple, rows: pa.Table, old: pa.Table) -> pa.Table:
            f = CuckooFilter.from_bytes(old["buckets"][0].as_py())
            f.delete(rows["key_a"].to_numpy())
            return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "buckets": [f.to_bytes()]})

        self.filters = self.scratch.table(dead.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInArrow(forget, _FILTER), "filters")
        self.postings = left

    def drops(self) -> DataFrame:
        """(doc_id, keys): the keys, by their first half and second half, whose lines a document loses."""
        many = self.counts.filter("n_docs > 1").select(*KEY, "keeper")
        lost = self.postings.join(many, KEY).filter("doc_id <> keeper")
        return lost.groupBy("doc_id").agg(F.collect_list(F.struct(*KEY)).alias("keys"))

    def apply(self, docs: DataFrame) -> DataFrame:
        """Per row of ``docs``: doc_id, text (lines kept), n_lines, n_dropped; see :func:`drop_repeated_lines`."""
        texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        lost = self.drops().select(F.col("doc_id").alias("of"), "keys")
        wide = texts.join(lost, F.col("doc_id") == F.col("of"), "left").select("doc_id", "text", "keys")
        lines, key = lines_of(F.col("text")), lambda x: line_key(x)
        kept = F.when(F.col("keys").isNull(), lines).otherwise(
            F.filter(lines, lambda x: (F.char_length(key(x)) < self.min_chars) | ~F.array_contains(F.col("keys"), F.struct(*_key(key(x)))))
        )
        wide = wide.select("doc_id", F.size(lines).cast("long").alias("n_lines"), kept.alias("kept"))
        return wide.select("doc_id", F.array_join("kept", "\n").alias("text"), "n_lines", (F.col("n_lines") - F.size("kept")).alias("n_dropped"))


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, text, n_lines, n_dropped.

    A text is split at \\n (null or empty: one empty line). A line's key is the line without ASCII white space at
    both ends, A-Z lower-cased. Keys of at least ``min_chars`` code points that at least two documents hold lose all
    their lines but in the smallest doc_id that holds them, where all stay. Other lines stay, joined by \\n.

    A row without doc_id keeps all its lines and counts for no key. Rows with one doc_id are one document. Other
    columns are not read. An empty table gives no rows.
    """
    index = LineIndex.for_docs(docs, min_chars)
    index.insert(docs)
    return index.apply(docs)


def replace_texts(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with the texts that :func:`drop_repeated_lines` leaves, all columns kept; ``n_chars``, if there, counts the new text's code points.

    A null text stays null where no line of it is to go, as none is.
    """
    index = LineIndex.for_docs(docs, min_chars)
    index.insert(docs)
    of, keys = "__tidemark_of", "__tidemark_keys"
    lost = index.drops().select(F.col("doc_id").alias(of), F.col("keys").alias(keys))
    wide = docs.join(lost, docs["doc_id"].cast("long") == F.col(of), "left")
    kept = F.filter(lines_of(F.col("text")), lambda x: (F.char_length(line_key(x)) < min_chars) | ~F.array_contains(F.col(keys), F.struct(*_key(line_key(x)))))
    text = F.when(F.col(keys).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    wide = wide.withColumn("text", text)
    if "n_chars" in docs.columns:
        wide = wide.withColumn("n_chars", F.when(F.col(keys).isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast(docs.schema["n_chars"].dataType)))
    return wide.select(*(f"`{c}`" for c in docs.columns))
