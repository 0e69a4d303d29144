"""Best-fit packing of documents into token sequences, under conflicts.

Documents are dealt into shards by a hash of their row, evenly whatever their source; a shard holds a bounded
number of pieces in expectation and is packed on its own. Pieces come longest first. Open bins are kept in order of
their residual, each with a bitmap of the duplicate clusters and one of the sources that it holds. For a piece the
search starts at the tightest residual that can take it and goes on to the successors until a bin is compatible: no
cluster bit in common, and fewer documents of the piece's source than allowed. None: a new bin.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .words import Powers, U, mix, slices

_SEQUENCE = Powers(0xB5297A4D3F84D5B5)

#: Words in a sequence, pieces expected in a shard, and documents of one source in a bin.
CAPACITY, SHARD_PIECES, PER_SOURCE = 2048, 4096, 2
_OUT = "shard int, bin long, place int, doc_id long, piece long, start long, n_words long"


class Bins:
    """Open bins in order of (residual, number)."""

    def __init__(self, capacity: int, per_source: int):
        self.capacity, self.per_source = capacity, per_source
        self.order: list[tuple[int, int]] = []
        self.clusters: list[int] = []
        self.sources: list[list[int]] = []  # bitmap k: sources held more than k times
        self.filled: list[int] = []
        self.bits: dict = {}

    def bit(self, kind: str, value) -> int:
        """The shard's own number of a cluster or source as a bit; null conflicts with nothing."""
        return 0 if value is None else 1 << self.bits.setdefault((kind, value), len(self.bits))

    def alone(self) -> int:
        """A bin that is full from the start."""
        self.clusters.append(0)
        self.sources.append([0] * self.per_source)
        self.filled.append(1)
        return len(self.filled) - 1

    def put(self, size: int, cluster, source) -> tuple[int, int]:
        """(bin, place in it) of a piece."""
        c, s = self.bit("c", cluster), self.bit("s", source)
        at = bisect_left(self.order, (size, -1))
        while at < len(self.order):
            residual, b = self.order[at]
            if not self.clusters[b] & c and not self.sources[b][-1] & s:
                del self.order[at]
                break
            at += 1
        else:
            residual, b = self.capacity, len(self.filled)
            self.clusters.append(0)
            self.sources.append([0] * self.per_source)
            self.filled.append(0)
        self.clusters[b] |= c
        for k in range(self.per_source - 1, 0, -1):
            self.sources[b][k] |= self.sources[b][k - 1] & s
        self.sources[b][0] |= s
        if residual > size:
            insort(self.order, (residual - size, b))
        self.filled[b] += 1
        return b, self.filled[b] - 1


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of texts: how many words, and a hash of the sequence of words, A-Z lower-cased."""
    for batch in batches:
        total, cluster = [], []
        for w in slices(batch.column(2), lower=True):
            up, down = _SEQUENCE.upto(len(w.hash) + 1)
            sums = np.zeros(len(w.hash) + 1, U)
            np.cumsum(w.hash * up[: len(w.hash)], out=sums[1:])
            lo, hi = w.bounds[:-1], w.bounds[1:]
            total.append(hi - lo)
            cluster.append(mix((sums[hi] - sums[lo]) * down[lo] ^ (hi - lo).astype(U)).view(np.int64))
        if total:
            yield pa.record_batch({"doc_id": batch.column(0), "source": batch.column(1), "total": pa.array(np.concatenate(total).astype(np.int64)), "cluster": pa.array(np.concatenate(cluster))})


def _pack(capacity: int, per_source: int):
    """Of one shard's rows (doc_id, source, cluster, total, copy): where each piece goes. Full pieces open bins of their own."""
    schema = pa.schema([("shard", pa.int32()), ("bin", pa.int64()), ("place", pa.int32()), ("doc_id", pa.int64()), ("piece", pa.int64()), ("start", pa.int64()), ("n_words", pa.int64())])

    def run(key: tuple, table: pa.Table) -> pa.Table:
        docs = table.select(["doc_id", "source", "cluster", "total", "copy"]).to_pylist()
        docs.sort(key=lambda r: (-(r["total"] % capacity), r["doc_id"] is None, r["doc_id"], r["total"], r["cluster"], r["source"] or "", r["copy"]))
        bins, out = Bins(capacity, per_source), []
        for r in docs:
            full, rest = divmod(r["total"], capacity)
            for k in range(full):
                out.append((bins.alone(), 0, r["doc_id"], k, k * capacity, capacity))
            if rest:
                out.append((*bins.put(rest, r["cluster"], r["source"]), r["doc_id"], full, full * capacity, rest))
        cols = list(zip(*out, strict=True)) or [[]] * 6
        shard = pa.array([key[0].as_py()] * len(out), pa.int32())
        return pa.table([shard, *(pa.array(c, f.type) for c, f in zip(cols, list(schema)[1:], strict=True))], schema=schema)

    return run


def pack(docs: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES, per_source: int = PER_SOURCE) -> DataFrame:
    """Where each piece of each row of ``docs`` (doc_id, text, source) goes: bin_id, place, doc_id, piece, start, n_words.

    Words are runs of other than ASCII white space. A document of more than ``capacity`` of them is cut into pieces of that many, and each
    full piece is a bin of its own. The last
    piece, or a whole shorter document, shares a bin with others that are neither of its duplicate cluster (equal
    words, A-Z lower-cased) nor, more than ``per_source`` of them, of its source. A bin's pieces never sum to more than ``capacity``.
    ``start`` counts words from 0.

    Null, empty or blank text: one piece of 0 words, with bin_id and place null. Null source: no source conflict. A null doc_id stays
    null. Repeated rows are packed as often as they come, in different bins. Other columns are not read. An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession)
    source = F.col("source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), source.alias("source"), F.col("text").cast("string").alias("text"))
    measured = base.mapInArrow(_measure, "doc_id long, source string, total long, cluster long")
    # the texts are read once; rows that are equal in all that matters differ by a copy number, which spreads them over the shards
    sized = scratch.table(measured.groupBy("doc_id", "source", "cluster", "total").agg(F.count("*").alias("copies")), "sized")
    rows = sized.select("doc_id", "source", "cluster", "total", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
    shards = max(1, -(-int(sized.agg(F.sum("copies")).first()[0] or 0) // shard_pieces))
    shard = F.pmod(F.xxhash64("doc_id", "cluster", "total", "source", "copy"), F.lit(shards)).cast("int").alias("shard")
    shared = rows.filter("total > 0").select(shard, "*").groupBy("shard").applyInArrow(_pack(capacity, per_source), _OUT)
    shared = shared.select(F.concat_ws("-", "shard", "bin").alias("bin_id"), "place", "doc_id", "piece", "start", "n_words")
    zero = F.lit(0).cast("long")
    none = rows.filter("total = 0").select(F.lit(None).cast("string").alias("bin_id"), F.lit(None).cast("int").alias("place"), "doc_id", zero.alias("piece"), zero.alias("start"), zero.alias("n_words"))
    return shared.unionByName(none)
