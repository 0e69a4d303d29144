"""N-gram Jaccard self-join by PartEnum signatures.

Two sets of sizes a, b with Jaccard similarity of at least s differ in at most (1-s)/(1+s)*(a+b)
elements. Sizes fall into bands whose ends are a factor s apart, so similar sets lie in one band or in
neighbours; a set signs for its own band and the next. Within a band with at most k differences the
domain of shingle hashes is cut into first-level partitions, each of those into three parts; the
signatures are the hashes of a set on every two of a partition's three parts. Two similar sets agree, but for one
element, in so many partitions that they still share a signature if each leaves out the few that
stand for empty parts only, which would bring strangers together.

Sets that are equal are one node, and a task signs for each only once. Signature rows are shuffled once: sorted by signature, a
streaming pass keeps those that two sets share. A node's hub is the one that most of its signatures point to as the most typical.
Every set has a parity bit map, of two bits or more for each element: the bits in which two maps differ are at most the elements in which the sets
differ, so pairs with too many are no link, which a few bytes tell.

Nodes near enough to their hub by the maps are compared with it as whole sets, so a large group of near copies costs a star, not all its
pairs. Other nodes of one bucket are set against each other by their maps, inside the task that holds the bucket; only pairs that
pass, and that no star has joined, are written and compared as whole sets. Buckets of more than :data:`BUCKET` nodes take another exact way: a node is
compared with the hubs of its bucket, and what is left are pairs under one
hub of which one is not linked with the hub. Such a pair's sets differ from the hub's in sets of elements that overlap by a known least amount if the
two are linked, so they share one of the first few of those elements (those the hub lacks come first); pairs that do
are compared as a whole. No link is lost.

Links are counted, if asked for, without a row for each pair of a group: nodes that are linked with one hub are known by the few elements in which
they differ from it, and two of them differ in what is in one of these lists only, so a task counts the links of some with some others and
gives one number for each node.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, doc_text
from .components import components
from .words import Powers, U, Words, mix, slices, windows

_SHINGLES = Powers(0xD1342543DE82EF95)
#: Rounds in which nodes take over the hub that prevails in their buckets.
LABEL_ROUNDS = 2
#: Largest bit map.
MAP_BITS = 1 << 16
#: Most nodes of a bucket whose maps are set against each other, rows held for it, and bytes of maps after which fewer rows are.
BUCKET, HELD, HELD_BYTES = 1 << 12, 1 << 15, 1 << 22
#: Rows compared with their hubs at once, and bytes of maps that are gathered at once.
NEAR_ROWS, GATHERED = 1 << 10, 1 << 18
#: Nodes of one hub that a task compares with it.
GROUP_PART = 1 << 10
#: Elements in which the nodes of a part differ from their hub, about, and how many of them are counted at once.
PART_ELEMENTS, COLUMNS = 1 << 18, 1 << 11
#: Sets that a task remembers to have signed for.
REMEMBERED = 1 << 19
_OUT_ROWS = 1 << 16


def shingle_sets(w: Words, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes); with fewer than n words the whole sequence is the one shingle."""
    all_ = windows(w.hash, n, _SHINGLES)
    for r in range(w.n):
        lo, hi = int(w.bounds[r]), int(w.bounds[r + 1])
        if hi - lo >= n:
            yield w.first + r, np.unique(all_[lo : hi - n + 1])
        elif hi > lo:
            yield w.first + r, windows(w.hash[lo:hi], hi - lo, _SHINGLES) ^ U(hi - lo)
        else:
            yield w.first + r, np.zeros(0, U)


def fingerprint(f: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed longs."""
    a = mix(np.array([mix(f).sum(dtype=U) + U(len(f)), mix(f ^ U(0xA5A5A5A5A5A5A5A5)).sum(dtype=U)]))
    return int(a[0].view(np.int64)), int(a[1].view(np.int64))


def bit_map(f: np.ndarray) -> bytes:
    """Of each bit, whether an odd number of elements fall on it. There are two to four bits for each element; of very large sets fewer, which tell less."""
    m = min(MAP_BITS, max(64, 1 << (2 * len(f) - 1).bit_length())) if len(f) else 64
    return np.packbits((np.bincount((f & U(m - 1)).astype(np.int64), minlength=m) & 1).astype(np.uint8), bitorder="little").tobytes()


class Maps:
    """Bit maps of many sets, folded to each smaller size as well: half a map upon the other is the map of half the size."""

    def __init__(self, maps: pa.Array):
        ends = maps.cast(pa.large_binary())
        offsets = np.frombuffer(ends.buffers()[1], np.int64)[ends.offset : ends.offset + len(ends) + 1]
        data = np.frombuffer(ends.buffers()[2], np.uint8)
        self.words = np.diff(offsets) // 8
        self.levels: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        row, bits = np.zeros(0, np.int64), None
        size = int(self.words.max(initial=0))
        while size:
            if bits is not None:
                bits = bits[:, :size] ^ bits[:, size:]
            own = np.flatnonzero(self.words == size)
            fresh = np.zeros((len(own), size), U)
            for at in np.array_split(np.arange(len(own)), 1 + 8 * size * len(own) // GATHERED):  # the places take eight times the maps
                fresh[at] = data[offsets[own[at]][:, None] + np.arange(8 * size)].view(U)
            row, bits = np.append(row, own), fresh if bits is None else np.concatenate([bits, fresh])
            place = np.full(len(self.words), -1, np.int64)
            place[row] = np.arange(len(row))
            self.levels[size] = place, bits
            if not (self.words < size).any():
                break
            size //= 2

    def apart(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """At least so many elements are in one of the sets i and j only."""
        out, size = np.zeros(len(i), np.int64), np.minimum(self.words[i], self.words[j])
        for level in np.unique(size):
            place, bits = self.levels[int(level)]
            for at in np.array_split(np.flatnonzero(size == level), 1 + len(i) * int(level) // (1 << 21)):
                out[at] = np.bitwise_count(bits[place[i[at]]] ^ bits[place[j[at]]]).sum(1)
        return out


def _may_link(apart: np.ndarray, x: np.ndarray, y: np.ndarray, num: int, den: int) -> np.ndarray:
    return np.maximum(apart, np.abs(x - y)) * (den + num) <= (den - num) * (x + y)


def _near_hub(num: int, den: int) -> Callable:
    """A mapInArrow function over (hub, node, size, bits, hub_size, hub_bits): the nodes that may be linked with their hub."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, NEAR_ROWS) for b in batches for at in range(0, b.num_rows, NEAR_ROWS)):
            n = batch.num_rows
            maps = Maps(pa.concat_arrays([batch.column(3), batch.column(5)]))
            apart = maps.apart(np.arange(n), np.arange(n, 2 * n))
            keep = _may_link(apart, batch.column(2).to_numpy(), batch.column(4).to_numpy(), num, den)
            yield pa.record_batch([batch.column(0), batch.column(1)], names=["hub", "node"]).filter(pa.array(keep))

    return run


def _bucket_pairs(num: int, den: int) -> Callable:
    """A mapInArrow function over (sig, node, star, size, bits) in order of sig: pairs of a bucket that may be linked and that no star joins."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def pairs(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        sig, node, star, size = (table[c].to_numpy() for c in ("sig", "node", "star", "size"))
        begin = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
        count = np.diff(np.append(begin, len(sig)))
        after = np.repeat(begin + count, count) - np.arange(len(sig))  # rows of the bucket from this one on
        maps, found = Maps(table["bits"].chunk(0)), []
        for d in range(1, int(count.max())):
            i = np.flatnonzero(after > d)
            i = i[star[i] != star[i + d]]
            i = i[_may_link(np.zeros(len(i), np.int64), size[i], size[i + d], num, den)]
            i = i[_may_link(maps.apart(i, i + d), size[i], size[i + d], num, den)]
            found.append(np.column_stack([np.minimum(node[i], node[i + d]), np.maximum(node[i], node[i + d])]))
        both = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)
        return pa.record_batch([pa.array(both[:, 0]), pa.array(both[:, 1])], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in (b.slice(at, NEAR_ROWS) for b in batches for at in range(0, b.num_rows, NEAR_ROWS)):
            held.append(batch)
            rows, size = sum(b.num_rows for b in held), sum(b.nbytes for b in held)
            if rows < HELD and size < HELD_BYTES:
                continue
            last = batch.column(0)[batch.num_rows - 1].as_py()
            table = pa.Table.from_batches(held)
            whole = int(np.searchsorted(table["sig"].to_numpy(), last))  # rows of buckets that are complete
            held = table.slice(whole).combine_chunks().to_batches()
            if whole:
                yield pairs(table.slice(0, whole))
        if held:
            yield pairs(pa.Table.from_batches(held))

    return run


@lru_cache(maxsize=16)
def bands(num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Last size of each band, and the most differences of two similar sets up to that size."""
    lo, last = 1, []
    while lo < 1 << 40:
        last.append(lo * den // num)
        lo = last[-1] + 1
    ends = np.array(last, dtype=object)
    return ends.astype(np.int64), (2 * ends * (den - num) // (den + num)).astype(np.int64)


@lru_cache(maxsize=256)
def _scheme(own: int, num: int, den: int) -> tuple | None:
    """Of sets in one band: cuts of the domain, the parts and salt of each signature, and of each band its signatures and spare ones."""
    edges, one, two, salt, tail, spans, at = [], [], [], [], [], [], 0
    for band in (own, own + 1):
        k = int(bands(num, den)[1][band])
        if not k:  # only equal sets are similar
            continue
        first = (k + 2) // 2
        spare = first // 16 + (first >= 4)
        first += spare
        step = (1 << 64) // (3 * first)
        edges.append(np.append(np.arange(3 * first, dtype=U) * U(step), U(2**64 - 1)))
        p = np.arange(first)
        for leave in range(3):
            one.append(at + 3 * p + (leave + 1) % 3)
            two.append(at + 3 * p + (leave + 2) % 3)
            salt.append(mix(p.astype(U) + U(band << 32)))
            tail.append(np.full(first, leave << 1 | band & 1, U))
        spans.append((3 * first, spare))
        at += 3 * first + 1
    return tuple(np.concatenate(x) for x in (edges, one, two, salt, tail)) + (spans,) if edges else None


def signatures(f: np.ndarray, num: int, den: int) -> np.ndarray:
    """A set's signatures for its band and the next."""
    total = np.zeros(len(f) + 1, U)
    np.cumsum(mix(f), out=total[1:])
    scheme = _scheme(int(np.searchsorted(bands(num, den)[0], len(f))), num, den) if len(f) else None
    if scheme is None:
        return np.zeros(0, U)
    edges, one, two, salt, tail, spans = scheme
    sums = total[np.searchsorted(f, edges)]
    sums = sums[1:] - sums[:-1]
    a, b = sums[one], sums[two]
    sig = mix(mix(a + salt) + b * U(3) + tail)
    empty = (a | b) == 0
    if empty.any():
        keep, at = np.ones(len(sig), bool), 0
        for n, spare in spans:
            keep[at + np.flatnonzero(empty[at : at + n])[:spare]] = False
            at += n
        sig = sig[keep]
    return sig


def _per_text(n: int, rows: Callable, schema: pa.Schema) -> Callable:
    """A mapInArrow function; rows(id, set) gives, for one text, equally long columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[list] = [[] for _ in schema]
        size = 0
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for w in slices(batch.column(1), lower=True):
                for r, f in shingle_sets(w, n):
                    cols = rows(ids[r], f)
                    size += len(cols[0])
                    for k, c in zip(kept, cols, strict=True):
                        k.append(c)
                    if size >= _OUT_ROWS:
                        yield pa.record_batch([_column(k, s.type) for k, s in zip(kept, schema, strict=True)], schema=schema)
                        kept, size = [[] for _ in schema], 0
        if size:
            yield pa.record_batch([_column(k, s.type) for k, s in zip(kept, schema, strict=True)], schema=schema)

    return run


def _column(parts: list, kind: pa.DataType) -> pa.Array:
    if pa.types.is_binary(kind):
        return pa.array([x for p in parts for x in p], kind)
    if pa.types.is_list(kind):
        flat = [x for p in parts for x in p]
        ends = np.cumsum([0, *map(len, flat)], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(flat).view(np.int64)))
    return pa.array(np.concatenate([np.asarray(p, dtype=np.int64) for p in parts]))


def _sign(n: int, num: int, den: int) -> Callable:
    """A mapInArrow function over (doc_id, text): signatures and the set's name. Copies that a task has signed for lately are passed over."""
    schema = pa.schema([("sig", pa.int64()), ("set_a", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()

        def rows(_, f):
            name = fingerprint(f)
            if name in seen:
                return [np.zeros(0, np.int64)] * 2
            if len(seen) >= REMEMBERED:
                seen.clear()  # signing again is harmless
            seen.add(name)
            s = signatures(f, num, den)
            return [s.view(np.int64), np.repeat(np.int64(name[0]), len(s))]

        yield from _per_text(n, rows, schema)(batches)

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (sig, set_a) in order, each once, those whose signature another set has too; only one row waits at a time."""
    wait, last, out = None, None, None  # the first row of an unfinished run, the last row seen, the signature already found shared
    for batch in batches:
        sig, node = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        new = np.ones(len(sig), bool)
        new[1:] = (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])
        if len(sig) and last == (sig[0], node[0]):
            new[0] = False
        sig, node = sig[new], node[new]
        if not len(sig):
            continue
        last = sig[-1], node[-1]
        if wait is not None:
            sig, node = np.append(wait[0], sig), np.append(wait[1], node)
        begin = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
        count = np.diff(np.append(begin, len(sig)))
        keep = count > 1
        keep[0] |= out is not None and sig[0] == out
        wait = None if keep[-1] else (sig[-1], node[-1])
        out = sig[-1] if keep[-1] else None
        rows = np.repeat(keep, count)
        yield pa.record_batch([pa.array(sig[rows]), pa.array(node[rows])], names=["sig", "set_a"])


def _send(n: int) -> Callable:
    """A mapInArrow function over (text, targets): the text's features once for each hub and part that it goes to."""
    schema = pa.schema([("hub", pa.int64()), ("part", pa.int64()), ("member", pa.bool_()), ("node", pa.int64()), ("owned", pa.bool_()), ("features", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, targets = batch.column(0), batch.column(2)
            for w in slices(batch.column(1), lower=True):
                for r, f in shingle_sets(w, n):
                    if not len(f):
                        continue
                    to = targets[r].values
                    for at in range(0, len(to), 256):
                        some = to.slice(at, 256)
                        features = _column([[f] * len(some)], schema.field("features").type)
                        yield pa.record_batch([some.field("hub"), some.field("part"), some.field("member"), pa.array([ids[r].as_py()] * len(some), pa.int64()), some.field("owned"), features], schema=schema)

    return run


def _against_hub(num: int, den: int) -> Callable:
    """A mapInArrow function over (hub, part, member, node, owned, features): in each part the hub's own rows come first."""
    schema = pa.schema([("hub", pa.int64()), ("node", pa.int64()), ("owned", pa.bool_()), ("size", pa.int64()), ("linked", pa.bool_()), ("apart", pa.int64()), ("most", pa.int64()), ("first", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, hubs = None, []
        for batch in batches:
            hub, part, member, node, owned = (batch.column(i).to_pylist() for i in range(5))
            out: list[tuple] = []
            ends = batch.column(5).offsets.to_numpy()
            flat = batch.column(5).values.to_numpy().view(U)
            for i in range(len(ends) - 1):
                x = flat[ends[i] : ends[i + 1]]
                if (hub[i], part[i]) != now:
                    now, hubs = (hub[i], part[i]), []
                if not member[i]:
                    hubs.append(x.copy())
                    continue
                for h in hubs:  # more than one only where a doc_id has several texts
                    more, less = x[~_in(x, h)], h[~_in(h, x)]
                    d, k = len(more) + len(less), (den - num) * (len(x) + len(x) * den // num) // (den + num)
                    linked = d * (den + num) <= (den - num) * (len(x) + len(h))
                    out.append((hub[i], node[i], owned[i], len(x), linked, d, k, np.concatenate([more, less])[: k + 1]))
            if out:
                cols = list(zip(*out, strict=True))
                yield pa.record_batch([pa.array(c, s.type) for c, s in zip(cols[:7], schema, strict=False)] + [_column([cols[7]], schema.field("first").type)], schema=schema)

    return run


def _in(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which of x are in y; both ascending and without repeats."""
    if not len(y):
        return np.zeros(len(x), bool)
    return y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many elements each list of ``left`` has in common with each of ``right``."""
    sides = [(np.concatenate(s), np.repeat(np.arange(len(s)), [len(x) for x in s])) for s in (left, right)]
    (x, _), (y, _) = sides
    shared, out = np.intersect1d(x, y), np.zeros((len(left), len(right)), np.float32)
    if left is right:  # what only one has is common to none
        shared, count = np.unique(x, return_counts=True)
        shared = shared[count > 1]
    for lo in range(0, len(shared), COLUMNS):
        some = shared[lo : lo + COLUMNS]
        has = []
        for flat, row in sides:
            m, hit = np.zeros((int(row.max(initial=-1)) + 1, len(some)), np.float32), _in(flat, some)
            m[row[hit], np.searchsorted(some, flat[hit])] = 1
            has.append(m)
        out[: len(has[0]), : len(has[1])] += has[0] @ has[1].T
    return out.astype(np.int64)


def _inside(num: int, den: int, count: bool) -> Callable:
    """A mapInArrow function over (hub, i, j, part, node, star, owned, docs, size, first) in order of hub, i, j: links of part i with part j.

    With ``count``, of each node the documents that it is linked with; else the pairs of different stars of which the hub owns one.
    """
    names = ("node", "n") if count else ("a", "b")

    def links(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows).combine_chunks()
        part, node, star, docs, size = (table[c].to_numpy() for c in ("part", "node", "star", "docs", "size"))
        owned = table["owned"].to_numpy()
        first = table["first"].chunk(0)
        ends, flat = first.offsets.to_numpy(), first.values.to_numpy()
        i, j = table["i"][0].as_py(), table["j"][0].as_py()
        x, y = np.flatnonzero(part == i), np.flatnonzero(part == j)
        left = [flat[ends[r] : ends[r + 1]] for r in x]
        right = left if i == j else [flat[ends[r] : ends[r + 1]] for r in y]
        if not len(x) or not len(y):
            return pa.record_batch([pa.array([], pa.int64())] * 2, names=names)
        lengths = np.diff(ends)
        apart = lengths[x][:, None] + lengths[y] - 2 * _common(left, right)
        linked = apart * (den + num) <= (den - num) * (size[x][:, None] + size[y])
        linked &= node[x][:, None] < node[y] if i == j else node[x][:, None] != node[y]
        if count:
            cols = np.concatenate([node[x], node[y]]), np.concatenate([linked @ docs[y], docs[x] @ linked])
        else:
            linked &= (star[x][:, None] != star[y]) & (owned[x][:, None] | owned[y])
            a, b = np.nonzero(linked)
            cols = np.minimum(node[x[a]], node[y[b]]), np.maximum(node[x[a]], node[y[b]])
        return pa.record_batch([pa.array(c) for c in cols], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.column_stack([batch.column(c).to_numpy() for c in range(3)])
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1).tolist(), len(key)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                block = tuple(key[lo])
                if held and block != now:
                    yield links(held)
                    held = []
                held.append(batch.slice(lo, hi - lo))
                now = block
        if held:
            yield links(held)

    return run


def _links_inside(near: DataFrame, stars: DataFrame, docs: DataFrame, num: int, den: int, count: bool) -> DataFrame:
    """Links of nodes that are linked with one hub, by :func:`_inside`: every part of a hub's nodes meets every other in a task of its own."""
    linked = near.filter("linked").groupBy("hub", "node").agg(F.min(F.struct("apart", "size", "first")).alias("x"), F.max("owned").alias("owned"))
    linked = linked.select("hub", "node", "owned", "x.*").join(stars, "node", "left").withColumn("star", F.coalesce("star", "node")).join(docs, "node")
    # nodes of one hub, by their number and by the elements that a task would hold
    counts = near.filter("linked").groupBy("hub").agg(F.count("*").alias("c"), F.greatest(F.ceil(F.count("*") / GROUP_PART), F.ceil(F.sum("apart") / PART_ELEMENTS)).alias("parts")).filter("c > 1")
    dealt = linked.join(counts, "hub").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    dealt = dealt.select("hub", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "node", "star", "owned", "docs", "size", "first")
    return dealt.repartition("hub", "i", "j").sortWithinPartitions("hub", "i", "j").mapInArrow(_inside(num, den, count), "node long, n long" if count else "a long, b long")


def _hubs(ranked: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, hub): every node's own hub.

    A bucket's champion is its node that shares the largest part of its signatures, so one with few differences from the others.
    A node's hub is the champion of most of its buckets, then that one's hub in turn, then what prevails around it.
    """
    champions = ranked.groupBy("sig").agg(F.max(F.struct("rank", F.col("node").alias("hub"))).alias("best"))
    votes = ranked.join(champions, "sig").groupBy("node", "best").agg(F.count("*").alias("votes"))
    hubs = votes.groupBy("node").agg(F.max_by("best.hub", F.struct("votes", "best")).alias("hub"))
    hubs = scratch.table(hubs, "hub")
    for _ in range(2):
        up = hubs.select(F.col("node").alias("hub"), F.col("hub").alias("above"))
        hubs = scratch.table(hubs.join(up, "hub", "left").select("node", F.coalesce("above", "hub").alias("hub")), "hub")
    for _ in range(LABEL_ROUNDS):  # the hub of most nodes in most of a node's buckets: a cluster comes to share one
        common = ranked.join(hubs, "node").groupBy("sig", "hub").agg(F.count("*").alias("c")).groupBy("sig").agg(F.max_by("hub", F.struct("c", "hub")).alias("hub"))
        counted = ranked.select("sig", "node").join(common, "sig").groupBy("node", "hub").agg(F.count("*").alias("c"))
        hubs = scratch.table(counted.groupBy("node").agg(F.max_by("hub", F.struct("c", "hub")).alias("hub")), "hub")
    return hubs


def _under_hubs(ranked: DataFrame, hubs: DataFrame, num: int, den: int) -> DataFrame:
    """(hub, node, owned): every node with its own hub, and with the smaller hubs of nodes that it shares a signature with."""
    met = ranked.join(hubs, "node").groupBy("sig", "hub").agg(F.min("size").alias("least"), F.max("size").alias("most"))
    # a node meets the hub of another node of its bucket if one of that hub's nodes there is near it in size
    near = (F.col("least") * num <= F.col("size") * den) & (F.col("size") * num <= F.col("most") * den)
    member = ranked.select("sig", "node", "size").join(met, "sig").filter(near).select("node", "hub").distinct()
    # two nodes of different hubs meet under the smaller of them
    own = member.join(hubs.withColumnRenamed("hub", "own"), "node").withColumn("owned", F.col("own") == F.col("hub"))
    return own.filter("(owned or own > hub) and node <> hub").select("hub", "node", "owned")


def _rest(near: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) of a hub's nodes, one of them its own, that may be linked although one of them is not linked with the hub."""
    wild = near.filter(~F.col("linked")).select("hub").distinct()
    each = near.join(wild, "hub", "left_semi").select("hub", "node", "owned", "size", "linked", "apart", "most", F.posexplode("first").alias("at", "element"))
    cols = ("node", "owned", "size", "linked", "apart", "at")
    x = each.select("hub", "element", *(F.col(c).alias(f"{c}_x") for c in cols))
    y = each.filter(F.col("at") <= F.floor(F.col("most") / 2)).select("hub", "element", *(F.col(c).alias(f"{c}_y") for c in cols))
    sizes = F.col("size_x") + F.col("size_y")
    least = F.ceil((F.col("apart_x") + F.col("apart_y") - F.floor(F.lit(den - num) * sizes / F.lit(den + num))) / 2)  # common elements
    ordered = (F.col("apart_x") > F.col("apart_y")) | ((F.col("apart_x") == F.col("apart_y")) & (F.col("node_x") > F.col("node_y")))
    met = x.join(y, ["hub", "element"]).filter(
        ordered & (F.col("owned_x") | F.col("owned_y")) & ~(F.col("linked_x") & F.col("linked_y")) & (F.least("size_x", "size_y") * den >= F.greatest("size_x", "size_y") * num)
        & (F.col("at_x") <= F.col("apart_x") - least) & (F.col("at_y") <= F.col("apart_y") - least)
    )
    return met.select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b")).distinct()


def _compared(texts: DataFrame, groups: DataFrame, n: int, num: int, den: int, scratch: Scratch) -> DataFrame:
    """Every (hub, node) compared as whole sets. A hub of many nodes is sent to as many parts, so no task holds them all."""
    counts = groups.groupBy("hub").agg(F.ceil(F.count("*") / GROUP_PART).alias("parts"))
    part = F.pmod(F.xxhash64("node"), F.col("parts"))
    members = groups.join(counts, "hub").select("node", F.struct("hub", part.alias("part"), F.lit(True).alias("member"), "owned").alias("t"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")
    leads = counts.select("hub", every).select(F.col("hub").alias("node"), F.struct("hub", "part", F.lit(False).alias("member"), F.lit(True).alias("owned")).alias("t"))
    # written, so that the join with the texts knows their size
    targets = scratch.table(members.unionByName(leads).groupBy("node").agg(F.collect_list("t").alias("targets")), "targets")
    sent = texts.join(targets, F.col("doc_id") == F.col("node")).select("doc_id", "text", "targets")
    sent = sent.mapInArrow(_send(n), "hub long, part long, member boolean, node long, owned boolean, features array<long>")
    return sent.repartition("hub", "part").sortWithinPartitions("hub", "part", "member").mapInArrow(
        _against_hub(num, den), "hub long, node long, owned boolean, size long, linked boolean, apart long, most long, first array<long>"
    )


def _degrees(found: DataFrame, within: DataFrame, stars: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, n): the documents of other nodes that a node is linked with. ``within`` has the links of nodes with one star, so pairs of these do not count again."""
    for k in "ab":
        found = found.join(stars.select(F.col("node").alias(k), F.col("star").alias(f"star_{k}")), k, "left").withColumn(f"star_{k}", F.coalesce(f"star_{k}", k))
    counted = (F.col("star_a") == F.col("star_b")) & (F.col("a") != F.col("star_a")) & (F.col("b") != F.col("star_a"))
    found = found.filter(~counted)
    both = found.select(F.col("a").alias("to"), F.col("b").alias("node")).unionByName(found.select(F.col("b").alias("to"), F.col("a").alias("node")))
    apart = both.join(docs, "node").groupBy(F.col("to").alias("node")).agg(F.sum("docs").alias("n"))
    return apart.unionByName(within).groupBy("node").agg(F.sum("n").alias("n"))


def similar_sets(docs: DataFrame, n: int = 5, num: int = 4, den: int = 5, links: bool = False) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, and if ``links``, n_links.

    Words are runs of other than ASCII white space, A-Z lower-cased; a document's set holds its distinct
    ``n``-word shingles, or its whole sequence if it has fewer words. Documents link if their sets have a Jaccard
    similarity of at least ``num/den``; component_id is the smallest doc_id reachable by links and n_links the number of
    other documents that the document is linked with.

    Null, empty or blank text: 0 shingles, linked with nothing, its own component. A null doc_id: a row with
    component_id and n_links null, linked with nothing. Rows with one doc_id are one document and may have several
    texts; such a one has no n_links, and its links count once for each of its sets. Repeated rows come back as often as they came, and count once. Other columns are not read. An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession)
    texts = doc_text(docs)
    known = texts.filter(F.col("doc_id").isNotNull())
    long4 = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_a", pa.int64()), ("set_b", pa.int64()), ("bits", pa.binary())])
    kept = "doc_id long, n_shingles long, set_a long, set_b long, bits binary"
    measure = _per_text(n, lambda i, f: [[0 if i is None else i], [len(f)], *([x] for x in fingerprint(f)), [bit_map(f)]], long4)
    sets = scratch.table(known.mapInArrow(measure, kept), "sets")
    classes = scratch.table(sets.filter("n_shingles > 0").groupBy("set_a", "set_b").agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("size"), F.first("bits").alias("bits")), "classes")
    signed = known.mapInArrow(_sign(n, num, den), "sig long, set_a long")
    shared = signed.repartition("sig").sortWithinPartitions("sig", "set_a").mapInArrow(_shared, "sig long, set_a long")
    shared = scratch.table(shared, "shared")
    hits = scratch.table(shared.join(classes.select("set_a", "node"), "set_a").select("sig", "node").distinct(), "hits")
    scratch.drop(shared)
    # a doc_id with several texts may stand for several sets
    about = scratch.table(classes.join(hits.select("node").distinct(), "node", "left_semi").select("node", "size", "bits"), "about")
    rank = hits.groupBy("node").agg(F.count("*").alias("n")).join(about.groupBy("node").agg(F.max("size").alias("size")), "node")
    ranked = scratch.table(hits.join(rank.select("node", "size", (F.col("n") / F.col("size")).alias("rank")), "node").select("sig", "node", "size", "rank"), "ranked")
    hubs = _hubs(ranked, scratch)

    of_hub = about.select(F.col("node").alias("hub"), F.col("size").alias("hub_size"), F.col("bits").alias("hub_bits"))
    star = hubs.filter("node <> hub").join(about, "node").join(of_hub, "hub").select("hub", "node", "size", "bits", "hub_size", "hub_bits")
    star = scratch.table(star.mapInArrow(_near_hub(num, den), "hub long, node long").distinct().withColumn("owned", F.lit(True)), "star")
    near = scratch.table(_compared(known, star, n, num, den, scratch), "near")
    joined = scratch.table(near.filter("linked").groupBy("node").agg(F.min("hub").alias("star")), "joined")
    big = scratch.table(hits.groupBy("sig").agg(F.count("*").alias("c")).filter(F.col("c") > BUCKET).select("sig"), "big")
    bucket = hits.join(big, "sig", "left_anti").join(joined, "node", "left").select("sig", "node", F.coalesce("star", "node").alias("star")).join(about, "node")
    pairs = bucket.select("sig", "node", "star", "size", "bits").repartition("sig").sortWithinPartitions("sig").mapInArrow(_bucket_pairs(num, den), "a long, b long")
    pairs = scratch.table(pairs.filter("a <> b").distinct(), "pairs")
    within = between = None
    if links:
        sizes = sets.filter("n_shingles > 0").select("doc_id", "set_a", "set_b").distinct().groupBy("set_a", "set_b").agg(F.count("*").alias("docs"))
        docs_of = scratch.table(sizes.join(classes, ["set_a", "set_b"]).groupBy("node").agg(F.sum("docs").alias("docs")), "docs")
        within = _links_inside(near, joined, docs_of, num, den, True)
    if not big.isEmpty():
        groups = scratch.table(_under_hubs(ranked.join(big, "sig", "left_semi"), hubs, num, den), "groups")
        more = scratch.table(_compared(known, groups, n, num, den, scratch), "more")
        pairs = scratch.table(pairs.unionByName(_rest(more, num, den)).distinct(), "pairs")
        if links:
            between = _links_inside(more, joined, docs_of, num, den, False)
        near = near.unionByName(more)
    row = pa.schema([("node", pa.int64()), ("features", pa.list_(pa.int64()))])
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    features = known.join(ends, F.col("doc_id") == F.col("node"), "left_semi").mapInArrow(_per_text(n, lambda i, f: [[i], [f]], row), "node long, features array<long>")
    features = scratch.table(features.filter(F.size("features") > 0), "features")
    left, right = (features.select(F.col("node").alias(k), F.col("features").alias(f"f{k}")) for k in "ab")
    checked = pairs.join(left, "a").join(right, "b").withColumn("both", F.size(F.array_intersect("fa", "fb")))
    checked = checked.filter(F.col("both") * den >= (F.size("fa") + F.size("fb") - F.col("both")) * num).select("a", "b")
    found = near.filter("linked").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).unionByName(checked)
    found = scratch.table((found if between is None else found.unionByName(between)).distinct(), "links")
    # sets of one document are one component
    one, held = F.struct("set_a", "set_b"), sets.filter("n_shingles > 0")
    several = held.groupBy("doc_id").agg(F.min(one).alias("lo"), F.max(one).alias("hi")).filter("lo <> hi").select("doc_id")
    several = scratch.table(held.join(several, "doc_id", "left_semi").join(classes, ["set_a", "set_b"]).select("doc_id", F.col("node").alias("b")).distinct(), "several")
    bridges = several.join(several.groupBy("doc_id").agg(F.min("b").alias("a")), "doc_id").select("a", "b")
    labels = components(found.unionByName(bridges), scratch)

    member = held.join(classes, ["set_a", "set_b"]).join(labels, "node", "left")
    each = [F.min(F.coalesce("component", "node")).alias("component_id")]
    out = ["doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")]
    if links:
        member = member.join(_degrees(found, within, joined, docs_of), "node", "left").join(docs_of, "node")
        each.append(F.when(F.min(one) == F.max(one), F.max(F.coalesce("n", F.lit(0)) + F.col("docs") - 1)).otherwise(F.lit(-1)).alias("n_links"))
        # none of a document without a set, null of one with several
        out.append(F.when(F.col("n_links") >= 0, F.col("n_links")).when(F.col("n_links").isNull(), F.lit(0).cast("long")).alias("n_links"))
    result = sets.join(member.groupBy("doc_id").agg(*each), "doc_id", "left").select(*out)
    nameless = texts.filter(F.col("doc_id").isNull()).select(F.lit(0).cast("long").alias("doc_id"), "text").mapInArrow(measure, kept)
    null = F.lit(None).cast("long")
    return result.unionByName(nameless.select(null.alias("doc_id"), "n_shingles", null.alias("component_id"), *([null.alias("n_links")] if links else [])))


def keep_one_of_each(docs: DataFrame, n: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """The rows of ``docs`` whose doc_id names its component, all columns kept; rows without a doc_id stay."""
    name = "__tidemark_id"
    gone = similar_sets(docs, n, num, den).filter("component_id <> doc_id").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == F.col(name), "left_anti")
