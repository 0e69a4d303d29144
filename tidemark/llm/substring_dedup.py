"""Substring deduplication by recompression.

Texts are sequences of word symbols. A round first names maximal runs of one symbol, then names pairs of a
symbol of the left class and one of the right class; names and classes are hashes of what is named, so every
task gives equal content equal names, without a dictionary. A boundary between two symbols that outlives a
round depends on a small stretch of words around it alone, which is tracked: inside two equal stretches of
text, the boundaries whose stretch lies within are the same. The boundaries of the highest rounds are few, so
they serve as the meeting points of repeats: each window of ``width`` words is represented by its highest
boundaries, under the name of the words around them. A window without any is represented by itself. Only names
that occur twice are followed up, on the windows' own 128-bit names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, row_key, rows_with
from .words import Powers, U, Words, mix, slices, windows

_NEAR, _WIDE_A, _WIDE_B = Powers(0x2545F4914F6CDD1D), Powers(0x9FB21C651E98DF25), Powers(0xE7037ED1A0B428DB)
_RUN, _LEFT, _RIGHT, _ALONE = (U(x) for x in (0xA24BAED4963EE407, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F))
_LEVELS = mix(np.arange(64, dtype=U))
_FAR = 1 << 40
#: Further rounds leave fewer boundaries, but too few windows see all that those depend on.
ROUNDS = 3


def rounds(h: np.ndarray, doc_first: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """After each round: word positions of the boundaries left, and the first and last word that each depends on.

    ``doc_first`` marks the words that begin a text; their boundaries outlive all, whatever the content.
    """
    n = len(h)
    at, name = np.arange(n + 1), h.copy()  # symbol j covers words at[j]..at[j+1]-1
    first = np.append(doc_first, True)
    lo, hi = np.arange(n + 1), np.arange(n + 1) - 1  # between words a boundary is plain; only its survival is not

    def depend(j: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of boundary j on the symbol right of it, and where ``left`` holds on the one left of it."""
        new_lo, new_hi = np.minimum(lo[j], np.minimum(lo[j + 1], at[j])), np.maximum(hi[j], np.maximum(hi[j + 1], at[j + 1] - 1))
        k = np.maximum(j - 1, 0)
        return np.where(left, np.minimum(new_lo, np.minimum(lo[k], at[k])), new_lo), np.where(left, np.maximum(new_hi, hi[k]), new_hi)

    level = 0
    while len(name) > 1 and level < ROUNDS:
        level += 1
        for step in ("runs", "pairs"):
            m = len(name)
            if step == "runs":
                join = np.append(False, (name[1:] == name[:-1])) & ~first[:-1]
                new_lo, new_hi = depend(np.arange(m), np.ones(m, bool))
            else:
                right = (mix(name ^ _LEVELS[level & 63]) >> U(17)) & U(1) == 1
                join = np.append(False, right[1:] & ~right[:-1]) & ~first[:-1]
                new_lo, new_hi = depend(np.arange(m), right)
            keep = np.flatnonzero(~join)
            count = np.diff(np.append(keep, m))
            if step == "runs":
                fresh = np.where(count > 1, mix(name[keep] * _RUN + count.astype(U)), name[keep])
            else:
                second = name[np.minimum(keep + 1, m - 1)]
                fresh = np.where(count > 1, mix(name[keep] * _LEFT + second * _RIGHT), name[keep])
            edge_first = first[keep]
            lo = np.append(np.where(edge_first, -_FAR, new_lo[keep]), -_FAR)
            hi = np.append(np.where(edge_first, _FAR, new_hi[keep]), _FAR)
            at, name, first = np.append(at[keep], n), fresh, np.append(edge_first, True)
        inner = np.flatnonzero(hi[:-1] - lo[:-1] < width)
        if not len(inner):
            return
        yield at[inner], lo[inner], hi[inner]


class Marks:
    """Of some texts: the names that stand for their windows, and the windows that each stands for."""

    def __init__(self, w: Words, width: int):
        n, half = len(w.hash), max(1, width // 4)
        last = n - width  # the last window start, texts' ends aside
        first = np.zeros(n, bool)
        filled = w.bounds[:-1][np.diff(w.bounds) > 0]
        first[filled] = True
        good = np.zeros(max(0, last + 1), bool)  # windows within one text
        for lo, hi in zip(w.bounds[:-1], w.bounds[1:], strict=True):
            good[lo : max(lo, hi - width + 1)] = True
        self.good, self.width = good, width
        left, right, names, word, open_ = [], [], [], [], good.copy()
        if good.any():
            near = windows(w.hash, 2 * half, _NEAR)
            for at, lo, hi in reversed(list(rounds(w.hash, first, width))):
                lo, hi = np.minimum(lo, at - half), np.maximum(hi, at + half - 1)
                a, b = np.maximum(hi - width + 1, 0), np.minimum(lo, last)  # window starts that see it whole
                fits = np.flatnonzero((a <= b) & (lo >= 0) & (hi < n))
                fits = fits[np.argsort(near[at[fits] - half], kind="stable")]  # of equal names the first, as in every equal window
                a, b, at = a[fits], b[fits], at[fits]
                best, none = np.full(len(open_), len(at)), len(at)  # each window's boundary of this round with the least name
                for d in range(int((b - a).max(initial=-1)) + 1):
                    i = np.flatnonzero(a + d <= b)[::-1]
                    now = np.full(len(open_), none)
                    now[a[i] + d] = i
                    np.minimum(best, now, out=best)
                chosen = np.unique(best[open_ & (best < none)])
                open_ &= best == none
                left.append(a[chosen])
                right.append(b[chosen])
                names.append(near[at[chosen] - half])
                word.append(at[chosen])
            alone = np.flatnonzero(open_)
            left.append(alone)
            right.append(alone)
            word.append(alone)
            names.append(windows(w.hash, width, _WIDE_A)[alone] ^ _ALONE)
        join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
        self.left, self.right, self.names = join(left, np.int64), join(right, np.int64), join(names, U)
        self.row = np.searchsorted(w.bounds, join(word, np.int64), "right") - 1

    def windows_of(self, chosen: np.ndarray) -> np.ndarray:
        """Starts of the windows for which a chosen name stands."""
        cover = np.zeros(len(self.good) + 1, np.int64)
        np.add.at(cover, self.left[chosen], 1)
        np.add.at(cover, self.right[chosen] + 1, -1)
        return np.flatnonzero((np.cumsum(cover[:-1]) > 0) & self.good)


def _batches(cols: list[list[np.ndarray]], schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(np.concatenate(c).view(np.int64)) for c in cols], schema=schema)


def _names(width: int):
    schema = pa.schema([*((k, pa.int64()) for k in ("id", "text_hash", "name")), ("again", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = (batch.column(i).to_numpy() for i in (0, 1))
            for w in slices(batch.column(2), lower=False):
                m = Marks(w, width)
                order = np.lexsort((m.names, m.row))
                row, name = m.row[order], m.names[order]
                new = np.append(True, (row[1:] != row[:-1]) | (name[1:] != name[:-1])) if len(row) else np.zeros(0, bool)
                at = np.flatnonzero(new)
                again = np.diff(np.append(at, len(row))) > 1  # the text itself has the name twice
                r = w.first + row[at]
                yield pa.record_batch([pa.array(ids[r]), pa.array(hashes[r]), pa.array(name[at].view(np.int64)), pa.array(again)], schema=schema)

    return run


def _windows(width: int):
    schema = pa.schema([(k, pa.int64()) for k in ("id", "text_hash", "start", "wide_a", "wide_b")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = (batch.column(i).to_numpy() for i in (0, 1))
            names = batch.column(3)
            flat, ends = names.flatten().to_numpy().view(U), np.concatenate(([0], np.cumsum(names.value_lengths().to_numpy())))
            for w in slices(batch.column(2), lower=False):
                m = Marks(w, width)
                if not len(m.names):
                    continue
                wanted = flat[ends[w.first] : ends[w.first + w.n]]
                start = m.windows_of(np.isin(m.names, wanted))
                row = np.searchsorted(w.bounds, start, "right") - 1
                wide = [windows(w.hash, width, p)[start] for p in (_WIDE_A, _WIDE_B)]
                yield _batches([[ids[w.first + row]], [hashes[w.first + row]], [start - w.bounds[row]], *([x] for x in wide)], schema)

    return run


def _kept(width: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, copy = batch.column(2), batch.column(3).to_numpy(zero_copy_only=False)
            for w in slices(batch.column(1), lower=False):
                counts, removed, texts = [], [], []
                for r in range(w.n):
                    lo, hi = w.bounds[r], w.bounds[r + 1]
                    words = np.ones(hi - lo, bool)
                    if copy[w.first + r] and hi - lo >= width:
                        words[:] = False
                    elif starts[w.first + r].is_valid:
                        cover = np.zeros(hi - lo + 1, np.int64)
                        s = np.unique(starts[w.first + r].values.to_numpy())
                        cover[s] += 1
                        np.subtract.at(cover, s + width, 1)
                        words = np.cumsum(cover[:-1]) == 0
                    left = np.flatnonzero(words) + lo
                    counts.append(hi - lo)
                    removed.append(hi - lo - len(left))
                    texts.append(b" ".join([w.data[a:b].tobytes() for a, b in zip(w.start[left].tolist(), w.end[left].tolist(), strict=True)]).decode())
                yield pa.record_batch([batch.column(0).slice(w.first, w.n), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string())], schema=schema)

    return run


def remove_repeats(docs: DataFrame, width: int = 50) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, n_removed, kept_text (kept words, joined by one space).

    Words are runs of other than ASCII white space, unchanged. A word goes if a window of ``width`` consecutive words
    of its text covers it whose word sequence also starts anywhere else in the table, its own text included; windows are
    judged on the input. The first occurrence goes too.

    Null or blank text: 0 words, empty kept_text. Texts below ``width`` words stay whole. A null doc_id stays
    null. Repeated rows are repeats of each other, and both lose what repeats. Other columns are not read. An empty
    table gives no rows.
    """
    scratch = Scratch(docs.sparkSession)
    texts = docs.select(*row_key(), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
    # equal texts repeat each other whole; one of them stands for all against the others
    keys = scratch.table(texts.select("id", "text_hash", F.xxhash64(F.lit("second"), "text").alias("other_hash")), "keys")
    classes = keys.groupBy("text_hash", "other_hash").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    classes = scratch.table(classes, "classes")
    names = scratch.table(texts.select("id", "text_hash", "text").mapInArrow(_names(width), "id long, text_hash long, name long, again boolean"), "names")
    twice = names.groupBy("name").agg(F.min("text_hash").alias("lo"), F.max("text_hash").alias("hi"), F.max("again").alias("again"), F.count("*").alias("n"))
    twice = scratch.table(twice.filter("lo < hi or again").select("name", "n"), "twice")
    by_text = rows_with(names, twice, ["name"]).join(classes.select("id", "text_hash"), ["id", "text_hash"], "left_semi")
    by_text = scratch.table(by_text.groupBy("id", "text_hash").agg(F.collect_set("name").alias("names")), "by-text")
    scratch.drop(names)
    scratch.drop(twice)
    wide = texts.select("id", "text_hash", "text").join(by_text, ["id", "text_hash"]).select("id", "text_hash", "text", "names")
    starts = scratch.table(wide.mapInArrow(_windows(width), "id long, text_hash long, start long, wide_a long, wide_b long"), "windows")
    again = scratch.table(starts.groupBy("wide_a", "wide_b").agg(F.count("*").alias("n")).filter("n > 1"), "again")
    marks = rows_with(starts, again, ["wide_a", "wide_b"]).groupBy("id", "text_hash").agg(F.collect_list(F.col("start")).alias("starts"))
    copied = classes.filter("copies > 1").select("text_hash", "other_hash", F.col("copies").alias("n"))
    copies = rows_with(keys, copied, ["text_hash", "other_hash"]).select("id", "text_hash").distinct()
    marks = scratch.table(marks.join(copies.withColumn("copy", F.lit(True)), ["id", "text_hash"], "full").select("id", "text_hash", "starts", F.coalesce("copy", F.lit(False)).alias("copy")), "marks")
    scratch.drop(starts)
    scratch.drop(again)
    return texts.join(marks, ["id", "text_hash"], "left").select("doc_id", "text", "starts", F.coalesce("copy", F.lit(False)).alias("copy")).mapInArrow(
        _kept(width), "doc_id long, n_words long, n_removed long, kept_text string"
    )
