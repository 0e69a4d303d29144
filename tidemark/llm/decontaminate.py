"""Benchmark decontamination by latent semantic retrieval.

Benchmark items and passages of documents are TF-IDF vectors over a fixed number of hashed words, with document
frequencies counted over all documents. A randomised SVD, its sketches summed by Spark over partitions of texts, finds
the space of low rank that all texts of the corpus and all items span best, both with the same weight in sum. An image there is the sum of its words' images, so
passages of every length come from sums over short blocks of words. Every passage of every text, in lengths and steps that
follow the items' lengths, is scored against the items' images by cosine, many at once. What reaches the least
cosine must have enough of the item's words, and of its rarest ones (bit sets of both, which lose nothing), and is then compared word by word: the longest common
subsequence with the stretch of text, and how much of the item's answer, its last words, that has.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .words import U, Words, mix, slices

#: Hashed words; rank and extra columns of the SVD, and its power rounds.
DIMENSIONS, RANK, EXTRA, POWER = 1 << 16, 64, 16, 1
#: Slots of texts that are sketched at once, and partitions of bags that are summed in one task, at least so many tasks.
FIT_SLOTS, FIT_PARTS, FIT_TASKS = 1 << 20, 8, 8
#: Rows of a matrix that are handled at once, and sums of more rows than those that are taken one by one.
ROWS, LONG = 1 << 12, 32
#: Benchmark items searched in one pass over the documents, and scores held at once.
BLOCK, SCORES = 8192, 1 << 22
#: Bytes of text searched at once, so that their images stay in the processor's cache.
SEARCH_BYTES = 1 << 18
#: Shortest passage, and the words in the blocks that passages are sums of.
SHORTEST = 4
#: Items of fewer words, whose few neighbours in a passage weigh much, and their least cosine.
FEW, COSINE_OF_FEW = 12, 0.3
#: Least cosine; then either so much of the item is found in order, or so much of it and of its answer.
COSINE, WHOLE, PART, ANSWER = 0.6, 0.8, 0.6, 0.6
_PLAIN = r"[^\p{L}\p{N} ]+"


def plain(column: str):
    """Text in lower case with all but letters and digits as spaces, so that case and marks do not hide a copy."""
    return F.lower(F.regexp_replace(F.coalesce(F.col(column).cast("string"), F.lit("")), _PLAIN, " "))


def _row_of_word(w: Words) -> np.ndarray:
    return np.repeat(np.arange(w.n), np.diff(w.bounds))


def _slot(h: np.ndarray) -> np.ndarray:
    return (mix(h) & U(DIMENSIONS - 1)).astype(np.int64)


_BAG = "slots array<int>, counts array<int>"


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text as its slots and how often it has them; texts without words have none."""
    for batch in batches:
        for w in slices(batch.column(0), lower=False, size=SEARCH_BYTES):
            pairs = np.sort((_row_of_word(w) * DIMENSIONS + _slot(w.hash)).astype(np.uint32 if w.n * DIMENSIONS <= 1 << 32 else np.int64))
            lead = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1])[: len(pairs)])
            n, pairs = np.diff(np.append(lead, len(pairs))), pairs[lead].astype(np.int64)
            ends = pa.array(np.searchsorted(pairs, np.arange(w.n + 1) * DIMENSIONS).astype(np.int32))
            lists = (pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int32))) for x in (pairs % DIMENSIONS, n))
            yield pa.record_batch(list(lists), names=["slots", "counts"])


def bags(texts: DataFrame) -> DataFrame:
    """(slots, counts) of each text (text)."""
    return texts.mapInArrow(_bags, _BAG)


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts of the partition each slot occurs; slot -1 counts the texts."""
    count, texts = np.zeros(DIMENSIONS, np.int64), 0
    for batch in batches:
        count += np.bincount(batch.column(0).flatten().to_numpy(), minlength=DIMENSIONS)
        texts += batch.num_rows
    at = np.flatnonzero(count)
    yield pa.record_batch({"slot": pa.array(np.append(at, -1)), "n": pa.array(np.append(count[at], texts))})


def inverse_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """One weight for each of :data:`DIMENSIONS` slots, from all texts' :func:`bags`, and the number of texts; the sums that reach the driver are as many."""
    sums = _in_few_tasks(texts).mapInArrow(_document_counts, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    count = np.zeros(DIMENSIONS + 1)
    count[sums["slot"].to_numpy()] = sums["n"].to_numpy()  # slot -1 is the last
    n = int(count[-1])
    return np.log((n + 1.0) / (count[:-1] + 1.0)) + 1.0, n


def _in_few_tasks(texts: DataFrame) -> DataFrame:
    """Bags are small and a task's sums are not, so several partitions are summed in one task; more texts make more tasks."""
    return texts.coalesce(max(FIT_TASKS, texts.rdd.getNumPartitions() // FIT_PARTS))


def _weighted_sums(bounds: np.ndarray, weights: np.ndarray, of: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """For each i the sum of ``weights[j] * rows[of[j]]`` over j in ``bounds[i]:bounds[i + 1]``; sums of equally many rows are taken together."""
    size, out = np.diff(bounds), np.zeros((len(bounds) - 1, rows.shape[1]), np.float32)
    for i in np.flatnonzero(size > LONG):
        some = slice(bounds[i], bounds[i + 1])
        np.dot(weights[some], rows.take(of[some], 0), out=out[i])
    for n in range(1, LONG + 1):
        at = np.flatnonzero(size == n)
        for lo in range(0, len(at), ROWS // n):
            some = at[lo : lo + ROWS // n]
            j = bounds[some][:, None] + np.arange(n)
            out[some] = (weights[j][:, None, :] @ rows[of[j]])[:, 0]
    return out


def _sketch(idf, basis):
    """Per partition of (slots, counts, weight), rows of A^T (A basis); A has each text's TF-IDF vector of length one, times its weight.

    The texts' images are sums over their slots; then the same entries, in order of their slots, sum up the images.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, q = idf.value, basis.value
        total, seen = np.zeros(q.shape), np.zeros(DIMENSIONS, bool)
        for batch in batches:
            ends = np.append(0, np.cumsum(batch.column(0).value_lengths().to_numpy()))
            slots, counts, weight = batch.column(0).flatten().to_numpy(), batch.column(1).flatten().to_numpy(), batch.column(2).to_numpy()
            lo = 0
            while lo < len(weight):
                hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + FIT_SLOTS, "right")) - 1)
                some = slice(ends[lo], ends[hi])
                at, bounds = slots[some], ends[lo : hi + 1] - ends[lo]
                row = np.repeat(np.arange(hi - lo), np.diff(bounds))
                v = counts[some] * weights[at]
                v = (v * (weight[lo:hi] / np.maximum(np.sqrt(np.bincount(row, v * v, hi - lo)), 1e-9))[row]).astype(np.float32)
                images = _weighted_sums(bounds, v, at, q)
                order = np.argsort(at.astype(np.uint16), kind="stable")
                at = at[order]
                lead = np.flatnonzero(np.append(True, at[1:] != at[:-1])[: len(at)])
                seen[at[lead]] = True
                total[at[lead]] += _weighted_sums(np.append(lead, len(at)), v[order], row[order], images)
                lo = hi
        i = np.flatnonzero(seen)
        for at in range(0, len(i), ROWS):
            yield _rows(i[at : at + ROWS], total[i[at : at + ROWS]])

    return run


_SUMS = "part long, i long, v array<float>"


def _rows(i: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    ends = np.arange(0, v.size + 1, v.shape[1], dtype=np.int32)
    return pa.record_batch({"part": pa.array(i % 64), "i": pa.array(i), "v": pa.ListArray.from_arrays(pa.array(ends), pa.array(v.astype(np.float32).ravel()))})


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    v = table["v"].combine_chunks()
    return table["i"].to_numpy(), v.flatten().to_numpy().reshape(len(v), -1)


def _total(table: pa.Table) -> pa.Table:
    i, v = _matrix(table)
    order = np.argsort(i, kind="stable")
    lead = np.flatnonzero(np.append(True, np.diff(i[order]) != 0))
    return pa.Table.from_batches([_rows(i[order][lead], np.add.reduceat(v[order].astype(np.float64), lead, axis=0))])


def _summed(rows: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(which of the rows occur, all rows): vectors added up by row number. Their number is bounded by :data:`DIMENSIONS`; they are held once, in single precision."""
    seen, total = np.zeros(DIMENSIONS, bool), np.zeros((DIMENSIONS, width), np.float32)
    table = rows.groupBy("part").applyInArrow(_total, _SUMS).toArrow()
    for batch in table.to_batches():
        i = batch["i"].to_numpy()
        seen[i], total[i] = True, batch["v"].flatten().to_numpy().reshape(len(i), width)
    return seen, total


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a^T b in double precision, over some rows at once."""
    return sum(a[i : i + ROWS].astype(np.float64).T @ b[i : i + ROWS].astype(np.float64) for i in range(0, len(a), ROWS))


def _turned(a: np.ndarray, by: np.ndarray) -> np.ndarray:
    """a times a small matrix, over some rows at once, in single precision."""
    out = np.empty((len(a), by.shape[1]), np.float32)
    for i in range(0, len(a), ROWS):
        out[i : i + ROWS] = a[i : i + ROWS].astype(np.float64) @ by
    return out


def _roots(square: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix above a share of the largest, falling, and their vectors."""
    values, vectors = np.linalg.eigh((square + square.T) / 2)
    kept = np.flatnonzero(values > least * values[-1])[::-1]
    return values[kept], vectors[:, kept]


def latent_space(texts: DataFrame, idf: np.ndarray, rank: int = RANK) -> tuple[np.ndarray, np.ndarray]:
    """(slots, V): an orthonormal basis, by rows of the slots that occur, of the best space of the texts' (slots, counts, weight) TF-IDF vectors.

    Randomised SVD: a random test matrix, power rounds, and from the last of them the singular vectors of the Nyström form Z (Q^T Z)^-1 Z^T of A^T A,
    where Z is A^T A Q. The driver holds Q and Z in single precision and decomposes only products of their columns.
    """
    sc = texts.sparkSession.sparkContext
    weights = sc.broadcast(idf.astype(np.float64))
    q = np.random.default_rng(7).standard_normal((DIMENSIONS, rank + EXTRA)).astype(np.float32)
    for left in range(POWER, -1, -1):
        shared = sc.broadcast(q)
        seen, z = _summed(texts.mapInArrow(_sketch(weights, shared), _SUMS), q.shape[1])
        shared.destroy()
        if not z.any():
            return np.zeros(0, np.int64), np.zeros((0, 1))
        if left:
            values, vectors = _roots(_product(z, z), 1e-12)
            q = _turned(z, vectors / np.sqrt(values))
    weights.destroy()
    values, vectors = _roots(_product(q, z), 1e-6)
    half = vectors / np.sqrt(values)
    values, vectors = _roots(half.T @ _product(z, z) @ half, 1e-6)
    at = np.flatnonzero(seen)
    return at, _turned(z[at], half @ (vectors / np.sqrt(values))[:, :rank])


def common_subsequence(item: list[int], text: list[int]) -> list[bool]:
    """Which words of ``item`` a longest common subsequence with ``text`` has; of several, the one ending latest in the item.

    By bits: after each word of the text, the zeros among the low i bits are the length for the first i words of the item.
    """
    n, full = len(item), (1 << len(item)) - 1
    at: dict[int, int] = {}
    for i, x in enumerate(item):
        at[x] = at.get(x, 0) | 1 << i
    text = [x for x in text if x in at]
    best = [full]
    for x in text:
        v = best[-1]
        u = v & at[x]
        best.append((v + u | v - u) & full)
    found, i, j = [False] * n, n, len(text)
    while i and j:
        low = (1 << i) - 1
        if item[i - 1] == text[j - 1]:
            found[i - 1] = True
            i, j = i - 1, j - 1
        elif (best[j - 1] & low).bit_count() == (best[j] & low).bit_count():
            j -= 1
        else:
            i -= 1
    return found


def answer_words(n: int) -> int:
    """The answer is the item's last fifth."""
    return max(1, -(-n // 5))


def leaks(found: list[bool]) -> tuple[bool, float, float]:
    n, a = len(found), answer_words(len(found))
    whole, answer = sum(found) / n, sum(found[-a:]) / a
    return whole >= WHOLE or (whole >= PART and answer >= ANSWER), whole, answer


def least_words(n: int) -> int:
    """The fewest words of an item of n that a leak has."""
    return next(k for k in range(n + 1) if k / n >= PART)


def passage_words(n: int) -> tuple[int, int]:
    """Words of the passages that are scored for an item of n words, and how many steps they have."""
    size = SHORTEST
    while size < n:
        if size * 3 // 2 >= n:
            return size * 3 // 2, 3
        size *= 2
    return size, 2


def _bit_sets(n: int, of: np.ndarray, h: np.ndarray) -> np.ndarray:
    """``n`` sets of words, each word one of 256 bits in four columns; ``of`` is each word's set."""
    flags = np.zeros(n * 256, np.uint8)
    flags[of * 256 + (mix(h) >> U(56)).astype(np.int64)] = 1
    return np.packbits(flags, bitorder="little").view("<u8").reshape(-1, 4)


def _add_next(total: np.ndarray, rows: np.ndarray, d: int, other: np.ndarray, add: np.ufunc) -> None:
    """Each row's d-th next one is added to it, but to those named in ``other``."""
    if len(rows) > d:
        kept = total[other]
        add(total[:-d], rows[d:], out=total[:-d])
        total[other] = kept


class Items:
    """A block of benchmark items: their images, words and bit sets, by the length of the passages scored for them.

    A leak has ``least`` of an item's n words (:func:`least_words`); as n - least words are not among the ``least`` rarest, it has
    2 least - n of those. So both bit sets leave out only what is no leak.
    """

    def __init__(self, ids: list[int], words: list[np.ndarray], vectors: np.ndarray, idf: np.ndarray):
        self.ids, self.words = ids, words
        least = np.array([least_words(len(x)) for x in words])
        size = np.array([len(x) for x in words])
        rare = [x[np.argsort(-idf[_slot(x)], kind="stable")[:k]] for x, k in zip(words, least, strict=True)]
        images = np.array([vectors[_slot(x)].sum(0) for x in words])
        self.images = (images / np.maximum(np.linalg.norm(images, axis=1, keepdims=True), 1e-9)).astype(np.float32)
        self.all_bits, self.rare_bits = (_bit_sets(len(x), np.repeat(np.arange(len(x)), [len(y) for y in x]), np.concatenate(x)) for x in (words, rare))
        self.may_miss = size - least
        self.cosine = np.where(size < FEW, COSINE_OF_FEW, COSINE).astype(np.float32)
        self.must_have = 2 * least - size - (least - np.bitwise_count(self.rare_bits).sum(1))
        self.rare_slots = np.zeros(DIMENSIONS, bool)
        for x in rare:
            self.rare_slots[_slot(x)] = True
        self.classes: dict[tuple[int, int], np.ndarray] = {}
        shape = [passage_words(len(x)) for x in words]
        for c in sorted(set(shape)):
            self.classes[c] = np.array([i for i, x in enumerate(shape) if x == c])
        self.base = min(n // steps for n, steps in self.classes)

    def candidates(self, w: Words, vectors: np.ndarray) -> Iterator[tuple[int, int, float, int, int]]:
        """(text, item, cosine, first word, end) of stretches of text, one step wider than the passage on both sides."""
        n, base = np.diff(w.bounds), self.base
        count = -(-n // base)
        if not count.sum():
            return
        owner, first = np.repeat(np.arange(w.n), count), np.cumsum(count) - count
        # each text filled up to whole blocks with a word that has no image
        at = np.arange(len(w.hash)) + np.repeat(first * base - w.bounds[:-1], n)
        slot = np.full(len(owner) * base, DIMENSIONS, np.int64)
        slot[at] = own_slot = _slot(w.hash)
        image = np.take(vectors, slot, axis=0, mode="clip").reshape(len(owner), base, -1).sum(1)
        rare = np.flatnonzero(self.rare_slots[own_slot])
        bits = np.hstack([_bit_sets(len(owner), at // base, w.hash), _bit_sets(len(owner), at[rare] // base, w.hash[rare])])
        for (words, steps), of in self.classes.items():
            per = words // steps // base
            n2 = -(-count // per)
            own, f2 = np.repeat(np.arange(w.n), n2), np.cumsum(n2) - n2
            place = np.arange(len(own)) - np.repeat(f2, n2)  # of the step in its text
            lead = first[own] + per * place
            step_image, step_bits, room = image[lead], bits[lead], count[own] - per * place
            for d in range(1, per):
                some = np.flatnonzero(room > d)
                step_image[some] += image[lead[some] + d]
                step_bits[some] |= bits[lead[some] + d]
            passage, wide = step_image.copy(), step_bits.copy()
            for d in range(1, steps + 1):
                other = np.flatnonzero(own[d:] != own[:-d])  # the next steps of these are another text's
                if d < steps:
                    _add_next(passage, step_image, d, other, np.add)
                _add_next(wide, step_bits, d, other, np.bitwise_or)
            before = wide[1:] | step_bits[:-1]
            starts = np.flatnonzero(own[1:] != own[:-1]) + 1
            kept = wide[starts]
            wide[1:] = before
            wide[starts] = kept
            norm = np.maximum(np.sqrt(np.einsum("ij,ij->i", passage, passage)), 1e-9)
            size, rows, images = words // steps, max(1, SCORES // len(of)), self.images[of].T
            # a cosine is a product over both lengths; images of items have length one, or that of their least cosine's inverse
            scaled = images / self.cosine[of]
            for lo in range(0, len(own), rows):
                b, c = np.nonzero(passage[lo : lo + rows] @ scaled >= norm[lo : lo + rows, None])
                i, b = of[c], b + lo
                keep = np.bitwise_count(self.rare_bits[i] & wide[b, 4:]).sum(1) >= self.must_have[i]
                i, b = i[keep], b[keep]
                keep = np.bitwise_count(self.all_bits[i] & ~wide[b, :4]).sum(1) <= self.may_miss[i]
                i, b = i[keep], b[keep]
                score = np.einsum("ij,ij->i", passage[b], self.images[i]) / norm[b]
                for x, j, k in zip(score.tolist(), i.tolist(), b.tolist(), strict=True):
                    r, begin = int(own[k]), int(place[k]) * size
                    yield r, j, x, int(w.bounds[r]) + max(0, begin - size), int(min(w.bounds[r] + begin + words + size, w.bounds[r + 1]))


_FOUND = "doc_id long, row long, item_id long, leaks boolean, cosine double, whole double, answer double"


def _search(items, vectors):
    """A mapInArrow function over (doc_id, row, text): the items that a text may hold, compared word by word."""
    schema = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("item_id", pa.int64()), ("leaks", pa.bool_()), ("cosine", pa.float64()), ("whole", pa.float64()), ("answer", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, image = items.value, vectors.value
        counts = [Counter(x.tolist()) for x in known.words]
        for batch in batches:
            ids, rows = batch.column(0), batch.column(1)
            best: dict = {}
            for w in slices(batch.column(2), lower=False, size=SEARCH_BYTES):
                for r, i, cosine, lo, hi in known.candidates(w, image):
                    key = (w.first + r, i)
                    if key in best and best[key][0]:
                        continue
                    item, text = known.words[i], w.hash[lo:hi].tolist()
                    if sum(counts[i][x] for x in counts[i].keys() & set(text)) < PART * len(item):
                        continue  # a common subsequence cannot be longer than that
                    now = (*leaks(common_subsequence(item.tolist(), text)), cosine)
                    best[key] = max(best.get(key, now), now)
            cols = list(zip(*((ids[r].as_py(), rows[r].as_py(), known.ids[i], v[0], v[3], v[1], v[2]) for (r, i), v in best.items()), strict=True)) or [[]] * 7
            yield pa.record_batch([pa.array(list(c), t.type) for c, t in zip(cols, schema, strict=True)], schema=schema)

    return run


def word_vectors(texts: DataFrame, n_texts: int, items: DataFrame, n_items: int, idf: np.ndarray) -> np.ndarray:
    """Each slot's weighted image in the latent space of all texts and all items (both as bags), and a last row of zeros."""
    weighed = [x.withColumn("weight", F.lit(max(1, n) ** -0.5)) for x, n in ((_in_few_tasks(texts), n_texts), (items, n_items))]
    at, v = latent_space(weighed[0].unionByName(weighed[1]), idf)
    out = np.zeros((DIMENSIONS + 1, v.shape[1]), np.float32)
    out[at] = v * idf[at][:, None]
    return out


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Candidates (doc_id, row, item_id, leaks, cosine, whole, answer); ``row`` is a hash of doc_id and text.

    Items come in blocks of :data:`BLOCK`, by one pass over the documents each, so neither the driver nor a task holds more of
    the benchmark. Items or texts without words match nothing.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    sc = spark.sparkContext
    texts = scratch.table(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", F.col("text").cast("string")).alias("row"), plain("text").alias("text")), "plain")
    items = scratch.table(benchmark.select(F.col("item_id").cast("long").alias("item_id"), plain("text").alias("text")).filter("item_id is not null and trim(text) <> ''").distinct(), "items")
    n_items = items.count()
    if not n_items:
        return spark.createDataFrame([], _FOUND)
    blocks = -(-n_items // (BLOCK * 4 // 5)) if n_items > BLOCK else 1
    numbered = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    known = scratch.table(bags(texts.select("text")), "bags")
    idf, n_texts = inverse_frequencies(known)
    vectors = word_vectors(known, n_texts, bags(items.select("text")).coalesce(FIT_TASKS), n_items, idf)
    shared, found = sc.broadcast(vectors), None
    for block in range(blocks):
        local = numbered.filter(F.col("block") == block).select("item_id", "text").orderBy("item_id", "text").collect()
        if not local:
            continue
        block_items = Items([r["item_id"] for r in local], [next(slices(pa.array([r["text"]]), lower=False)).hash for r in local], vectors, idf)
        hits = scratch.table(texts.mapInArrow(_search(sc.broadcast(block_items), shared), _FOUND), "hits")
        found = hits if found is None else found.unionByName(hits)
    return found


def flag(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, contaminated, n_items, item_ids (sorted), best_whole, best_answer.

    A text is contaminated by an item (item_id, text of ``benchmark``) if it has four fifths of the item's words in order, or three fifths of them and of its
    answer, within a passage of like meaning, about as long as the item, and a step to both sides. Case and marks do not count.

    Null or empty text, or an empty benchmark: not contaminated, 0 items, nulls for the best shares. A null doc_id stays null.
    Repeated rows come back as often as they came. Other columns are not read.
    """
    hits = find_leaks(docs, benchmark).filter("leaks").groupBy("row").agg(
        F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.max("whole").alias("best_whole"), F.max("answer").alias("best_answer")
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", F.col("text").cast("string")).alias("row"))
    wide = rows.join(hits, "row", "left")
    none = F.array().cast("array<bigint>")
    return wide.select("doc_id", F.col("item_ids").isNotNull().alias("contaminated"), F.when(F.col("item_ids").isNull(), 0).otherwise(F.size("item_ids")).cast("long").alias("n_items"), F.coalesce("item_ids", none).alias("item_ids"), "best_whole", "best_answer")


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that :func:`flag` does not call contaminated, with all their columns."""
    name = "__tidemark_row"
    bad = find_leaks(docs, benchmark).filter("leaks").select(F.col("row").alias(name)).distinct()
    return docs.join(bad, F.xxhash64(docs["doc_id"], docs["text"].cast("string")) == F.col(name), "left_anti")
