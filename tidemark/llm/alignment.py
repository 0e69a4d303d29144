"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

Two as-of joins over token starts, keyed by document, give all overlaps: each token of one side finds the token of the
other that covers its start. Equal ends cut both sides into groups that cover the same bytes.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, doc_text

#: Fixed value: how byte-level tokenizers split text before their merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Runs of white space that long overflow the stack of the faster encoder.
LONG_SPACE = re.compile(r"\s{1000}")
#: Code points that a task aligns at once; a text is never cut.
AT_ONCE = 1 << 20
#: Id pairs whose counts may be broadcast: at 48 bytes each 48 MB, whatever the corpus. More of them are joined by a shuffle.
BROADCAST_PAIRS = 1_000_000

_ALIGNED = "doc_id long, row long, n_a long, n_b long, n_groups long, n_links long, groups string, links array<struct<a:int,b:int,n:int>>"
_LINKS = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int32())]))


class ByteLevel:
    """A byte-level BPE file of the tokenizers library. Where its merges stand in the order of their ids, ranks give the same ids faster."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        added = {t["id"] for t in spec["added_tokens"]}
        vocab = spec["model"]["vocab"]
        pieces = {bytes(letters[c] for c in word): i for word, i in vocab.items() if i not in added}
        self.bytes = [b""] * (max(vocab.values()) + 1)
        for piece, i in pieces.items():
            self.bytes[i] = piece
        self.exact = Tokenizer.from_file(path)
        self.exact.encode_special_tokens = True
        merges = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        pre = spec.get("pre_tokenizer") or {}
        ranked = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and spec.get("normalizer") is None
        ranked = ranked and all(vocab.get(a + b) == 256 + k for k, (a, b) in enumerate(merges)) and sorted(pieces.values()) == list(range(len(pieces)))
        self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=pieces, special_tokens={}) if ranked else None

    def encode(self, texts: list[str]) -> list[list[int]]:
        slow = lambda t: self.exact.encode(t, add_special_tokens=False).ids
        return [slow(t) if self.fast is None or LONG_SPACE.search(t) else self.fast.encode_ordinary(t) for t in (f" {t}" for t in texts)]


class Pieces:
    """A SentencePiece model; it puts the space before a text itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = m = SentencePieceProcessor(model_file=path)
        piece = lambda i: bytes([int(m.id_to_piece(i)[3:5], 16)]) if m.is_byte(i) else m.id_to_piece(i).replace("▁", " ").encode()
        self.bytes = [piece(i) for i in range(m.get_piece_size())]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def _byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=4)
def tokenizer(path: str):
    return Pieces(path) if path.endswith(".model") else ByteLevel(path)


class Side:
    """The tokens of some texts in a row: ids, and where in the joined bytes of all texts each begins and ends."""

    def __init__(self, ids: list[list[int]], widths: np.ndarray):
        self.counts = np.array([len(x) for x in ids], np.int64)
        self.ids = np.fromiter((i for x in ids for i in x), np.int64, int(self.counts.sum()))
        self.end = np.cumsum(widths[self.ids])
        self.start = self.end - widths[self.ids]
        self.doc = np.repeat(np.arange(len(ids)), self.counts)

    def frame(self, name: str) -> pd.DataFrame:
        return pd.DataFrame({"at": self.start, "doc": self.doc, name: np.arange(len(self.ids))})


def overlaps(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """Positions of every pair of tokens whose bytes overlap, each once."""
    left, right = a.frame("i"), b.frame("j")
    covering_b = pd.merge_asof(left, right, on="at", by="doc")["j"].to_numpy()
    covering_a = pd.merge_asof(right, left, on="at", by="doc")["i"].to_numpy()
    later = a.start[covering_a] != b.start  # equal starts came from the other direction
    return np.concatenate([left["i"].to_numpy(), covering_a[later]]), np.concatenate([covering_b, np.flatnonzero(later)])


def _written(a: Side, b: Side, n_docs: int, names: np.ndarray, size_a: int, size_b: int) -> tuple[np.ndarray, list[str]]:
    """How many groups each document has, and what they are: ids of a, a bar, ids of b; groups apart by semicolons."""
    ends = np.zeros(int(a.end[-1]) + 1, np.uint8)
    ends[a.end] = 1
    ends[b.end] += 1
    cut_a, cut_b = ends[a.end] == 2, ends[b.end] == 2
    through_a, through_b = np.flatnonzero(cut_a) + 1, np.concatenate([[0], np.flatnonzero(cut_b) + 1])
    at_a = np.arange(len(a.ids)) + through_b[np.cumsum(cut_a) - cut_a]
    at_b = np.arange(len(b.ids)) + through_a[np.cumsum(cut_b) - cut_b]
    out = np.empty(len(a.ids) + len(b.ids), object)
    out[at_a] = names[a.ids + size_a * cut_a]
    out[at_b] = names[2 * size_a + b.ids + size_b * cut_b]
    bounds = np.concatenate([[0], np.cumsum(a.counts + b.counts)]).tolist()
    texts = out.tolist()
    return np.bincount(a.doc[cut_a], minlength=n_docs), ["".join(texts[i:j])[:-1] for i, j in zip(bounds, bounds[1:], strict=False)]


def aligner(path_a: str, path_b: str):
    """A mapInArrow function over (doc_id, row, text)."""

    def align_batches(batches):
        a, b = tokenizer(path_a), tokenizer(path_b)
        width_a, width_b = (np.array([len(x) for x in t.bytes], np.int64) for t in (a, b))
        n_a, n_b = len(width_a), len(width_b)
        names = np.array([f"{i}," for i in range(n_a)] + [f"{i}|" for i in range(n_a)] + [f"{i}," for i in range(n_b)] + [f"{i};" for i in range(n_b)], object)

        def rows(doc_ids: pa.Array, row_ids: pa.Array, texts: list) -> pa.RecordBatch:
            some = [i for i, t in enumerate(texts) if t]
            ids_a, ids_b = a.encode([texts[i] for i in some]), b.encode([texts[i] for i in some])
            same = []
            for k, i in enumerate(some):
                whole = f" {texts[i]}".encode()
                same.append(b"".join(map(a.bytes.__getitem__, ids_a[k])) == whole and b"".join(map(b.bytes.__getitem__, ids_b[k])) == whole)
            some, ids_a, ids_b = ([x for x, ok in zip(y, same, strict=True) if ok] for y in (some, ids_a, ids_b))
            counts, groups, links = np.zeros((4, len(texts)), np.int64), [""] * len(texts), np.zeros(len(texts) + 1, np.int64)
            pair_a = pair_b = times = np.zeros(0, np.int32)
            if some:
                left, right, at = Side(ids_a, width_a), Side(ids_b, width_b), np.array(some)
                i, j = overlaps(left, right)
                n_groups, written = _written(left, right, len(some), names, n_a, n_b)
                counts[:, at] = left.counts, right.counts, n_groups, np.bincount(left.doc[i], minlength=len(some))
                for k, text in zip(some, written, strict=True):
                    groups[k] = text
                keys, times = np.unique((left.doc[i] * n_a + left.ids[i]) * n_b + right.ids[j], return_counts=True)
                links[at + 1] = np.bincount(keys // (n_a * n_b), minlength=len(some))
                pair_a, pair_b = (keys // n_b % n_a).astype(np.int32), (keys % n_b).astype(np.int32)
            pairs = pa.StructArray.from_arrays([pa.array(pair_a), pa.array(pair_b), pa.array(times.astype(np.int32))], fields=list(_LINKS.value_type))
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum(links), pa.int32()), pairs).cast(_LINKS)
            return pa.record_batch([doc_ids, row_ids, *(pa.array(c) for c in counts), pa.array(groups, pa.string()), lists], names=[x.split()[0] for x in _ALIGNED.split(", ")])

        for batch in batches:
            lengths = batch.column(2).to_pylist()
            begin = size = 0
            for i, t in enumerate(lengths):
                size += len(t or "")
                if size >= AT_ONCE or i + 1 == len(lengths):
                    yield rows(batch.column(0)[begin : i + 1], batch.column(1)[begin : i + 1], lengths[begin : i + 1])
                    begin, size = i + 1, 0

    return align_batches


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per document (a row of ``docs``): doc_id, a row number, n_a and n_b tokens, n_groups, n_links (pairs of tokens that overlap), ``groups`` as
    text (``a1,a2|b1;a3|b2,b3``), and ``links``: its distinct id pairs with how often they overlap.

    Texts are tokenized whole, with a space before them. Null or empty texts, and those that a tokenizer does not give back byte for byte, have
    no tokens: zeros, an empty text, no links. Null and repeated doc_ids stay, a row each. Other columns are not read.
    """
    return doc_text(docs).select("doc_id", F.monotonically_increasing_id().alias("row"), "text").mapInArrow(aligner(path_a, path_b), _ALIGNED)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """Per id pair (a, b): in how many documents it is linked, and whether no pair of the same ``a`` is in more."""
    counts = aligned.select(F.explode("links").alias("l")).groupBy("l.a", "l.b").agg(F.count("*").alias("n"))
    most = counts.groupBy("a").agg(F.max("n").alias("most"))  # as many rows as ids of one vocabulary, so Spark broadcasts it
    return counts.join(most, "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def with_counts(aligned: DataFrame, counts: DataFrame, n_counts: int) -> DataFrame:
    """The rows of ``aligned``, a written table, with n_best (links whose pair is the most frequent of its ``a``) and count_sum over the links."""
    each = aligned.select("row", F.explode("links").alias("l")).select("row", "l.a", "l.b", F.col("l.n").cast("long").alias("times"))
    found = F.broadcast(counts) if n_counts <= BROADCAST_PAIRS else counts
    sums = each.join(found, ["a", "b"]).groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return aligned.drop("links").join(sums, "row", "left").select(*(c for c in aligned.columns if c != "links"), zero("n_best"), zero("count_sum"))


def report(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per document: counts of tokens, groups and links, the SHA-256 of the groups, and what corpus-wide pair counts say of its links.

    A pair is counted once for each row of ``docs`` that has it, so copies and rows of one doc_id count each.
    """
    scratch = Scratch(docs.sparkSession)
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    aligned = scratch.table(align(docs, path_a, path_b).select("doc_id", "row", "n_a", "n_b", "n_groups", "n_links", digest, "links"), "aligned")
    counts = scratch.table(pair_counts(aligned), "pairs")
    return with_counts(aligned, counts, counts.count()).drop("row")
