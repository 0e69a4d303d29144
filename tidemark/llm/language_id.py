"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies come from all training texts. The weights are fitted on a bounded, hashed sample of distinct training
texts by follow-the-regularised-leader with elastic-net penalties: shards of the sample learn at the same time, each from the
state that the round before left, and their states are averaged (iterative parameter mixing). A held-back shard gives the
temperature of the probabilities.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, doc_text

#: Character n-grams of these lengths, words apart, fall into 2 ** BITS features by a hash.
LENGTHS, BITS = (1, 2, 3), 16
#: About so many distinct texts of a language are fitted on, all shards together.
PER_LANGUAGE = 2_000
#: Shards that learn at the same time (one more calibrates), and rounds of learning and averaging.
SHARDS, ROUNDS = 4, 3
#: Odd multipliers of the hash, one for each place of an n-gram.
ODD = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1)


@dataclass(frozen=True)
class Penalties:
    """Follow-the-regularised-leader: learning rate, smoothing of its fall, and the weights of both penalties."""

    alpha: float = 0.2
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.02


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """The lower-case letter for each code point that is one, else a space; letters whose lower case is longer stay."""
    out = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        if (x := chr(c)).isalpha():
            out[c] = ord(low) if len(low := x.lower()) == 1 else c
    return out


def grams(text: str | None, lengths: tuple[int, ...] = LENGTHS, bits: int = BITS) -> np.ndarray:
    """A feature for each character n-gram of the whole text, in which everything but letters is a space; none without a letter."""
    points = _letters()[np.frombuffer((text or "").encode("utf-32-le", "replace"), np.uint32)]
    solid = points != 32
    if not solid.any():
        return np.zeros(0, np.int64)
    words = points[solid | np.concatenate([[False], solid[:-1]])]  # of several spaces the first stays
    points = np.concatenate([[np.uint32(32)], words[: len(words) - (words[-1] == 32)], [np.uint32(32)]])
    out = []
    for n in lengths:
        if len(points) >= n:
            h = np.full(len(points) - n + 1, n, np.uint32)
            for k in range(n):
                h = (h ^ points[k : len(points) - n + 1 + k]) * np.uint32(ODD[k % len(ODD)])
                h ^= h >> np.uint32(15)
            out.append((h * np.uint32(ODD[0])) >> np.uint32(32 - bits))
    return np.concatenate(out).astype(np.int64)


def _counted(text: str | None, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """The features of a text, rising, and how often each occurs."""
    found = grams(text, bits=bits)
    if len(found) < 2_000:
        return np.unique(found, return_counts=True)
    n = np.bincount(found, minlength=1 << bits)
    at = np.flatnonzero(n)
    return at, n[at]


def _slices(batches, rows: int = 256):
    """Batches in small parts, so that a task never holds the features of many texts at once."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def _presence(bits: int):
    """A mapInArrow function over (text): in how many texts each feature is."""

    def presence(batches):
        n = np.zeros(1 << bits, np.int64)
        for batch in _slices(batches):
            for text in batch.column(0).to_pylist():
                n[_counted(text, bits)[0]] += 1
        at = np.flatnonzero(n)
        yield pa.record_batch({"feature": at, "n": n[at]})

    return presence


def weighted(text: str | None, idf: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """TF-IDF of a text as features and values of length one, and the bias, which is the last feature.

    Features of no training text are left out.
    """
    at, n = _counted(text, bits)
    v = n * idf[at]
    at, v = at[v > 0], v[v > 0]
    return np.append(at, 1 << bits), np.append(v / max(np.sqrt(v @ v), 1e-300), 1.0)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


class Leader:
    """State of the learner for each feature and language: ``z`` sums gradients, ``n`` their squares."""

    def __init__(self, z: np.ndarray, n: np.ndarray, penalties: Penalties):
        self.z, self.n, self.p = z, n, penalties

    def weights(self, at=slice(None)) -> np.ndarray:
        """The weights that lead now; the first penalty holds small ones at zero, which makes the model sparse."""
        z, p = self.z[at], self.p
        return -(z - np.sign(z) * p.l1) / ((p.beta + np.sqrt(self.n[at])) / p.alpha + p.l2) * (np.abs(z) > p.l1)

    def learn(self, at: np.ndarray, v: np.ndarray, label: int) -> None:
        w = self.weights(at)
        error = _softmax(v @ w)
        error[label] -= 1
        g = np.outer(v, error)
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.p.alpha * w
        self.n[at] = n + g * g


_FEATURES = "shard int, h long, label int, at binary, v binary"


def _features(idf, bits: int):
    """A mapInArrow function over (shard, h, label, text)."""

    def features(batches):
        for batch in _slices(batches):
            found = [weighted(t, idf.value, bits) for t in batch.column(3).to_pylist()]
            packed = [pa.array([x.astype(kind).tobytes() for x in column], pa.binary()) for column, kind in zip(zip(*found, strict=True), ("<i4", "<f4"), strict=True)]
            yield pa.record_batch([*(batch.column(i) for i in range(3)), *packed], names=["shard", "h", "label", "at", "v"])

    return features


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, int]:
    return np.frombuffer(row["at"], "<i4"), np.frombuffer(row["v"], "<f4").astype(float), row["label"]


def _shard_pass(state, penalties: Penalties):
    """An applyInArrow function over the features of a shard: the learner's state after one pass in order of the hash."""

    def one_pass(key, table):
        z, n = state.value
        leader = Leader(z.copy(), n.copy(), penalties)
        for part in _slices(table.sort_by([("h", "ascending"), ("label", "ascending")]).to_batches()):
            for row in part.to_pylist():
                leader.learn(*_unpacked(row))
        return pa.table({"z": pa.array([leader.z.tobytes()], pa.binary()), "n": pa.array([leader.n.tobytes()], pa.binary())})

    return one_pass


def _logits(weights):
    """A mapInArrow function over features: label and logits."""

    def logits(batches):
        for batch in _slices(batches):
            rows = [_unpacked(r) for r in batch.to_pylist()]
            yield pa.record_batch({"label": pa.array([r[2] for r in rows], pa.int32()), "logits": pa.array([(v @ weights.value[at]).tolist() for at, v, _ in rows], pa.list_(pa.float64()))})

    return logits


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the greatest likelihood of the labels, between 1/50 and 50, by golden section over its logarithm."""
    if not len(labels):
        return 1.0
    loss = lambda t: -np.log(np.maximum(_softmax(logits / np.exp(t))[np.arange(len(labels)), labels], 1e-300)).mean()
    low, high, part = np.log(1 / 50), np.log(50), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - part * (high - low), low + part * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


@dataclass(frozen=True)
class Model:
    """Its size is that of the features times the languages, whatever the corpus."""

    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float
    bits: int = BITS

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and its calibrated probability; ``und`` and 0 for a text without a letter, or if nothing was learned."""
        at, v = weighted(text, self.idf, self.bits)
        if not self.languages or (len(at) == 1 and not len(grams(text, (1,), self.bits))):
            return "und", 0.0
        p = _softmax(v @ self.weights[at] / self.temperature)
        return self.languages[int(p.argmax())], float(p.max())


def train(labelled: DataFrame, per_language: int = PER_LANGUAGE, penalties: Penalties | None = None, bits: int = BITS) -> Model:
    """A model from (text, lang); rows without a language or a letter teach nothing.

    Languages and document frequencies are those of all rows. Weights and temperature are fitted on about ``per_language`` distinct texts of each
    language, those with the least hashes, so that copies count once.
    """
    spark, penalties, scratch = labelled.sparkSession, penalties or Penalties(), Scratch(labelled.sparkSession)
    sc, size = spark.sparkContext, (1 << bits) + 1
    rows = labelled.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    hashed = rows.withColumn("h", F.xxhash64("text"))
    found = hashed.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct("h", 0.02).alias("texts")).orderBy("lang").collect()  # a row for each language
    if not found:
        return Model([], np.zeros(size - 1), np.zeros((size, 0)), 1.0, bits)
    languages, total = [r["lang"] for r in found], sum(r["n"] for r in found)
    have = np.zeros(size - 1)
    for r in rows.select("text").mapInArrow(_presence(bits), "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect():  # no more rows than features
        have[r["feature"]] = r["n"]
    idf = np.where(have > 0, np.log((1 + total) / (1 + have)) + 1, 0)
    share = spark.createDataFrame([(r["lang"], i, min(1.0, per_language / max(1, r["texts"]))) for i, r in enumerate(found)], "lang string, label int, share double")
    least = hashed.join(F.broadcast(share), "lang").filter(F.col("h") / F.lit(2.0**64) + 0.5 < F.col("share"))
    once = least.groupBy("h", "label").agg(F.first("text").alias("text")).select(F.pmod(F.xxhash64("h"), F.lit(SHARDS + 1)).cast("int").alias("shard"), "h", "label", "text")
    shared_idf = sc.broadcast(idf)
    sample = scratch.table(once.mapInArrow(_features(shared_idf, bits), _FEATURES), "sample")
    z, n = np.zeros((size, len(languages))), np.zeros((size, len(languages)))
    for _ in range(ROUNDS):
        state = sc.broadcast((z, n))
        done = sample.filter(F.col("shard") < SHARDS).groupBy("shard").applyInArrow(_shard_pass(state, penalties), "z binary, n binary").collect()  # a row for each shard
        if done:
            z, n = (np.mean([np.frombuffer(r[c]).reshape(z.shape) for r in done], axis=0) for c in ("z", "n"))
        state.unpersist()
    weights = Leader(z, n, penalties).weights()
    held = sample.filter(F.col("shard") == SHARDS).mapInArrow(_logits(sc.broadcast(weights)), "label int, logits array<double>").collect()  # of the bounded sample
    t = temperature(np.array([r["logits"] for r in held]), np.array([r["label"] for r in held], int)) if held else 1.0
    scratch.drop(sample)
    return Model(languages, idf, weights, t, bits)


def identify(rows: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows with lang_pred and score, from their text alone."""
    shared, name = rows.sparkSession.sparkContext.broadcast(model), text
    out = {"lang_pred": "string", "score": "double"}
    kept = [f for f in rows.schema if f.name not in out]

    def predict(batches):
        for batch in _slices(batches):
            found = [shared.value.predict(t) for t in batch.column(batch.schema.get_field_index(name)).to_pylist()]
            more = [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            yield pa.record_batch([*batch.columns, *more], names=[*batch.schema.names, *out])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), *(f"{k} {v}" for k, v in out.items())])
    return rows.select(*(f"`{f.name}`" for f in kept)).mapInArrow(predict, schema)


def held_out(doc_id: Column) -> Column:
    """Whether a document stays out of training: one in five, by the CRC-32 of its id as text. A null id does not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score. A model is trained on the documents that are not held out, and predicts all, whole texts.

    ``und`` with score 0 for texts that are null or have no letter, and where no document teaches. Documents with a null doc_id are neither held
    out nor learned from. Repeated rows come back as often as they came. Other columns are not read.
    """
    taught = docs.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("text", "lang")
    rows = doc_text(docs).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return identify(rows, train(taught)).drop("text")
