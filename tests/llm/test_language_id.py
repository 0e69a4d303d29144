"""Language identification: held-out accuracy, odd tables, the learner's parts against plain Python."""

import math
import zlib

import numpy as np
import pytest

from tidemark.llm import language_id, queries

S = "doc_id long, text string, lang string, source string, lang_pred string, score double"
WORDS = {"en": "the of and to in is that for with was as by this".split(), "de": "der die und das nicht ein mit auf für ist zu wird".split(), "fr": "le la les de des et un une dans pour qui est".split()}


def frame(spark, rows):
    return spark.createDataFrame([(i, t, x, "s", "clash", 0.5) for i, t, x in rows], S)


def corpus(n=240, seed=1):
    rng, rows = np.random.default_rng(seed), []
    for i in range(n):
        lang = list(WORDS)[i % 3]
        rows.append((i, " ".join(rng.choice(WORDS[lang], 25)), lang))
    return rows


def test_held_out_accuracy_on_documents(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = queries.op13_language_id(spark, sf)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"]
    got = out.collect()
    assert len(got) == len(truth) and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r["held_out"]]
    right = np.array([r["lang_pred"] == truth[r["doc_id"]] for r in held])
    assert right.mean() > 0.97
    assert abs(np.mean([r["score"] for r in held]) - right.mean()) < 0.05  # calibrated
    assert all(0 <= r["score"] <= 1 and r["lang_pred"] in {"en", "de", "fr", "es", "und"} for r in got)


def test_odd_rows(spark):
    rows = corpus()
    odd = [(900, None, "en"), (901, "", "en"), (902, "123 !? 456", "de"), (903, "the " * 200_000, "de"), (904, "und die und das", None), (None, "le la les des une", "de"), (905, "漢字", None), (905, "漢字", None)]
    got = language_id.report(frame(spark, rows + odd)).collect()
    assert len(got) == len(rows) + len(odd)
    by = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got}
    assert by[900] == by[901] == by[902] == ("und", 0.0) and by[903][0] == "en" and by[904][0] == "de" and by[None][0] == "fr" and by[905][0] in WORDS
    assert all(by[i][0] == lang for i, _, lang in rows)
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [False]


def test_labels_ids_and_sources_are_no_inputs(spark):
    rows = corpus(90)
    model = language_id.train(frame(spark, rows))
    texts = {t: model.predict(t) for _, t, _ in rows}
    other = frame(spark, [(i + 5000, t, "xx") for i, t, _ in rows])
    assert {r["text"]: (r["lang_pred"], r["score"]) for r in language_id.identify(other, model).collect()} == texts


def test_copies_count_once_and_the_sample_is_bounded(spark):
    rows = corpus(60)
    hot = [(1000 + i, "die die die", "en") for i in range(400)]  # many copies with a wrong label
    model = language_id.train(frame(spark, rows + hot), per_language=50)
    assert model.predict("der die das und nicht")[0] == "de"


def test_empty_tables(spark):
    assert language_id.report(frame(spark, [])).count() == 0
    got = language_id.report(frame(spark, [(1, "some words", None), (2, None, None)])).collect()
    assert [(r["lang_pred"], r["score"]) for r in got] == [("und", 0.0)] * 2


@pytest.mark.parametrize("text", ["Straße, Ça va? ÉTÉ", "  a  b ", "x", "!!", "", None, "İstanbul", "a1b2"])
def test_grams_by_definition(text):
    lower = lambda c: low if len(low := c.lower()) == 1 else c
    letters = "".join(lower(c) if c.isalpha() else " " for c in text or "")
    plain = f" {' '.join(letters.split())} " if letters.strip() else ""
    expected = [plain[i : i + n] for n in language_id.LENGTHS for i in range(len(plain) - n + 1)]
    got = language_id.grams(text, bits=16)
    assert len(got) == len(expected) and len(dict.fromkeys(zip(expected, got.tolist(), strict=True))) == len(set(expected))
    at, n = language_id._counted(text)
    assert dict(zip(at.tolist(), n.tolist(), strict=True)) == {f: got.tolist().count(f) for f in got.tolist()}


def test_learner_by_definition():
    """One coordinate at a time, as the rule is stated."""
    rng, p = np.random.default_rng(5), language_id.Penalties(0.3, 1.0, 0.4, 0.1)
    leader = language_id.Leader(np.zeros((7, 3)), np.zeros((7, 3)), p)
    z, n = [[0.0] * 3 for _ in range(7)], [[0.0] * 3 for _ in range(7)]
    w = lambda i, c: 0.0 if abs(z[i][c]) <= p.l1 else -(z[i][c] - math.copysign(p.l1, z[i][c])) / ((p.beta + math.sqrt(n[i][c])) / p.alpha + p.l2)
    for _ in range(40):
        at, label = np.sort(rng.choice(7, 4, replace=False)), int(rng.integers(3))
        v = rng.normal(size=4)
        leader.learn(at, v, label)
        s = [sum(v[k] * w(i, c) for k, i in enumerate(at)) for c in range(3)]
        e = [math.exp(x) for x in s]
        g = {(i, c): v[k] * (e[c] / sum(e) - (c == label)) for k, i in enumerate(at) for c in range(3)}
        now = {x: w(*x) for x in g}
        for (i, c), x in g.items():
            z[i][c] += x - (math.sqrt(n[i][c] + x * x) - math.sqrt(n[i][c])) / p.alpha * now[i, c]
            n[i][c] += x * x
    assert np.allclose(leader.weights(), [[w(i, c) for c in range(3)] for i in range(7)]) and (leader.weights() == 0).any()


def test_temperature_of_logits_that_are_too_sure():
    rng = np.random.default_rng(8)
    logits = rng.normal(size=(4000, 3)) * 2
    p = np.exp(logits) / np.exp(logits).sum(1, keepdims=True)
    labels = np.array([rng.choice(3, p=x) for x in p])
    assert abs(language_id.temperature(logits * 4, labels) - 4) < 0.3 and language_id.temperature(np.zeros((0, 3)), np.zeros(0, int)) == 1.0
