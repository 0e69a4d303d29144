"""Token alignment against a plain reading of byte offsets."""

import base64
import hashlib
import json
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tidemark.llm import alignment, queries

A, B = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
TEXTS = [
    None, "", " ", "a", "Hello world, it's 2024!\n\nNext  line\t.", "naïve café — 東京 😀 é", "<|endoftext|> <s> </s> <unk> <0x41>", "▁ is no space", "\x00\x01 bytes",
    "copy of copies copy", "copy of copies copy", "x" * 5000, " " * 3000 + "z", "the quick brown fox " * 400, "\r\n  　​", "ﬁligree ½ Å", "क्षत्रिय ไทย עברית",
]


def reference(rows):
    """By definition: byte ranges of each token, every pair compared."""
    exact = Tokenizer.from_file(A)
    exact.encode_special_tokens = True
    ranks = {int(i): base64.b64decode(t) for t, i in map(bytes.split, open("/opt/tokenizers/byte_bpe_50k.tiktoken", "rb"))}
    pieces, out, holds = SentencePieceProcessor(model_file=B), [], Counter()
    for doc_id, text in rows:
        a = [(i, ranks[i]) for i in exact.encode(f" {text}", add_special_tokens=False).ids] if text else []
        b = [(i, bytes.fromhex(p[3:5]) if pieces.is_byte(i) else p.replace("▁", " ").encode()) for i in (pieces.encode(text) if text else []) for p in [pieces.id_to_piece(i)]]
        if any(b"".join(x for _, x in t) != f" {text}".encode() for t in (a, b)):
            a = b = []
        spans = []
        for tokens in (a, b):
            at, held = 0, []
            for i, x in tokens:
                held.append((i, at, at + len(x)))
                at += len(x)
            spans.append(held)
        ends = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, since = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(i) for i, s, e in side if since <= s and e <= end) for side in spans))
            since = end
        links, j = [], 0
        for i, s, e in spans[0]:
            links += [(i, k) for k, s2, e2 in spans[1] if s < e2 and s2 < e] if len(spans[1]) < 3000 else [(i, k) for k, s2, e2 in spans[1][max(0, s // 4 - 1000) :] if s < e2 and s2 < e]
        holds.update(set(links))
        out.append((doc_id, len(a), len(b), groups, links))
    best = defaultdict(int)
    for (i, _), n in holds.items():
        best[i] = max(best[i], n)
    return [
        (d, a, b, len(g), len(x), sum(holds[p] == best[p[0]] for p in x), sum(holds[p] for p in x), hashlib.sha256(";".join(g).encode()).hexdigest() if a else "") for d, a, b, g, x in out
    ]


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()), key=str)


@pytest.mark.parametrize("limit", [alignment.BROADCAST_PAIRS, 0])
def test_report_by_definition(spark, monkeypatch, limit):
    monkeypatch.setattr(alignment, "BROADCAST_PAIRS", limit)
    monkeypatch.setattr(alignment, "AT_ONCE", 300)
    rows = [*enumerate(TEXTS), (3, "a"), (None, "a null id"), (None, "a null id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"row": F.lit("clash"), "n_a": F.lit(1), "links": F.lit(None)})
    assert result(alignment.report(df, A, B)) == sorted(reference(rows), key=str)


def test_whole_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect() if len(r["text"] or "") < 4000]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(alignment.report(docs, A, B)) == sorted(reference(rows), key=str)
    whole = queries.op12_token_alignment(spark, sf)
    assert whole.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"] and whole.count() == spark.read.parquet(f"{sf}/documents.parquet").count()


def test_groups_and_links_of_a_text(spark):
    r = alignment.align(spark.createDataFrame([(1, "tokenizers align")], "doc_id long, text string"), A, B).first()
    sides = [g.split("|") for g in r["groups"].split(";")]
    assert len(sides) == r["n_groups"] and sum(len(a.split(",")) for a, _ in sides) == r["n_a"] and sum(len(b.split(",")) for _, b in sides) == r["n_b"]
    assert sum(x["n"] for x in r["links"]) == r["n_links"]


def test_empty_table(spark):
    assert alignment.report(spark.createDataFrame([], "doc_id int, text string"), A, B).count() == 0


def test_ranks_give_the_ids_of_the_file():
    """Letters, numbers, marks and spaces of all scripts, beside each other."""
    t = alignment.ByteLevel(A)
    assert t.fast is not None
    points = [c for c in range(1, 0x30000, 7) if not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)}b 1{chr(c)}2 {chr(c)} {chr(c)}{chr(c)}x!{chr(c)}?  " for c in points]
    assert t.encode(texts) == [t.exact.encode(f" {x}", add_special_tokens=False).ids for x in texts]


def test_a_file_whose_merges_are_out_of_order_is_encoded_as_it_says(tmp_path):
    spec = json.load(open(A))
    spec["model"]["merges"][300], spec["model"]["merges"][301] = spec["model"]["merges"][301], spec["model"]["merges"][300]
    (tmp_path / "odd.json").write_text(json.dumps(spec))
    t = alignment.ByteLevel(str(tmp_path / "odd.json"))
    assert t.fast is None and b"".join(t.bytes[i] for i in t.encode(["some words"])[0]) == b" some words"
