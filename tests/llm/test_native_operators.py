"""Pseudonyms, preference formatting and licence scan."""

import datetime as dt
import hashlib
import re
import textwrap
from pathlib import Path

import duckdb
import pytest

from pyspark.sql import functions as F

from tidemark.llm import chat_format, license_scan, pii, quality_rules, queries

S = "doc_id long, text string"


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def pseudonyms(spark, texts, key="k"):
    df = spark.createDataFrame(list(enumerate(texts)), S).withColumn("found", F.lit(1))
    return {r["doc_id"]: (r["text"], r["n_replaced"]) for r in pii.pseudonymise(df, key).collect()}


def test_formats_and_validation(spark):
    texts = ["call +1 (017) 555-7713 now", "card 4417744280351547.", "no card 4417744280351548", "4417-7442-8035-1547", "ip 97.51.17.173 not 300.1.1.1", "on 2024-02-29, not 2023-02-29", "31.12.1999", "me.34@mail7.example.com!", 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"', "DE89 3704 0044 0532 0130 00", None, "", "plain words only", "123-45-6789"]
    got = pseudonyms(spark, texts)
    for i in (2, 10, 11, 12):
        assert got[i] == (texts[i], 0)
    shape = lambda t: re.sub(r"[0-9]", "9", t)
    for i in (0, 1, 3, 5, 6, 9, 13):
        assert got[i][0] != texts[i] and shape(got[i][0]) == shape(texts[i]), i
    assert got[0][0].startswith("call +1 (") and "300.1.1.1" in got[4][0] and "97.51.17.173" not in got[4][0] and "2023-02-29" in got[5][0]
    assert luhn(re.sub(r"\D", "", got[1][0])) and luhn(re.sub(r"\D", "", got[3][0]))
    assert re.sub(r"\D", "", got[1][0]) == re.sub(r"\D", "", got[3][0])  # equal values stay linked
    assert got[7][0].endswith("@mail7.example.com!") and "me.34" not in got[7][0]
    assert re.fullmatch(r'token = "[0-9a-f]{40}"', got[8][0]) and got[8][0] != texts[8]
    odd = pseudonyms(spark, ["leenè.90@mail2.example.com de"])[0]
    assert odd[1] == 1 and "90@" not in odd[0] and "leenè" not in odd[0]
    s = got[9][0].replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def test_permutation_is_a_bijection(spark):
    df = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("d"))
    out = [r[0] for r in df.select(pii.permute_digits(F.col("d"), "k", "t")).collect()]
    assert sorted(out) == [f"{i:03d}" for i in range(1000)]
    other = [r[0] for r in df.select(pii.permute_digits(F.col("d"), "another", "t")).collect()]
    assert out != other


def test_only_spark_expressions(spark):
    df = spark.createDataFrame([(1, "x")], S)
    plan = pii.pseudonymise(df, "k")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_preference_pairs(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (1, 2, "user", "a"), (1, 3, "assistant", "bé"), (1, 3, "assistant", "bé"), (2, 0, "user", "hi"), (2, 1, "assistant", "yo"), (2, 2, "user", None), (2, 3, "assistant", "d"), (None, 0, "user", "z"), (3, 0, None, "hi")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("prompt", F.lit(1))
    pairs = spark.createDataFrame([(7, 1, 2), (8, 2, 2), (9, 3, 1), (10, 1, 77)], "pair_id long, chosen long, rejected long")
    got = {r["pair_id"]: r for r in chat_format.format_pairs(df, pairs).collect()}
    assert set(got) == {7, 8, 9}
    r = got[7]
    assert r["n_shared"] == 2 and r["prompt"] == "<|user|>\nhi<|end|>\n<|assistant|>\nyo<|end|>\n"
    assert [r["chosen_text"][s["start"] : s["end"]] for s in r["chosen_spans"]] == ["bé<|end|>\n"]
    assert [r["rejected_text"][s["start"] : s["end"]] for s in r["rejected_spans"]] == ["d<|end|>\n"]
    assert got[8]["chosen_text"] == "" and got[8]["chosen_spans"] == [] and got[8]["n_shared"] == 4
    assert got[9]["n_shared"] == 1 and got[9]["chosen_text"] == ""
    near = chat_format.format_neighbours(df).collect()
    assert sorted((r["pair_id"], r["chosen"], r["rejected"], r["n_shared"]) for r in near) == [(0, None, 1, 0), (1, 2, 3, 1)]
    alone = next(r for r in near if r["pair_id"] == 0)
    assert alone["prompt"] == "" and alone["chosen_text"] is None and alone["chosen_spans"] is None and alone["rejected_text"].startswith("<|user|>") and len(alone["rejected_spans"]) == 2
    wide = chat_format.format_neighbours(spark.createDataFrame([(c, 0, "user", str(c)) for c in (2**60 + 2, 2**60 + 3, -4, -3)], df.schema.fields and "conv_id long, turn long, role string, text string")).collect()
    assert sorted((r["chosen"], r["rejected"]) for r in wide) == [(-4, -3), (2**60 + 2, 2**60 + 3)]
    long = spark.createDataFrame([(0, i, "user" if i % 2 else "assistant", "x" * 5000) for i in range(300)] + [(1, 0, "assistant", "x" * 5000)], "conv_id long, turn long, role string, text string")
    assert [(r["n_shared"], len(r["chosen_spans"])) for r in chat_format.format_neighbours(long).collect()] == [(1, 149)]
    assert chat_format.format_neighbours(df.limit(0)).count() == 0


def test_license_scan(spark):
    mit = license_scan.KNOWN[0][1]
    texts = ["Copyright (c) 2020 Some One\n\n" + mit.upper().replace(",", " ,"), "words\nlicenced under the APACHE licence, version 2.0\nmore", None, "Released under the MIT License.", "nothing"]
    got = {r["doc_id"]: (r["license"], r["notices"]) for r in license_scan.scan(spark.createDataFrame(list(enumerate(texts)), S).withColumn("license", F.lit(1))).collect()}
    assert got == {0: ("MIT", []), 1: (None, ["Apache-2.0"]), 2: (None, []), 3: ("MIT", ["MIT"]), 4: (None, [])}


def test_whole_licences_in_every_guise(spark):
    heads = ["Copyright (c) 2019-2021, Some One <a@b.c>\n", "\u00a9 2020 Some One. All rights reserved.\n\n", "(c) 2001 X\nAll rights reserved.\n", "Portions Copyright 1999 by Y\n", ""]
    whole = [(n, t) for n, t in license_scan.KNOWN if len(t) > 200]
    texts, want = [], []
    for i, (name, text) in enumerate(whole):
        t = heads[i % len(heads)] + "\n".join("# " + x for line in text.split("\n") for x in textwrap.wrap(line, 60 + i))
        texts += [t, t + "\nand more"]
        want += [name, None]
    df = spark.createDataFrame([*enumerate(texts), (None, texts[0]), (5, texts[5])], S)
    got = license_scan.scan(df).collect()
    assert [r["license"] for r in sorted(got, key=lambda r: (r["doc_id"] is None, r["doc_id"]))][: len(texts) + 1] == want[:6] + want[5:]
    assert len(got) == len(texts) + 2 and len({n for n, _ in whole}) >= 10
    own = spark.createDataFrame([(hashlib.md5(b"purple monkey dishwasher").hexdigest(), n) for n in ("zz", "mine")], "digest string, license string")
    assert license_scan.scan(spark.createDataFrame([(1, "Purple, monkey...\n DISHWASHER")], S), own).first()["license"] == "mine"
    assert license_scan.scan(df.limit(0)).count() == 0


def same_as_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    cur = con.execute(queries.ORACLE_SQL[name])
    cols = [d[0] for d in cur.description]
    df = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert sorted(df.columns) == sorted(cols)
    mine, theirs = ([tuple(map(str, r)) for r in rows] for rows in (df.select(*cols).collect(), cur.fetchall()))
    assert mine and sorted(mine) == sorted(theirs)


FILES = {n: n for n in ("Apache-2.0", "CC0-1.0", "GFDL-1.2", "GFDL-1.3", "LGPL-2.1", "MPL-1.1", "MPL-2.0")} | {"Artistic": "Artistic-1.0-Perl", "BSD": "BSD-3-Clause", "GPL-1": "GPL-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2": "LGPL-2.0", "LGPL-3": "LGPL-3.0"}
FOLDER = Path("/usr/share/common-licenses")


@pytest.mark.skipif(not FOLDER.exists(), reason="this system keeps no licence texts")
def test_whole_legal_texts(spark):
    """Each as it is, wrapped otherwise and in other case and punctuation, and without its appendix; none if a word is added. Any table of texts serves as a list."""
    rows, want = [], []
    for file, name in FILES.items():
        text = (FOLDER / file).read_text(errors="replace")
        other = re.sub(r'["\',;]', " ", text.upper()).replace("\n\n", "\n \n*** \n") + "\nCopyright (c) 2024 Some Body\n"
        ends = text.find("END OF TERMS AND CONDITIONS")
        texts = [text, other, text + " more"] + ([text[: ends + 27]] if ends > 0 else [])
        rows += texts
        want += [name, name, None] + [name] * (ends > 0)
    docs = spark.createDataFrame(list(enumerate(rows)), S)
    assert [r["license"] for r in license_scan.scan(docs).orderBy("doc_id").collect()] == want
    known = license_scan.digests_of(spark.createDataFrame([(f"my {w}", t) for t, w in zip(rows, want, strict=True) if w], "license string, text string"))
    assert [r["license"] for r in license_scan.scan(docs, known).orderBy("doc_id").collect()] == [w and f"my {w}" for w in want]


def test_license_of_a_very_long_text(spark):
    long = "\n".join(["some words of a long text"] * 100_000 + ["Licensed under CC BY 4.0."])
    assert license_scan.scan(spark.createDataFrame([(1, long)], S)).first()["notices"] == ["CC-BY-4.0"]


def test_pseudonyms_without_a_key_of_one_s_own_warn(spark):
    sf = "/root/testdata/sf0.001"
    with pytest.warns(UserWarning, match="reversed by anyone"):
        open_key = queries.op2_pii_pseudonyms(spark, sf)
    spark.conf.set(queries.KEY_SETTING, "own")
    try:
        assert open_key.exceptAll(queries.op2_pii_pseudonyms(spark, sf)).count() > 0
    finally:
        spark.conf.unset(queries.KEY_SETTING)


def test_native_plans_run_no_python(spark):
    """What the queries of the operators that must be native run on executors is the JVM's alone."""
    for name in ("op2_pii_pseudonyms", "op6_quality_rules", "op7_preference_format"):
        plan = queries.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
        assert not re.search(r"Python|Pandas|Arrow", plan), name


def test_license_query_equals_its_sql(spark):
    same_as_sql(spark, "op5_license_scan")


def test_preference_query_equals_its_sql(spark):
    same_as_sql(spark, "op7_preference_format")


def test_base_statistics_equal_sql(spark):
    sql = r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        t AS (SELECT doc_id, i, w[i:i+2] AS g, w FROM d, unnest(range(1, len(w) - 1)) AS u(i)),
        a AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM t) WHERE c > 1),
        r AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS i FROM a) GROUP BY 1),
        l AS (SELECT doc_id, count(*) - count(DISTINCT x) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY 1)
        SELECT doc_id, len(w), length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')), length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')), coalesce(l.n, 0), coalesce(r.n, 0) FROM d LEFT JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)"""
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    got = quality_rules.judge(docs, labels).select("doc_id", *quality_rules.STATS).collect()
    assert sorted(tuple(r) for r in got) == sorted(tuple(map(int, r)) for r in con.execute(sql).fetchall())
    assert quality_rules.judge(docs.limit(0), labels).count() == 0
    long = spark.createDataFrame([(1, "word " * 100_000)], S)
    assert quality_rules.judge(long, labels).first()["n_repeat_words"] == 100_000


def feistel(left, right, m, n, key, tag):
    for i in range(pii.ROUNDS):
        half = right if i % 2 == 0 else left
        f = int(hashlib.sha256(f"{key}|{tag}|{i}|{half}".encode()).hexdigest()[:12], 16)
        left, right = ((left + f) % m, right) if i % 2 == 0 else (left, (right + f) % n)
    return left, right


def test_pseudonyms_equal_plain_feistel(spark):
    ssn, days = ["123-45-6789", "001-01-0001", "899-99-9999", "667-20-0003"], ["2024-02-29", "1800-01-01", "2199-12-31"]
    got = pseudonyms(spark, ssn + days)
    for i, s in enumerate(ssn):
        a, g, n = map(int, s.split("-"))
        x, y = feistel((a - 1 - (a > 666)) * 99 + g - 1, n - 1, 898 * 99, 9999, "k", "ssn")
        a = x // 99 + 1
        assert got[i][0] == f"{a + (a >= 666):03d}-{x % 99 + 1:02d}-{y + 1:04d}"
    for i, d in enumerate(days, len(ssn)):
        at = (dt.date.fromisoformat(d) - dt.date(1800, 1, 1)).days
        x, y = feistel(at // 773, at % 773, 189, 773, "k", "date")
        assert got[i][0] == str(dt.date(1800, 1, 1) + dt.timedelta(x * 773 + y))


def test_pseudonyms_stay_valid_and_apart(spark):
    ssn = [f"{a:03d}-{g:02d}-{n:04d}" for a in range(1, 900, 7) if a != 666 for g in (1, 50, 99) for n in (1, 9999)]
    got = [t for _, (t, _) in sorted(pseudonyms(spark, ssn).items())]
    assert len(set(got)) == len(ssn) and not any(re.search("^(000|666|9)|-00-|-0000$", x) for x in got)
    every = [dt.date(2000, 1, 1) + dt.timedelta(i) for i in range(366)]
    slash = [f"{d.day:02d}/{d.month:02d}/{d.year}" for d in every] + [f"{d.month:02d}/{d.day:02d}/{d.year}" for d in every if d.day > 12]
    got = [t for _, (t, _) in sorted(pseudonyms(spark, slash).items())]
    assert len(set(got)) == len(slash) and all(int(x[3:5]) > 12 for x in got[366:])
    secret = "0badf00d" * 4 + "0badf00e"
    one, two = (pseudonyms(spark, [x])[0][0] for x in (secret, secret[:-1] + "d"))
    assert re.fullmatch("[0-9a-f]{40}", one) and len({one[i : i + 8] for i in range(0, 40, 8)}) == 5
    assert all(one[i : i + 8] != two[i : i + 8] for i in range(0, 40, 8))


def test_pseudonyms_of_odd_tables(spark):
    df = spark.createDataFrame([(1, "card 4417744280351547"), (1, "card 4417744280351547"), (None, "x " * 200_000 + "31.12.1999")], S)
    got = pii.pseudonymise(df, "k").collect()
    assert len(got) == 3 and all(r["n_replaced"] == 1 for r in got) and len({r["text"] for r in got}) == 2
    assert pii.pseudonymise(df.limit(0), "k").count() == 0
