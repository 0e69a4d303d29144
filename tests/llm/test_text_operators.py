"""The text operators against plain Python, on small random and awkward inputs."""

import hashlib
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import common, decontaminate, html_text, line_dedup, ngram_join, packing, quality_rules, substring_dedup

S = "doc_id long, text string"
WORD = r"[^\x20\x09-\x0D]+"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return re.findall(WORD, t or "")


def corpus(seed=3, n=70):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 5))) for _ in range(300)]
    rows = [(0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, "One"), (5, "a b c")]
    base = [rng.choice(vocab) for _ in range(120)]
    for d in range(6, n):
        t = list(base) if d % 4 == 0 else [rng.choice(vocab) for _ in range(rng.choice([5, 20, 60, 150]))]
        for _ in range(rng.choice([0, 1, 2, 6])):
            t[rng.randrange(len(t))] = rng.choice(vocab)
        if d % 9 == 0:
            t += ["again"] * 50
        sep = [rng.choice([" ", " ", " ", "\n", "  ", "\t"]) for _ in t]
        rows.append((d, "".join(w + s for w, s in zip(t, sep))))
    rows.append((n, rows[8][1]))
    rows.append((n + 1, rows[8][1].upper()))
    return rows


def frame(spark, rows):
    """With columns whose names the operators use themselves."""
    df = spark.createDataFrame(rows, S)
    for c in ("n_words", "component_id", "keys", "kept", "id", "text_hash"):
        df = df.withColumn(c, F.lit("x"))
    return df


def linked(rows, n, num, den):
    sets = {}
    for d, t in rows:
        w = words((t or "").translate(LOW))
        sets[d] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids, links = sorted(sets), Counter()
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and den * both >= num * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
                links.update([a, b])
    return {d: (len(sets[d]), find(d), links[d]) for d in ids}


def similar(spark, rows, n, num, den):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in ngram_join.similar_sets(frame(spark, rows), n, num, den, links=True).collect()}


def chains(seed=11, groups=4, each=18):
    """Groups of copies whose words change one after another, so that not all of a group are linked, and some that are equal."""
    rng, rows = random.Random(seed), [(0, None), (1, "  ")]
    for _ in range(groups):
        t = [str(rng.randrange(10**6)) for _ in range(rng.choice([40, 90, 200]))]
        for _ in range(each):
            t = list(t)
            if rng.random() < 0.8:
                t[rng.randrange(len(t))] = str(rng.randrange(10**6))
            rows.append((len(rows), " ".join(t)))
    return rows


@pytest.mark.parametrize("n,num,den", [(4, 85, 100), (5, 4, 5), (2, 1, 2)])
def test_similar_sets(spark, n, num, den):
    rows = corpus()
    assert similar(spark, rows, n, num, den) == linked(rows, n, num, den)


def test_similar_sets_of_buckets_that_are_too_large_for_pairs(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BUCKET", 1)
    monkeypatch.setattr(ngram_join, "GROUP_PART", 3)
    rows = chains()
    assert similar(spark, rows, 4, 85, 100) == linked(rows, 4, 85, 100)


def test_links_of_groups_are_counted_in_parts(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "GROUP_PART", 3)
    monkeypatch.setattr(ngram_join, "COLUMNS", 4)
    rows = chains(5)
    expected = linked(rows, 4, 85, 100)
    assert max(x[2] for x in expected.values()) > 8
    assert similar(spark, rows, 4, 85, 100) == expected


def test_bit_maps_bound_the_difference():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 2**63, int(n), dtype=np.uint64)) for n in (1, 5, 40, 300, 900, 40_000)]
    sets += [np.unique(np.concatenate([s[: len(s) * 9 // 10], rng.integers(0, 2**63, len(s) // 10, dtype=np.uint64)])) for s in sets] + [np.zeros(0, np.uint64)]
    maps = ngram_join.Maps(pa.array([ngram_join.bit_map(s) for s in sets], pa.binary()))
    i, j = (x.ravel() for x in np.meshgrid(range(len(sets)), range(len(sets))))
    exact = np.array([len(np.setxor1d(sets[a], sets[b])) for a, b in zip(i, j, strict=True)])
    least = maps.apart(i, j)
    assert (least <= exact).all() and (least[exact > 0] > 0).mean() > 0.9


def test_similar_sets_nulls_and_empty(spark):
    texts = [(None, "a b c d e"), (7, "a b c d e"), (7, "a b c d e"), (8, "A b c d e"), (9, "a b c d e"), (9, "f g h i j"), (10, "f g h i j")]
    got = ngram_join.similar_sets(spark.createDataFrame(texts, S), links=True).collect()
    assert sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"], r["n_links"]) for r in got) == [
        (-1, 1, None, None), (7, 1, 7, 2), (7, 1, 7, 2), (8, 1, 7, 2), (9, 1, 7, None), (9, 1, 7, None), (10, 1, 7, 1),
    ]
    assert ngram_join.similar_sets(spark.createDataFrame([], S), links=True).count() == 0


def repeats(rows, width):
    texts = [words(t) for _, t in rows]
    seen = Counter(tuple(w[i : i + width]) for w in texts for i in range(len(w) - width + 1))
    out = []
    for (d, _), w in zip(rows, texts):
        keep = [True] * len(w)
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                keep[i : i + width] = [False] * width
        out.append((d, len(w), len(w) - sum(keep), " ".join(x for x, k in zip(w, keep) if k)))
    return sorted(out)


@pytest.mark.parametrize("width", [5, 12, 35])
def test_remove_repeats(spark, width):
    rows = corpus(seed=width)
    got = sorted(map(tuple, substring_dedup.remove_repeats(frame(spark, rows), width).collect()))
    assert got == repeats(rows, width)


def test_remove_repeats_edges(spark):
    assert substring_dedup.remove_repeats(spark.createDataFrame([], S), 5).count() == 0
    long = " ".join(f"w{i % 977}x{i % 1009}" for i in range(60_000))
    got = {r["doc_id"]: r["n_removed"] for r in substring_dedup.remove_repeats(spark.createDataFrame([(1, long), (None, long), (2, "a b")], S), 35).collect()}
    assert got == {1: 60_000, None: 60_000, 2: 0}


@pytest.mark.parametrize("seed", [24, 45])
def test_remove_repeats_of_a_phrase_said_back_to_back(spark, seed):
    r = random.Random(seed)
    t = [" ".join(f"w{r.randrange(10**6)}" for _ in range(400)) for _ in range(3)]
    for d in range(30):
        phrase, n = [f"p{seed}x{d}x{i}" for i in range(6 + (d + seed) % 12)], 36 + r.randrange(30)
        t.append(" ".join([" ".join(f"w{r.randrange(10**6)}" for _ in range(60)), " ".join((phrase * 12)[:n]), " ".join(f"w{r.randrange(10**6)}" for _ in range(60))]))
    rows = list(enumerate(t))
    assert sorted(map(tuple, substring_dedup.remove_repeats(spark.createDataFrame(rows, S).coalesce(1), 35).collect())) == repeats(rows, 35)


@pytest.mark.parametrize("few", [1, 3])
def test_remove_repeats_of_hot_windows(spark, monkeypatch, few):
    monkeypatch.setattr(common, "FEW", few)
    monkeypatch.setattr(common, "SHARES", 1000)
    rows = corpus(seed=6) + [(1000 + i, f"own{i} " + " ".join(f"hot{j}" for j in range(20)) + f" end{i}") for i in range(30)]
    got = sorted(map(tuple, substring_dedup.remove_repeats(frame(spark, rows), 12).collect()))
    assert got == repeats(rows, 12)


def test_rows_with(spark, monkeypatch):
    monkeypatch.setattr(common, "FEW", 2)
    rows = spark.createDataFrame([(k, i) for i, k in enumerate([1] * 5 + [2] * 2 + [3] + [4] * 9)], "k long, i long")
    found = rows.groupBy("k").agg(F.count("*").alias("n")).filter("k <> 4")
    assert sorted(r["i"] for r in common.rows_with(rows, found, ["k"]).collect()) == list(range(8))
    assert common.rows_with(rows, found.filter("n > 99"), ["k"]).count() == 0


def kept_lines(rows):
    key = lambda x: x.strip(" \t\n\x0b\f\r").translate(LOW)
    held = defaultdict(set)
    for d, t in rows:
        for x in (t or "").split("\n"):
            held[key(x)].add(d)
    out = []
    for d, t in rows:
        all_ = (t or "").split("\n")
        kept = [x for x in all_ if len(key(x)) < 10 or len(held[key(x)]) < 2 or min(held[key(x)]) == d]
        out.append((d, "\n".join(kept), len(all_), len(all_) - len(kept)))
    return sorted(out)


def line_rows():
    rng = random.Random(1)
    lines = ["A long enough line", "  a LONG enough line\t", "short", "", "é" * 10, "another line that repeats", "ÀÉ is not lowered here", "àé is not lowered here"]
    return [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 6)))) for i in range(40)] + [(40, None), (41, "")]


def test_drop_repeated_lines(spark):
    rows = line_rows()
    assert sorted(map(tuple, line_dedup.drop_repeated_lines(frame(spark, rows)).collect())) == kept_lines(rows)
    assert line_dedup.drop_repeated_lines(spark.createDataFrame([], S)).count() == 0


def test_line_index_is_reversible(spark):
    rows = line_rows()
    a, b = rows[:20], rows[20:]
    index = line_dedup.LineIndex(spark, 3)
    index.insert(spark.createDataFrame(a, S))
    index.insert(spark.createDataFrame(b, S))
    assert sorted(map(tuple, index.apply(spark.createDataFrame(rows, S)).collect())) == kept_lines(rows)
    index.delete(spark.createDataFrame([(d,) for d, _ in a], "doc_id long"))
    assert sorted(map(tuple, index.apply(spark.createDataFrame(b, S)).collect())) == kept_lines(b)
    index.insert(spark.createDataFrame(a, S))
    assert sorted(map(tuple, index.apply(spark.createDataFrame(rows, S)).collect())) == kept_lines(rows)


def test_line_index_grows_and_is_saved(spark, tmp_path):
    rows = [(i, f"a line that all have\na line of number {i // 2}\nand one of number {i} alone") for i in range(60)]
    a, b, c = rows[:5], rows[5:40], rows[40:]
    index = line_dedup.LineIndex(spark, 1, keys_per_shard=8)
    for i, part in enumerate((a, b)):
        index.insert(spark.createDataFrame(part, S))
        index.save(str(tmp_path / str(i)))
        index = line_dedup.LineIndex.load(spark, str(tmp_path / str(i)))
    assert index.shards > 1 and index.keys_per_shard == 8
    kept = index.counts.groupBy("shard").agg(F.collect_list("key_a").alias("keys")).join(index.filters, "shard").collect()
    assert sum(len(r["keys"]) for r in kept) == index.counts.count() > 8
    assert all(line_dedup.CuckooFilter.from_bytes(bytes(r["buckets"])).contains(np.array(r["keys"])).all() for r in kept)
    index.delete(spark.createDataFrame([(d,) for d, _ in a], "doc_id long"))
    index.insert(spark.createDataFrame(c, S))
    assert sorted(map(tuple, index.apply(spark.createDataFrame(b + c, S)).collect())) == kept_lines(b + c)
    with pytest.raises(Exception):
        index.save(str(tmp_path / "0"))
    empty = line_dedup.LineIndex(spark, 1)
    empty.save(str(tmp_path / "empty"))
    again = line_dedup.LineIndex.load(spark, str(tmp_path / "empty"))
    again.insert(spark.createDataFrame(a, S))
    assert sorted(map(tuple, again.apply(spark.createDataFrame(a, S)).collect())) == kept_lines(a)


def test_line_index_keeps_keys_that_share_a_fingerprint(spark):
    import numpy as np

    lines = spark.range(120_000).select(F.concat(F.lit("a long line, number "), "id").alias("line")).withColumn("key", F.xxhash64("line")).collect()
    mark, one, two = line_dedup.CuckooFilter.sized(line_dedup.KEYS_PER_SHARD)._place(np.array([r["key"] for r in lines]))
    seen, pair = {}, None
    for i, place in enumerate(zip(mark.tolist(), np.minimum(one, two).tolist())):
        if place in seen:
            pair = lines[seen[place]]["line"], lines[i]["line"]
            break
        seen[place] = i
    assert pair
    index = line_dedup.LineIndex(spark, 1)
    index.insert(spark.createDataFrame([(1, pair[0])], S))
    index.insert(spark.createDataFrame([(2, pair[1])], S))
    index.delete(spark.createDataFrame([(1,)], "doc_id long"))
    index.insert(spark.createDataFrame([(3, pair[1])], S))
    assert [(r["n_docs"], r["keeper"]) for r in index.counts.collect()] == [(2, 2)]
    rows = [(2, pair[1]), (3, pair[1])]
    assert sorted(map(tuple, index.apply(spark.createDataFrame(rows, S)).collect())) == kept_lines(rows)


def test_cuckoo_filter_misses_nothing():
    import numpy as np

    keys = np.unique(np.random.default_rng(0).integers(-(2**62), 2**62, 30_000))
    f = line_dedup.CuckooFilter(1 << 12)  # too small: the overflow takes the rest
    f.insert(keys)
    f = line_dedup.CuckooFilter.from_bytes(f.to_bytes())
    assert f.contains(keys).all()
    f.delete(keys[:1000])
    assert f.contains(keys[1000:]).all()


def stats(t):
    t = t or ""
    w, lines = words(t), [x for x in t.split("\n") if words(x)]
    tri = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    again = {j for i in range(len(w) - 2) if tri[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(again)


def test_quality_rules(spark):
    rng = random.Random(2)
    rows = corpus()
    for i in range(100, 400):
        w = [f"word{rng.randrange(5000)}" for _ in range(80)]
        rows.append((i, " ".join(x + "%%" * (i % 3 == 0) for x in w)))
    labels = spark.createDataFrame([(i, 0 if i % 3 == 0 else 1) for i in range(100, 400)] + [(None, 0), (7, None)], "doc_id long, quality int")
    got = quality_rules.judge(frame(spark, rows), labels).collect()
    for r, (d, t) in zip(sorted(got, key=lambda r: r["doc_id"]), sorted(rows)):
        n, *_, rep = s = stats(t)
        assert tuple(r)[1:6] == s and r["base_failed"] == (n < 50 or 100 * rep > 50 * n), d
        if d >= 100 and not r["base_failed"]:
            assert r["kept"] == (d % 3 != 0)
        assert r["kept"] <= (not r["base_failed"])
    kept = quality_rules.keep_good(frame(spark, rows), labels)
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] >= 100) == sorted(r["doc_id"] for r in got if r["kept"] and r["doc_id"] >= 100)
    bare = quality_rules.judge(frame(spark, rows), labels.limit(0)).collect()
    assert all(r["kept"] == (not r["base_failed"]) for r in bare)


def test_packing(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(f"w{rng.randrange(9999)}" for _ in range(rng.choice([0, 1, 9, 30, 64, 130]))), "hot" if i % 3 else f"s{i % 5}") for i in range(300)]
    rows += [(300 + i, rows[5][1] or "x y", "hot") for i in range(30)] + [(None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = packing.pack(df, capacity=64, shard_pieces=100).collect()
    size, text = Counter(), {d: words(t) for d, t, _ in rows}
    source, bins, pieces = {d: s for d, _, s in rows}, defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["n_words"]))
        if r["bin_id"] is None:
            assert r["n_words"] == 0
            continue
        size[r["bin_id"]] += r["n_words"]
        bins[r["bin_id"]].append(r["doc_id"])
    assert max(size.values()) <= 64
    for d, w in text.items():
        assert sum(n for *_, n in pieces[d]) == len(w)
        assert sorted(s for _, s, n in pieces[d] if n) == list(range(0, len(w), 64))
    for b in bins.values():
        assert len({tuple(text[d]) for d in b}) == len(b)
        assert max(Counter(source[d] for d in b).values()) <= packing.PER_SOURCE


def best_fit(pieces, capacity, per_source):
    """Bins by trying every open one: the tightest that is compatible, of equal ones the oldest."""
    bins, out = [], []
    for size, cluster, source in pieces:
        fit = [(capacity - b["n"], i) for i, b in enumerate(bins) if b["n"] + size <= capacity and b["n"] < capacity and cluster not in b["c"] and b["s"][source] < per_source]
        i = min(fit)[1] if fit else len(bins)
        if not fit:
            bins.append({"n": 0, "c": set(), "s": Counter()})
        bins[i]["n"] += size
        bins[i]["c"].add(cluster)
        bins[i]["s"][source] += 1
        out.append(i)
    return out


def test_best_fit_against_every_bin():
    rng = random.Random(4)
    for _ in range(30):
        pieces = [(rng.randint(1, 30), rng.randrange(40), rng.randrange(4)) for _ in range(200)]
        bins = packing.Bins(40, 2)
        assert [bins.put(*p)[0] for p in pieces] == best_fit(pieces, 40, 2)


def test_packing_of_repeated_long_and_empty_rows(spark):
    five = " ".join(f"w{i % 91}" for i in range(5000))
    rows = [(1, five, "a"), (1, five, "a"), (None, five, None), (None, five, None), (2, "short", "a"), (2, "short", "a"), (3, None, "b"), (3, " ", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("bin", F.lit(1)).withColumn("copies", F.lit(1))
    got = packing.pack(df).collect()
    held = defaultdict(int)
    for r in got:
        if r["bin_id"] is not None:
            held[r["bin_id"]] += r["n_words"]
    assert max(held.values()) <= packing.CAPACITY and sum(held.values()) == 4 * 5000 + 2
    assert sum(n == packing.CAPACITY for n in held.values()) == 8 and sum(r["bin_id"] is None for r in got) == 2 and len(got) == 4 * 3 + 2 + 2
    assert packing.pack(df.limit(0)).count() == 0 and packing.pack(df.drop("source")).count() == len(got)


def test_best_fit_takes_the_tightest_compatible_bin():
    b = packing.Bins(10, 1)
    assert [b.put(7, "a", "x"), b.put(8, "b", "y"), b.put(2, "c", "z")] == [(0, 0), (1, 0), (1, 1)]
    assert b.put(3, "d", "x") == (2, 0)  # bin 0 has the source
    assert b.put(3, "a", "q") == (2, 1)  # bin 0 has the cluster
    assert b.put(3, None, None) == (0, 1)


def test_decontamination(spark):
    rng = random.Random(6)
    vocab = [f"v{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(15, 50)))) for i in range(12)] + [(99, None), (98, " ... ")]
    docs, dirty = [], set()
    for d in range(120):
        w = [rng.choice(vocab) for _ in range(rng.choice([20, 90, 300]))]
        if d % 5 == 0:
            i = d // 5 % 12
            t = items[i][1].split()
            if d % 2:
                t[1] = "changed"
            w[7:7] = [x.upper() + "!!" for x in t]
            dirty.add((d, i))
        docs.append((d, " ".join(w)))
    docs += [(200, None), (201, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.flag(frame(spark, docs), bench).collect()
    assert {(r["doc_id"], i) for r in got for i in r["item_ids"]} == dirty
    assert len(got) == len(docs) and all(r["contaminated"] == bool(r["item_ids"]) for r in got)
    assert decontaminate.keep_clean(frame(spark, docs), bench).count() == len(docs) - len(dirty)
    assert not any(r["contaminated"] for r in decontaminate.flag(frame(spark, docs), bench.limit(0)).collect())


def test_decontamination_recall_against_all_pairs(spark):
    """Items told again with words left out, changed and put in: what a common subsequence over all pairs of item and text finds."""
    rng = random.Random(12)
    vocab = [f"v{int(rng.paretovariate(0.4)) % 3000}" for _ in range(20_000)]
    draw = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(i, draw(rng.randint(8, 70))) for i in range(40)]
    docs = []
    for d in range(160):
        i, keep = d % 40, rng.choice([0.5, 0.7, 0.85, 1.0])
        told = [w for x in items[i][1] for w in ([x] if rng.random() < keep else draw(rng.randint(0, 2)))]
        docs.append((d, draw(rng.randint(0, 80)) + told + draw(rng.randint(0, 80))))
    name = {w: k for k, w in enumerate(sorted({w for _, t in items + docs for w in t}))}
    num = lambda t: [name[w] for w in t]
    want, strict = set(), set()
    for d, t in docs:
        for i, x in items:
            n = len(x)
            # a leak in some stretch of three halves of the item's words, and one in the whole text
            if any(decontaminate.leaks(decontaminate.common_subsequence(num(x), num(t[a : a + n * 3 // 2])))[0] for a in range(0, len(t), max(1, n // 8))):
                strict.add((d, i))
            if sum(decontaminate.common_subsequence(num(x), num(t))) >= decontaminate.PART * n:
                want.add((d, i))  # no leak has less
    text = lambda rows: [(i, " ".join(w)) for i, w in rows]
    got = decontaminate.flag(spark.createDataFrame(text(docs), S), spark.createDataFrame(text(items), "item_id long, text string")).collect()
    found = {(r["doc_id"], i) for r in got for i in r["item_ids"]}
    assert found <= want and len(strict) > 60 and len(found & strict) >= 0.95 * len(strict)


def test_decontamination_of_odd_tables(spark):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa")], "item_id long, text string")
    hit = "word " * 50_000 + "alpha beta gamma delta epsilon zeta eta theta iota kappa" + " word" * 50_000
    df = spark.createDataFrame([(1, hit), (1, hit), (None, hit), (None, None)], S).withColumn("row", F.lit("x")).withColumn("slot", F.lit(1))
    got = decontaminate.flag(df, bench).collect()
    assert sorted(r["contaminated"] for r in got) == [False, True, True, True]
    assert decontaminate.flag(df.limit(0), bench).count() == 0 and decontaminate.keep_clean(df, bench).count() == 1


def test_decontamination_of_long_and_short_items(spark):
    """A passage's cosine with a long item is low, and so is that of a full passage with a short item."""
    rng = random.Random(8)
    vocab = [f"v{i}" for i in range(3000)]
    draw = lambda n: [rng.choice(vocab) for _ in range(n)]
    long, middle, short = draw(600), draw(120), ["common", "words", "only"]
    part = [x if i % 5 < 3 or i >= 96 else f"other{i}" for i, x in enumerate(middle)]
    docs = [(1, long), (2, draw(50) + long + draw(50)), (3, draw(40) + part + draw(40)), (4, draw(30) + short + draw(30)), (5, draw(300)), (6, long[:200]), (7, ["common"] + draw(30) + ["only"])]
    docs += [(d, ["common", f"r{d}", "words", f"s{d}", "only"][d % 5 :: 2][:1] + draw(20)) for d in range(10, 60)]
    items = [(0, long), (1, middle), (2, short)]
    text = lambda rows: [(i, " ".join(w)) for i, w in rows]
    got = decontaminate.flag(spark.createDataFrame(text(docs), S), spark.createDataFrame(text(items), "item_id long, text string")).collect()
    assert {r["doc_id"]: r["item_ids"] for r in got if r["contaminated"]} == {1: [0], 2: [0], 3: [1], 4: [2]}


def test_common_subsequence():
    assert decontaminate.common_subsequence([1, 2, 3, 4], [9, 1, 3, 4, 2]) == [True, False, True, True]
    assert decontaminate.leaks([True] * 8 + [False] * 2)[0] and not decontaminate.leaks([True] * 6 + [False] * 4)[0]


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body><header><h1>Site</h1></header><nav><ul><li><a>Home</a></ul></nav>
<div class="cookie-notice">Cookies!</div><div class="ad">buy</div>{main}<aside>side</aside><div id="comments"><p>first!</p></div><form><p>mail</p></form><footer>&copy; x</footer></body></html>"""


def test_main_text(spark):
    rows = []
    for i in range(8):
        article = f"<article><h1>Head {i}</h1><p>All rights to the host</p><p><b>one&amp;two {i}<br><p>  three\n&lt;{i}&gt; </p><div class='share'>tweet</div><ul><li>a{i}<li>b</ul></article>"
        rows.append((i, f"http://h.example/{i}?x", PAGE.format(main=article)))
    rows += [(20, "http://one.example/", PAGE.format(main="<main><p>alone</p></main>")), (21, None, None), (22, "odd", ""), (23, "odd", "<p>plain &eacute;")]
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1))).collect()}
    for i in range(8):  # an article keeps what all pages of the host have too
        assert got[i][0] == f"Head {i}\nAll rights to the host\none&two {i}\nthree <{i}>\na{i}\nb"
    assert got[20] == ("alone", 5) and got[21] == ("", 0) and got[22] == ("", 0) and got[23] == ("plain é", 7)


def test_main_text_template_is_confirmed_by_all_pages(spark):
    page = lambda body: f"<html><body>{body}</body></html>"
    big = "".join(f"<div><p>x{i}</p></div>" for i in range(300))
    rows = [(i, "http://often.example/", page(f"<p>once in three</p><p>head</p><p>own {i}</p>" if i % 3 else f"<p>head</p><p>own {i}</p>")) for i in range(60)]
    rows += [(100 + i, "http://big.example/", page(f"<p>same</p><p>own {i}</p>{big.replace('x', f'x{i}-')}")) for i in range(6)]
    rows += [(200 + i, "http://art.example/", page(f"<article><p>same</p><p>own {i}</p></article>")) for i in range(6)]
    rows += [(300 + i, "http://few.example/", page(f"<p>same</p><p>own {min(i, 3)}</p><!-- {i} -->")) for i in range(80)]
    got = {r["page_id"]: r["text"].split("\n") for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == (["once in three"] if i % 3 else []) + [f"own {i}"] for i in range(60))
    assert all(got[100 + i][:2] == [f"own {i}", f"x{i}-0"] for i in range(6))
    assert all(got[200 + i] == ["same", f"own {i}"] for i in range(6))
    assert all(got[300 + i] == [f"own {min(i, 3)}"] for i in range(80))


@pytest.mark.parametrize("body,text", [
    ('<div class="content has-sidebar"><article><p>a</p></article></div>', "a"),
    ("<form action=x><div><p>all of the page</p></div><input><button>go</button></form>", "all of the page"),
    ("<form><nav>menu</nav><article><h1>t</h1><p>b</p></article></form>", "t\nb"),
    ("<article><p>one <![foo[ x ]]> two</p><![if IE]><p>three</p><![endif]><!weird ><?php x ?></article>", "one two\nthree"),
    ('<article><p>see <span class="related">this</span> and <label>that</label></p><div class="ad">buy</div><div class="comment-list">first</div></article>', "see this and that"),
    ("<article>" + "<div>" * 1500 + "deep" + "</div>" * 1500 + "</article>", "deep"),
    ("<article>" + "<p>x</p>" * 5000 + "</article>", "\n".join(["x"] * 5000)),
    ("<article><p>caf&eacute; &#x41;&bogus; &amp", "café A&bogus; &"),
    ("<p></b></article></body>a<table><tr><td>b<td>c", "a\nb\nc"),
    # ids that come from headings, and classes that only begin like a menu's, are the article's own
    ('<article><h2 id="related-work">Related work</h2><p>x</p><h2 id="search-algorithms">S</h2><h3 id="comments">Comments</h3><section id="comments-on-the-new-law"><p>law</p></section><p class="share-price">9.5</p><div class="search-results-table">t</div></article>', "Related work\nx\nS\nComments\nlaw\n9.5\nt"),
    # reader comments and teasers go, wherever they stand and though they are articles
    ('<article><p>text</p></article><section id="comments"><article class="comment-body"><p>Reader says hi</p></article></section>', "text"),
    ('<article><p>text</p><article class="comment"><p>Reader says hi</p></article><section id="comments"><p>hi</p></section></article>', "text"),
    ('<div class="related"><article><p>teaser</p></article></div><article><p>text</p></article><div class="related-posts"><article>teaser</article></div>', "text"),
    ('<div class="widget-wrapper"><article class="comment">only</article></div>', "only"),
    # inline adverts and buttons go
    ('<article><p>one <span class="advert">buy</span> two <a class="share-button" href="#">Share</a> <a class="searchable">three</a></p></article>', "one two three"),
    # comments end as in browsers; one that does not is the rest of the page
    ("<article><p>a</p><!-->b<!-- x --!>c</article><!-- <p>not text</p>", "a\nbc"),
    ('<article><p>a</p><div class="sideBar">s</div><div class="site-header">h</div><div class="page_footer">f</div><div class="ad ad-slot-1">x</div><div class="newsletter-signup-form">x</div></article>', "a"),
])
def test_main_text_of_one_page(body, text):
    assert "\n".join(t for _, t in html_text.blocks(html_text.parse(f"<html><body>{body}"))) == text


def test_wrapper_decides_on_pages_with_articles_too(spark):
    """Articles that are not what varies most over a host's pages are teasers; a few pages are no host, and where the article is the slot it stays whole."""
    teaser = lambda i, w=9: f"<html><body><p>Our site</p><section class=t1><article><p>Read of {i}</p></article></section><div class=x2><h1>Head {i}</h1><p>Same line</p><p>{'text of page ' * w}{i}</p></div><p>Same end</p></body></html>"
    real = lambda i: f"<html><body><div class=x2><p>Most read {i % 3}</p></div><article><p>Same line</p><p>{'text of page ' * 9}{i}</p></article></body></html>"
    rows = [(i, "http://teaser.example/", teaser(i)) for i in range(30)] + [(40, "http://teaser.example/", "<article><p>other shape</p></article>"), (41, "http://teaser.example/", None)]
    rows += [(100 + i, "http://real.example/", real(i)) for i in range(30)] + [(200 + i, "http://few.example/", teaser(i)) for i in range(3)] + [(300 + i, "http://even.example/", teaser(i, 0)) for i in range(9)]
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert len(got) == len(rows) and all(n == len(t) for t, n in got.values())
    assert all(got[i][0] == f"Head {i}\n{'text of page ' * 9}{i}" for i in range(30)) and got[40][0] == "other shape" and got[41][0] == ""
    assert all(got[100 + i][0] == f"Same line\n{'text of page ' * 9}{i}" for i in range(30))
    assert all(got[200 + i][0] == f"Read of {i}" for i in range(3)) and all(got[300 + i][0] == f"Read of {i}" for i in range(9))


def test_wrapper_finds_the_container_of_the_slots(spark):
    page = lambda i, deep="": f"<html><body><div class=top><p>Our site</p></div><div class=wrap>{deep}<div class=x1><a href=/>go {i}</a> <a href=/>on {i}</a></div><div class=x2><h2>Head {i}</h2><p>{'text of page ' * 9}{i}</p><p>Sign here</p></div></div><div class=x3>{i} hits</div></body></html>"
    rows = [(i, "http://slots.example/", page(i)) for i in range(12)] + [(50 + i, "http://deep.example/", page(i, "<b>" * 300 + "</b>" * 300)) for i in range(5)] + [(90, "http://slots.example/", "<p>other shape</p>"), (91, "http://slots.example/", page(3))]
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    df = spark.createDataFrame(rows, empty.schema)
    got = {r["page_id"]: r["text"] for r in html_text.main_text(df).collect()}
    own = lambda i: f"Head {i}\n{'text of page ' * 9}{i}"
    assert all(got[i] == own(i) for i in range(12)) and all(got[50 + i] == own(i) for i in range(5))
    assert got[90] == "other shape" and got[91] == own(3)
    assert html_text.main_text(empty).count() == 0


def test_simple_tree_matching():
    a, b = html_text.parse("<div><p>a</p><ul><li>b</li></ul></div>"), html_text.parse("<div><p>x</p><p>y</p><ul><li>b</li><li>c</li></ul></div>")
    assert html_text.match(a, b) == 5


def test_pipeline_stages(spark):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "best-fit packing"]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in corpus(n=30)], "doc_id long, text string, lang string, source string, n_chars long")
    lines = corpus_pipeline.lines(spark, docs, "")
    assert lines.columns == docs.columns and lines.count() == docs.count()
    packed = corpus_pipeline.packed(spark, docs, "")
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in docs.collect()}
    for stage in (corpus_pipeline.lines, corpus_pipeline.near_duplicates, corpus_pipeline.packed):
        assert stage(spark, docs.limit(0), "").count() == 0
    one = corpus_pipeline.near_duplicates(spark, docs, "")
    assert one.columns == docs.columns
    assert sorted(r["doc_id"] for r in one.collect()) == sorted(d for d, (_, c, _) in linked(corpus(n=30), 5, 4, 5).items() if d == c)


def test_hash_of_kept_text(spark):
    r = spark.createDataFrame([("é",)], "t string").select(F.sha2("t", 256)).first()[0]
    assert r == hashlib.sha256("é".encode()).hexdigest()


def test_pipeline_run_is_its_stages(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    verdicts = {r["doc_id"]: r["kept"] for r in quality_rules.judge(docs, spark.read.parquet(f"{sf}/labels.parquet")).collect()}
    good = corpus_pipeline.quality(spark, docs, sf)
    assert good.columns == docs.columns
    left = {r["doc_id"]: r["text"] for r in good.collect()}
    assert set(left) == {d for d, k in verdicts.items() if k}
    lines = {d: t for d, t, _, _ in kept_lines(sorted(left.items()))}
    single = {d for d, (_, c, _) in linked(sorted(lines.items()), 5, 4, 5).items() if d == c}
    rows = [(d, lines[d]) for d in sorted(single)]
    flagged = decontaminate.flag(spark.createDataFrame(rows, S), spark.read.parquet(f"{sf}/benchmark.parquet"))
    clean = {r["doc_id"] for r in flagged.collect() if not r["contaminated"]}
    out = corpus_pipeline.run(spark, sf).collect()
    assert {r["doc_id"] for r in out} == clean and sum(r["n_words"] for r in out) == sum(len(words(lines[d])) for d in clean)


def test_decontamination_space_is_fitted_on_all_texts(spark):
    """The space is that of an exact decomposition over every text and every item: more of both than 2,048."""
    rng = np.random.default_rng(3)
    topics = [[f"t{k}w{i}" for i in range(12)] for k in range(6)]
    texts = [" ".join(rng.choice(topics[d % 6], 8)) for d in range(5000)]
    items = [" ".join(rng.choice(topics[i % 2], 5)) for i in range(3000)]
    both = [spark.createDataFrame([(x,) for x in t], "text string") for t in (texts, items)]
    bags = [decontaminate.bags(x) for x in both]
    idf, n = decontaminate.inverse_frequencies(bags[0])
    assert n == 5000
    at, v = decontaminate.latent_space(bags[0].withColumn("weight", F.lit(n**-0.5)).unionByName(bags[1].withColumn("weight", F.lit(3000**-0.5))), idf, 6)
    place, a = {x: i for i, x in enumerate(at.tolist())}, []
    for rows, weight in ((bags[0].collect(), n**-0.5), (bags[1].collect(), 3000**-0.5)):
        for r in rows:
            x = np.zeros(len(at))
            x[[place[s] for s in r["slots"]]] = np.array(r["counts"]) * idf[r["slots"]]
            a.append(x / np.linalg.norm(x) * weight)
    best = np.linalg.svd(np.array(a), compute_uv=False)[:6]
    assert ((np.array(a) @ v) ** 2).sum() > 0.98 * (best**2).sum() and np.allclose(v.T @ v, np.eye(6), atol=1e-6)
    assert decontaminate.word_vectors(bags[0], n, bags[1], 3000, idf)[list(at)].any(1).all()


def test_maps_of_long_sets_are_held_by_their_bytes():
    """As many rows as a task may hold, with large maps, are compared in parts; the pairs are those of all rows at once."""
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 1 << 13).astype(np.uint64)
    sets = [np.unique(np.append(base[i // 4 * 800 : i // 4 * 800 + 3000], np.uint64(i))) for i in range(24)]
    made = []
    rows = pa.record_batch({"sig": pa.array(np.repeat(np.arange(3000), 2)), "node": pa.array(np.arange(6000) % 24), "star": pa.array(np.arange(6000) % 24), "size": pa.array([len(sets[i % 24]) for i in range(6000)]), "bits": pa.array([ngram_join.bit_map(sets[i % 24]) for i in range(6000)], pa.binary())})
    for batch in ngram_join._bucket_pairs(4, 5)(iter([rows])):
        made.append(set(zip(*(c.to_pylist() for c in batch.columns), strict=True)))
    assert len(made) > 1 and set().union(*made) == {(i, i + 1) for i in range(0, 24, 2)}


def test_decontamination_space_is_made_in_little_memory(spark):
    """The driver holds the matrices of the space in single precision, and no decomposition of a tall one."""
    rows = [(" ".join(f"w{d * 40 + i}" for i in range(40)),) for d in range(4000)]
    bags = decontaminate.bags(spark.createDataFrame(rows, "text string").repartition(4))
    idf, n = decontaminate.inverse_frequencies(bags)
    weighed = bags.withColumn("weight", F.lit(n**-0.5))
    tracemalloc.start()
    at, v = decontaminate.latent_space(weighed, idf)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(at) > 55_000 and v.shape[1] == decontaminate.RANK and peak < 120e6


@pytest.mark.parametrize("longest", [3, 200])
def test_weighted_sums(longest):
    rng = np.random.default_rng(4)
    bounds = np.append(0, np.cumsum(rng.integers(0, longest + 1, 300)))
    of, weights, rows = rng.integers(0, 50, bounds[-1]), rng.random(bounds[-1]).astype(np.float32), rng.random((50, 7)).astype(np.float32)
    want = [(weights[a:b, None] * rows[of[a:b]]).sum(0) for a, b in zip(bounds, bounds[1:])]
    assert np.allclose(decontaminate._weighted_sums(bounds, weights, of, rows), want, rtol=1e-4)


def test_wrapper_is_proposed_by_all_pages(spark):
    """A node that the pages of least digest do not have, and one that most of a host's pages with articles have but not those of least hash, are known for the host's."""
    text = "text of page " * 9
    plain = lambda i, line: f"<html><body><p>Our site</p>{line}<p>{text}{i}</p></body></html>"
    teaser = lambda i, end: f"<html><body><p>Our site</p><section class=t1><article><p>Read of {i}</p></article></section><div class=x2><h1>Head {i}</h1><p>{text}{i}</p></div>{end}</body></html>"
    digest = lambda i, s: hashlib.md5(f"{s}{text}{i}".encode()).hexdigest()
    low = set(sorted(range(200), key=lambda i: digest(i, "Our site\n"))[:8])
    line = "<p>Sign here</p>"
    rows = [(i, "http://plain.example/", plain(i, "" if i in low else line)) for i in range(200)]
    # which pages with the node stay behind those without depends on the others' digests, so count on the digests with the node
    first = sorted([digest(i, "Our site\n") if i in low else digest(i, "Our site\nSign here\n") for i in range(200)])[:8]
    assert sum(digest(i, "Our site\n") in first for i in low) > 4  # so that node is not in most of the least eight pages
    # on the least pages by hash the text is in another container
    frame_of = lambda r: spark.createDataFrame(r, "page_id long, url string, html string")
    other = lambda i: teaser(i, "").replace("<article>", "<article><p>" + "own text " * 90 + f"{i}</p>")
    made = [(1000 + i, "http://teaser.example/", teaser(i, "")) for i in range(160)]
    odd = sorted((r["h"], r["i"]) for r in frame_of([(i, "", other(i)) for i in range(4000)]).select(F.xxhash64("html").alias("h"), F.col("page_id").alias("i")).collect())[:8]
    made += [(3000 + k, "http://teaser.example/", other(i)) for k, (_, i) in enumerate(odd)]
    least = frame_of(made).orderBy(F.xxhash64("html")).limit(8)
    assert {r["page_id"] for r in least.collect()} == {3000 + k for k in range(8)}
    got = {r["page_id"]: r["text"] for r in html_text.main_text(frame_of(rows + made)).collect()}
    assert len(got) == len(rows) + len(made) and all(got[i] == f"{text}{i}" for i in range(200))
    assert all(got[1000 + i] == f"Head {i}\n{text}{i}" for i in range(160))


def test_pages_are_shuffled_once_and_only_of_open_hosts(spark, monkeypatch):
    """Html travels once to the parts that propose a wrapper, and not at all from hosts whose outlines agree with their articles."""
    plans, table = {}, html_text.Scratch.table

    def seen(self, df, name):
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        plans[name] = df._jdf.queryExecution().explainString(mode)
        return table(self, df, name)

    monkeypatch.setattr(html_text.Scratch, "table", seen)
    line = lambda i: " ".join(f"w{i}x{k}" for k in range(30))
    usual = [(i, "http://usual.example/", f"<body><nav>Menu</nav><article><p>{line(i)}</p></article><p>Foot</p></body>") for i in range(24)]
    frame_of = lambda rows: spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_text.main_text(frame_of(usual)).collect()}
    assert got == {i: line(i) for i in range(24)} and "proposed" not in plans
    plain = [(100 + i, "http://plain.example/", f"<body><p>Our site</p><p>{line(i)}</p><script>{'x' * i}</script></body>") for i in range(24)]
    got = {r["page_id"]: r["text"] for r in html_text.main_text(frame_of(usual + plain + plain[:3])).collect()}
    assert got == {i: line(i) for i in range(24)} | {100 + i: line(i) for i in range(24)}
    moved = [x for x in plans["proposed"].split("\n\n") if re.match(r"\(\d+\) Exchange", x.strip()) and re.search(r"\b(html|packed)#", x)]
    assert len(moved) == 1


def test_packed_trees_are_the_same():
    html = '<body id=b><div class="a c"><p>x &amp; "y"<br>\ud800 é中</p><script>1 < 2</script><svg><g>t</g></svg></div>-1<article><h1>A</h1></article></body>'
    tree = html_text.parse(html)
    back = html_text.unpack(html_text.pack(tree))
    assert html_text._prepare(tree, shapes := {}) == html_text._prepare(back, shapes) and tree.shape == back.shape and tree.digest == back.digest
    assert list(html_text._blocks(tree, [tree])) == list(html_text._blocks(back, [back])) and html_text.blocks(tree) == html_text.blocks(back)


def test_shared_shapes_match_as_all_pairs_do():
    """Tables kept for two shapes and children of equal shape at the end give the most nodes, as the plain recursion does."""
    rng = random.Random(5)
    grow = lambda d: "".join(f"<{t}>{grow(d - 1) if d else rng.choice('xyz')}</{t}>" for t in rng.choices(["div", "ul", "section"], k=rng.randint(0, 3)))

    def most(a, b):
        if html_text._label(a) != html_text._label(b):
            return 0
        x, y = ([c for c in n.children if c.tag != "#text"] for n in (a, b))
        m = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i, p in enumerate(x):
            for j, q in enumerate(y):
                m[i + 1][j + 1] = max(m[i][j + 1], m[i + 1][j], m[i][j] + most(p, q))
        return m[-1][-1] + 1

    for _ in range(60):
        a, b = html_text.parse(grow(4)), html_text.parse(grow(4))
        pairs = []
        assert html_text.match(a, b, pairs) == most(a, b) == len(pairs)
        assert all(html_text._label(p) == html_text._label(q) for p, q in pairs) and len({id(p) for p, _ in pairs}) == len({id(q) for _, q in pairs}) == len(pairs)
