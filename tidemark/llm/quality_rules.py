"""Text statistics and learned decision lists, in Spark expressions only.

The list is learned by sequential covering. A rule is a conjunction of thresholds on statistics. It is grown on
two thirds of the labelled rows, one threshold at a time, by information gain; then thresholds are dropped again from its end
while that helps on the last third. Rules are added while they are precise there, and each takes the rows
that it covers out of the further search. Every step is one grouped count over the labelled rows' bins; what reaches the driver is a
count for each statistic, bin and label.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, Scratch

SYMBOLS = "#*$%&|<>"
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Bins of each statistic, most rules, most thresholds in a rule, and the least precision and support of a rule.
BINS, MAX_RULES, MAX_TERMS, PRECISION, SUPPORT = 32, 12, 4, 0.95, 5


def with_stats(df: DataFrame, text: Column, prefix: str = "") -> DataFrame:
    """``df`` with the text statistics as further columns of the given prefix, all long.

    n_words, word_chars (code points in words), n_symbols, n_dup_lines (lines with a word, equal to an
    earlier line), n_repeat_words (words in three-word windows that the text holds twice or more), n_lines (lines with a word),
    n_upper (A-Z), n_marks (! and ?). Null text counts as empty.
    """
    p = prefix
    text = F.coalesce(text.cast("string"), F.lit(""))
    w, h, s = F.col(f"{p}w"), F.col(f"{p}h"), F.col(f"{p}s")
    bare = F.translate(text, SPACES, "")
    count = lambda chars: F.char_length(text) - F.char_length(F.translate(text, chars, ""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    before = df.columns
    df = df.withColumns({
        f"{p}w": F.filter(F.split(text, r"[\x20\x09-\x0D]+", -1), lambda x: x != ""),
        f"{p}l": lines,
        f"{p}word_chars": F.char_length(bare).cast("long"),
        f"{p}n_symbols": count(SYMBOLS).cast("long"),
        f"{p}n_upper": count("ABCDEFGHIJKLMNOPQRSTUVWXYZ").cast("long"),
        f"{p}n_marks": count("!?").cast("long"),
    })
    df = df.withColumns({
        f"{p}n_words": F.size(w).cast("long"),
        f"{p}n_lines": F.size(f"{p}l").cast("long"),
        f"{p}n_dup_lines": (F.size(f"{p}l") - F.size(F.array_distinct(f"{p}l"))).cast("long"),
        f"{p}h": F.when(F.size(w) >= 3, F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))),
    })
    # only texts that repeat a window need their windows sorted
    df = df.withColumn(f"{p}s", F.when(F.size(F.array_distinct(h)) < F.size(h), F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    again = F.filter(s, lambda x, i: F.get(s, i + 1)["h"].eqNullSafe(x["h"]) | ((i > 0) & F.get(s, i - 1)["h"].eqNullSafe(x["h"])))
    df = df.withColumn(f"{p}r", F.array_sort(F.transform(again, lambda x: x["i"])))
    r = F.col(f"{p}r")
    covered = F.aggregate(F.transform(r, lambda x, i: F.coalesce(F.least(F.lit(3), F.get(r, i + 1) - x), F.lit(3))), F.lit(0), lambda a, x: a + x)
    df = df.withColumn(f"{p}n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    return df.select(*(df[f"`{c}`"] for c in before), *(f"{p}{c}" for c in [*STATS, "n_lines", "n_upper", "n_marks"]))


def base_failed(prefix: str = "") -> Column:
    n, r = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (n < 50) | (100 * r > 50 * n)


def features(prefix: str = "") -> dict[str, Column]:
    """What rules speak about: rates, so that a rule holds for texts of every length."""
    c = lambda x: F.col(f"{prefix}{x}").cast("double")
    words = F.greatest(c("n_words"), F.lit(1.0))
    return {
        "words": c("n_words"),
        "chars_per_word": c("word_chars") / words,
        "symbols_per_word": c("n_symbols") / words,
        "repeated_words": c("n_repeat_words") / words,
        "repeated_lines": c("n_dup_lines") / F.greatest(c("n_lines"), F.lit(1.0)),
        "upper_case": c("n_upper") / F.greatest(c("word_chars"), F.lit(1.0)),
        "marks_per_word": c("n_marks") / words,
    }


@dataclass(frozen=True)
class Term:
    feature: str
    above: bool  # value > threshold, else value <= threshold
    bin: int
    threshold: float

    def holds(self, cols: dict[str, Column]) -> Column:
        return cols[self.feature] > self.threshold if self.above else cols[self.feature] <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


def _covers(rule: list[Term]) -> Column:
    out = F.lit(True)
    for t in rule:
        out = out & (F.col(t.feature) > t.bin if t.above else F.col(t.feature) <= t.bin)
    return out


def learn(labelled: DataFrame, target: str = "bad") -> list[list[Term]]:
    """An ordered list of rules for the rows whose boolean ``target`` is true, from the columns of :func:`features`.

    Without rows of both kinds the list is empty.
    """
    names = [c for c in features()]
    scratch = Scratch(labelled.sparkSession)
    # deciles and the like, over all labelled rows; equal values share a bin
    quantiles = labelled.agg(*(F.percentile_approx(c, [i / BINS for i in range(1, BINS)], 10000).alias(c) for c in names)).first()
    cuts = {c: sorted(set(quantiles[c] or [])) for c in names}
    bins = [sum((F.when(F.col(c) > t, 1).otherwise(0) for t in cuts[c]), F.lit(0)).alias(c) for c in names]
    part = F.when(F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(3)) == 0, "prune").otherwise("grow")
    rows = scratch.table(labelled.select(*bins, F.col(target).alias("bad"), part.alias("part")), "bins")

    def counts(df: DataFrame) -> dict:
        """(bad, good) of the rows at each feature and bin."""
        each = df.groupBy(*names, "bad").agg(F.count("*").alias("c"))
        flat = each.select("bad", "c", F.explode(F.array(*(F.struct(F.lit(c).alias("f"), F.col(c).alias("bin")) for c in names))).alias("x"))
        out: dict = {c: {} for c in names}
        for r in flat.groupBy("x.f", "x.bin", "bad").agg(F.sum("c").alias("c")).collect():
            out[r["f"]].setdefault(r["bin"], [0, 0])[0 if r["bad"] else 1] += r["c"]
        return out

    def score(df: DataFrame, rule: list[Term]) -> tuple[int, int]:
        r = df.filter(_covers(rule)).agg(F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n")).first()
        return r["p"], r["n"]

    left, rules = rows, []
    while len(rules) < MAX_RULES:
        grow, prune = left.filter("part = 'grow'"), left.filter("part = 'prune'")
        rule: list[Term] = []
        while len(rule) < MAX_TERMS:
            found = counts(grow.filter(_covers(rule)))
            total = [sum(b[k] for b in found[names[0]].values()) for k in (0, 1)]
            if not total[0] or not total[1]:
                break
            best, gain = None, 1e-9
            for c in names:
                p = n = 0
                for b in range(len(cuts[c])):
                    p, n = p + found[c].get(b, [0, 0])[0], n + found[c].get(b, [0, 0])[1]
                    for above, (x, y) in ((False, (p, n)), (True, (total[0] - p, total[1] - n))):
                        if x < SUPPORT:
                            continue
                        now = x * (math.log2(x / (x + y)) - math.log2(total[0] / sum(total)))
                        if now > gain:
                            best, gain = Term(c, above, b, cuts[c][b]), now
            if best is None:
                break
            rule.append(best)
        if not rule:
            break
        tried = [(score(prune, rule[:k]), k) for k in range(len(rule), 0, -1)]
        (p, n), k = max(tried, key=lambda x: ((x[0][0] - x[0][1]) / max(1, sum(x[0])), x[0][0]))
        if p < SUPPORT or p < PRECISION * (p + n):
            break
        rules.append(rule[:k])
        left = left.filter(~_covers(rule[:k]))
    return [_widen(labelled.filter(target), r) for r in rules]


def _widen(bad: DataFrame, rule: list[Term]) -> list[Term]:
    """Thresholds moved half way from their bin's edge to nearly all of the rows that the rule is for."""
    cols = {t.feature: F.col(t.feature) for t in rule}
    inside = F.lit(True)
    for t in rule:
        inside = inside & t.holds(cols)
    ends = [F.percentile_approx(t.feature, 0.01 if t.above else 0.99, 10000).alias(f"t{i}") for i, t in enumerate(rule)]
    far = bad.filter(inside).agg(*ends).first()
    return [t if far[i] is None else replace(t, threshold=(t.threshold + far[i]) / 2) for i, t in enumerate(rule)]


def verdict(rules: list[list[Term]], prefix: str = "") -> Column:
    """The list as one conditional expression: false from the first rule that holds, else true."""
    cols, out = features(prefix), F.when(base_failed(prefix), False)
    for rule in rules:
        every = rule[0].holds(cols)
        for t in rule[1:]:
            every = every & t.holds(cols)
        out = out.when(every, False)
    return out.otherwise(True)


def _labelled(stats: DataFrame, labels: DataFrame) -> DataFrame:
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).dropna().groupBy("doc_id").agg(F.min("quality").alias("q"))
    return stats.filter(~base_failed()).join(known, "doc_id").select("doc_id", *(v.alias(k) for k, v in features().items()), (F.col("q") == 0).alias("bad"))


def _stats(docs: DataFrame) -> DataFrame:
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return with_stats(texts, F.col("text")).drop("text")


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept.

    ``labels`` (doc_id, quality 0/1; 0 is bad) teach the list. Rows of it with nulls count for nothing, of several
    labels for one document the least holds. Base rules come first: below 50 words, or more than half of the words in repeated
    windows. Null, empty or blank text: zero counts, base_failed. A null doc_id stays null. Repeated rows come back as often as they came.
    Without labels only the base rules decide. Other columns are not read.
    """
    stats = Scratch(docs.sparkSession).table(_stats(docs), "stats")
    rules = learn(_labelled(stats, labels))
    return stats.select("doc_id", *STATS, base_failed().alias("base_failed"), verdict(rules).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps, with all their columns, without a shuffle of texts."""
    ids = labels.select(F.col("doc_id").cast("long").alias("__tidemark_label")).dropna().distinct()
    taught = docs.join(ids, docs["doc_id"].cast("long") == F.col("__tidemark_label"), "left_semi")
    scratch = Scratch(docs.sparkSession)
    rules = learn(_labelled(scratch.table(_stats(taught), "stats"), labels))  # only labelled rows teach
    p = "__tidemark_"
    # the statistics are long expressions: a column that is not deterministic keeps the filter from repeating them
    judged = with_stats(docs, F.col("text"), p).withColumn(f"{p}row", F.monotonically_increasing_id())
    return judged.withColumn(f"{p}kept", F.coalesce(verdict(rules, p), F.lit(False))).filter((F.col(f"{p}row") >= 0) & F.col(f"{p}kept")).select(*(f"`{c}`" for c in docs.columns))
