"""The queries of this folder's operators with production parameters, and their SQL where it can express them."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, chat_format, decontaminate, html_text, language_id, license_scan, line_dedup, ngram_join, packing, pii, quality_rules, substring_dedup, whitening
from .common import LOWER, UPPER, documents


#: The setting that names a deployment's secret; without it, a word for demonstrations.
KEY_SETTING, DEMO_KEY = "spark.tidemark.pseudonymKey", "demonstration"
#: The setting that names the folder of tokenizer files, on every machine, and where it is otherwise.
TOKENIZERS_SETTING, TOKENIZERS = "spark.tidemark.tokenizers", "/opt/tokenizers"


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_sets(documents(spark, sf_dir), n=4, num=85, den=100, links=True)


def op2_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = spark.conf.get(KEY_SETTING, None)
    if key is None:
        warnings.warn(f"{KEY_SETTING} is not set: pseudonyms under the demonstration key can be reversed by anyone", stacklevel=2)
    return pii.pseudonymise(documents(spark, sf_dir), key=key or DEMO_KEY)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(documents(spark, sf_dir), width=35)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir)).withColumn("notices", F.array_join("notices", ","))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations 2k and 2k + 1 as chosen and rejected: the table has no pairs of its own."""
    out = chat_format.format_neighbours(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    ranges = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws("-", x["start"].cast("string"), x["end"].cast("string"))), ",")
    return out.withColumns({c: ranges(c) for c in ("chosen_spans", "rejected_spans")})


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.flag(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op9_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_repeated_lines(documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.report(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), most=4)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = spark.conf.get(TOKENIZERS_SETTING, TOKENIZERS)
    return alignment.report(documents(spark, sf_dir), f"{folder}/byte_bpe_50k.json", f"{folder}/piece_bpe_32k.model")


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.report(documents(spark, sf_dir))


QUERIES = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_pii_pseudonyms": op2_pii_pseudonyms,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_license_scan": op5_license_scan,
    "op6_quality_rules": op6_quality_rules,
    "op7_preference_format": op7_preference_format,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_html_main_text": op9_html_main_text,
    "op10_line_dedup": op10_line_dedup,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_token_alignment": op12_token_alignment,
    "op13_language_id": op13_language_id,
}

_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

def _spelled(column: str) -> str:
    for a, b in license_scan.EQUIVALENT:
        column = f"regexp_replace({column}, '\\b{a}\\b', '{b}', 'g')"
    return column


_LINES = "list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: trim(regexp_replace(replace(lower(x), chr(169), ' copyright '), '[^a-z0-9]+', ' ', 'g'))), lambda x: x <> '')"
_KEPT = f"list_filter(lines, lambda x: NOT regexp_matches(x, '{license_scan._NOTICE}'))"
_TEXTS = ", ".join("('{}', '{}')".format(t.replace("'", "''"), n) for n, t in license_scan.KNOWN)
_LONG = ", ".join(f"('{d}', '{n}')" for n, _, d in license_scan.LONG)
_SIDE = "string_agg('<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10), '' ORDER BY i) FILTER (WHERE side = {0} AND i > n_shared)"
_SPANS = "string_agg((z - length(text) - 8) || '-' || z, ',' ORDER BY i) FILTER (WHERE side = {0} AND i > n_shared AND role = 'assistant')"

ORACLE_SQL: dict[str, str] = {
    "op5_license_scan": f"""
        WITH short AS (SELECT license, coalesce(nullif(array_to_string({_KEPT}, ' '), ''), array_to_string(lines, ' ')) AS whole FROM (SELECT license, {_LINES} AS lines FROM (VALUES {_TEXTS}) t(text, license))),
        known AS (SELECT digest, min(license) AS license FROM (SELECT md5({_spelled('whole')}) AS digest, license FROM short UNION ALL VALUES {_LONG}) GROUP BY 1),
        l AS (SELECT doc_id, {_LINES} AS lines FROM documents),
        w AS (SELECT doc_id, lines, coalesce(array_to_string({_KEPT}, ' '), '') AS whole FROM l),
        d AS (SELECT doc_id, md5({_spelled('whole')}) AS digest, lines FROM w),
        e AS (SELECT doc_id, unnest(lines) AS line FROM l),
        n AS (SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS notices FROM (SELECT doc_id, md5({_spelled('line')}) AS digest FROM e) JOIN known USING (digest) GROUP BY 1)
        SELECT doc_id, digest, license, coalesce(notices, '') AS notices FROM d LEFT JOIN known USING (digest) LEFT JOIN n USING (doc_id)""",
    "op7_preference_format": f"""
        WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
        n AS (SELECT *, conv_id >> 1 AS pair_id, conv_id & 1 AS side, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM t),
        f AS (SELECT pair_id, min(i) - 1 AS n_shared FROM (SELECT coalesce(a.pair_id, b.pair_id) AS pair_id, coalesce(a.i, b.i) AS i,
                  a.role IS DISTINCT FROM b.role OR a.text IS DISTINCT FROM b.text AS differs
              FROM (SELECT * FROM n WHERE side = 0) a FULL JOIN (SELECT * FROM n WHERE side = 1) b ON a.pair_id = b.pair_id AND a.i = b.i) WHERE differs GROUP BY 1),
        s AS (SELECT pair_id, min(c) AS shorter FROM (SELECT pair_id, side, count(*) AS c FROM n GROUP BY 1, 2) GROUP BY 1),
        m AS (SELECT n.*, coalesce(n_shared, shorter) AS n_shared FROM n JOIN s USING (pair_id) LEFT JOIN f USING (pair_id)),
        p AS (SELECT *, sum(CASE WHEN i > n_shared THEN length(role) + length(text) + 13 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY i) AS z FROM m),
        g AS (SELECT pair_id, max(CASE side WHEN 0 THEN conv_id END) AS chosen, max(CASE side WHEN 1 THEN conv_id END) AS rejected, CAST(max(n_shared) AS bigint) AS n_shared,
                  string_agg('<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10), '' ORDER BY i) FILTER (WHERE side = 0 AND i <= n_shared) AS prompt,
                  {_SIDE.format(0)} AS c, {_SIDE.format(1)} AS r, {_SPANS.format(0)} AS cs, {_SPANS.format(1)} AS rs FROM p GROUP BY 1)
        SELECT pair_id, chosen, rejected, n_shared, coalesce(prompt, '') AS prompt, CASE WHEN chosen IS NOT NULL THEN coalesce(c, '') END AS chosen_text, CASE WHEN rejected IS NOT NULL THEN coalesce(r, '') END AS rejected_text,
               CASE WHEN chosen IS NOT NULL THEN coalesce(cs, '') END AS chosen_spans, CASE WHEN rejected IS NOT NULL THEN coalesce(rs, '') END AS rejected_spans FROM g""",
    "op4_substring_dedup": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        p AS (SELECT doc_id, unnest(range(1, len(w) - 33)) AS i, w FROM d WHERE len(w) >= 35),
        s AS (SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 34), ' ')) AS h FROM p),
        r AS (SELECT doc_id, i FROM s WHERE h IN (SELECT h FROM s GROUP BY h HAVING count(*) > 1)),
        c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM r),
        g AS (SELECT doc_id, list(i) AS gone FROM c GROUP BY doc_id),
        k AS (SELECT d.doc_id, len(w) AS n, coalesce(len(gone), 0) AS m,
                     CASE WHEN gone IS NULL THEN w ELSE list_select(w, list_filter(range(1, len(w) + 1), lambda x: NOT list_contains(gone, x))) END AS kept
              FROM d LEFT JOIN g USING (doc_id))
        SELECT doc_id, n AS n_words, m AS n_removed, sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256 FROM k""",
    "op10_line_dedup": f"""
        WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        l AS (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM d),
        k AS (SELECT doc_id, i, lines[i] AS line, translate(trim(lines[i], {_SPACES}), '{UPPER}', '{LOWER}') AS key FROM l),
        c AS (SELECT key, min(doc_id) AS keeper FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
        m AS (SELECT k.doc_id, k.i, k.line, coalesce(c.keeper <> k.doc_id, false) AS gone FROM k LEFT JOIN c USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM m GROUP BY doc_id""",
}
