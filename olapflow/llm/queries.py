"""The registered queries: each operator over its whole table, as a digest of its result."""

from __future__ import annotations

from pyspark.sql import functions as F

from olapflow.llm import (
    html_text, language, lines, mixing, packing, periods, resample, rules, secrets, simhash, spotsigs, tokens, whitening,
)
from olapflow.llm.base import documents, query, settle


def word_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op1_token_counts")
def op1(spark, folder):
    docs = documents(spark, folder).select("doc_id", "text")
    return tokens.token_counts(docs, word_bpe()).drop("text")


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, trim(coalesce(text, ''), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS s
  FROM documents
), w AS (
  SELECT doc_id, t, CASE WHEN s = '' THEN CAST([] AS VARCHAR[]) ELSE string_split_regex(s, '[\x20\x09-\x0D]+') END AS w FROM d
), windows AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM windows) WHERE c > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(3) r(k) GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM w)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), m AS (
  SELECT w.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(lines.dup, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
    coalesce(lines.n, 0) AS n_lines, length(t) - length(regexp_replace(t, '\p{Lu}', '', 'g')) AS n_upper,
    len(list_filter(w, lambda x: regexp_matches(x, '\p{L}'))) AS n_lettered
  FROM w LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)
), b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 5 * n_symbols > n_words
    OR 2 * n_dup_lines > n_lines OR 5 * n_upper > 2 * word_chars OR 100 * n_lettered < 70 * n_words) AS kept
FROM b
"""


@query("op5_quality_rules", OP5_SQL)
def op5(spark, folder):
    docs = documents(spark, folder).select("doc_id", "text")
    out = rules.quality_rules(docs, report=True)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.select("doc_id", *rules.MEASURES, failed.alias("base_failed"), "kept")


OP4_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), k AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l
), shared AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT k.*, coalesce(keeper <> doc_id, false) AS dropped FROM k LEFT JOIN shared USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query("op4_line_dedup", OP4_SQL)
def op4(spark, folder):
    docs = documents(spark, folder).select("doc_id", "text")
    out = lines.dedup_lines(docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5('mix:' || doc_id), 1, 15) AS BIGINT) AS key
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS HUGEINT) AS s FROM d GROUP BY source
), w AS (
  SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM s
), f AS (
  SELECT *, 3 * sum(s) OVER () AS budget, coalesce(sum(4 * s) OVER b, 0) AS below,
    sum(w) OVER () - coalesce(sum(w) OVER b, 0) AS w_left
  FROM w WINDOW b AS (ORDER BY CAST(s AS DOUBLE) / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), c AS (
  SELECT *, (budget - below) * w >= 4 * s * w_left AS capped FROM f
), t AS (
  SELECT source, s, CASE WHEN capped THEN CAST(2 * s AS DOUBLE) ELSE
    CAST(budget - coalesce(sum(4 * s) FILTER (capped) OVER (), 0) AS DOUBLE) / 2.0 * w / sum(w) FILTER (NOT capped) OVER () END AS target
  FROM c
), p AS (
  SELECT source, s, target, CASE WHEN s > 0 THEN CAST(floor(target) AS BIGINT) // CAST(s AS BIGINT) ELSE 0 END AS epochs FROM t
), r AS (
  SELECT d.*, p.s, p.target, p.epochs, CAST(floor(p.target) AS BIGINT) - p.epochs * CAST(p.s AS BIGINT) AS rest,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key) AS upto,
    sum(d.size) OVER (PARTITION BY d.source, d.key) AS tied
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, CAST(s AS BIGINT) AS source_size, target,
  CAST(epochs * size + CASE WHEN upto <= rest THEN size WHEN upto - tied < rest THEN size * (rest - (upto - tied)) // tied ELSE 0 END AS BIGINT) AS taken
FROM r
"""


@query("op9_source_mix", OP9_SQL)
def op9(spark, folder):
    docs = documents(spark, folder).select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


@query("op10_simhash_dedup")
def op10(spark, folder):
    docs = documents(spark, folder).select("doc_id", "text")
    out = simhash.near_duplicates(docs)
    return out.select("doc_id", simhash.as_hex(F.col("fingerprint")).alias("fingerprint"), "component_id")


def piece_digest(pieces):
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query("op2_curve_packing")
def op2(spark, folder):
    docs = documents(spark, folder).select("doc_id", "text")
    return piece_digest(packing.pack(docs, word_bpe()))


def _spans(spans):
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def _count_of(spans, kind):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


@query("op6_secret_scan")
def op6(spark, folder):
    docs = documents(spark, folder).select("doc_id", "text")
    found = secrets.scan_secrets(docs)
    base = F.filter("secrets", lambda s: s["depth"] == 0)
    return found.select(
        "doc_id", *[_count_of(base, kind) for kind in secrets.KINDS],
        F.sha2(_spans(base), 256).alias("base_sha256"), _spans(F.col("secrets")).alias("spans"),
    )


@query("op8_spot_signatures")
def op8(spark, folder):
    docs = documents(spark, folder).select("doc_id", "text")
    out = spotsigs.compare_with_next(docs, floor=0.0)
    return out.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited_text", 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    )


@query("op7_importance_resampling")
def op7(spark, folder):
    docs = documents(spark, folder).select("doc_id", "text")
    labels = spark.read.parquet(f"{folder.rstrip('/')}/labels.parquet")
    clean = F.coalesce((F.col("quality") == 1) & (F.col("toxic") == 0), F.lit(False))
    good = labels.agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0] or 0.0
    return resample.resample(docs, resample.target_ids(labels, clean), good)


@query("op3_html_text")
def op3(spark, folder):
    pages = settle(spark).read.parquet(f"{folder.rstrip('/')}/pages.parquet").select("page_id", "html")
    out = html_text.extract(pages)
    return out.select("page_id", "text", F.length("text").cast("long").alias("n_chars"))


def _id_checksum():
    return F.crc32(F.col("doc_id").cast("string").cast("binary"))


@query("op11_language_spans")
def op11(spark, folder):
    docs = documents(spark, folder)
    held_out = F.coalesce(_id_checksum() % 4 == 2, F.lit(False))
    model = language.fit(docs.where(~held_out).select("text", "lang"))
    out = language.identify(docs.select("doc_id", "text"), model)
    spans = F.array_join(F.transform("lang_spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"), s["lang"])), ",")
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", spans.alias("lang_spans"))


@query("op12_chebyshev_whitening")
def op12(spark, folder):
    embeddings = settle(spark).read.parquet(f"{folder.rstrip('/')}/embeddings.parquet").select("vec_id", "embedding")
    return whitening.whiten(embeddings).drop("embedding")


@query("op13_periodic_runs")
def op13(spark, folder):
    docs = documents(spark, folder).select("doc_id", "text")
    out = periods.periodic_runs(docs.withColumn("text", periods.planted(F.col("text"), F.col("doc_id"))))
    line = F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")
    ))
    best = F.col("strongest")
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *[best[c].alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
