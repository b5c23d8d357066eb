"""The registered queries of the corpus operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, decontaminate, html_text, line_dedup, minhash, mixing, pii, quality_classifier, quality_rules, runs, simhash, token_rollup, toxicity
from .shared import stored, table, words, work_dir


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", ((F.col("n_dropped") < F.col("n_lines")) | (F.col("n_lines") == 0)).alias("kept"), "text")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    out = quality_rules.quality_rules(table(spark, sf_dir, "documents"), good)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality_llr")


def remainder(key: str, by: int) -> Column:
    """crc32 of the key as text, modulo by."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % by


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    learnt = table(spark, sf_dir, "labels").where(remainder("doc_id", 5) != 0)
    out = toxicity.score_toxicity(docs, learnt, keep_text=False)
    return out.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    learnt = table(spark, sf_dir, "labels").where(remainder("doc_id", 4) != 2)
    out = quality_classifier.score_quality(docs, learnt)
    return out.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= 0.7).cast("int").alias("predicted"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_pii(docs)
    every = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("rk")).join(found, "rk", "left")
    base = F.filter("found", lambda x: x["base"])
    count = lambda kind: F.coalesce(F.size(F.filter("found", lambda x: x["base"] & (x["kind"] == kind))), F.lit(0)).cast("long")
    every = every.withColumn("found", F.coalesce("found", F.array().cast(found.schema["found"].dataType)))
    return every.select("doc_id", *[count(k).alias(f"n_{k}") for k in pii.BASE], F.sha2(pii.listed(base).cast("binary"), 256).alias("base_sha256"), pii.listed(F.col("found")).alias("spans"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op8_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches: all documents come; texts seen under a smaller doc_id go; lines repeated inside a text go."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    lines = F.split("text", "\n")
    shorter = F.when(F.size(F.array_distinct(lines)) < F.size(lines), F.array_join(F.array_distinct(lines), "\n"))
    row = docs.select("doc_id", "source", "lang", F.xxhash64("text").alias("h"), "text", shorter.alias("shorter"))
    row = row.withColumns({"words": token_rollup.word_tokens(F.col("text")), "shorter_words": F.when(F.col("shorter").isNotNull(), token_rollup.word_tokens(F.col("shorter")))})
    (version, path), *_ = token_rollup.TOKENIZERS.items()
    counted = stored(token_rollup.count_tokens(row, ["text", "shorter"], path), "token-counts")
    first = counted.groupBy("h").agg(F.min("doc_id").alias("first"))
    both = F.explode(F.array(F.struct(F.lit(version).alias("tokenizer"), F.col("text").alias("n"), F.col("shorter").alias("m")), F.struct(F.lit("words").alias("tokenizer"), F.col("words").alias("n"), F.col("shorter_words").alias("m"))))
    long = counted.join(first, "h").select("source", "lang", F.col("doc_id").eqNullSafe(F.col("first")).alias("stays"), both.alias("x")).select("source", "lang", "stays", "x.*")
    store = f"{work_dir(spark)}/{spark.sparkContext.applicationId}/token-store-{uuid.uuid4().hex}"
    none = F.lit(None).cast("long")
    token_rollup.commit(long.select(F.lit("insert").alias("op"), "source", "lang", "tokenizer", F.col("n").alias("n_tokens"), none.alias("old_tokens")), store, "all")
    token_rollup.commit(long.where("not stays").select(F.lit("delete").alias("op"), "source", "lang", "tokenizer", F.col("n").alias("n_tokens"), none.alias("old_tokens")), store, "repeated")
    token_rollup.commit(long.where("stays and m is not null").select(F.lit("revise").alias("op"), "source", "lang", "tokenizer", F.col("m").alias("n_tokens"), F.col("n").alias("old_tokens")), store, "shortened")
    return token_rollup.totals(spark, store)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", F.col("leaked_items").alias("items"), F.size("leaked_items").cast("long").alias("n_items"), F.col("leaked_words").alias("n_matched"), "kept")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("mix_size") * F.col("mix_copies")).alias("taken"),
    )


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; see :func:`simhash.near_duplicates`."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; see :func:`collocations.mine`."""
    return collocations.mine(table(spark, sf_dir, "documents"))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """Texts of a tenth of the rows go on periodically from one of their words, both told by a hash of doc_id (null: empty)."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    g = F.expr("h div 10")
    a = F.expr("cast(g % n as int)")
    p = F.expr("cast(1 + (n - a) div (3 + g % 8) as int)")
    rows = docs.select("doc_id", "text", h.alias("h")).withColumn("w", F.when(F.col("h") % 10 == 0, words(F.col("text")))).withColumns({"n": F.size("w"), "g": g})
    rows = rows.withColumn("a", F.when(F.col("n") > 0, a)).withColumn("p", F.when(F.col("n") > 0, p))
    again = F.expr("concat(slice(w, 1, a), slice(flatten(array_repeat(slice(w, a + 1, p), cast((n - a) div p + 1 as int))), 1, n - a))")
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, a tenth with a planted period; see :func:`runs.collapse_runs`."""
    out = runs.collapse_runs(with_planted_periods(table(spark, sf_dir, "documents")))
    out = out.withColumn("best", runs.longest_run(F.col("runs")))
    lines = F.array_join(F.transform("runs", lambda x: F.concat(x["start"].cast("string"), F.lit(","), x["length"].cast("string"), F.lit(","), x["period"].cast("string"), F.lit("\n"))), "")
    return out.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_line_dedup": op1_line_dedup,
        "op2_quality_rules": op2_quality_rules,
        "op3_toxicity": op3_toxicity,
        "op4_minhash": op4_minhash,
        "op5_quality_classifier": op5_quality_classifier,
        "op6_pii": op6_pii,
        "op7_html_text": op7_html_text,
        "op8_token_rollup": op8_token_rollup,
        "op9_decontaminate": op9_decontaminate,
        "op10_mixing": op10_mixing,
        "op11_simhash": op11_simhash,
        "op12_collocations": op12_collocations,
        "op13_runs": op13_runs,
    }


#: CTEs from ``docs`` (a relation with doc_id, text, source) to ``taken`` (its rows with the mix's figures).
MIX_SQL = r"""
mix_docs AS (
  SELECT *, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM docs),
mix_sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM mix_docs GROUP BY source),
mix_ranked AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::BIGINT AS weight
  FROM mix_sizes),
mix_filled AS (
  SELECT *, sum(source_size) OVER ()::BIGINT AS total,
         coalesce(sum(source_size) OVER before, 0)::BIGINT AS full_size,
         (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::BIGINT AS left_weight,
         row_number() OVER (ORDER BY source_size / weight ASC, source ASC NULLS LAST) AS place
  FROM mix_ranked
  WINDOW before AS (ORDER BY source_size / weight ASC, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
mix_levels AS (SELECT *, (1.5::DOUBLE * total - 2 * full_size) / left_weight AS lvl FROM mix_filled),
mix_final AS (SELECT arg_min(lvl, place) AS lvl FROM mix_levels WHERE lvl * weight <= 2 * source_size),
mix_targets AS (
  SELECT l.source, l.source_size, least(f.lvl * l.weight, (2 * l.source_size)::DOUBLE) AS target
  FROM mix_levels l, mix_final f),
mix_needs AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS copies,
         target - CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT * source_size AS need
  FROM mix_targets),
mix_hashes AS (SELECT source, h, sum(size)::BIGINT AS words FROM mix_docs GROUP BY source, h),
mix_running AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY h)::BIGINT AS upto FROM mix_hashes),
mix_extra AS (
  SELECT r.source, r.h,
         (r.upto <= n.need OR (r.upto - r.words <= n.need AND r.upto - n.need < n.need - (r.upto - r.words)))::BIGINT AS one
  FROM mix_running r JOIN mix_needs n ON r.source IS NOT DISTINCT FROM n.source),
mix_taken AS (
  SELECT d.*, n.source_size, n.target, least(n.copies + e.one, 2)::BIGINT AS copies
  FROM mix_docs d
  JOIN mix_needs n ON d.source IS NOT DISTINCT FROM n.source
  JOIN mix_extra e ON d.source IS NOT DISTINCT FROM e.source AND d.h = e.h)
"""

COLLOCATIONS_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
places AS (
  SELECT lang, 1 AS size, unnest(w) AS phrase FROM words
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM words),
counts AS (SELECT lang, size, phrase, count(*) AS f FROM places GROUP BY lang, size, phrase),
totals AS (SELECT lang, count(*) AS n FROM places WHERE size = 1 GROUP BY lang),
candidates AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE size > 1 AND f >= 10),
cuts AS (
  SELECT lang, size, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS rest
  FROM candidates, (VALUES (1), (2)) AS t(k) WHERE k < size),
scored AS (
  SELECT c.lang, c.size, c.phrase, c.a, c.k, x.f AS l, y.f AS r, (1000000::HUGEINT * c.a * c.a // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c
  JOIN counts x ON x.lang = c.lang AND x.size = c.k AND x.phrase = c.head
  JOIN counts y ON y.lang = c.lang AND y.size = c.size - c.k AND y.phrase = c.rest),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, size, phrase ORDER BY score, k) = 1),
held AS (
  SELECT lang, part, max(a) AS most
  FROM (SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS part FROM candidates WHERE size = 3)
  GROUP BY lang, part),
ranked AS (
  SELECT s.lang, s.phrase, s.a, s.l, s.r, s.score,
         row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, s.phrase) AS rank
  FROM lowest s LEFT JOIN held h ON h.lang = s.lang AND s.size = 2 AND h.part = s.phrase
  WHERE h.most IS NULL OR 100 * h.most < 50 * s.a)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op12_collocations": COLLOCATIONS_SQL,
        "op10_mixing": f"WITH docs AS (SELECT * FROM documents), {MIX_SQL} SELECT doc_id, size, source_size, target, size * copies AS taken FROM mix_taken",
    }
