"""The registered text queries: operator results in the columns agreed for them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealglass.llm import (
    decontaminate, html_text, jaccard, language, licenses, packing, periodic_runs, quality_model,
    quality_rules, sharding, token_counts, toxicity, whitening)
from dealglass.llm.common import SPACE_WORD, held_out, matches, read


def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan(read(spark, folder, "documents"))
    return found.select(
        "doc_id", "text_digest", "text_license",
        F.size("licenses").cast("long").alias("n_licenses"),
        F.array_join("licenses", ",").alias("licenses"),
    )


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.scan(
        read(spark, folder, "documents"), read(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op3_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    model = quality_model.learn(docs, read(spark, folder, "labels"))
    scored = quality_model.with_scores(docs, model)
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= quality_model.THRESHOLD).cast("int").alias("predicted"),
    )


def op4_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.join(read(spark, folder, "documents"))


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = token_counts.with_counts(read(spark, folder, "documents").select("doc_id", "text"))
    return counted.select("doc_id", "tokens.n_words", "tokens.n_tokens")


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judge(read(spark, folder, "documents"))
    return judged.withColumn("cleaned_md5", F.md5(F.col("cleaned").cast("binary"))).drop("cleaned")


def op7_html_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = html_text.extract(read(spark, folder, "pages").select("page_id", "url", "html"))
    return pages.select(
        "page_id", "url", F.col("visible_text").alias("text"),
        F.length("visible_text").cast("long").alias("n_chars"),
        F.md5(F.col("visible_text").cast("binary")).alias("text_md5"),
    )


def op8_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read(spark, folder, "documents"))


def op9_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard_records(read(spark, folder, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version",
    )


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text", "lang")
    return language.predict(docs).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "language.lang_pred",
        "language.score", F.array_join("language.languages", ",").alias("languages"),
    )


def _repeating(docs: DataFrame) -> DataFrame:
    """The texts of op11: in a tenth of the documents, by the id's CRC-32, the words from
    one on are those of a cycle.  The others, and those without an id, stay as they are."""
    code = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    split = docs.select(
        "doc_id", "text", F.floor(code / 10).alias("g"),
        F.when(code % 10 == 0, matches(F.col("text"), SPACE_WORD)).alias("words"))
    placed = split.withColumn("n", F.size("words")).withColumn(
        "a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    timed = placed.withColumn(
        "p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    cycle = F.slice("words", F.col("a") + 1, F.col("p"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    cycles = F.flatten(F.array_repeat(cycle, times))
    words = F.slice(F.concat(F.slice("words", F.lit(1), F.col("a")), cycles), F.lit(1), F.col("n"))
    text = F.when(F.col("p").isNull(), F.col("text")).otherwise(F.array_join(words, " "))
    return timed.select("doc_id", text.alias("text"))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    found = periodic_runs.with_runs(_repeating(docs)).select("doc_id", "periodic.*")
    lines = F.transform("runs", lambda r: F.concat(
        r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "strongest.*",
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        "n_words",
    )


def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read(spark, folder, "embeddings").select("vec_id", "embedding")
    white, fitted, error = whitening.whiten(vectors)
    explained = [] if fitted is None else fitted.explained.tolist()
    each = white.select(
        "vec_id", "whitening.deviation",
        F.posexplode("whitening.whitened").alias("component", "whitened"))
    return each.select(
        "vec_id", (F.col("component") + 1).cast("int").alias("component"),
        F.lit(0 if fitted is None else fitted.n).cast("long").alias("n"),
        F.expr("try_cast(deviation as bigint)").alias("deviation"),  # null beyond a long
        "whitened",
        F.get(F.lit(explained).cast("array<double>"), F.col("component")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def op13_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, read(spark, folder, "labels"))
    scored = toxicity.with_scores(docs, model).select("doc_id", "toxicity.*")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        F.size("spans").cast("long").alias("n_spans"),
        F.array_join(F.transform("spans", lambda s: F.concat(s["start"], F.lit("-"), s["end"])),
                     ",").alias("spans"),
    )


TEXT_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_license_scan, op2_decontamination, op3_quality_classifier, op4_jaccard_join,
        op5_token_counts, op6_quality_rules, op7_html_text, op8_best_fit_packing, op9_sharding,
        op10_language_id, op11_periodic_runs, op12_embedding_whitening,
        op13_toxicity,
    )
}
