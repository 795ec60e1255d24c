"""The registered queries of this subpackage: each applies an operator, with production parameters, to its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollspark.llm import (alignment, chat, decontam, html_crf, imatch, langid, linedup, linkgraph, mixing, quality,
                           simhash, toxicity, whitening)
from tollspark.llm.common import fold, staged, table


def op1_html_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = html_crf.extract(pages, html_crf.fit(pages), ["page_id", "url"])
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 3) == 1
    model = langid.fit(documents.where(~held_out).select("text", "lang"))
    rows = documents.select("doc_id", held_out.alias("held_out"), "text")
    return langid.predict(rows, model, ["doc_id", "held_out"])


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    chosen, sources = mixing.mix(documents, F.array("source"), ["doc_id", "source"])
    # A row per source, of which mix() admits a bounded number.
    per_source = F.broadcast(sources.withColumnRenamed("source", "of"))
    return chosen.join(per_source, F.col("source").eqNullSafe(F.col("of"))) \
        .select("doc_id", "size", "source_size", "target", "taken")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.find(documents, table(spark, sf_dir, "benchmark"), ["doc_id"])
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, span: total + span[1] - span[0])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (n_hit > 0).alias("contaminated"))


def op5_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.compared(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    spans = F.transform("spans", lambda s: F.concat_ws("-", s.begin, s.end))
    return chat.rotate(turns).select("conv_id", "perspective", "part", "n_turns", "text",
                                     F.array_join(spans, ",").alias("loss_spans"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("row.doc_id", F.col("lines").alias("n_lines"), F.col("kept").alias("n_kept"), "text")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.grouped(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = fold(F.col("doc_id"), 5) == 0
    model = toxicity.fit(documents, labels.where(~held_out).select("doc_id", F.col("toxic").alias("label")),
                         max_examples=1000, common=0.2)
    rows = documents.select("doc_id", held_out.alias("held_out"), "text")
    found = toxicity.score(rows, model, ["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
                        "evidence")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = fold(F.col("doc_id"), 4) == 2
    model = quality.fit(documents, labels.where(~held_out).select("doc_id", F.col("quality").alias("label")))
    rows = documents.select("doc_id", held_out.alias("held_out"), "text")
    found = quality.score(rows, model, ["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
             ("block", "com/de/")]


def op11_url_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return linkgraph.judge(pages, linkgraph.rule_table(spark, URL_RULES), ["page_id"])


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whitening.apply(vectors, whitening.fit(vectors), ["vec_id"])


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    aligned = staged(alignment.align(documents, ["doc_id"]).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "n_a", "n_b", "n_groups", "n_links", digest, "pairs", "times"),
        "aligned")
    counts = staged(alignment.link_counts(aligned), "counts")
    return alignment.scored(aligned, counts, ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"], "row")


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in (
        op1_html_crf, op2_language, op3_mix, op4_decontaminate, op5_imatch, op6_chat, op7_line_dedup, op8_simhash,
        op9_toxicity, op10_quality, op11_url_graph, op12_whitening,
        op13_alignment)}
