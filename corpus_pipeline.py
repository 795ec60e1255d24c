"""A corpus pipeline of five operators; each stage's result is written and read again as the next one's documents.

All stages but the last return the columns of `documents`; other columns of the input pass through. Stages read the
columns doc_id, text, source and n_chars; a missing n_chars is not added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollspark.llm import decontam, linedup, mixing, quality, simhash
from tollspark.llm.common import staged, table


def _with_text(rows: DataFrame, documents: DataFrame, changed: Column) -> DataFrame:
    """The columns of `documents` from rows of (row, text), with the new text and, where it has changed, its length."""
    def value(name: str):
        if name == "text":
            return F.col("text")
        if name == "n_chars":
            length = F.char_length("text").cast(documents.schema[name].dataType)
            return F.when(changed, length).otherwise(F.col("row").getField(name)).alias(name)
        return F.col("row").getField(name).alias(name)
    return rows.select(*map(value, documents.columns))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose compression score reaches 0.7. All labels whose documents are here may teach."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    rows = docs.select(F.struct("*").alias("row"), "text")
    found = quality.score(rows, quality.fit(docs, labels), ["row"])
    return found.where("score >= 0.7").select("row.*")


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that an earlier line repeats; a document that had lines and loses all of them goes."""
    found = linedup.dedup_lines(docs)
    stays = F.col("text").isNull() | (F.btrim("text", F.lit(" \t\n\x0b\f\r")) != "") \
        | (F.btrim(F.col("row").getField("text"), F.lit(" \t\n\x0b\f\r")) == "")
    return _with_text(found.where(stays), docs, ~F.col("text").eqNullSafe(F.col("row").getField("text")))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id. Rows that repeat an id are one
    document, whose first text in order stays; rows without an id all stay."""
    groups = simhash.grouped(docs.select("doc_id", "text"))
    first = groups.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("first")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"))
    chosen = rows.join(first, F.col("id") == F.col("first"), "left_semi")
    chosen = chosen.groupBy("id").agg(F.min_by("row", F.struct(F.col("row").getField("text"))).alias("row"))
    return chosen.select("row.*").unionByName(rows.where("id is null").select("row.*"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of the benchmark; a document that is benchmark for more than half of its words goes."""
    return _with_text(decontam.clean(docs, table(spark, sf_dir, "benchmark")), docs, F.col("changed"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with the words taken of each."""
    rows = docs.select("doc_id", "source", "text", F.struct("*").alias("row"))
    chosen, _ = mixing.mix(rows, F.array("source"), ["doc_id", "source", "row"])
    return chosen.where("taken > 0").select("row.*", F.col("size").alias("mix_size"), F.col("taken").alias("mix_taken"))


STAGES = [("quality", good_quality), ("line_dedup", fresh_lines), ("near_dedup", one_of_each),
          ("decontaminate", decontaminated), ("mix", mixed)]

#: No SQL: the quality stage's dictionaries and the fingerprints' XXH64 aren't in DuckDB; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
