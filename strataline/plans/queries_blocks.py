"""Queries on blocks and chunks made from whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.blocks import chunk_documents
from ..sources.tables import read_table
from .registering import registry

QUERIES, ORACLE, query = registry()


@query()
def document_chunks(spark: SparkSession, d: str) -> DataFrame:
    """The structural chunks of every document."""
    return chunk_documents(read_table(spark, d, "documents").select("doc_id", "text"))


@query()
def chunk_statistics(spark: SparkSession, d: str) -> DataFrame:
    """Chunks, characters and heading depth by language."""
    docs = read_table(spark, d, "documents")
    made = chunk_documents(docs.select("doc_id", "text")).select("doc_id", "kind", F.length("text").alias("n"), F.size(F.split("title_context", " > ")).alias("depth"))
    per_doc = made.groupBy("doc_id", "kind").agg(F.count(F.lit(1)).alias("chunks"), F.sum("n").alias("chars"), F.max("depth").alias("depth"))
    return per_doc.join(docs.select("doc_id", "lang"), "doc_id").groupBy("lang", "kind").agg(F.sum("chunks").alias("chunks"), F.sum("chars").alias("chars"), F.max("depth").alias("depth"))


def _judged(spark: SparkSession, d: str) -> DataFrame:
    """Chunks read as blocks by their first layout label, under the labels their rule version drops."""
    from ..operators.cleaning import judged_blocks

    rules = read_table(spark, d, "governance_config")
    named = rules.select("rule_version", "drop_block_labels").unionByName(rules.where("is_default").select(F.lit(None).cast("string").alias("rule_version"), "drop_block_labels"))
    drop = F.broadcast(named.groupBy("rule_version").agg(F.max("drop_block_labels").alias("drop")).withColumnRenamed("rule_version", "v"))  # one row per rule version
    chunks = read_table(spark, d, "chunks").where("text is not null").select("document_uid", "rule_version", "chunk_index", "chunk_version_uid", F.try_element_at("block_labels", F.lit(1)).alias("label"), "text").distinct()
    joined = chunks.join(drop, chunks.rule_version.eqNullSafe(F.col("v")), "left").drop("v")
    return judged_blocks(joined, ["document_uid", "rule_version"], ["chunk_index", "chunk_version_uid"], F.col("drop"))


@query()
def cleaned_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Every block with its clean text's digest, its content type and why it was removed, if it was."""
    return _judged(spark, d).select("chunk_version_uid", "kind", "fate", F.sha2("clean", 256).alias("clean_hash"))


@query("""
    SELECT document_uid, rule_version, count(*) AS input_blocks, count(*) FILTER (WHERE gone) AS dropped_by_label FROM (
        SELECT c.document_uid, c.rule_version, coalesce(list_contains(g.drop_block_labels, c.block_labels[1]), FALSE) AS gone
        FROM (SELECT DISTINCT document_uid, rule_version, chunk_index, chunk_version_uid, block_labels, text FROM chunks WHERE text IS NOT NULL) c
        LEFT JOIN governance_config g ON c.rule_version = g.rule_version OR (c.rule_version IS NULL AND g.is_default)) GROUP BY 1, 2
""")
def cleaning_label_counters(spark: SparkSession, d: str) -> DataFrame:
    """The counters of cleaning that depend on labels only."""
    from ..operators.cleaning import cleaning_counters

    return cleaning_counters(_judged(spark, d), ["document_uid", "rule_version"]).select("document_uid", "rule_version", "input_blocks", "dropped_by_label")


@query()
def cleaning_statistics(spark: SparkSession, d: str) -> DataFrame:
    """All counters of cleaning of each document."""
    from ..operators.cleaning import cleaning_counters

    return cleaning_counters(_judged(spark, d), ["document_uid", "rule_version"])


@query(r"""
    SELECT doc_id, TRUE AS covers_text, TRUE AS in_order FROM documents WHERE length(regexp_replace(text, '\s', '', 'g')) > 0
      AND NOT regexp_matches(lower(text), '<table') AND length(regexp_replace(regexp_replace(text, '(?m)^#{1,6}\s+.*$', '', 'g'), '\s', '', 'g')) > 0
""".replace("\\", "\\"))
def chunk_offset_invariants(spark: SparkSession, d: str) -> DataFrame:
    """For every document with text below its headings: each chunk's text stands at its offsets but for white space, and offsets never go back."""
    docs = read_table(spark, d, "documents").where("text is not null and not lower(text) like '%<table%'").select("doc_id", "text")
    made = chunk_documents(docs)
    bare = lambda c: F.regexp_replace(c, r"(?U)[\s\x{200b}]+", "")
    joined = made.join(docs.select("doc_id", F.col("text").alias("whole")), "doc_id")
    inside = F.expr("substring(whole, cast(char_start as int) + 1, cast(char_end - char_start as int))")
    # A later part of a table repeats its head rows, which lie before its place.
    same = F.when(F.col("kind") == "table", F.endswith(bare(F.col("text")), bare(inside))).otherwise(bare(F.col("text")) == bare(inside))
    at = F.sort_array(F.collect_list(F.struct("chunk_index", "char_start", "char_end")))  # the chunks of one document
    per = joined.groupBy("doc_id").agg(F.min(same).alias("covers_text"), at.alias("at"))
    rising = F.forall(F.sequence(F.lit(1), F.size("at") - 1), lambda k: F.get("at", k)["char_start"] >= F.get("at", k - 1)["char_start"])
    return per.select("doc_id", "covers_text", F.when(F.size("at") > 1, rising).otherwise(True).alias("in_order"))
