"""Queries on what a registry keeps: targets, numbers, dispositions, overrides, sync state, conflicts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dedup
from ..operators import registry as R
from ..sources.tables import read_table
from .registering import registry

QUERIES, ORACLE, query = registry()


@query("""
    SELECT stock_code, CAST(y AS BIGINT) AS year FROM (
      SELECT stock_code, unnest(generate_series(greatest(coalesce(lo, hi), 1990), hi)) AS y FROM (
        SELECT stock_code, min(report_year) AS lo, CASE WHEN count(*) % 2 = 0 THEN 2023 ELSE coalesce(max(report_year), 2023) END AS hi
        FROM local_documents WHERE stock_code IS NOT NULL GROUP BY 1) WHERE greatest(coalesce(lo, hi), 1990) <= hi)
""")
def collection_targets(spark: SparkSession, d: str) -> DataFrame:
    """The years to collect for each code; ranges without an end go to the year before 2024."""
    t = read_table(spark, d, "local_documents").where("stock_code is not null").groupBy("stock_code").agg(
        F.min("report_year").alias("start_year"), F.when(F.count(F.lit(1)) % 2 == 1, F.max("report_year")).alias("end_year")
    )
    return R.target_years(t, 2024).select("stock_code", F.col("year").cast("bigint").alias("year"))


@query("SELECT document_uid FROM (SELECT DISTINCT document_uid, publish_date FROM local_documents) WHERE publish_date IS NULL OR year(publish_date) BETWEEN 2020 AND 2022")
def year_window(spark: SparkSession, d: str) -> DataFrame:
    """Files of three years, and those without a date."""
    rows = read_table(spark, d, "local_documents").select("document_uid", "publish_date").distinct()
    return rows.where(R.within_years(F.year("publish_date"), 2020, 2022)).select("document_uid")


@query("""
    SELECT document_uid, list_sort(list_distinct(flatten(list(coalesce(batch_ids, []))))) AS batches FROM local_documents GROUP BY 1
""")
def document_batches(spark: SparkSession, d: str) -> DataFrame:
    """All batches that ever named a file."""
    rows = read_table(spark, d, "local_documents").select("document_uid", F.explode_outer("batch_ids").alias("b")).distinct()
    return rows.groupBy("document_uid").agg(R.batch_ids(F.collect_list("b"), F.lit(None).cast("array<string>")).alias("batches"))  # batches of one file


@query("""
    WITH n AS (SELECT doc_id, source FROM documents WHERE doc_id % 2 = 1), u AS (SELECT source, count(*) AS last FROM documents WHERE doc_id % 2 = 0 GROUP BY 1)
    SELECT doc_id, coalesce(last, 0) + row_number() OVER (PARTITION BY n.source ORDER BY sha256(CAST(doc_id AS VARCHAR))) AS number FROM n LEFT JOIN u ON n.source IS NOT DISTINCT FROM u.source
""")
def sequential_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Numbers of the documents with odd ids, going on from the count of those with even ids, by source."""
    docs = read_table(spark, d, "documents").select("doc_id", "source")
    used = docs.where("doc_id % 2 = 0").groupBy("source").agg(F.count(F.lit(1)).alias("number"))
    return R.numbered(docs.where("doc_id % 2 = 1"), used, "source", "doc_id").select("doc_id", "number")


@query("""
    WITH c AS (SELECT doc_id, url AS source_url, sha256(text) AS h, length(text) >= 100 AS valid FROM documents WHERE doc_id % 2 = 1 AND url IS NOT NULL),
    held AS (SELECT url AS source_url, sha256(text) AS h FROM documents WHERE doc_id % 2 = 0),
    s AS (SELECT c.*, source_url IN (SELECT source_url FROM held WHERE source_url IS NOT NULL) AS known_url, coalesce(h IN (SELECT h FROM held WHERE h IS NOT NULL), FALSE) AS known_hash FROM c),
    f AS (SELECT h, min(source_url) AS first FROM s WHERE NOT known_url AND coalesce(valid, FALSE) AND NOT known_hash GROUP BY 1)
    SELECT doc_id, CASE WHEN known_url THEN 'reused' WHEN NOT coalesce(valid, FALSE) THEN 'quarantined' WHEN known_hash OR coalesce(first <> source_url, FALSE) THEN 'duplicate' ELSE 'success' END AS disposition
    FROM s LEFT JOIN f USING (h)
""")
def download_dispositions(spark: SparkSession, d: str) -> DataFrame:
    """Documents with odd ids read as downloads against those with even ids."""
    docs = read_table(spark, d, "documents").select("doc_id", F.col("url").alias("source_url"), F.sha2("text", 256).alias("content_hash"), (F.length("text") >= 100).alias("valid"))
    return R.report_dispositions(docs.where("doc_id % 2 = 1 and source_url is not null"), docs.where("doc_id % 2 = 0").select("source_url", "content_hash")).select("doc_id", "disposition")


@query("""
    WITH s AS (SELECT document_uid, arg_max(struct_pack(y := report_year, t := title), updated_at) AS r FROM local_documents GROUP BY 1)
    SELECT document_uid, CAST(coalesce(CASE WHEN substr(document_uid, 1, 1) IN ('0', '1') THEN 2001 WHEN substr(document_uid, 1, 1) = '2' THEN NULL ELSE r.y END, 0) AS INTEGER) AS report_year FROM s
""")
def metadata_overrides(spark: SparkSession, d: str) -> DataFrame:
    """Report years under overrides (0 for none): the later of two holds, one by null empties the field, one that is no number changes nothing."""
    rows = dedup.last_wins(read_table(spark, d, "local_documents").select("document_uid", "report_year", "updated_at"), "document_uid", "updated_at").select("document_uid", "report_year")
    head = F.substring("document_uid", 1, 1)
    old = rows.where(head.isin("0", "1", "2", "3")).select("document_uid", F.lit("report_year").alias("field"), F.lit("1999").alias("value"), F.lit(1).alias("at"))
    new = rows.select("document_uid", F.lit("report_year").alias("field"), F.when(head.isin("0", "1"), "2001").when(head == "3", "soon").alias("value"), F.lit(2).alias("at")).where(head.isin("0", "1", "2", "3"))
    return R.overridden(rows, old.unionByName(new), "document_uid", ["report_year"])[0].na.fill(0, ["report_year"])


@query("""
    SELECT event_type AS source, user_id AS target, max(ts) AS last_success, arg_max(event_id, struct_pack(t := ts, e := event_id)) AS cursor FROM events WHERE value > 20 GROUP BY 1, 2
""")
def sync_cursors(spark: SparkSession, d: str) -> DataFrame:
    """Events read as runs that succeed above a value: the last success and its cursor."""
    e = read_table(spark, d, "events").select(F.col("event_type").alias("source"), F.col("user_id").alias("target"), F.when(F.col("value") > 20, "success").otherwise("failed").alias("status"), F.col("ts").alias("finished_at"), F.col("event_id").alias("cursor"))
    return R.sync_state(e)


@query("""
    SELECT event_type AS source, CASE WHEN user_id % 2 = 0 THEN 'live' ELSE 'history' END AS lane, min(ts) AS starts_at FROM events WHERE value > 20 GROUP BY 1, 2
""")
def next_windows(spark: SparkSession, d: str) -> DataFrame:
    """Events read as windows: the oldest unfinished one of each source and lane."""
    w = read_table(spark, d, "events").select(F.col("event_type").alias("source"), F.when(F.col("user_id") % 2 == 0, "live").otherwise("history").alias("lane"), F.col("event_id").alias("window_id"), F.col("ts").alias("starts_at"), F.when(F.col("value") > 20, "failed").otherwise("finished").alias("status"))
    return R.next_window(w).select("source", "lane", "starts_at")


@query("""
    WITH m AS (SELECT DISTINCT nullif(lower(trim(split)), '') AS split, sha256(text) AS h, work_uid FROM corpus),
    k AS (SELECT DISTINCT split, 'content:' || h AS key FROM m UNION SELECT DISTINCT split, 'image:' || work_uid FROM m)
    SELECT key, count(*) AS splits FROM k WHERE key IS NOT NULL AND split IS NOT NULL GROUP BY 1 HAVING count(*) > 1
""")
def split_keys_in_conflict(spark: SparkSession, d: str) -> DataFrame:
    """Contents, and works in the place of images, that stand in several splits."""
    m = read_table(spark, d, "corpus").select("sample_id", F.nullif(F.lower(F.trim("split")), F.lit("")).alias("split"), F.sha2("text", 256).alias("content_hash"), F.array("work_uid").alias("image_hashes"))
    return R.split_conflict_groups(m)


@query("SELECT source, CAST(sum(n_chars) AS BIGINT) AS n_chars, count(*) AS texts FROM documents GROUP BY 1")
def usage_by_role(spark: SparkSession, d: str) -> DataFrame:
    """Characters and texts summed by source."""
    return R.usage_sums(read_table(spark, d, "documents").select("source", "n_chars", F.lit(1).alias("texts")), "source", ["n_chars", "texts"])
