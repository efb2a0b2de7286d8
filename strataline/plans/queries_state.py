"""Queries on states, versions, joins, evaluation and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import metadata as M
from ..functions.labels import split_label
from ..functions import rules
from ..operators import dedup, graph
from ..operators import state as S
from ..sources.tables import read_table
from .registering import registry

QUERIES, ORACLE, query = registry()


@query("""
    SELECT document_uid, arg_max(struct_pack(o := ocr_status, t := title), struct_pack(u := updated_at, o := ocr_status, t := title)).o AS ocr_status, strftime(max(updated_at), '%Y-%m-%d') AS updated
    FROM local_documents GROUP BY 1
""")
def latest_document_state(spark: SparkSession, d: str) -> DataFrame:
    """The last state of each imported file."""
    rows = read_table(spark, d, "local_documents").select("document_uid", "updated_at", "ocr_status", "title")
    return dedup.last_wins(rows, "document_uid", "updated_at").select("document_uid", "ocr_status", F.date_format("updated_at", "yyyy-MM-dd").alias("updated"))


@query("""
    WITH a AS (SELECT DISTINCT uid AS k FROM dedup_index), b AS (SELECT DISTINCT sample_id AS k FROM corpus)
    SELECT coalesce(a.k, b.k) AS sample_id, CASE WHEN b.k IS NOT NULL THEN 'corpus' ELSE 'index' END AS origin FROM a FULL JOIN b ON a.k = b.k
""")
def manifest_union(spark: SparkSession, d: str) -> DataFrame:
    """Samples of two manifests; the second overrides the first."""
    index = read_table(spark, d, "dedup_index").select(F.col("uid").alias("sample_id"), F.lit("index").alias("origin"))
    corpus = read_table(spark, d, "corpus").select("sample_id", F.lit("corpus").alias("origin"))
    return dedup.priority_union([index, corpus], "sample_id")


@query("""
    SELECT DISTINCT document_uid, asset_uid FROM local_documents
    WHERE len(list_intersect(batch_ids, ['batch-03', 'batch-07', 'batch-13'])) > 0 AND ocr_status IN ('success', 'reused') AND nullif(trim(asset_uid), '') IS NOT NULL
""")
def adopted_reports(spark: SparkSession, d: str) -> DataFrame:
    """Collected files of three batches that came through."""
    rows = read_table(spark, d, "local_documents").where(F.arrays_overlap("batch_ids", F.array(*[F.lit(f"batch-{b}") for b in ("03", "07", "13")])))
    return rows.where(F.col("ocr_status").isin("success", "reused") & M.clean_text(F.col("asset_uid")).isNotNull()).select("document_uid", "asset_uid").distinct()


@query("""
    SELECT document_uid, unnest(generate_series(1, pages, 4)) AS first_page, least(unnest(generate_series(1, pages, 4)) + 3, pages) AS last_page
    FROM (SELECT document_uid, max(page) AS pages FROM chunks WHERE page IS NOT NULL GROUP BY 1) WHERE pages > 0
""")
def page_segments(spark: SparkSession, d: str) -> DataFrame:
    """Each document's pages in segments of four."""
    pages = read_table(spark, d, "chunks").where("page is not null").groupBy("document_uid").agg(F.max("page").cast("bigint").alias("pages")).where("pages > 0")
    first = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("pages"), F.lit(4).cast("bigint")))
    return pages.select("document_uid", "pages", first.alias("first_page")).select("document_uid", "first_page", F.least(F.col("first_page") + 3, F.col("pages")).alias("last_page"))


@query(r"""
    WITH s AS (SELECT document_uid, arg_max(struct_pack(y := report_year, t := report_type, ti := title, d := publish_date, c := stock_code, n := company_name),
                      struct_pack(u := updated_at, y := report_year, t := report_type, ti := title)) AS r FROM local_documents GROUP BY 1)
    SELECT document_uid,
           coalesce(CASE WHEN r.y BETWEEN 1900 AND 2100 THEN r.y END, TRY_CAST(nullif(regexp_extract(r.ti, '((?:19|20)[0-9]{2})', 1), '') AS INTEGER), year(r.d) - 1) AS period,
           CASE WHEN r.y BETWEEN 1900 AND 2100 THEN 'record' WHEN nullif(regexp_extract(r.ti, '((?:19|20)[0-9]{2})', 1), '') IS NOT NULL THEN 'title'
                WHEN r.d IS NOT NULL THEN 'publish_date' END AS period_source,
           CASE lower(trim(r.t)) WHEN 'annual' THEN 'annual' WHEN '年报' THEN 'annual' WHEN '年度报告' THEN 'annual' WHEN 'semiannual' THEN 'semiannual'
                WHEN '半年报' THEN 'semiannual' WHEN 'interim' THEN 'semiannual' WHEN 'quarterly' THEN 'quarterly' WHEN '季报' THEN 'quarterly' END AS kind,
           nullif(regexp_extract(r.c, '([0-9]{6})', 1), '') AS code, nullif(trim(r.n), '') AS company
    FROM s
""")
def metadata_precedence(spark: SparkSession, d: str) -> DataFrame:
    """Metadata of each file by precedence: its record, then its title, then its date, with where it came from."""
    cols = ["document_uid", "updated_at", "report_year", "report_type", "title", "publish_date", "stock_code", "company_name"]
    s = dedup.last_wins(read_table(spark, d, "local_documents").select(*cols), "document_uid", "updated_at")
    period, source = M.first_known(record=M.year(F.col("report_year")), title=M.first_match(r"((?:19|20)[0-9]{2})", F.col("title")).try_cast("int"), publish_date=F.year("publish_date") - 1)
    return s.select("document_uid", period.alias("period"), source.alias("period_source"), M.report_type(F.col("report_type")).alias("kind"), M.first_match("([0-9]{6})", F.col("stock_code")).alias("code"), M.clean_text(F.col("company_name")).alias("company"))


_QC = """
    c AS (SELECT DISTINCT chunk_version_uid, document_uid, text, page, title_context, char_start, char_end, text_hash FROM chunks),
    q AS (SELECT chunk_version_uid, unnest([
            struct_pack(name := 'text', status := CASE WHEN length(trim(coalesce(text, ''))) > 0 THEN 'pass' ELSE 'fail' END),
            struct_pack(name := 'document', status := CASE WHEN nullif(document_uid, '') IS NOT NULL THEN 'pass' ELSE 'fail' END),
            struct_pack(name := 'page', status := CASE WHEN page >= 0 THEN 'pass' ELSE 'warn' END),
            struct_pack(name := 'context', status := CASE WHEN length(title_context) > 0 THEN 'pass' ELSE 'warn' END),
            struct_pack(name := 'offsets', status := CASE WHEN char_end > char_start THEN 'pass' ELSE 'warn' END)]) AS k FROM c)
"""


def _checked(spark: SparkSession, d: str) -> DataFrame:
    rows = read_table(spark, d, "chunks").select("chunk_version_uid", "document_uid", "text", "page", "title_context", "char_start", "char_end", "text_hash").distinct()
    return S.checks(rows, "chunk_version_uid", {
        "text": ("fail", F.length(F.trim(F.coalesce("text", F.lit("")))) > 0),
        "document": ("fail", F.nullif("document_uid", F.lit("")).isNotNull()),
        "page": ("warn", F.col("page") >= 0),
        "context": ("warn", F.length("title_context") > 0),
        "offsets": ("warn", F.col("char_end") > F.col("char_start")),
    })


@query(f"WITH {_QC} SELECT k.name AS name, k.status AS status, count(*) AS n FROM q GROUP BY 1, 2")
def chunk_qc_summary(spark: SparkSession, d: str) -> DataFrame:
    """How often each check of a chunk passes, warns or fails."""
    return S.check_summary(_checked(spark, d))


@query(f"WITH {_QC} SELECT chunk_version_uid, bool_and(k.status <> 'fail') AS qc_passed, count(*) FILTER (WHERE k.status = 'warn') AS warnings FROM q GROUP BY 1")
def chunk_qc(spark: SparkSession, d: str) -> DataFrame:
    """Whether each chunk passes, and its warnings."""
    return _checked(spark, d).select("chunk_version_uid", "qc_passed", F.size(F.filter("qc_checks", lambda c: c["status"] == "warn")).cast("bigint").alias("warnings"))


@query(r"""
    WITH u AS (SELECT doc_id, nullif(regexp_replace(regexp_replace(regexp_replace(lower(trim(url)), '^(?:https?:)?//(?:www\.|m\.)?', ''), '[?#].*$', ''), '/+$', ''), '') AS key FROM documents)
    SELECT split_part(key, '/', 1) AS host, count(*) AS urls, count(*) - count(DISTINCT key) AS repeats, min(doc_id) AS first_doc FROM u WHERE key IS NOT NULL GROUP BY 1
""")
def duplicate_url_stats(spark: SparkSession, d: str) -> DataFrame:
    """Canonical URLs of each host and their repeats."""
    u = read_table(spark, d, "documents").select("doc_id", M.canonical_url(F.col("url")).alias("key")).where("key is not null")
    per_url = u.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_doc"))
    return per_url.groupBy(F.split_part("key", F.lit("/"), F.lit(1)).alias("host")).agg(F.sum("n").alias("urls"), (F.sum("n") - F.count(F.lit(1))).alias("repeats"), F.min("first_doc").alias("first_doc"))


@query("""
    WITH c AS (SELECT DISTINCT chunk_version_uid, document_uid, rule_version, char_start AS s, char_end AS e FROM chunks WHERE char_start < char_end AND rule_version IS NOT NULL)
    SELECT a.chunk_version_uid, count(*) AS overlaps FROM c a JOIN c b
      ON a.document_uid = b.document_uid AND a.rule_version = b.rule_version AND a.chunk_version_uid <> b.chunk_version_uid AND a.s < b.e AND b.s < a.e GROUP BY 1
""")
def overlapping_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Chunks of one document and rule whose ranges overlap."""
    rows = read_table(spark, d, "chunks").where("rule_version is not null").select("chunk_version_uid", "document_uid", "rule_version", "char_start", "char_end").distinct()
    pairs = S.overlapping(rows, rows, ["document_uid", "rule_version"], "char_start", "char_end", 2000)
    return pairs.where("l_chunk_version_uid <> r_chunk_version_uid").groupBy(F.col("l_chunk_version_uid").alias("chunk_version_uid")).agg(F.count(F.lit(1)).alias("overlaps"))


@query("""
    WITH RECURSIVE e AS (
        SELECT 'c' || c_custkey AS child, 'n' || c_nationkey AS parent FROM customer UNION SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation
        UNION SELECT 's' || s_suppkey, 'n' || s_nationkey FROM supplier),
    a AS (SELECT child AS node, parent AS ancestor, 1 AS depth FROM e UNION SELECT a.node, e.parent, a.depth + 1 FROM a JOIN e ON e.child = a.ancestor)
    SELECT node, ancestor, min(depth) AS depth FROM a GROUP BY 1, 2
""")
def lineage_closure(spark: SparkSession, d: str) -> DataFrame:
    """All ancestors of all nodes of a lineage."""
    edge = lambda t, c, p, x, y: read_table(spark, d, t).select(F.concat(F.lit(x), F.col(c)).alias("child"), F.concat(F.lit(y), F.col(p)).alias("parent"))
    edges = edge("customer", "c_custkey", "c_nationkey", "c", "n").unionByName(edge("nation", "n_nationkey", "n_regionkey", "n", "r")).unionByName(edge("supplier", "s_suppkey", "s_nationkey", "s", "n"))
    return graph.ancestors(edges)


@query("""
    SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY (o_orderstatus <> 'O')::INT, o_orderdate, o_orderkey) = 1 AS is_selected FROM orders
""")
def version_resolution(spark: SparkSession, d: str) -> DataFrame:
    """The earliest active row of each group, or its earliest."""
    return S.resolve_versions(read_table(spark, d, "orders"), ["o_custkey", "o_orderpriority"], F.col("o_orderstatus") == "O", [F.col("o_orderdate"), F.col("o_orderkey")]).select("o_orderkey", "is_selected")


@query("""
    SELECT DISTINCT c.chunk_version_uid FROM chunks c LEFT JOIN (SELECT document_uid, arg_max(ocr_status, struct_pack(u := updated_at, o := ocr_status)) AS status FROM local_documents GROUP BY 1) v USING (document_uid)
    WHERE v.document_uid IS NULL OR v.status = 'success'
""")
def active_or_unversioned(spark: SparkSession, d: str) -> DataFrame:
    """Chunks whose document is active or unknown."""
    v = read_table(spark, d, "local_documents").groupBy("document_uid").agg(F.max_by("ocr_status", F.struct("updated_at", "ocr_status")).alias("status"), F.lit(True).alias("known"))
    return read_table(spark, d, "chunks").select("chunk_version_uid", "document_uid").distinct().join(v, "document_uid", "left").where("known is null or status = 'success'").select("chunk_version_uid").distinct()


@query("""
    SELECT DISTINCT document_uid FROM local_documents l WHERE EXISTS (SELECT 1 FROM chunks c WHERE c.document_uid = l.document_uid AND c.content_type = 'table')
""")
def documents_with_tables(spark: SparkSession, d: str) -> DataFrame:
    """Files that have a table: a semi join instead of a join and a distinct."""
    tables = read_table(spark, d, "chunks").where("content_type = 'table'").select("document_uid")
    return read_table(spark, d, "local_documents").select("document_uid").distinct().join(tables, "document_uid", "left_semi")


@query("""
    WITH a AS (SELECT sample_id, min(content_hash) AS h FROM quality_report WHERE reported_at < TIMESTAMP '2024-03-01' GROUP BY 1),
         b AS (SELECT sample_id, min(content_hash) AS h FROM quality_report WHERE reported_at >= TIMESTAMP '2024-02-01' GROUP BY 1)
    SELECT coalesce(a.sample_id, b.sample_id) AS sample_id,
           CASE WHEN a.sample_id IS NULL THEN 'new' WHEN b.sample_id IS NULL THEN 'missing' WHEN a.h IS NOT DISTINCT FROM b.h THEN 'unchanged' ELSE 'changed' END AS status
    FROM a FULL JOIN b ON a.sample_id = b.sample_id
""")
def upsert_change_status(spark: SparkSession, d: str) -> DataFrame:
    """What a later batch of reports changes."""
    rows = read_table(spark, d, "quality_report").select("sample_id", "content_hash", F.col("reported_at").cast("timestamp").alias("at"))
    old = rows.where("at < timestamp'2024-03-01'").groupBy("sample_id").agg(F.min("content_hash").alias("h"))
    new = rows.where("at >= timestamp'2024-02-01'").groupBy("sample_id").agg(F.min("content_hash").alias("h"))
    return dedup.upsert_status(old, new, "sample_id", "h")


@query("""
    SELECT l_partkey, l_suppkey, l_linenumber FROM (
        SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_linenumber, l_suppkey, l_orderkey) AS rn FROM lineitem WHERE l_returnflag <> 'R') WHERE rn = 1
""")
def source_fallback(spark: SparkSession, d: str) -> DataFrame:
    """The first source of each part, by priority, that succeeds."""
    order = [F.col(c) for c in ("l_linenumber", "l_suppkey", "l_orderkey")]
    return dedup.first_success(read_table(spark, d, "lineitem"), ["l_partkey"], order, F.col("l_returnflag") != "R").select("l_partkey", "l_suppkey", "l_linenumber")


@query("""
    SELECT event_type, count(*) FILTER (WHERE value < 30) AS pending, count(*) FILTER (WHERE value >= 30 AND value < 70) AS running, count(*) FILTER (WHERE value >= 70) AS done
    FROM events GROUP BY 1
""")
def queue_matrix(spark: SparkSession, d: str) -> DataFrame:
    """Tasks by kind and state."""
    state = F.when(F.col("value") < 30, "pending").when(F.col("value") < 70, "running").when(F.col("value") >= 70, "done")
    rows = read_table(spark, d, "events").withColumn("state", state)  # the states are fixed, so one pass does
    count = lambda s: F.count(F.when(F.col("state") == s, 1)).alias(s)
    return rows.groupBy("event_type").agg(count("pending"), count("running"), count("done"))


@query("""
    WITH e AS (SELECT event_id, user_id, value, lag(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS dependency FROM events)
    SELECT e.event_id FROM e LEFT JOIN e p ON p.event_id = e.dependency WHERE e.dependency IS NULL OR p.value >= 50
""")
def dependency_ready(spark: SparkSession, d: str) -> DataFrame:
    """Tasks without a dependency, or whose dependency has succeeded."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = read_table(spark, d, "events").select("event_id", F.lag("event_id").over(w).alias("dependency"), F.lag("value").over(w).alias("before"))
    return e.where("dependency is null or before >= 50").select("event_id")


@query("""
    SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n, round(sum(value), 3) AS seconds,
           max(epoch_us(ts)) - min(epoch_us(ts)) AS span_us
    FROM events GROUP BY 1, 2
""")
def stage_durations(spark: SparkSession, d: str) -> DataFrame:
    """Runs and durations by day and stage."""
    e = read_table(spark, d, "events").withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    return e.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 3).alias("seconds"), (F.max("us") - F.min("us")).alias("span_us")
    )


@query("""
    SELECT coalesce(track, '*') AS track, coalesce(difficulty, '*') AS difficulty, count(*) AS cases, CAST(sum(runs) AS BIGINT) AS runs,
           round(sum(wins) / nullif(sum(runs), 0), 6) AS pass_at_1, round(avg(CASE WHEN wins > 0 THEN 1.0 ELSE 0.0 END), 6) AS pass_at_k
    FROM (SELECT case_id, min(track) AS track, coalesce(min(grouping.difficulty), 'none') AS difficulty, count(*) AS runs,
                 count(*) FILTER (WHERE lower(trim(split)) = 'train') AS wins FROM agent_cases WHERE track IS NOT NULL GROUP BY 1)
    GROUP BY GROUPING SETS ((), (track), (difficulty))
""")
def evaluation_summary(spark: SparkSession, d: str) -> DataFrame:
    """Totals, by track and by difficulty: pass at 1 over runs, pass at k over cases."""
    win = split_label(F.col("split")) == "train"
    cases = read_table(spark, d, "agent_cases").where("track is not null").groupBy("case_id").agg(
        F.min("track").alias("track"), F.coalesce(F.min("grouping.difficulty"), F.lit("none")).alias("difficulty"), F.count(F.lit(1)).alias("runs"), F.count(F.when(win, 1)).alias("wins")
    )
    sets = cases.groupingSets([(), ("track",), ("difficulty",)], "track", "difficulty").agg(
        F.count(F.lit(1)).alias("cases"), F.sum("runs").alias("n"), F.sum("wins").alias("w"), F.avg(F.when(F.col("wins") > 0, 1.0).otherwise(0.0)).alias("k")
    )
    return sets.select(F.coalesce("track", F.lit("*")).alias("track"), F.coalesce("difficulty", F.lit("*")).alias("difficulty"), "cases", F.col("n").alias("runs"), F.round(F.try_divide("w", "n"), 6).alias("pass_at_1"), F.round("k", 6).alias("pass_at_k"))


@query("""
    SELECT user_id, count(DISTINCT value > 50) = 1 AS constant, bool_and(value > 50) AS all_won, bool_or(value > 50) AS any_won, round(avg(value), 6) AS mean_value FROM events GROUP BY 1
""")
def group_statistics(spark: SparkSession, d: str) -> DataFrame:
    """Whether the runs of a group agree, and their mean."""
    won = F.col("value") > 50
    return read_table(spark, d, "events").groupBy("user_id").agg(
        (F.min(won) == F.max(won)).alias("constant"), F.bool_and(won).alias("all_won"), F.bool_or(won).alias("any_won"), F.round(F.avg("value"), 6).alias("mean_value")
    )


@query("""
    SELECT work_uid, min(report_year) AS report_year FROM local_documents WHERE report_year IS NOT NULL GROUP BY 1 HAVING count(DISTINCT report_year) = 1
""")
def agreeing_values(spark: SparkSession, d: str) -> DataFrame:
    """Works whose files agree on the year."""
    return read_table(spark, d, "local_documents").where("report_year is not null").groupBy("work_uid").agg(F.min("report_year").alias("report_year"), F.max("report_year").alias("hi")).where("report_year = hi").select("work_uid", "report_year")


@query("""
    SELECT document_uid, count(*) AS attempts, CAST(coalesce(max(len(batch_ids)), 0) + 1 AS BIGINT) AS next_attempt FROM local_documents GROUP BY 1
""")
def next_attempts(spark: SparkSession, d: str) -> DataFrame:
    """The number of the next attempt at each file."""
    rows = read_table(spark, d, "local_documents").select("document_uid", F.size("batch_ids").alias("attempt"))
    return rows.groupBy("document_uid").agg(F.count(F.lit(1)).alias("attempts"), (F.coalesce(F.max("attempt"), F.lit(0)) + 1).cast("bigint").alias("next_attempt"))


@query("""
    SELECT 'documents' AS name, count(*) AS n FROM documents UNION ALL SELECT 'chunks', count(*) FROM chunks UNION ALL
    SELECT 'corpus', count(*) FROM corpus UNION ALL SELECT 'local_documents', count(*) FROM local_documents UNION ALL SELECT 'quality_report', count(*) FROM quality_report
""")
def inventory(spark: SparkSession, d: str) -> DataFrame:
    """Rows of five tables."""
    out = None
    for name in ("documents", "chunks", "corpus", "local_documents", "quality_report"):
        one = read_table(spark, d, name).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("""
    WITH t AS (SELECT n_nationkey AS k, n_regionkey * 400 + 100 AS lo, n_regionkey * 400 + 900 AS hi FROM nation)
    SELECT s_suppkey, count(*) AS scopes FROM supplier JOIN t ON s_nationkey = k AND abs(s_acctbal) BETWEEN lo AND hi GROUP BY 1
""")
def interval_scope(spark: SparkSession, d: str) -> DataFrame:
    """Rows in the range of a target: an equality and a range, so the join stays a hash join."""
    t = read_table(spark, d, "nation").select(F.col("n_nationkey").alias("s_nationkey"), (F.col("n_regionkey") * 400 + 100).alias("lo"), (F.col("n_regionkey") * 400 + 900).alias("hi"))
    s = read_table(spark, d, "supplier")
    return s.join(t, "s_nationkey").where(F.abs("s_acctbal").between(F.col("lo"), F.col("hi"))).groupBy("s_suppkey").agg(F.count(F.lit(1)).alias("scopes"))


@query("""
    WITH m AS (SELECT l_suppkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (WHERE l_linenumber = 1) AS a,
                      sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (WHERE l_linenumber = 2) AS b FROM lineitem GROUP BY 1)
    SELECT l_suppkey, CAST(b - a AS DOUBLE) AS difference, round(CAST(b - a AS DOUBLE) / nullif(CAST(a AS DOUBLE), 0) * 100, 2) AS growth FROM m
""")
def decimal_programs(spark: SparkSession, d: str) -> DataFrame:
    """Difference and growth of exact decimal sums."""
    amount = F.col("l_extendedprice").cast("decimal(18,2)")
    m = read_table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.sum(F.when(F.col("l_linenumber") == 1, amount)).alias("a"), F.sum(F.when(F.col("l_linenumber") == 2, amount)).alias("b"))
    gap = (F.col("b") - F.col("a")).cast("double")
    return m.select("l_suppkey", gap.alias("difference"), F.round(F.try_divide(gap, F.col("a").cast("double")) * 100, 2).alias("growth"))


@query("""
    SELECT CAST(epoch_us(time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01')) // 1000000 AS BIGINT) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total
    FROM events GROUP BY 1, 2
""")
def tumbling_windows(spark: SparkSession, d: str) -> DataFrame:
    """Events in windows of six hours."""
    e = read_table(spark, d, "events").withColumn("t", F.col("ts").cast("timestamp"))
    return e.groupBy(F.window("t", "6 hours").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.unix_seconds("w.start").alias("window_start"), "event_type", "n", "total")


@query("""
    WITH s AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL '2 hours' THEN 0 ELSE 1 END AS first FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    n AS (SELECT user_id, ts, sum(first) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM s)
    SELECT user_id, min(epoch_us(ts)) AS start_us, count(*) AS n FROM n GROUP BY user_id, k
""")
def session_windows(spark: SparkSession, d: str) -> DataFrame:
    """Sessions of a user that end after two hours without an event."""
    e = read_table(spark, d, "events").withColumn("t", F.col("ts").cast("timestamp"))
    s = e.groupBy("user_id", F.session_window("t", "2 hours").alias("w")).agg(F.count(F.lit(1)).alias("n"), F.min("t").alias("first"))
    return s.select("user_id", F.unix_micros("first").alias("start_us"), "n")


@query("""
    SELECT json_extract_string(props, '$.k') AS k, count(*) AS n, count(DISTINCT user_id) AS users FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL GROUP BY 1
""")
def json_key_counts(spark: SparkSession, d: str) -> DataFrame:
    """Events and users by a key inside a JSON column."""
    e = read_table(spark, d, "events").select(F.get_json_object("props", "$.k").alias("k"), "user_id").where("k is not null")
    per_user = e.groupBy("k", "user_id").agg(F.count(F.lit(1)).alias("n"))
    return per_user.groupBy("k").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("users"))


@query("""
    WITH runs AS (SELECT user_id, min(ts) AS a, max(ts) AS b FROM events WHERE event_type = 'purchase' GROUP BY 1)
    SELECT r.user_id, count(*) AS steps FROM runs r JOIN events e ON e.user_id = r.user_id AND e.ts BETWEEN r.a AND r.b GROUP BY 1
""")
def steps_inside_runs(spark: SparkSession, d: str) -> DataFrame:
    """Events of a user between the first and the last run."""
    e = read_table(spark, d, "events")
    runs = e.where("event_type = 'purchase'").groupBy("user_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    return e.join(runs, "user_id").where("ts between a and b").groupBy("user_id").agg(F.count(F.lit(1)).alias("steps"))


@query("""
    SELECT label, count(*) AS n, count(DISTINCT document_uid) AS documents FROM (SELECT document_uid, unnest(block_labels) AS label FROM (SELECT DISTINCT chunk_version_uid, document_uid, block_labels FROM chunks)) GROUP BY 1
""")
def layout_inventory(spark: SparkSession, d: str) -> DataFrame:
    """Blocks and documents by layout label."""
    rows = read_table(spark, d, "chunks").select("chunk_version_uid", "document_uid", "block_labels").distinct().select("document_uid", F.explode("block_labels").alias("label"))
    per_doc = rows.groupBy("label", "document_uid").agg(F.count(F.lit(1)).alias("n"))
    return per_doc.groupBy("label").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("documents"))


@query("""
    SELECT DISTINCT chunk_version_uid, CASE WHEN bboxes IS NULL THEN 'missing' WHEN len(list_filter(bboxes, lambda b: len(b) <> 4 OR b[1] >= b[3] OR b[2] >= b[4])) > 0 THEN 'invalid'
           WHEN len(list_filter(bboxes, lambda b: b[1] < 0 OR b[2] < 0 OR b[3] > 600 OR b[4] > 850)) > 0 THEN 'out' ELSE 'within' END AS bbox_status
    FROM chunks
""")
def bbox_status(spark: SparkSession, d: str) -> DataFrame:
    """Whether the boxes of a chunk are there, well-formed and on the page."""
    at = lambda b, i: F.try_element_at(b, F.lit(i))
    bad = F.exists("bboxes", lambda b: F.coalesce((F.size(b) != 4) | (at(b, 1) >= at(b, 3)) | (at(b, 2) >= at(b, 4)), F.lit(True)))
    out = F.exists("bboxes", lambda b: (at(b, 1) < 0) | (at(b, 2) < 0) | (at(b, 3) > 600) | (at(b, 4) > 850))
    return read_table(spark, d, "chunks").select("chunk_version_uid", F.when(F.col("bboxes").isNull(), "missing").when(bad, "invalid").when(out, "out").otherwise("within").alias("bbox_status")).distinct()


@query("""
    WITH e AS (SELECT user_id, ts, event_id, CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'succeeded' WHEN 'view' THEN 'deferred' ELSE 'started' END AS status FROM events),
    a AS (SELECT user_id, arg_max(status, struct_pack(t := ts, s := status)) AS last, count(*) FILTER (WHERE status = 'failed') AS failures,
                 count(*) FILTER (WHERE status IN ('started', 'failed')) AS starts, count(*) FILTER (WHERE status = 'deferred') AS deferred FROM e GROUP BY 1)
    SELECT user_id, CASE WHEN last = 'failed' AND failures < 20 THEN 'retry_wait' ELSE last END AS status, greatest(starts - deferred, 0) AS attempts,
           CASE WHEN last = 'failed' AND failures < 20 THEN least(3600.0, 5 * pow(2.0, failures)) END AS wait_seconds
    FROM a
""")
def task_states(spark: SparkSession, d: str) -> DataFrame:
    """The state of each task after its events: retries, waits and deferrals."""
    kind = F.col("event_type")
    status = F.when(kind == "error", "failed").when(kind == "purchase", "succeeded").when(kind == "view", "deferred").otherwise("started")
    events = read_table(spark, d, "events").select("user_id", "ts", status.alias("status"))
    return S.task_states(events, "user_id", "ts", "status", retries=20)


@query()
def bootstrap_intervals(spark: SparkSession, d: str) -> DataFrame:
    """Mean value of each event type with its bootstrap interval."""
    return S.bootstrap_mean(read_table(spark, d, "events").select("event_id", "event_type", "value"), "value", ["event_type"])


@query("""
    SELECT coalesce(event_type, '*') AS event_type, coalesce(day, '*') AS day, count(*) AS episodes, count(DISTINCT user_id) AS users,
           round(avg(value), 6) AS mean_reward, count(*) FILTER (WHERE value > 50) AS accepted
    FROM (SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, user_id, value FROM events) GROUP BY GROUPING SETS ((), (event_type), (day), (event_type, day))
""")
def episode_report(spark: SparkSession, d: str) -> DataFrame:
    """Episodes in total, by kind, by day and by both; users are counted from one row per user and slice."""
    e = read_table(spark, d, "events").select("event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"), "user_id", "value")
    fine = e.groupBy("event_type", "day", "user_id").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("v"), F.count("value").alias("nv"), F.count(F.when(F.col("value") > 50, 1)).alias("ok"))
    sets = fine.groupingSets([(), ("event_type",), ("day",), ("event_type", "day")], "event_type", "day")
    return sets.agg(
        F.sum("n").alias("episodes"), F.countDistinct("user_id").alias("users"), F.round(F.sum("v") / F.sum("nv"), 6).alias("mean_reward"), F.sum("ok").alias("accepted")
    ).select(F.coalesce("event_type", F.lit("*")).alias("event_type"), F.coalesce("day", F.lit("*")).alias("day"), "episodes", "users", "mean_reward", "accepted")


@query("""
    SELECT coalesce(a.s, b.s) AS sample_id, a.h AS corpus_hash, b.h AS report_hash FROM
      (SELECT sample_id AS s, min(sha256(text)) AS h FROM corpus GROUP BY 1) a JOIN
      (SELECT sample_id AS s, min(lower(content_hash)) AS h FROM quality_report GROUP BY 1) b ON a.s = b.s AND a.h <> b.h
""")
def score_identity_guard(spark: SparkSession, d: str) -> DataFrame:
    """Samples whose report was made for another text; none if the reports may be used."""
    a = read_table(spark, d, "corpus").groupBy("sample_id").agg(F.min(F.sha2("text", 256)).alias("corpus_hash"))
    b = read_table(spark, d, "quality_report").groupBy("sample_id").agg(F.min(F.lower("content_hash")).alias("report_hash"))
    return a.join(b, "sample_id").where("corpus_hash <> report_hash").select("sample_id", "corpus_hash", "report_hash")


@query("""
    SELECT CAST(o_custkey AS BIGINT) AS custkey, arg_max(o_orderkey, struct_pack(d := o_orderdate, k := o_orderkey)) AS last_order, count(*) AS orders
    FROM orders GROUP BY 1
""")
def latest_run(spark: SparkSession, d: str) -> DataFrame:
    """The last order of each customer: the point-in-time lookup, combined before the shuffle."""
    return read_table(spark, d, "orders").groupBy(F.col("o_custkey").alias("custkey")).agg(F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("last_order"), F.count(F.lit(1)).alias("orders"))


@query("""
    SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n
    FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2
""")
def pricing_summary(spark: SparkSession, d: str) -> DataFrame:
    """Sums by two flags below a date, with the filter in the scan."""
    rows = read_table(spark, d, "lineitem").where("l_shipdate <= timestamp_ntz'1998-09-02 00:00:00'")
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count(F.lit(1)).alias("n"))


def _report_states(spark: SparkSession, d: str) -> DataFrame:
    columns = ["document_uid", "asset_uid", "stock_code", "company_name", "report_year", "report_type", "title", "source_name", "language", "raw_file_hash", "publish_date", "work_uid", "updated_at"]
    rows = dedup.last_wins(read_table(spark, d, "local_documents").select(*columns), "document_uid", "updated_at")
    return rows.withColumn("announcement_date", F.col("publish_date").cast("string"))


_STATES = """
    s AS (SELECT document_uid, unnest(arg_max(struct_pack(asset_uid, stock_code, company_name, report_year, report_type, title, source_name, language, raw_file_hash, publish_date, work_uid),
          updated_at)) FROM local_documents GROUP BY 1)
"""
_GIVEN = " AND ".join(f"coalesce(CAST({c} AS VARCHAR) <> '', FALSE)" for c in ("document_uid", "asset_uid", "stock_code", "company_name", "report_year", "report_type", "title", "source_name", "language", "raw_file_hash"))
_TITLED = "TRY_CAST(nullif(regexp_extract(title, '(?:^|[^0-9])(20[0-9]{2})(?:[^0-9]|$)', 1), '') AS INTEGER)"


@query(f"""
    WITH {_STATES}, q AS (SELECT unnest([
        struct_pack(name := 'metadata_required_fields', ok := {_GIVEN}),
        struct_pack(name := 'metadata_stock_code_format', ok := coalesce(regexp_matches(stock_code, '^[0-9]{{6}}$'), FALSE)),
        struct_pack(name := 'metadata_report_type', ok := coalesce(report_type IN ('annual', 'semiannual', 'quarterly', 'research'), FALSE)),
        struct_pack(name := 'metadata_report_year', ok := coalesce(report_year BETWEEN 1990 AND 2100, FALSE)),
        struct_pack(name := 'metadata_title_year_consistency', ok := report_year IS NOT NULL AND coalesce({_TITLED} = report_year, TRUE)),
        struct_pack(name := 'metadata_announcement_date', ok := TRUE),
        struct_pack(name := 'metadata_raw_hash', ok := coalesce(regexp_matches(raw_file_hash, '^[0-9a-f]{{64}}$'), FALSE))]) AS k FROM s)
    SELECT k.name AS name, CASE WHEN k.ok THEN 'pass' ELSE 'warn' END AS status, count(*) AS n FROM q GROUP BY 1, 2
""")
def metadata_qc_summary(spark: SparkSession, d: str) -> DataFrame:
    """The hints on the valid metadata of all files."""
    return S.check_summary(S.checks(_report_states(spark, d), "document_uid", rules.financial_metadata_rules()))


@query(f"""
    WITH {_STATES} SELECT document_uid, coalesce(regexp_matches(stock_code, '^[0-9]{{6}}$'), FALSE) AND coalesce({_TITLED} = report_year, FALSE)
      AND coalesce(NOT regexp_matches(title, '摘要|英文|取消'), FALSE) AS qc_passed FROM s
""")
def candidate_qc(spark: SparkSession, d: str) -> DataFrame:
    """Whether each file would pass as a discovered report."""
    rows = _report_states(spark, d).withColumn("source_url", F.lit("https://x.example/y"))
    return S.checks(rows, "document_uid", rules.candidate_rules()).select("document_uid", "qc_passed")


@query("""
    WITH g AS (SELECT governed_uid, min(work_uid) AS w, min(asset_uid) AS a, min(document_uid) AS p, count(*) AS n, sum(length(text)) AS chars
               FROM (SELECT DISTINCT governed_uid, work_uid, asset_uid, document_uid, chunk_version_uid, text FROM chunks) GROUP BY 1)
    SELECT governed_uid, coalesce(governed_uid <> '', FALSE) AND n > 0 AND coalesce(chars > 0, FALSE) AND coalesce(w <> '', FALSE) AND coalesce(a <> '', FALSE) AND coalesce(p <> '', FALSE) AS qc_passed FROM g
""")
def governed_document_qc(spark: SparkSession, d: str) -> DataFrame:
    """Whether each governed document has an id, blocks, text and lineage."""
    rows = read_table(spark, d, "chunks").select("governed_uid", "work_uid", "asset_uid", "document_uid", "chunk_version_uid", "text").distinct()
    g = rows.groupBy("governed_uid").agg(F.min("work_uid").alias("work_uid"), F.min("asset_uid").alias("asset_uid"), F.min("document_uid").alias("input_path"), F.count(F.lit(1)).alias("n_blocks"), F.sum(F.length("text")).alias("char_count"))
    return S.checks(g, "governed_uid", rules.governed_document_rules()).select("governed_uid", "qc_passed")


@query(f"""
    WITH {_QC}, c2 AS (SELECT DISTINCT chunk_version_uid, chunk_index FROM chunks WHERE chunk_index % 2 = 0)
    SELECT DISTINCT q.chunk_version_uid, q.k.name AS name FROM q JOIN c2 USING (chunk_version_uid) WHERE q.k.status = 'warn'
""")
def release_gate(spark: SparkSession, d: str) -> DataFrame:
    """The warnings of the chunks at even places, read as the failures that would stop their release."""
    results = _checked(spark, d).select("chunk_version_uid", F.explode("qc_checks").alias("k")).select("chunk_version_uid", "k.name", F.when(F.col("k.status") == "warn", "fail").otherwise(F.col("k.status")).alias("status"))
    return S.failed_gate(read_table(spark, d, "chunks").where("chunk_index % 2 = 0"), results, "chunk_version_uid")


@query("""
    WITH t AS (SELECT event_id, CASE event_type WHEN 'click' THEN 'pending' WHEN 'view' THEN 'running' WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'succeeded' ELSE 'deferred' END AS status,
                      CASE WHEN event_id % 3 = 0 THEN event_id - 1 END AS dependency, ts, ts + INTERVAL 6 HOUR AS lease FROM events),
    n AS (SELECT max(ts) - INTERVAL 5 DAY AS now FROM events)
    SELECT t.event_id AS task_uid, CASE WHEN t.status = 'running' THEN 'retry_wait' ELSE t.status END AS status
    FROM t CROSS JOIN n LEFT JOIN t p ON p.event_id = t.dependency
    WHERE ((t.status = 'running' AND t.lease < now) OR (t.status IN ('pending', 'deferred') AND t.ts <= now)) AND (t.dependency IS NULL OR p.status = 'succeeded')
""")
def claimable_tasks(spark: SparkSession, d: str) -> DataFrame:
    """Events read as tasks: those that may run five days before the last event."""
    e = read_table(spark, d, "events")
    now = e.agg(F.max("ts")).first()[0]
    states = {"click": "pending", "view": "running", "error": "failed", "purchase": "succeeded"}
    status = F.lit("deferred")
    for kind, name in states.items():
        status = F.when(F.col("event_type") == kind, name).otherwise(status)
    tasks = e.select(F.col("event_id").alias("task_uid"), F.lit("parse").alias("kind"), status.alias("status"), F.lit(0).alias("attempts"), F.when(F.col("event_id") % 3 == 0, F.col("event_id") - 1).alias("dependency_uid"),
                     F.col("ts").alias("available_at"), (F.col("ts") + F.expr("interval 6 hours")).alias("lease_until"), F.col("ts").alias("created_at"))
    return S.claimable(tasks, F.lit(now).cast("timestamp_ntz") - F.expr("interval 5 days")).select("task_uid", "status")
