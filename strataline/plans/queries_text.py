"""Queries on texts, lines and chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import dedup
from ..sources.tables import read_table
from .registering import registry

QUERIES, ORACLE, query = registry()

_COLLAPSED = r"trim(regexp_replace(lower(text), '[ \t\n\r\f\x0B]+', ' ', 'g'))"
_NUM = r"[+-]?[0-9]+(?:[,.][0-9]+)*%?"


@query(rf"""
    SELECT doc_id, min(doc_id) OVER (PARTITION BY sha256({_COLLAPSED})) AS representative,
           doc_id = min(doc_id) OVER (PARTITION BY sha256({_COLLAPSED})) AS is_kept
    FROM documents WHERE text IS NOT NULL
""")
def exact_dedup_keep_first(spark: SparkSession, d: str) -> DataFrame:
    """Every document with the first of its normalised text."""
    docs = read_table(spark, d, "documents").where("text is not null").select("doc_id", T.content_hash(F.col("text")).alias("h"))
    return dedup.keep_first(docs, F.col("h"), "doc_id").select("doc_id", "representative", "is_kept")


@query(rf"""
    SELECT doc_id, array_to_string(regexp_extract_all(text, '{_NUM}'), ' ') AS guard,
           CAST(len(regexp_extract_all(text, '{_NUM}')) AS INTEGER) AS n_numbers
    FROM documents
""")
def numeric_guard_signature(spark: SparkSession, d: str) -> DataFrame:
    """The ordered numbers of each text."""
    return read_table(spark, d, "documents").select("doc_id", T.guard_signature(F.col("text")).alias("guard"), F.size(T.numbers(F.col("text"))).alias("n_numbers"))


@query(rf"""
    SELECT c.seq, array_to_string(list_sort(list_filter(regexp_extract_all(c.text, '{_NUM}'),
             lambda x: NOT list_contains(regexp_extract_all(b.text, '{_NUM}'), x))), ' ') AS unmatched
    FROM (SELECT DISTINCT seq, text, work_uid FROM corpus) c
    JOIN (SELECT work_uid, arg_min(text, seq) AS text FROM corpus GROUP BY 1) b USING (work_uid)
""")
def unmatched_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Numbers of a sample that the first sample of its work does not hold."""
    rows = read_table(spark, d, "corpus").select("seq", "text", "work_uid").distinct()
    base = rows.groupBy("work_uid").agg(F.min_by("text", "seq").alias("base")).select("work_uid", T.numbers(F.col("base")).alias("base"))
    own = T.numbers(F.col("text"))
    missing = F.array_sort(F.filter(own, lambda x: ~F.array_contains("base", x)))
    return rows.join(base, "work_uid").select("seq", F.concat_ws(" ", missing).alias("unmatched"))


_SQL_EMAIL = r"[\p{L}\p{N}_.+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+([^\p{L}\p{N}_.-]|$)"
_SQL_PHONE = r"(^|[^0-9])(?:\+?86[-\s]?)?(?:1[3-9](?:[-\s]?[0-9]){9}|0[0-9]{2,3}[-\s]?[0-9]{7,8})([^0-9]|$)"


@query(rf"""
    WITH e AS (SELECT doc_id, len(regexp_extract_all(text, '{_SQL_EMAIL}')) AS emails, regexp_replace(text, '{_SQL_EMAIL}', '<EMAIL>\1', 'g') AS t FROM documents)
    SELECT doc_id, CAST(emails AS BIGINT) AS emails, CAST(len(regexp_extract_all(t, '{_SQL_PHONE}')) AS BIGINT) AS phones,
           sha256(regexp_replace(regexp_replace(t, '{_SQL_PHONE}', '\1<PHONE>\2', 'g'), '{_SQL_PHONE}', '\1<PHONE>\2', 'g')) AS redacted_hash
    FROM e
""")
def contact_redaction(spark: SparkSession, d: str) -> DataFrame:
    """E-mail addresses and phone numbers of each text, and the digest of the text with marks in their places."""
    emails, phones = T.contacts(F.col("text"))
    return read_table(spark, d, "documents").select("doc_id", emails.cast("bigint").alias("emails"), phones.cast("bigint").alias("phones"), F.sha2(T.redacted(F.col("text")), 256).alias("redacted_hash"))


@query(r"""
    WITH lines AS (
        SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL
    ), measured AS (
        SELECT doc_id, length(line) AS chars, len(regexp_extract_all(line, '[\p{L}\p{N}]')) AS alnum,
               coalesce(list_max(list_transform(regexp_extract_all(line, '[A-Za-z]+'), lambda x: length(x))), 0) AS longest,
               coalesce(list_sum(list_transform(regexp_extract_all(line, '[A-Za-z]+'), lambda x: len(regexp_extract_all(lower(x), '[bcdfghjklmnpqrstvwxyz]{4,}')))), 0) AS clusters
        FROM lines
    )
    SELECT doc_id, count(*) AS n_lines,
           count(*) FILTER (WHERE alnum = 0 OR alnum / greatest(chars, 1) < 0.35 OR longest >= 30 OR (clusters >= 2 AND longest >= 20)) AS noise_lines
    FROM measured GROUP BY 1
""")
def noise_line_flags(spark: SparkSession, d: str) -> DataFrame:
    """Lines and noise lines of each text; counted inside the row, so nothing is shuffled."""
    lines = F.split("text", "\n")
    return read_table(spark, d, "documents").where("text is not null").select(
        "doc_id", F.size(lines).cast("bigint").alias("n_lines"), F.size(F.filter(lines, T.noise_line)).cast("bigint").alias("noise_lines")
    )


@query(r"""
    WITH m AS (
        SELECT doc_id, length(text) AS chars,
               len(list_filter(string_split(text, chr(10)), lambda x: length(regexp_replace(x, '\s', '', 'g')) > 0)) AS nonblank_lines,
               len(regexp_extract_all(text, chr(65533))) AS lost_chars,
               length(regexp_replace(text, '\s', '', 'g')) AS visible,
               len(regexp_extract_all(text, '[\p{L}\p{N}]')) AS wordlike
        FROM documents WHERE text IS NOT NULL
    )
    SELECT doc_id, chars, CAST(nonblank_lines AS BIGINT) AS nonblank_lines, CAST(lost_chars AS BIGINT) AS lost_chars, visible,
           round_even(wordlike / greatest(visible, 1), 4) AS word_ratio,
           CASE WHEN chars < 20 OR lost_chars > 0 OR wordlike / greatest(visible, 1) < 0.2 THEN 'needs_review' ELSE 'passed' END AS status
    FROM m
""")
def ocr_style_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Character metrics of each text and whether any of them warns."""
    text = F.col("text")
    visible = F.length(F.regexp_replace(text, r"\s", ""))
    ratio = F.regexp_count(text, F.lit(r"[\p{L}\p{N}]")) / F.greatest(F.col("visible"), F.lit(1))
    lines = F.size(F.filter(F.split(text, "\n"), lambda x: F.length(F.regexp_replace(x, r"\s", "")) > 0))
    return (
        read_table(spark, d, "documents").where("text is not null")
        .select("doc_id", text, F.length(text).cast("bigint").alias("chars"), lines.cast("bigint").alias("nonblank_lines"),
                F.regexp_count(text, F.lit("�")).cast("bigint").alias("lost_chars"), visible.cast("bigint").alias("visible"))
        .select("doc_id", "chars", "nonblank_lines", "lost_chars", "visible", F.bround(ratio, 4).alias("word_ratio"),
                F.when((F.col("chars") < 20) | (F.col("lost_chars") > 0) | (ratio < 0.2), "needs_review").otherwise("passed").alias("status"))
    )


@query(r"""
    SELECT doc_id,
           CASE WHEN len(regexp_extract_all(substr(text, 1, 4000), '[一-鿿]')) / greatest(length(substr(text, 1, 4000)), 1) > 0.15
                THEN 'zh' ELSE 'en' END AS detected
    FROM documents WHERE text IS NOT NULL
""")
def language_detection(spark: SparkSession, d: str) -> DataFrame:
    """zh or en by the share of Chinese characters in the stretch the rule is defined on."""
    return read_table(spark, d, "documents").where("text is not null").select("doc_id", T.detected_language(F.col("text")).alias("detected"))


@query(r"""
    WITH w AS (SELECT doc_id, regexp_extract_all(text, '[A-Za-z][A-Za-z\-]{2,}') AS words FROM documents WHERE text IS NOT NULL)
    SELECT doc_id, CASE WHEN len(words) = 0 THEN 0.0
           ELSE least(100.0, greatest(0.0, round_even(100 - 400 * (len(list_filter(words, lambda x: length(x) >= 18)) / len(words)), 0))) END AS score
    FROM w
""")
def quality_heuristic(spark: SparkSession, d: str) -> DataFrame:
    """The long-word score of each text."""
    return read_table(spark, d, "documents").where("text is not null").select("doc_id", T.long_word_score(F.col("text")).alias("score"))


@query(rf"""
    WITH w AS (
        SELECT source, lower(unnest(regexp_extract_all(text, '[A-Za-z][A-Za-z\-]{{2,}}'))) AS word FROM documents WHERE text IS NOT NULL
    ), c AS (
        SELECT lower(trim(source)) AS source_name, word, count(*) AS n FROM w
        WHERE length(word) >= 4 AND word NOT IN ({', '.join(f"'{x}'" for x in T.TOPIC_STOP)}) GROUP BY 1, 2
    )
    SELECT source_name, list_aggregate(list_transform(string_split(word, '-'), lambda p: upper(p[1]) || lower(p[2:])), 'string_agg', '-') AS topic, n, rn FROM (
        SELECT *, row_number() OVER (PARTITION BY source_name ORDER BY n DESC, word) AS rn FROM c) WHERE rn <= 5
""")
def topic_terms(spark: SparkSession, d: str) -> DataFrame:
    """The five most frequent topic words of each source."""
    words = read_table(spark, d, "documents").where("text is not null").select(F.lower(F.trim("source")).alias("source_name"), F.explode(T.topic_words(F.col("text"))).alias("word"))
    counts = words.groupBy("source_name", "word").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("source_name").orderBy(F.desc("n"), "word")
    top = counts.withColumn("rn", F.row_number().over(w).cast("bigint")).where("rn <= 5")
    return top.select("source_name", T.title_case(F.col("word")).alias("topic"), "n", "rn")


@query(r"""
    WITH l AS (
        SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS line_no, unnest(string_split(text, chr(10))) AS line
        FROM documents WHERE text IS NOT NULL
    )
    SELECT doc_id, line_no, CAST(coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY line_no
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS char_start, length(line) AS n_chars
    FROM l
""")
def line_offsets(spark: SparkSession, d: str) -> DataFrame:
    """Every line with its offset; the running sum runs inside the row."""
    lengths = F.transform(F.split("text", "\n"), lambda x: F.length(x).cast("bigint"))
    step = F.aggregate(
        "ls",
        F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<char_start:bigint,n_chars:bigint>>").alias("out")),
        lambda acc, n: F.struct((acc["at"] + n + 1).alias("at"), F.array_append(acc["out"], F.struct(acc["at"].alias("char_start"), n.alias("n_chars"))).alias("out")),
        lambda acc: acc["out"],
    )
    rows = read_table(spark, d, "documents").where("text is not null").select("doc_id", lengths.alias("ls"))
    return rows.select("doc_id", F.posexplode(step).alias("p", "l")).select("doc_id", (F.col("p") + 1).cast("bigint").alias("line_no"), "l.char_start", "l.n_chars")


@query(rf"""
    WITH l AS (
        SELECT chunk_version_uid, generate_subscripts(string_split(text, chr(10)), 1) AS n, unnest(string_split(text, chr(10))) AS line
        FROM (SELECT DISTINCT chunk_version_uid, text FROM chunks WHERE text IS NOT NULL)
    ), h AS (
        SELECT chunk_version_uid, min(n) FILTER (WHERE regexp_matches(line,
          '{T.REFERENCE_HEADING}')) AS cut
        FROM l GROUP BY 1
    )
    SELECT l.chunk_version_uid, count(*) FILTER (WHERE cut IS NULL OR n < cut) AS kept_lines,
           count(*) FILTER (WHERE n >= cut) AS removed_lines,
           CAST(coalesce(sum(length(line)) FILTER (WHERE n >= cut), 0) AS BIGINT) AS removed_chars
    FROM l JOIN h USING (chunk_version_uid) GROUP BY 1
""")
def reference_tail(spark: SparkSession, d: str) -> DataFrame:
    """Lines kept and removed when a text is cut at its first reference heading."""
    chunks = read_table(spark, d, "chunks").where("text is not null").select("chunk_version_uid", "text").distinct()
    lines = F.split("text", "\n")
    cut = F.array_position(F.transform(lines, lambda x: T.reference_heading(x).cast("int")), 1)
    kept = F.when(F.col("cut") > 0, F.slice("lines", 1, (F.col("cut") - 1).cast("int"))).otherwise(F.col("lines"))
    gone = F.slice("lines", (F.size("kept") + 1), F.greatest(F.size("lines") - F.size("kept"), F.lit(0)))
    chars = F.aggregate(gone, F.lit(0).cast("bigint"), lambda a, x: a + F.length(x))
    return (
        chunks.select("chunk_version_uid", lines.alias("lines"), cut.alias("cut")).withColumn("kept", kept)
        .select("chunk_version_uid", F.size("kept").cast("bigint").alias("kept_lines"), (F.size("lines") - F.size("kept")).cast("bigint").alias("removed_lines"), chars.alias("removed_chars"))
    )


@query(rf"""
    WITH k AS (
        SELECT document_uid, rule_version, chunk_index, chunk_version_uid, length(text) AS n, regexp_matches(text, '{T.REFERENCE_HEADING}') OR coalesce(list_contains(block_labels, 'reference'), FALSE) AS opens
        FROM (SELECT DISTINCT document_uid, rule_version, chunk_index, chunk_version_uid, text, block_labels FROM chunks WHERE text IS NOT NULL)
    ), c AS (
        SELECT *, max(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY document_uid, rule_version ORDER BY chunk_index, chunk_version_uid) = 1 AS gone FROM k
    )
    SELECT document_uid, rule_version, bool_or(gone) AS detected, count(*) FILTER (WHERE gone) AS removed_blocks, CAST(coalesce(sum(n) FILTER (WHERE gone), 0) AS BIGINT) AS removed_chars
    FROM c GROUP BY 1, 2
""")
def reference_section_cut(spark: SparkSession, d: str) -> DataFrame:
    """What is removed of each document from its first reference heading or block labelled reference on."""
    rows = read_table(spark, d, "chunks").where("text is not null").select("document_uid", "rule_version", "chunk_index", "chunk_version_uid", "text", "block_labels").distinct()
    opens = T.reference_heading(F.col("text")) | F.coalesce(F.array_contains("block_labels", "reference"), F.lit(False))
    at = F.struct("chunk_index", "chunk_version_uid")
    placed = rows.select("document_uid", "rule_version", at.alias("at"), F.length("text").alias("n"), F.when(opens, at).alias("open"))
    # The cut is a minimum, which combines before the shuffle; a document's rows meet it by a join on small keys.
    cut = placed.groupBy("document_uid", "rule_version").agg(F.min("open").alias("cut")).select(F.col("document_uid").alias("u"), F.col("rule_version").alias("v"), "cut")
    gone = F.coalesce(F.col("at") >= F.col("cut"), F.lit(False))
    joined = placed.join(cut, F.col("document_uid").eqNullSafe(F.col("u")) & F.col("rule_version").eqNullSafe(F.col("v")))
    return joined.groupBy("document_uid", "rule_version").agg(
        F.max(gone).alias("detected"), F.count(F.when(gone, 1)).alias("removed_blocks"), F.coalesce(F.sum(F.when(gone, F.col("n"))), F.lit(0)).cast("bigint").alias("removed_chars")
    )


_SQL_LEVEL = r"""CASE WHEN regexp_matches(clean, '^#{1,6}\s') THEN length(regexp_extract(clean, '^(#{1,6})\s', 1))
                WHEN label = 'doc_title' THEN 1 WHEN label = 'abstract' THEN 2
                WHEN label = 'paragraph_title' AND regexp_matches(clean, '^[0-9]+(\.[0-9]+)*\.?\s') THEN 3 ELSE 2 END"""
_SQL_KIND = """CASE label WHEN 'header' THEN 'noise' WHEN 'footer' THEN 'noise' WHEN 'number' THEN 'noise' WHEN 'vision_footnote' THEN 'noise'
                WHEN 'doc_title' THEN 'heading' WHEN 'paragraph_title' THEN 'heading' WHEN 'table' THEN 'table' WHEN 'formula' THEN 'formula'
                WHEN 'image' THEN 'figure' WHEN 'chart' THEN 'figure' WHEN 'figure_title' THEN 'caption' WHEN 'reference' THEN 'reference'
                WHEN 'footnote' THEN 'footnote' WHEN 'algorithm' THEN 'algorithm' ELSE 'paragraph' END"""
_SQL_CLEAN = r"regexp_replace(text, '^\s+|\s+$', '', 'g') AS clean, coalesce(block_labels[1], '') AS label"


@query(f"""
    SELECT DISTINCT chunk_version_uid, {_SQL_LEVEL} AS heading_level, {_SQL_KIND} AS kind
    FROM (SELECT chunk_version_uid, {_SQL_CLEAN} FROM chunks WHERE text IS NOT NULL)
""")
def heading_levels(spark: SparkSession, d: str) -> DataFrame:
    """Heading level and content type by the first layout label."""
    first = F.try_element_at("block_labels", F.lit(1))
    return read_table(spark, d, "chunks").where("text is not null").select(
        "chunk_version_uid", T.heading_level(F.col("text"), F.coalesce(first, F.lit(""))).cast("bigint").alias("heading_level"), T.content_type(first).alias("kind")
    ).distinct()


@query("""
    SELECT rule, count(*) AS blocks, count(*) FILTER (WHERE dropped) AS dropped FROM (
        SELECT g.rule_version AS rule, list_contains(g.drop_block_labels, label) AS dropped
        FROM (SELECT rule_version, unnest(block_labels) AS label FROM (SELECT DISTINCT chunk_version_uid, rule_version, block_labels FROM chunks)) c
        JOIN governance_config g ON c.rule_version = g.rule_version OR (c.rule_version IS NULL AND g.is_default))
    GROUP BY 1
""")
def dropped_labels(spark: SparkSession, d: str) -> DataFrame:
    """Blocks of each governance rule and how many of them its labels drop."""
    rules = read_table(spark, d, "governance_config")
    keyed = rules.select("rule_version", "drop_block_labels", F.col("rule_version").alias("rule")).unionByName(
        rules.where("is_default").select(F.lit(None).cast("string").alias("rule_version"), "drop_block_labels", F.col("rule_version").alias("rule"))
    )
    chunks = read_table(spark, d, "chunks").select("chunk_version_uid", "rule_version", "block_labels").distinct()
    joined = chunks.join(F.broadcast(keyed), chunks.rule_version.eqNullSafe(keyed.rule_version))  # a fixed table
    dropped = F.size(F.filter("block_labels", lambda x: F.array_contains("drop_block_labels", x)))
    return joined.groupBy("rule").agg(F.sum(F.size("block_labels")).alias("blocks"), F.sum(dropped).alias("dropped"))


@query(rf"""
    WITH c AS (SELECT DISTINCT chunk_version_uid, document_uid, rule_version, chunk_index, {_SQL_CLEAN} FROM chunks WHERE text IS NOT NULL)
    SELECT document_uid, rule_version, sha256(string_agg(CASE WHEN {_SQL_KIND} = 'heading' AND NOT starts_with(clean, '#') THEN repeat('#', {_SQL_LEVEL}) || ' ' || clean ELSE clean END,
           chr(10) || chr(10) ORDER BY chunk_index, chunk_version_uid)) AS markdown_hash, count(*) AS parts
    FROM c GROUP BY 1, 2
""")
def governed_markdown(spark: SparkSession, d: str) -> DataFrame:
    """Digest of each document as one Markdown text, parts in order, headings with their level."""
    chunks = read_table(spark, d, "chunks").where("text is not null").select("chunk_version_uid", "document_uid", "rule_version", "chunk_index", "block_labels", "text").distinct()
    part = T.governed_part(F.col("text"), F.coalesce(F.try_element_at("block_labels", F.lit(1)), F.lit("")))
    parts = F.array_sort(F.collect_list(F.struct("chunk_index", "chunk_version_uid", part.alias("part"))))  # the result is the document itself
    return chunks.groupBy("document_uid", "rule_version").agg(parts.alias("p")).select(
        "document_uid", "rule_version", F.sha2(F.concat_ws("\n\n", F.transform("p", lambda x: x["part"])), 256).alias("markdown_hash"), F.size("p").cast("bigint").alias("parts")
    )


@query("""
    SELECT chunk_version_uid, row_number() OVER (PARTITION BY document_uid, content_type, title_context, text_hash ORDER BY chunk_index, chunk_version_uid) - 1 AS occurrence
    FROM (SELECT DISTINCT chunk_version_uid, document_uid, content_type, title_context, text_hash, chunk_index FROM chunks)
""")
def chunk_occurrence(spark: SparkSession, d: str) -> DataFrame:
    """How many equal chunks of its document come before a chunk."""
    w = Window.partitionBy("document_uid", "content_type", "title_context", "text_hash").orderBy("chunk_index", "chunk_version_uid")
    rows = read_table(spark, d, "chunks").select("chunk_version_uid", "document_uid", "content_type", "title_context", "text_hash", "chunk_index").distinct()
    return rows.select("chunk_version_uid", (F.row_number().over(w) - 1).cast("bigint").alias("occurrence"))


@query(r"""
    WITH k AS (
        SELECT DISTINCT chunk_version_uid, document_uid, rule_version, content_type, chunk_index, sha256(lower(regexp_replace(text, '^\s+|\s+$', '', 'g'))) AS key,
               content_type IN ('section', 'paragraph', 'reference', 'footnote', 'algorithm') AS once FROM chunks WHERE text IS NOT NULL
    )
    SELECT chunk_version_uid, NOT once OR row_number() OVER (PARTITION BY document_uid, rule_version, key, once ORDER BY chunk_index, chunk_version_uid) = 1 AS is_kept
    FROM k
""")
def keep_first_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Repeated blocks of a document, but for types that may repeat. The first is a minimum by digest, no window over texts."""
    key = F.sha2(F.lower(T.stripped(F.col("text"))), 256).alias("key")
    once = F.coalesce(F.col("content_type").isin("section", "paragraph", "reference", "footnote", "algorithm"), F.lit(False)).alias("once")
    rows = read_table(spark, d, "chunks").where("text is not null").select("chunk_version_uid", F.xxhash64("document_uid", "rule_version").alias("doc"), "document_uid", "rule_version", F.struct("chunk_index", "chunk_version_uid").alias("at"), key, once).distinct()
    first = rows.where("once").groupBy("doc", "document_uid", "rule_version", "key").agg(F.min("at").alias("first")).select(
        "doc", F.col("key").alias("k"), F.col("document_uid").alias("u"), F.col("rule_version").alias("v"), "first"
    )
    same = (rows.doc == first.doc) & (F.col("key") == F.col("k")) & F.col("document_uid").eqNullSafe(F.col("u")) & F.col("rule_version").eqNullSafe(F.col("v"))
    repeated = rows.where("once").join(first, same).select("chunk_version_uid", (F.col("at") == F.col("first")).alias("is_kept"))
    return repeated.unionByName(rows.where("not once").select("chunk_version_uid", F.lit(True).alias("is_kept")))


@query("""
    WITH c AS (SELECT DISTINCT chunk_version_uid, document_uid, chunk_index, text FROM chunks WHERE text IS NOT NULL)
    SELECT chunk_version_uid,
           length(coalesce(right(lag(text) OVER w, 600), '')) AS previous_chars,
           length(coalesce(left(lead(text) OVER w, 600), '')) AS next_chars,
           count(*) OVER (PARTITION BY document_uid ORDER BY chunk_index, chunk_version_uid ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS near
    FROM c WINDOW w AS (PARTITION BY document_uid ORDER BY chunk_index, chunk_version_uid)
""")
def neighbour_context(spark: SparkSession, d: str) -> DataFrame:
    """What the chunks before and after a chunk give as its context."""
    w = Window.partitionBy("document_uid").orderBy("chunk_index", "chunk_version_uid")
    rows = read_table(spark, d, "chunks").where("text is not null").select("chunk_version_uid", "document_uid", "chunk_index", "text").distinct()
    return rows.select(
        "chunk_version_uid",
        F.length(F.coalesce(F.right(F.lag("text").over(w), F.lit(600)), F.lit(""))).cast("bigint").alias("previous_chars"),
        F.length(F.coalesce(F.left(F.lead("text").over(w), F.lit(600)), F.lit(""))).cast("bigint").alias("next_chars"),
        F.count(F.lit(1)).over(w.rowsBetween(-1, 1)).alias("near"),
    )


@query(r"""
    SELECT DISTINCT chunk_version_uid, length(array_to_string(list_filter([nullif(trim(title_context), ''), nullif(trim(text), '')],
           lambda x: x IS NOT NULL), chr(10) || chr(10))) AS retrieval_chars
    FROM chunks
""")
def retrieval_text(spark: SparkSession, d: str) -> DataFrame:
    """Length of the context and the body of a chunk as one retrieval text."""
    both = F.concat_ws("\n\n", F.nullif(F.trim("title_context"), F.lit("")), F.nullif(F.trim("text"), F.lit("")))
    return read_table(spark, d, "chunks").select("chunk_version_uid", F.length(both).cast("bigint").alias("retrieval_chars")).distinct()


@query(r"""
    WITH r AS (
        SELECT chunk_version_uid, generate_subscripts(string_split(text, chr(10)), 1) - 3 AS pos, unnest(string_split(text, chr(10))) AS line
        FROM (SELECT DISTINCT chunk_version_uid, text FROM chunks WHERE content_type = 'table' AND text IS NOT NULL)
    )
    SELECT chunk_version_uid, pos // 16 AS part, count(*) AS n_rows, CAST(sum(length(line)) AS BIGINT) AS n_chars
    FROM r WHERE pos >= 0 GROUP BY 1, 2
""")
def table_split(spark: SparkSession, d: str) -> DataFrame:
    """Body rows of each table in parts of 16; the two head rows are repeated in every part."""
    lines = F.split("text", "\n")
    rows = read_table(spark, d, "chunks").where("content_type = 'table' and text is not null").select("chunk_version_uid", "text").distinct().select("chunk_version_uid", F.posexplode(lines).alias("p", "line"))
    body = rows.where("p >= 2").withColumn("part", F.floor((F.col("p") - 2) / 16))
    return body.groupBy("chunk_version_uid", "part").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.length("line")).alias("n_chars"))


@query(r"""
    SELECT doc_id, len(list_filter(string_split(text, chr(10)), lambda x: starts_with(x, '|'))) AS pipe_rows,
           coalesce(list_max(list_transform(list_filter(string_split(text, chr(10)), lambda x: starts_with(x, '|')),
             lambda x: length(x) - length(replace(x, '|', '')) - 1)), 0) AS widest
    FROM documents WHERE text IS NOT NULL
""")
def table_shape(spark: SparkSession, d: str) -> DataFrame:
    """Pipe rows of each text and the most columns of one."""
    rows = F.filter(F.split("text", "\n"), lambda x: F.startswith(x, F.lit("|")))
    width = F.array_max(F.transform(rows, lambda x: F.length(x) - F.length(F.replace(x, F.lit("|"), F.lit(""))) - 1))
    return read_table(spark, d, "documents").where("text is not null").select("doc_id", F.size(rows).cast("bigint").alias("pipe_rows"), F.coalesce(width, F.lit(0)).cast("bigint").alias("widest"))


@query("""
    WITH f AS (SELECT document_uid, arg_max(struct_pack(t := title, c := company_name), updated_at) AS s FROM local_documents GROUP BY 1)
    SELECT DISTINCT c.chunk_version_uid, coalesce(contains(c.text, f.s.t), FALSE) AS holds_title, coalesce(contains(c.text, f.s.c), FALSE) AS holds_company
    FROM chunks c JOIN f USING (document_uid) WHERE c.text IS NOT NULL
""")
def quote_containment(spark: SparkSession, d: str) -> DataFrame:
    """Whether a chunk quotes the title and the company of its document."""
    f = read_table(spark, d, "local_documents").groupBy("document_uid").agg(F.max_by(F.struct("title", "company_name"), "updated_at").alias("s"))
    chunks = read_table(spark, d, "chunks").where("text is not null").select("chunk_version_uid", "document_uid", "text").distinct()
    return chunks.join(f, "document_uid").select(
        "chunk_version_uid", F.coalesce(F.contains("text", "s.title"), F.lit(False)).alias("holds_title"), F.coalesce(F.contains("text", "s.company_name"), F.lit(False)).alias("holds_company")
    )


@query(r"""
    SELECT chunk_version_uid, stable AS uid FROM (
        SELECT DISTINCT chunk_version_uid, substr(sha256(concat_ws('|', coalesce(trim(document_uid), 'None'), coalesce(trim(content_type), 'None'),
               coalesce(trim(title_context), 'None'), coalesce(trim(text_hash), 'None'))), 1, 32) AS stable FROM chunks)
""")
def stable_identity(spark: SparkSession, d: str) -> DataFrame:
    """Content-addressed ids of chunks."""
    uid = T.stable_uid(*[F.col(c) for c in ("document_uid", "content_type", "title_context", "text_hash")])
    return read_table(spark, d, "chunks").select("chunk_version_uid", uid.alias("uid")).distinct()
