"""Queries on quotas, ranks, samples and vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.labels import label
from ..operators import mixture as M
from ..operators import selection as S
from ..sources.tables import read_table
from .registering import registry

QUERIES, ORACLE, query = registry()

_QUOTAS = """
    c AS (SELECT coalesce(nullif(lower(trim(lang)), ''), 'unknown') AS lang, count(*) AS n FROM documents GROUP BY 1),
    w AS (SELECT lang, pow(n, 0.5) / sum(pow(n, 0.5)) OVER () * 300 AS exact FROM c),
    b AS (SELECT lang, exact, CAST(floor(exact) AS BIGINT) AS base, exact - floor(exact) AS rest FROM w),
    quotas AS (SELECT lang, base + CASE WHEN row_number() OVER (ORDER BY round(rest, 9) DESC, lang) <= 300 - sum(base) OVER () THEN 1 ELSE 0 END AS quota FROM b)
"""


def _quotas(docs: DataFrame) -> DataFrame:
    weights = S.temperature_weights(docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "lang", "n", 0.5)
    return S.largest_remainder(weights, "lang", "weight", 300)


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "documents").select("doc_id", label(F.col("lang")).alias("lang"), "n_chars", "source")


@query(f"WITH {_QUOTAS} SELECT lang, CAST(quota AS BIGINT) AS quota FROM quotas")
def temperature_quotas(spark: SparkSession, d: str) -> DataFrame:
    """300 samples shared by language at temperature 0.5, by largest remainder."""
    return _quotas(_docs(spark, d))


@query(f"""
    WITH {_QUOTAS}, r AS (
        SELECT doc_id, coalesce(nullif(lower(trim(lang)), ''), 'unknown') AS lang,
               row_number() OVER (PARTITION BY coalesce(nullif(lower(trim(lang)), ''), 'unknown') ORDER BY sha256(CAST(doc_id AS VARCHAR))) AS rank
        FROM documents)
    SELECT doc_id, lang, rank FROM r JOIN quotas USING (lang) WHERE rank <= quota
""")
def mixture_selection(spark: SparkSession, d: str) -> DataFrame:
    """The documents a language mixture takes, in hash order."""
    docs = _docs(spark, d)
    return M.quota_select(docs, _quotas(docs), "lang", "doc_id").select("doc_id", "lang", "rank")


_MIXED = """
    WITH RECURSIVE o AS (
        SELECT doc_id, coalesce(nullif(lower(trim(lang)), ''), 'unknown') AS lang, n_chars AS size,
               row_number() OVER (PARTITION BY coalesce(nullif(lower(trim(lang)), ''), 'unknown') ORDER BY sha256(CAST(doc_id AS VARCHAR))) AS rn
        FROM documents WHERE n_chars > 0
    ), q AS (SELECT lang, CAST(floor(sum(size) * 0.3) AS BIGINT) AS quota FROM o GROUP BY 1),
    walk AS (
        SELECT lang, CAST(0 AS BIGINT) AS rn, CAST(0 AS HUGEINT) AS total, CAST(NULL AS BIGINT) AS doc_id FROM q
        UNION ALL
        SELECT o.lang, o.rn, CASE WHEN w.total + o.size <= q.quota THEN w.total + o.size ELSE w.total END, CASE WHEN w.total + o.size <= q.quota THEN o.doc_id END
        FROM walk w JOIN o ON o.lang = w.lang AND o.rn = w.rn + 1 JOIN q ON q.lang = o.lang
    )
"""


def _mix(spark: SparkSession, d: str):
    docs = _docs(spark, d).where("n_chars > 0")
    quotas = docs.groupBy("lang").agg(F.floor(F.sum("n_chars") * 0.3).cast("bigint").alias("quota"))
    return docs, quotas


@query(_MIXED + "SELECT doc_id, lang FROM walk WHERE doc_id IS NOT NULL")
def mixture_greedy(spark: SparkSession, d: str) -> DataFrame:
    """Intact documents up to 30 % of the characters of each language, those too large for the room left skipped."""
    docs, quotas = _mix(spark, d)
    return M.mix(docs, quotas, "lang", "doc_id", "n_chars").select("doc_id", "lang")


@query(_MIXED + """, a AS (SELECT lang, sum(size) AS available FROM o GROUP BY 1), s AS (SELECT w.lang, sum(size) AS selected FROM walk w JOIN o USING (doc_id) GROUP BY 1)
    SELECT q.lang, quota, CAST(available AS BIGINT) AS available, CAST(coalesce(selected, 0) AS BIGINT) AS selected,
           round(coalesce(selected, 0) / sum(coalesce(selected, 0)) OVER (), 6) AS fraction, CAST(quota - coalesce(selected, 0) AS BIGINT) AS shortfall
    FROM q JOIN a USING (lang) LEFT JOIN s USING (lang)
""")
def mixture_greedy_report(spark: SparkSession, d: str) -> DataFrame:
    """Quota, holding, choice, share and shortfall of each language of the greedy mixture."""
    docs, quotas = _mix(spark, d)
    return M.mixture_report(docs, M.mix(docs, quotas, "lang", "doc_id", "n_chars"), quotas, "lang", "n_chars")


@query("SELECT 'none' AS fault, 'none' AS subject WHERE FALSE")
def mixture_faults(spark: SparkSession, d: str) -> DataFrame:
    """Faults of a mixture with two documents a source at most and redistribution: there must be none."""
    docs, quotas = _mix(spark, d)
    made = M.mix(docs, quotas, "lang", "doc_id", "n_chars", family="source", cap=2, redistribute=True)
    return M.mixture_faults(docs, made, quotas, "lang", "doc_id", "n_chars", "source", 2)


@query(f"""
    WITH {_QUOTAS}, a AS (SELECT lang, n FROM c)
    SELECT lang, CAST(quota AS BIGINT) AS quota, n AS available, greatest(CAST(quota AS BIGINT) - n, 0) AS shortfall FROM quotas JOIN a USING (lang)
""")
def mixture_shortfall(spark: SparkSession, d: str) -> DataFrame:
    """What each language holds of its quota."""
    docs = _docs(spark, d)
    counts = docs.groupBy("lang").agg(F.count(F.lit(1)).alias("available"))
    return _quotas(docs).join(counts, "lang").select("lang", "quota", "available", F.greatest(F.col("quota") - F.col("available"), F.lit(0)).alias("shortfall"))


@query("""
    WITH s AS (SELECT source_name, sample_id, max(token_count) AS t FROM quality_report WHERE token_count > 0 GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY source_name ORDER BY t DESC, sample_id) AS rank FROM s)
    SELECT source_name, sample_id, t AS score, rank FROM r WHERE rank <= 3
""")
def score_ranked_topk(spark: SparkSession, d: str) -> DataFrame:
    """The three best samples of each source."""
    s = read_table(spark, d, "quality_report").where("token_count > 0").groupBy("source_name", "sample_id").agg(F.max("token_count").alias("score"))
    w = Window.partitionBy("source_name").orderBy(F.desc("score"), "sample_id")
    return s.withColumn("rank", F.row_number().over(w).cast("bigint")).where("rank <= 3")


@query("""
    WITH q AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id % 100 = 0),
    s AS (SELECT q.vec_id AS query_id, v.vec_id AS item_id, list_cosine_similarity(q.e, CAST(v.embedding AS DOUBLE[])) AS sim
          FROM q JOIN embeddings v ON v.vec_id <> q.vec_id),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(sim, 12) DESC, item_id) AS rank FROM s)
    SELECT query_id, item_id, round(sim, 6) AS similarity, rank FROM r WHERE rank <= 5
""")
def embedding_cosine_topk(spark: SparkSession, d: str) -> DataFrame:
    """The five nearest vectors of every hundredth vector, against all vectors."""
    e = read_table(spark, d, "embeddings")
    return S.top_by_similarity(e.where("vec_id % 100 = 0"), e, 5).select("query_id", "item_id", F.round("similarity", 6).alias("similarity"), "rank")


@query()
def embedding_diverse(spark: SparkSession, d: str) -> DataFrame:
    """Vectors accepted one after the other unless too like an accepted one."""
    return S.greedy_diverse(read_table(spark, d, "embeddings"), 0.95)


@query("""
    WITH r AS (SELECT doc_id, coalesce(nullif(lower(trim(lang)), ''), 'unknown') AS lang,
                      row_number() OVER (PARTITION BY coalesce(nullif(lower(trim(lang)), ''), 'unknown') ORDER BY sha256(CAST(doc_id AS VARCHAR))) AS turn
               FROM documents)
    SELECT doc_id, lang, turn FROM (SELECT * FROM r ORDER BY turn, lang LIMIT 60)
""")
def stratified_review_sample(spark: SparkSession, d: str) -> DataFrame:
    """60 documents, one of each language in turn."""
    return S.round_robin(_docs(spark, d), "lang", [F.sha2(F.col("doc_id").cast("string"), 256)], 60).select("doc_id", "lang", "turn")


@query("""
    WITH r AS (SELECT domain, doc_id, row_number() OVER (PARTITION BY domain ORDER BY sha256(CAST(doc_id AS VARCHAR)), doc_id) AS rank FROM documents)
    SELECT domain, doc_id, rank FROM r WHERE rank <= 10
""")
def hash_eval_sample(spark: SparkSession, d: str) -> DataFrame:
    """Ten documents of each domain in hash order."""
    w = Window.partitionBy("domain").orderBy(F.sha2(F.col("doc_id").cast("string"), 256), "doc_id")
    return read_table(spark, d, "documents").select("domain", "doc_id").withColumn("rank", F.row_number().over(w).cast("bigint")).where("rank <= 10")


@query("""
    SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC NULLS LAST, doc_id LIMIT 25
""")
def longest_documents(spark: SparkSession, d: str) -> DataFrame:
    """The 25 longest documents."""
    return read_table(spark, d, "documents").select("doc_id", "n_chars").orderBy(F.desc_nulls_last("n_chars"), "doc_id").limit(25)


@query("""
    WITH t AS (SELECT unnest(['prospectus', 'dividend', 'mortgage', 'refinery', '抵押贷款']) AS term),
    s AS (SELECT doc_id, count(*) AS score FROM documents, t WHERE contains(lower(text), term) GROUP BY 1),
    r AS (SELECT *, row_number() OVER (ORDER BY score DESC, doc_id) AS pos FROM s)
    SELECT doc_id, score, (pos - 1) // 4 AS page FROM r WHERE pos <= 40
""")
def keyword_search(spark: SparkSession, d: str) -> DataFrame:
    """The first ten pages of documents by the number of terms they hold."""
    terms = ["prospectus", "dividend", "mortgage", "refinery", "抵押贷款"]
    low = F.lower("text")
    score = sum((F.contains(low, F.lit(t)).cast("bigint") for t in terms), F.lit(0))
    top = read_table(spark, d, "documents").select("doc_id", score.alias("score")).where("score > 0").orderBy(F.desc("score"), "doc_id").limit(40)
    return top.select("doc_id", "score", F.floor((F.row_number().over(Window.orderBy(F.desc("score"), "doc_id")) - 1) / 4).alias("page"))  # 40 rows


@query("""
    SELECT source_name, arg_min(sample_id, struct_pack(t := token_count, s := sample_id)) AS sample_id, min(token_count) AS tokens
    FROM quality_report WHERE token_count > 0 GROUP BY 1
""")
def argmin_by_source(spark: SparkSession, d: str) -> DataFrame:
    """The sample of least tokens of each source."""
    rows = read_table(spark, d, "quality_report").where("token_count > 0")
    return rows.groupBy("source_name").agg(F.min_by("sample_id", F.struct("token_count", "sample_id")).alias("sample_id"), F.min("token_count").alias("tokens"))
