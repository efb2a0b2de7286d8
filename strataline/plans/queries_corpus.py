"""Corpus queries over the standard tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from .registering import registry

QUERIES, ORACLE, query = registry()

_NORM = r"trim(regexp_replace(lower(text), '[ \t\n\r\f\x0B]+', ' ', 'g'))"


def _norm() -> F.Column:
    return F.trim(F.regexp_replace(F.lower("text"), r"[ \t\n\r\f\x0B]+", " "))


@query(f"""
    SELECT coalesce(nullif(lower(trim(source)), ''), 'unknown') AS source_name,
           count(*) AS samples, count(DISTINCT sha256({_NORM})) AS unique_content,
           count(*) - count(DISTINCT sha256({_NORM})) AS duplicate_copies,
           round(1 - count(DISTINCT sha256({_NORM})) / count(*), 6) AS duplicate_rate
    FROM documents WHERE text IS NOT NULL GROUP BY 1
""")
def source_quality_report(spark: SparkSession, d: str) -> DataFrame:
    """Samples, distinct normalised texts and duplicate rate of each source."""
    from ..functions.labels import label

    rows = read_table(spark, d, "documents").where("text is not null").select(label(F.col("source")).alias("source_name"), F.sha2(_norm(), 256).alias("content"))
    # Two plain levels combine before the shuffle; a distinct count would expand the rows.
    per_text = rows.groupBy("source_name", "content").agg(F.count(F.lit(1)).alias("n"))
    per_source = per_text.groupBy("source_name").agg(F.sum("n").alias("samples"), F.count(F.lit(1)).alias("unique_content"))
    return per_source.select(
        "source_name", "samples", "unique_content", (F.col("samples") - F.col("unique_content")).alias("duplicate_copies"),
        F.round(1 - F.col("unique_content") / F.col("samples"), 6).alias("duplicate_rate"),
    )


_SPLIT = "nullif(lower(trim(split)), '')"


def _samples(spark: SparkSession, d: str) -> DataFrame:
    from ..functions.labels import split_label

    return read_table(spark, d, "corpus").select("seq", "sample_id", "text", split_label(F.col("split")).alias("split"), "work_uid", "batch_no", "status").distinct()


@query("""
    SELECT field, label, count(*) AS samples, CAST(sum(n_chars) AS BIGINT) AS chars FROM (
        SELECT DISTINCT doc_id, n_chars, field, coalesce(nullif(lower(trim(label)), ''), 'unknown') AS label FROM (
            SELECT doc_id, n_chars, 'source' AS field, source AS label FROM documents UNION ALL
            SELECT doc_id, n_chars, 'lang', lang FROM documents UNION ALL
            SELECT doc_id, n_chars, 'domain', domain FROM documents))
    GROUP BY 1, 2
""")
def coverage_by_field(spark: SparkSession, d: str) -> DataFrame:
    """Samples and characters of each label of three fields, from one pass over the rows."""
    from ..functions.labels import label

    pair = lambda f: F.struct(F.lit(f).alias("field"), label(F.col("lang" if f == "lang" else f)).alias("label"))
    rows = read_table(spark, d, "documents").select("n_chars", F.explode(F.array_distinct(F.array(*[pair(f) for f in ("source", "lang", "domain")]))).alias("p"))
    return rows.groupBy("p.field", "p.label").agg(F.count(F.lit(1)).alias("samples"), F.sum("n_chars").alias("chars"))


@query(f"""
    WITH s AS (SELECT DISTINCT seq, {_SPLIT} AS split, text, work_uid FROM corpus WHERE {_SPLIT} IS NOT NULL)
    SELECT 'content' AS kind, count(*) AS conflicts FROM (SELECT sha256(text) AS k FROM s WHERE text IS NOT NULL GROUP BY 1 HAVING count(DISTINCT split) > 1)
    UNION ALL
    SELECT 'work', count(*) FROM (SELECT work_uid FROM s WHERE work_uid IS NOT NULL GROUP BY 1 HAVING count(DISTINCT split) > 1)
""")
def cross_split_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Texts and works that stand in more than one split."""
    rows = _samples(spark, d).where("split is not null")
    keys = rows.select("split", F.explode(F.array(F.struct(F.lit("content").alias("kind"), F.sha2("text", 256).alias("key")), F.struct(F.lit("work").alias("kind"), F.col("work_uid").alias("key")))).alias("k"))
    seen = keys.where("k.key is not null").groupBy("k.kind", "k.key").agg((F.min("split") < F.max("split")).cast("int").alias("mixed"))
    return seen.groupBy("kind").agg(F.sum("mixed").alias("conflicts"))


@query("""
    WITH a AS (SELECT sha256(text) AS h, count(*) AS n, min(batch_no) AS b FROM corpus WHERE batch_no <= 20 AND text IS NOT NULL GROUP BY 1),
         b AS (SELECT sha256(text) AS h, count(*) AS n FROM corpus WHERE batch_no >= 5 AND text IS NOT NULL GROUP BY 1)
    SELECT CASE WHEN a.h IS NULL THEN 'added' WHEN b.h IS NULL THEN 'removed' ELSE 'retained' END AS change,
           count(*) AS contents, CAST(coalesce(sum(b.n), 0) - coalesce(sum(a.n), 0) AS BIGINT) AS delta
    FROM a FULL JOIN b ON a.h = b.h GROUP BY 1
""")
def release_compare(spark: SparkSession, d: str) -> DataFrame:
    """Contents added, removed and retained between two releases."""
    rows = read_table(spark, d, "corpus").where("text is not null").select(F.sha2("text", 256).alias("h"), "batch_no")
    a = rows.where("batch_no <= 20").groupBy("h").agg(F.count(F.lit(1)).alias("na"))
    b = rows.where("batch_no >= 5").groupBy("h").agg(F.count(F.lit(1)).alias("nb"))
    change = F.when(F.col("na").isNull(), "added").when(F.col("nb").isNull(), "removed").otherwise("retained")
    return a.join(b, "h", "full_outer").groupBy(change.alias("change")).agg(
        F.count(F.lit(1)).alias("contents"), (F.coalesce(F.sum("nb"), F.lit(0)) - F.coalesce(F.sum("na"), F.lit(0))).alias("delta")
    )


@query("""
    SELECT DISTINCT work_uid, CAST(('0x' || substr(sha256(work_uid), 1, 8)) AS BIGINT) / 4294967295.0 < 0.1 AS is_validation
    FROM chunks WHERE work_uid IS NOT NULL
""")
def hash_split_assignment(spark: SparkSession, d: str) -> DataFrame:
    """A tenth of the works by the hash of their id."""
    from ..functions.text import hash_fraction

    return read_table(spark, d, "chunks").where("work_uid is not null").select("work_uid").distinct().select("work_uid", (hash_fraction(F.col("work_uid")) < 0.1).alias("is_validation"))


_TIES = """
    ties AS (SELECT DISTINCT sample_id AS m, 'w' || work_uid AS g FROM corpus WHERE work_uid IS NOT NULL UNION
             SELECT DISTINCT sample_id, 't' || sha256(text) FROM corpus WHERE text IS NOT NULL),
    step AS (SELECT DISTINCT a.m AS a, b.m AS b FROM ties a JOIN ties b USING (g)),
    reach AS (SELECT a, b FROM step UNION SELECT r.a, s.b FROM reach r JOIN step s ON r.b = s.a)
"""


@query(f"WITH RECURSIVE {_TIES} SELECT a AS sample_id, min(b) AS family FROM reach GROUP BY 1")
def sample_families(spark: SparkSession, d: str) -> DataFrame:
    """Samples tied by work or equal text, named by their least member."""
    from ..operators.graph import families

    return families(_ties(spark, d), "sample_id", "g")


def _ties(spark: SparkSession, d: str) -> DataFrame:
    rows = read_table(spark, d, "corpus")
    return rows.where("work_uid is not null").select("sample_id", F.concat(F.lit("w"), "work_uid").alias("g")).unionByName(
        rows.where("text is not null").select("sample_id", F.concat(F.lit("t"), F.sha2("text", 256)).alias("g"))
    ).distinct()


@query(f"""
    WITH RECURSIVE {_TIES}, fam AS (SELECT a AS sample_id, min(b) AS family FROM reach GROUP BY 1),
    prior AS (SELECT f.family, min({_SPLIT}) AS lo, max({_SPLIT}) AS hi
              FROM fam f JOIN corpus c USING (sample_id) WHERE c.batch_no <= 20 GROUP BY 1)
    SELECT DISTINCT f.sample_id, f.family,
           CASE WHEN p.lo IS NULL THEN CASE WHEN CAST(('0x' || substr(sha256(f.family), 1, 8)) AS BIGINT) / 4294967295.0 < 0.1 THEN 'validation' ELSE 'train' END
                WHEN p.lo = p.hi THEN p.lo ELSE 'quarantine' END AS assigned
    FROM fam f LEFT JOIN prior p USING (family)
""")
def family_split_groups(spark: SparkSession, d: str) -> DataFrame:
    """Splits by family: a family inherits its one prior split, is quarantined with two, and is hashed with none."""
    from ..functions.labels import split_label
    from ..functions.text import hash_fraction
    from ..operators.graph import families
    from .stage import stage

    fam = stage(families(_ties(spark, d), "sample_id", "g"))
    history = read_table(spark, d, "corpus").where("batch_no <= 20").select("sample_id", split_label(F.col("split")).alias("split"))
    prior = fam.join(history, "sample_id").groupBy("family").agg(F.min("split").alias("lo"), F.max("split").alias("hi"))
    fresh = F.when(hash_fraction(F.col("family")) < 0.1, "validation").otherwise("train")
    assigned = F.when(F.col("lo").isNull(), fresh).when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise("quarantine")
    return fam.join(prior, "family", "left").select("sample_id", "family", assigned.alias("assigned"))


_WORD_JACCARD = r"""
    base AS (SELECT doc_id, trim(regexp_replace(lower(text), '[ \t\n\r\f\x0B]+', ' ', 'g')) AS t FROM documents WHERE text IS NOT NULL),
    cls AS (SELECT sha256(t) AS h, min(doc_id) AS class_id, any_value(t) AS t FROM base GROUP BY 1),
    w AS (SELECT class_id, string_split(t, ' ') AS ws FROM cls),
    sh AS (SELECT DISTINCT class_id, array_to_string(ws[i:i + 4], ' ') AS s
           FROM (SELECT class_id, ws, unnest(generate_series(1, greatest(len(ws) - 4, 1))) AS i FROM w)),
    n AS (SELECT class_id, count(*) AS n FROM sh GROUP BY 1),
    pairs AS (SELECT a.class_id AS a, b.class_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.class_id < b.class_id GROUP BY 1, 2),
    near AS (SELECT a, b FROM pairs JOIN n x ON x.class_id = a JOIN n y ON y.class_id = b WHERE c >= 0.8 * (x.n + y.n - c) - 1e-9)
"""


@query(f"""
    WITH {_WORD_JACCARD}, links AS (SELECT k, count(*) AS links FROM (SELECT a AS k FROM near UNION ALL SELECT b FROM near) GROUP BY 1)
    SELECT b.doc_id, c.class_id, coalesce(l.links, 0) AS links
    FROM base b JOIN cls c ON sha256(b.t) = c.h LEFT JOIN links l ON l.k = c.class_id
""")
def word_shingle_near_duplicates(spark: SparkSession, d: str) -> DataFrame:
    """Each document with its class of equal texts and its number of near-duplicate texts (five words, 0.8)."""
    from ..operators.near_duplicates import near_duplicate_classes

    return near_duplicate_classes(read_table(spark, d, "documents").select("doc_id", "text"), "doc_id")


@query()
def greedy_near_duplicate_decisions(spark: SparkSession, d: str) -> DataFrame:
    """Which distinct texts stay when each earlier kept text excludes the later ones similar to it."""
    from ..functions.text import content_hash
    from ..operators.near_duplicates import greedy_decisions, similar_texts
    from .stage import stage

    docs = read_table(spark, d, "documents").where("text is not null").select("doc_id", "text", content_hash(F.col("text")).alias("h"))
    first = stage(docs.groupBy("h").agg(F.min("doc_id").alias("k"), F.first("text").alias("text")))
    return greedy_decisions(first.select("k"), similar_texts(first.select("k", "text"), "k")).withColumnRenamed("k", "doc_id")


@query("""
    WITH known AS (SELECT DISTINCT sha256(text) AS h FROM corpus WHERE batch_no <= 20 AND text IS NOT NULL)
    SELECT DISTINCT seq, CASE WHEN sha256(text) IN (SELECT h FROM known) THEN 'duplicate' ELSE 'new' END AS disposition
    FROM corpus WHERE batch_no > 20 AND text IS NOT NULL
""")
def incremental_delta(spark: SparkSession, d: str) -> DataFrame:
    """Pending samples that are new against the history, and those that are not."""
    from ..operators.dedup import delta

    rows = read_table(spark, d, "corpus").where("text is not null").select("seq", "batch_no", F.sha2("text", 256).alias("h"))
    fresh, held = delta(rows.where("batch_no > 20"), rows.where("batch_no <= 20"), "h")
    return fresh.select("seq", F.lit("new").alias("disposition")).unionByName(held.select("seq", F.lit("duplicate").alias("disposition"))).distinct()


@query("""
    SELECT h AS content_hash, min(batch_no) AS first_batch, count(DISTINCT sample_id) AS origins, count(DISTINCT work_uid) AS works
    FROM (SELECT sha256(text) AS h, batch_no, sample_id, work_uid FROM corpus WHERE text IS NOT NULL AND status = 'accepted') GROUP BY 1
""")
def snapshot_union(spark: SparkSession, d: str) -> DataFrame:
    """The union of all accepted batches: each text once, all its origins kept."""
    rows = read_table(spark, d, "corpus").where("text is not null and status = 'accepted'").select(F.sha2("text", 256).alias("content_hash"), "batch_no", "sample_id", "work_uid")
    # Two plain aggregations count origins and works, so a text copied everywhere gathers nothing.
    origins = rows.groupBy("content_hash", "sample_id").agg(F.min("batch_no").alias("b")).groupBy("content_hash").agg(F.min("b").alias("first_batch"), F.count("sample_id").alias("origins"))
    works = rows.groupBy("content_hash", "work_uid").agg(F.lit(1).alias("one")).groupBy("content_hash").agg(F.count("work_uid").alias("works"))
    return origins.join(works, "content_hash")


@query("""
    SELECT DISTINCT sha256(text) AS content_hash, sample_id, work_uid FROM corpus WHERE text IS NOT NULL AND status = 'accepted'
""")
def snapshot_origins(spark: SparkSession, d: str) -> DataFrame:
    """The origins of each text of the union, as rows."""
    rows = read_table(spark, d, "corpus").where("text is not null and status = 'accepted'")
    return rows.select(F.sha2("text", 256).alias("content_hash"), "sample_id", "work_uid").distinct()


@query("""
    SELECT c.sample_id, count(q.sample_id) AS reports, coalesce(max(q.token_count), 0) AS tokens FROM (SELECT DISTINCT sample_id FROM corpus) c
    LEFT JOIN quality_report q USING (sample_id) GROUP BY 1
""")
def pool_provenance(spark: SparkSession, d: str) -> DataFrame:
    """Every sample with the number of its reports; samples without one stay."""
    reports = read_table(spark, d, "quality_report").groupBy("sample_id").agg(F.count(F.lit(1)).alias("reports"), F.max("token_count").alias("tokens"))
    return read_table(spark, d, "corpus").select("sample_id").distinct().join(reports, "sample_id", "left").select("sample_id", F.coalesce("reports", F.lit(0)).alias("reports"), F.coalesce("tokens", F.lit(0)).alias("tokens"))


@query("""
    SELECT coalesce(a.k, b.k) AS sample_id, a.k IS NOT NULL AS in_left FROM (SELECT DISTINCT sample_id AS k FROM corpus) a
    FULL JOIN (SELECT DISTINCT uid AS k FROM dedup_index) b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL
""")
def index_cover(spark: SparkSession, d: str) -> DataFrame:
    """Samples that only the corpus or only the index holds."""
    from ..operators.dedup import full_cover

    return full_cover(read_table(spark, d, "corpus").select("sample_id"), read_table(spark, d, "dedup_index").select(F.col("uid").alias("sample_id")), "sample_id")


@query("""
    SELECT work_uid, CASE WHEN count(DISTINCT s) = 1 THEN max(s) ELSE 'mixed' END AS split_label,
           CASE WHEN count(DISTINCT t) = 1 THEN max(t) ELSE 'mixed' END AS status_label
    FROM (SELECT work_uid, coalesce(nullif(lower(trim(split)), ''), 'unknown') AS s, coalesce(nullif(lower(trim(status)), ''), 'unknown') AS t FROM corpus) GROUP BY 1
""")
def group_labels(spark: SparkSession, d: str) -> DataFrame:
    """The one label of a work's samples, else mixed."""
    from ..functions.labels import label

    one = lambda c: F.when(F.min(c) == F.max(c), F.max(c)).otherwise("mixed")
    rows = read_table(spark, d, "corpus").select("work_uid", label(F.col("split")).alias("s"), label(F.col("status")).alias("t"))
    return rows.groupBy("work_uid").agg(one("s").alias("split_label"), one("t").alias("status_label"))


@query("""
    WITH s AS (SELECT DISTINCT seq, text, work_uid FROM corpus WHERE text IS NOT NULL),
    b AS (SELECT seq, unnest(generate_series(0, greatest(len(string_split(text, ' ')) - 1, 0), 32)) AS start, len(string_split(text, ' ')) AS n FROM s)
    SELECT seq, start, CAST(least(33, n - start) AS BIGINT) AS n_tokens FROM b WHERE n - start >= 2
""")
def token_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Blocks of 32 words and one target word; a tail of a single word is dropped."""
    rows = read_table(spark, d, "corpus").where("text is not null").select("seq", "text", "work_uid").distinct()
    n = F.size(F.split("text", " ")).cast("bigint")
    starts = rows.select("seq", n.alias("n"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(n - 1, F.lit(0)), F.lit(32).cast("bigint"))).alias("start"))
    return starts.where("n - start >= 2").select("seq", "start", F.least(F.lit(33).cast("bigint"), F.col("n") - F.col("start")).alias("n_tokens"))
