"""Keeping a registry: names in sequence, batches, overrides with their audit, dispositions of what was collected, sync state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.stage import stage


def target_years(targets: DataFrame, now_year: int, lag: int = 1, first: int = 1990) -> DataFrame:
    """One row per target and year from start_year to end_year (the current year less ``lag`` where null), as ``year``.

    Years before ``first`` and ranges that end before they begin give no rows.
    """
    end = F.coalesce("end_year", F.lit(now_year - lag))
    start = F.greatest(F.coalesce("start_year", end), F.lit(first))
    return targets.withColumn("year", F.explode(F.when(start <= end, F.sequence(start.cast("int"), end.cast("int")))))


def within_years(year: Column, start: int, end: int) -> Column:
    """Whether a year lies in a range; an unknown one does."""
    return year.isNull() | year.between(start, end)


def batch_ids(old: Column, new: Column) -> Column:
    """Two sets of batch ids as one, sorted, without nulls; batches are only ever added."""
    none = F.array().cast("array<string>")
    return F.array_sort(F.filter(F.array_union(F.coalesce(old, none), F.coalesce(new, none)), lambda x: x.isNotNull()))


def numbered(new: DataFrame, used: DataFrame, group: str, key: str, number: str = "number") -> DataFrame:
    """``new`` with numbers that go on from the greatest of ``used`` in each group, in order of the key's digest.

    Ranks come from stretches of the order (see mixture.running_totals), so no group is gathered.
    """
    from .mixture import in_hash_order, running_totals

    ranked = running_totals(in_hash_order(new, key).withColumn("_one", F.lit(1)), group, "_one").drop("_order", "_stretch", "_one", "_before")
    last = used.groupBy(F.col(group).alias("_g")).agg(F.max(number).alias("_last"))
    return ranked.join(last, ranked[group].eqNullSafe(F.col("_g")), "left").withColumn(number, F.col("_rank") + F.coalesce("_last", F.lit(0))).drop("_g", "_last", "_rank")


def report_dispositions(candidates: DataFrame, held: DataFrame) -> DataFrame:
    """``candidates`` (source_url, content_hash, valid) with ``disposition`` against ``held`` (source_url, content_hash).

    In this order: reused if the URL is held, quarantined if the file is not valid, duplicate if the content is held or
    comes first from another candidate (the least URL), success otherwise.
    """
    urls = held.where("source_url is not null").select(F.col("source_url").alias("_u")).distinct()
    hashes = held.where("content_hash is not null").select(F.col("content_hash").alias("_h")).distinct()
    seen = candidates.join(urls, F.col("source_url") == F.col("_u"), "left").join(hashes, F.col("content_hash") == F.col("_h"), "left")
    fresh = F.col("_u").isNull() & F.coalesce(F.col("valid"), F.lit(False)) & F.col("_h").isNull() & F.col("content_hash").isNotNull()
    first = seen.where(fresh).groupBy(F.col("content_hash").alias("_c")).agg(F.min("source_url").alias("_first"))
    met = seen.join(first, F.col("content_hash") == F.col("_c"), "left")
    known = F.col("_h").isNotNull() | (F.col("_first") != F.col("source_url"))
    kind = F.when(F.col("_u").isNotNull(), "reused").when(~F.coalesce(F.col("valid"), F.lit(False)), "quarantined").when(F.coalesce(known, F.lit(False)), "duplicate").otherwise("success")
    return met.withColumn("disposition", kind).select(*candidates.columns, "disposition")


def scholarly_dispositions(candidates: DataFrame, blocked: DataFrame, held: DataFrame) -> DataFrame:
    """``candidates`` (work_uid, file_url, updated, licence_ok, content_hash, valid, error) with ``disposition``.

    metadata_only without a file, blocked while URL and update are those of a remembered block, failed_retryable after a
    passing error, failed_invalid for a file that is no document, skipped without a licence, duplicate if the content is
    held, else success.
    """
    b = blocked.select(F.col("work_uid").alias("_w"), F.col("file_url").alias("_u"), F.col("updated").alias("_d")).distinct()
    h = held.where("content_hash is not null").select(F.col("content_hash").alias("_h")).distinct()
    c = candidates.join(b, (F.col("work_uid") == F.col("_w")) & F.col("file_url").eqNullSafe(F.col("_u")) & F.col("updated").eqNullSafe(F.col("_d")), "left").join(h, F.col("content_hash") == F.col("_h"), "left")
    yes = lambda x: F.coalesce(F.col(x), F.lit(False))
    kind = (
        F.when(F.coalesce(F.trim("file_url"), F.lit("")) == "", "metadata_only").when(F.col("_w").isNotNull(), "blocked").when(~yes("licence_ok"), "skipped")
        .when(F.col("error").isNotNull(), "failed_retryable").when(~yes("valid"), "failed_invalid").when(F.col("_h").isNotNull(), "duplicate").otherwise("success")
    )
    return c.withColumn("disposition", kind).select(*candidates.columns, "disposition")


def overridden(records: DataFrame, overrides: DataFrame, key: str, fields: list[str]) -> tuple[DataFrame, DataFrame]:
    """Records whose ``fields`` take the value of the latest override, and the audit (key, field, old_value, new_value, at).

    ``overrides`` has the key, field, value and at; those of other fields or unknown keys change nothing. An override with
    a null value is an override by null. Values are text; each is cast to the type of its field and, where it cannot be,
    stays visible in the audit only.
    """
    latest = overrides.where(F.col("field").isin(*fields)).groupBy(key, "field").agg(F.max(F.struct("at", "value")).alias("o"))
    wide = latest.groupBy(key).pivot("field", fields).agg(F.first(F.struct(F.lit(True).alias("set"), F.col("o.value").alias("value"), F.col("o.at").alias("at"))))
    met = records.join(wide.select(F.col(key).alias("_k"), *[F.col(f).alias(f"_o_{f}") for f in fields]), records[key] == F.col("_k"), "left")
    cast = {f: F.col(f"_o_{f}.value").try_cast(records.schema[f].dataType) for f in fields}
    usable = {f: F.coalesce(F.col(f"_o_{f}.set"), F.lit(False)) & (F.col(f"_o_{f}.value").isNull() | cast[f].isNotNull()) for f in fields}
    out = met.select(*[F.when(usable[c], cast[c]).otherwise(F.col(c)).alias(c) if c in fields else F.col(c) for c in records.columns])
    rows = [F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("old_value"), F.col(f"_o_{f}.value").alias("new_value"), F.col(f"_o_{f}.at").alias("at"), F.col(f"_o_{f}.set").alias("set")) for f in fields]
    audit = met.select(F.col("_k").alias(key), F.explode(F.array(*rows)).alias("a")).where("a.set").select(key, "a.field", "a.old_value", "a.new_value", "a.at")
    return out, audit


def parsed_assignments(text: Column, fields: list[str]) -> tuple[Column, Column]:
    """(map of FIELD=VALUE lines, fault): unknown, repeated and empty fields are faults, and then there is no map."""
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    names = F.transform(lines, lambda x: F.trim(F.substring_index(x, "=", 1)))
    values = F.transform(lines, lambda x: F.trim(F.substring(x, F.locate("=", x) + 1, F.length(x))))
    fault = (
        F.when(F.exists(lines, lambda x: ~F.contains(x, F.lit("="))), "no_assignment").when(F.exists(names, lambda x: ~x.isin(*fields)), "unknown_field")
        .when(F.size(F.array_distinct(names)) < F.size(names), "repeated_field").when(F.exists(values, lambda x: x == ""), "empty_value")
    )
    return F.when(fault.isNull(), F.map_from_arrays(F.when(fault.isNull(), names), values)), fault


def sync_state(runs: DataFrame) -> DataFrame:
    """(source, target, last_success, cursor): the end and cursor of the latest successful run; a failed run moves neither."""
    ok = runs.where("status = 'success'")
    return ok.groupBy("source", "target").agg(F.max(F.struct("finished_at", "cursor")).alias("s")).select("source", "target", F.col("s.finished_at").alias("last_success"), F.col("s.cursor").alias("cursor"))


def next_window(windows: DataFrame) -> DataFrame:
    """For each (source, lane) the oldest window that is not finished; lanes (live, history) go on independently."""
    return windows.where("status <> 'finished'").groupBy("source", "lane").agg(F.min(F.struct("starts_at", "window_id")).alias("w")).select("source", "lane", "w.window_id", "w.starts_at")


def interrupted(starts: DataFrame, reports: DataFrame, key: str = "run_uid") -> DataFrame:
    """Runs that began and have no report: to be recovered."""
    return starts.join(reports.select(key).distinct(), key, "left_anti")


def replace_partition(spark_table: DataFrame, path: str, partition: str) -> None:
    """Replaces the partitions that occur in the new rows, and only these; the new rows are written before any is replaced."""
    stage(spark_table).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def select_version(versions: DataFrame, group: list[str], chosen: str, actor: str, at: Column) -> tuple[DataFrame, DataFrame]:
    """Versions with ``chosen`` (a version_uid) current and the former current one of its group demoted, and the audit of both.

    An unknown version changes nothing.
    """
    target = versions.where(F.col("version_uid") == chosen).select(*[F.col(g).alias(f"_{g}") for g in group]).limit(1)  # one row
    same = None
    for g in group:
        same = F.col(g).eqNullSafe(F.col(f"_{g}")) if same is None else same & F.col(g).eqNullSafe(F.col(f"_{g}"))
    met = versions.join(F.broadcast(target.withColumn("_in", F.lit(True))), same, "left")
    now = F.when(F.col("_in"), F.col("version_uid") == chosen).otherwise(F.col("is_current"))
    changed = met.withColumn("_now", now)
    audit = changed.where(F.col("_in") & (F.coalesce("is_current", F.lit(False)) != F.col("_now"))).select(
        "version_uid", F.when(F.col("_now"), "selected").otherwise("demoted").alias("action"), F.lit(actor).alias("actor"), at.alias("at")
    )
    return changed.select(*[F.col("_now").alias(c) if c == "is_current" else F.col(c) for c in versions.columns]), audit


def support_faults(claims: DataFrame) -> DataFrame:
    """(id, missing, surplus) of claims whose evidence differs from the union of their supports, as sorted sets."""
    none = F.array().cast("array<string>")
    union = F.array_distinct(F.flatten(F.filter(F.coalesce("supports", F.array().cast("array<array<string>>")), lambda x: x.isNotNull())))
    own = F.array_distinct(F.coalesce("evidence", none))
    rows = claims.select("id", F.array_sort(F.array_except(union, own)).alias("missing"), F.array_sort(F.array_except(own, union)).alias("surplus"))
    return rows.where((F.size("missing") > 0) | (F.size("surplus") > 0))


def admitted(samples: DataFrame, policy: DataFrame) -> DataFrame:
    """Samples of sources approved for training whose recognition passed and whose text holds more than blanks, thinking tags or a model's phrases."""
    ok = policy.where("training = 'approved'").select("source").distinct()
    text = F.col("text")
    # Traces of a model in a text.
    bad = text.rlike(r"(?i)</?think\b|^\s*(?:as an ai|作为(?:一个)?(?:ai|人工智能))") | (F.trim(F.regexp_replace(text, r"\s+", " ")) == "")
    return samples.where((F.col("ocr_status") == "passed") & ~F.coalesce(bad, F.lit(True))).join(ok, "source", "left_semi")


def usage_sums(rows: DataFrame, role: str, columns: list[str]) -> DataFrame:
    """Sums of sizes and usages by role; nulls count as 0."""
    return rows.groupBy(role).agg(*[F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in columns])


def first_in_order(df: DataFrame, order: list[Column], limit: int) -> DataFrame:
    """The first ``limit`` rows of a fixed order: a top-k, for runs that were asked for a part."""
    return df.orderBy(*order).limit(limit)


def split_conflict_groups(members: DataFrame) -> DataFrame:
    """(key, splits) of content or image keys that stand in several splits; ``members`` has sample_id, split, content_hash and image_hashes."""
    content = members.select("split", F.concat(F.lit("content:"), "content_hash").alias("key"))
    images = members.select("split", F.explode("image_hashes").alias("h")).select("split", F.concat(F.lit("image:"), "h").alias("key"))
    rows = content.unionByName(images).where("key is not null and split is not null").distinct()
    return rows.groupBy("key").agg(F.count(F.lit(1)).alias("splits")).where("splits > 1")
