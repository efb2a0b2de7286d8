"""Versioned state: which row holds, what comes next, what overlaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def resolve_versions(df: DataFrame, group: list[str], active: Column, order: list[Column]) -> DataFrame:
    """Adds ``is_selected``: the first active row of each group, or its first row if none is active."""
    w = Window.partitionBy(*group).orderBy(F.when(active, 0).otherwise(1), *order)
    return df.withColumn("is_selected", F.row_number().over(w) == 1)


def next_attempt(df: DataFrame, keys: list[str], attempt: str = "attempt") -> DataFrame:
    """(keys, next_attempt): one more than the greatest attempt, 1 for none."""
    return df.groupBy(*keys).agg((F.coalesce(F.max(attempt), F.lit(0)) + 1).alias("next_attempt"))


def checks(df: DataFrame, key: str, rules: dict[str, tuple[str, Column]]) -> DataFrame:
    """(key, qc_checks, qc_passed): one struct (name, severity, status) per rule; a row passes if no check fails.

    A rule is (severity, condition); a condition that is null does not hold.
    """
    made = [
        F.struct(F.lit(name).alias("name"), F.when(F.coalesce(ok, F.lit(False)), "pass").otherwise(severity).alias("status")) for name, (severity, ok) in rules.items()
    ]
    return df.select(key, F.array(*made).alias("qc_checks")).withColumn("qc_passed", ~F.exists("qc_checks", lambda c: c["status"] == "fail"))


def check_summary(checked: DataFrame) -> DataFrame:
    """(name, status, n) over all checks."""
    return checked.select(F.explode("qc_checks").alias("c")).groupBy("c.name", "c.status").agg(F.count(F.lit(1)).alias("n"))


def passing(df: DataFrame, checked: DataFrame, key: str) -> DataFrame:
    """Rows whose checks hold no failure; a row that was not checked does not pass."""
    return df.join(checked.where("qc_passed").select(key).distinct(), key, "left_semi")


def failed_gate(df: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """(key, name) of the failed checks of rows that are to be published; any row stops the release."""
    return results.where("status = 'fail'").join(df.select(key).distinct(), key, "left_semi").select(key, "name").distinct()


def claimable(tasks: DataFrame, now: Column) -> DataFrame:
    """Tasks that may run now, with the state they are in.

    A running task whose lease ended waits again, from now. A task is due when it is pending, waiting or deferred, its time
    has come, and the task it depends on has succeeded; one that depends on an unknown task never is.
    ``tasks`` has task_uid, kind, status, attempts, dependency_uid, available_at, lease_until and created_at.
    """
    expired = F.coalesce((F.col("status") == "running") & (F.col("lease_until") < now), F.lit(False))
    freed = tasks.withColumn("available_at", F.when(expired, now).otherwise(F.col("available_at"))).withColumn("status", F.when(expired, "retry_wait").otherwise(F.col("status")))
    due = freed.where(F.col("status").isin("pending", "retry_wait", "deferred") & (F.col("available_at") <= now))
    done = tasks.where("status = 'succeeded'").select(F.col("task_uid").alias("dependency_uid")).distinct()
    return due.where("dependency_uid is null").unionByName(due.where("dependency_uid is not null").join(done, "dependency_uid", "left_semi"))


def claimed(tasks: DataFrame, now: Column, owner: str, limit: int, lease_seconds: int = 3600) -> DataFrame:
    """The oldest ``limit`` claimable tasks as they run: one attempt more, an owner and a lease."""
    first = claimable(tasks, now).orderBy("created_at", "task_uid").limit(limit)
    lease = now + F.make_interval(secs=F.lit(lease_seconds))
    return first.withColumn("status", F.lit("running")).withColumn("attempts", F.coalesce("attempts", F.lit(0)) + 1).withColumn("owner", F.lit(owner)).withColumn("lease_until", lease)


def overlapping(left: DataFrame, right: DataFrame, on: list[str], start: str, end: str, width: int) -> DataFrame:
    """Pairs of rows with equal ``on`` whose half-open ranges overlap, as (on, l_*, r_*) columns.

    Both sides are laid on cells of ``width`` and joined cell by cell; a pair is kept in the one cell in which the
    later of the two starts lies, so wide ranges and hot groups are spread and no pair comes twice.
    """
    def cells(df: DataFrame, side: str) -> DataFrame:
        named = df.select(*on, *[F.col(c).alias(f"{side}_{c}") for c in df.columns if c not in on]).where(F.col(f"{side}_{start}") < F.col(f"{side}_{end}"))
        return named.withColumn("_cell", F.explode(F.sequence(F.floor(F.col(f"{side}_{start}") / width), F.floor((F.col(f"{side}_{end}") - 1) / width))))

    a, b = cells(left, "l"), cells(right, "r")
    hit = a.join(b, [*on, "_cell"]).where((F.col(f"l_{start}") < F.col(f"r_{end}")) & (F.col(f"r_{start}") < F.col(f"l_{end}")))
    return hit.where(F.col("_cell") == F.floor(F.greatest(f"l_{start}", f"r_{start}") / width)).drop("_cell")


def task_states(events: DataFrame, task: str, order: str, status: str, retries: int = 5) -> DataFrame:
    """(task, status, attempts, wait_seconds): the state of each task after all its events.

    ``failed`` events wait 5 * 2 ** n seconds, at most an hour, and end in ``failed`` after ``retries``; a deferred
    task gets its attempt back. The last event decides; ties fall to the greatest status.
    """
    per_task = events.where(F.col(task).isNotNull()).groupBy(task).agg(
        F.max(F.struct(order, status)).alias("last"),
        F.count(F.when(F.col(status) == "failed", 1)).alias("failures"),
        F.count(F.when(F.col(status).isin("started", "failed"), 1)).alias("starts"),
        F.count(F.when(F.col(status) == "deferred", 1)).alias("deferred"),
    )
    last = F.col(f"last.{status}")
    state = F.when((last == "failed") & (F.col("failures") < retries), "retry_wait").otherwise(last)
    return per_task.select(
        task,
        state.alias("status"),
        F.greatest(F.col("starts") - F.col("deferred"), F.lit(0)).alias("attempts"),
        F.when(state == "retry_wait", F.least(F.lit(3600.0), 5 * F.pow(F.lit(2.0), F.col("failures")))).alias("wait_seconds"),
    )


def bootstrap_mean(df: DataFrame, value: str, group: list[str], rounds: int = 2000, seed: int = 0) -> DataFrame:
    """(group, mean, low, high): the mean and the 2.5 % and 97.5 % quantiles of its Poisson bootstrap.

    Every row draws its weight in each round from its own hash, so rounds are sums that combine before the shuffle
    and no group is gathered. Groups without a value give no row; ``group`` may be empty.
    """
    import numpy as np
    import pandas as pd

    keyed = df.where(F.col(value).isNotNull()).select(*group, F.col(value).cast("double").alias("_v"), F.xxhash64(F.lit(seed), *[F.col(c) for c in df.columns]).alias("_h"))
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in keyed.schema.fields[: len(group)])

    def draw(batches):
        for pdf in batches:
            for key, part in pdf.groupby(group, dropna=False) if group else [((), pdf)]:
                w = np.zeros((2, rounds))
                for h, v in zip(part["_h"].to_numpy(np.int64), part["_v"].to_numpy(float)):
                    n = np.random.Generator(np.random.PCG64(int(h) & (1 << 63) - 1)).poisson(1.0, rounds)
                    w += n * np.array([[1.0], [v]])
                out = {c: [k] * rounds for c, k in zip(group, key)}
                yield pd.DataFrame({**out, "round": range(rounds), "n": w[0], "s": w[1]})

    sums = keyed.mapInPandas(draw, f"{fields}round int, n double, s double").groupBy(*group, "round").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    means = sums.withColumn("m", F.try_divide("s", "n")).groupBy(*group).agg(F.percentile("m", F.array(F.lit(0.025), F.lit(0.975))).alias("q"))
    exact = keyed.groupBy(*group).agg(F.avg("_v").alias("mean"))
    joined = exact.join(means, group) if group else exact.withColumn("_k", F.lit(1)).join(means.withColumn("_k", F.lit(1)), "_k")
    return joined.select(*group, "mean", F.col("q")[0].alias("low"), F.col("q")[1].alias("high"))
