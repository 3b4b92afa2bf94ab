"""Incremental processing: what is pending, what expires, and appends that ignore conflicts.

All anti-joins are declarative; Catalyst turns them into (null-aware) hash or sort-merge anti
joins, and nothing is collected. Times are compared with an explicit ``as_of``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_in(records: DataFrame, key: str, done: DataFrame, done_key: str) -> DataFrame:
    """SQL's NOT IN: one NULL in ``done`` leaves nothing, and NULL keys are never pending (unless nothing is done).

    The NULLs are counted in one row, and the rest is an ordinary anti-join, so the plan does not
    hang on a single broadcast of everything done.
    """
    keys = done.select(F.col(done_key).alias("__done"))
    facts = keys.agg(F.count(F.lit(1)).alias("__n"), F.count_if(F.col("__done").isNull()).alias("__nulls"))
    left = records.join(keys.where("__done is not null"), F.col(key) == F.col("__done"), "left_anti")
    # one row: an aggregate without keys
    return left.join(F.broadcast(facts), F.lit(True)).where((F.col("__n") == 0) | (F.col("__nulls") == 0) & F.col(key).isNotNull()).drop("__n", "__nulls")


def not_exists(records: DataFrame, key: str, done: DataFrame, done_key: str) -> DataFrame:
    """NOT EXISTS: NULL keys stay pending."""
    return records.join(done.select(F.col(done_key).alias("__done")), F.col(key) == F.col("__done"), "left_anti")


def stale(records: DataFrame, key: str, ledger: DataFrame, ledger_key: str, date: str, as_of: Column, days: int) -> DataFrame:
    """Records without an entry newer than ``days`` before ``as_of``: never handled, or expired."""
    fresh = ledger.where(F.col(date) > as_of - F.expr(f"INTERVAL {days} DAYS"))
    return not_exists(records, key, fresh, ledger_key)


def append_new(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` and the ``rows`` whose keys it lacks; the least of rows with equal keys."""
    rest = [c for c in rows.columns if c not in keys]
    one = rows.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__r")).select(*keys, "__r.*") if rest else rows.distinct()
    return target.unionByName(one.join(target.select(*keys), keys, "left_anti"))


def update(target: DataFrame, changes: DataFrame, keys: list[str], column: str) -> DataFrame:
    """``target`` with ``column`` replaced where ``changes`` has the keys (one row per key)."""
    new = changes.select(*keys, F.col(column).alias("__new"), F.lit(True).alias("__hit"))
    joined = target.join(new, keys, "left")
    return joined.withColumn(column, F.when(F.col("__hit"), F.col("__new")).otherwise(F.col(column))).select(*target.columns)


def any_value(rows: DataFrame, key: str, value: str, alias: str) -> DataFrame:
    """A scalar subquery's LIMIT 1, made deterministic: the least value per key."""
    return rows.groupBy(key).agg(F.min(value).alias(alias))


def keep_first(rows: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The first row of each key, with how many it stands for: an aggregate, combined before the shuffle, so a hot key is one row a task."""
    first = F.min_by(F.struct(*rows.columns), F.struct(*order, *[F.col(c).alias(f"__{c}") for c in rows.columns]))
    return rows.groupBy(F.col(key).alias("__key")).agg(first.alias("__r"), F.count(F.lit(1)).alias("n_rows")).select("__r.*", "n_rows")


def either_key(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]], out: list[str]) -> DataFrame:
    """A join on any of several key pairs: a union of equi-joins, so no nested loop."""
    parts = [left.join(right, F.col(a) == F.col(b)).select(*out) for a, b in pairs]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows.distinct()


def first_of(rows: DataFrame, tables: list[tuple[DataFrame, Column, Column]], alias: str) -> DataFrame:
    """An ordered fallback: the value of the first table that matches. (table, condition, value) each."""
    out, names = rows, []
    for k, (table, condition, value) in enumerate(tables):
        out = out.join(table, condition, "left").withColumn(f"__v{k}", value).select(*rows.columns, *names, f"__v{k}")
        names.append(f"__v{k}")
    return out.withColumn(alias, F.coalesce(*names)).drop(*names)


def augment(records: DataFrame, record_id: str, properties: dict[str, Column], process: str, as_of: Column) -> DataFrame:
    """(record_id, property, value, process, date): one row per record and property."""
    pairs = F.array(*[F.struct(F.lit(p).alias("property"), v.cast("string").alias("value")) for p, v in properties.items()])
    flat = records.select(F.col(record_id).cast("string").alias("record_id"), F.explode(pairs).alias("x"))
    return flat.select("record_id", "x.property", "x.value", F.lit(process).alias("process"), as_of.alias("date"))


def next_batch(records: DataFrame, key: str, done: DataFrame, done_key: str, wanted: Column, limit: int) -> DataFrame:
    """The next ``limit`` pending records (by key) that a process wants: a batch of its work, not a sample."""
    return not_exists(records.where(wanted), key, done, done_key).orderBy(key).limit(limit)


def pending_dois(records: DataFrame, key: str, identifier: str, status: DataFrame, status_key: str, limit: int = 100) -> DataFrame:
    """Records whose identifier holds a DOI and that have no status yet."""
    return next_batch(records, key, status, status_key, F.col(identifier).rlike(r"10\.[0-9]{4,9}/\S+"), limit)


def pending_persons(persons: DataFrame, key: str, orcid: str, employment: DataFrame, person_key: str, limit: int = 1000) -> DataFrame:
    """Persons with an identifier of their own whose employment isn't known yet."""
    return next_batch(persons, key, employment, person_key, F.coalesce(orcid, F.lit("")) != "", limit)


def pending_videos(records: DataFrame, key: str, identifier: str, answer: str, limit: int = 100) -> DataFrame:
    """Records that point to a video and have no answer; a failure that was noted counts as one."""
    link = F.lower(identifier).contains("youtu.be") | F.lower(identifier).contains("youtube.com")
    return records.where(link & F.col(answer).isNull()).orderBy(key).limit(limit)
