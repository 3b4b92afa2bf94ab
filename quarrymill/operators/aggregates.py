"""Aggregations over records, labels, citations and evaluations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import present

# Weights of the completeness score.
WEIGHTS = {
    "identifier": 10, "title": 20, "abstract": 10, "language": 5, "type": 5, "thumbnail": 10, "date": 5, "datamodel": 10, "subjects": 10, "matched_subjects": 10, "contacts": 10,
    "accessconstraints": 5, "temporal_start": 5, "temporal_end": 5, "spatial": 10, "distributions": 10, "projects": 5, "license": 10, "rights": 5, "format": 5, "lineage": 5,
}


def completeness(columns: dict[str, Column], weights: dict[str, int] | None = None) -> Column:
    """Weighted share of present fields in percent, to one place; a row-wise sum, no shuffle."""
    weights = weights or WEIGHTS
    total = float(sum(weights.values()))
    parts = [F.when(present(columns[f]), F.lit(w * 100.0)).otherwise(0.0) for f, w in weights.items() if f in columns]
    return F.round(reduce(lambda a, b: a + b, parts) / total, 1)


def ordered_set(value: Column, order: Column) -> Column:
    """Distinct values in the order of their first occurrence."""
    return F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), value.alias("v")))), lambda x: x["v"]))


def least_values(rows: DataFrame, by: list[str], value: str, k: int, alias: str) -> DataFrame:
    """``by`` and the ``k`` least distinct values, in order; no group is held whole."""
    w = Window.partitionBy(*by).orderBy(value)
    top = rows.where(F.col(value).isNotNull()).select(*by, value).distinct().withColumn("__k", F.row_number().over(w)).where(F.col("__k") <= k)
    return top.groupBy(*by).agg(F.array_sort(F.collect_list(value)).alias(alias))


def census(rows: DataFrame, by: list[str], group: str, value: str, k: int = 5) -> DataFrame:
    """Per kind of keyword group: distinct groups, values, and the ``k`` least values as examples."""
    counts = rows.groupBy(*by).agg(F.countDistinct(group).alias("group_count"), F.count(F.lit(1)).alias("value_count"))
    return counts.join(least_values(rows, by, value, k, "examples"), by, "left")


def cited_by(edges: DataFrame) -> DataFrame:
    """(reference, citing, n_citing): who cites each reference; NULL references are left out."""
    return edges.where(F.col("reference").isNotNull()).groupBy("reference").agg(F.array_sort(F.collect_set("citing")).alias("citing")).withColumn("n_citing", F.size("citing").cast("long"))


def index_quantiles(rows: DataFrame, by: str, value: str, at: dict[str, str]) -> DataFrame:
    """Per group: n, least, most, and for each name in ``at`` the value at a place of the sorted values (SQL over n, from 0).

    Values are counted first, so a group's window holds its distinct values, not its rows.
    """
    counts = rows.where(F.col(value).isNotNull()).groupBy(by, value).agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy(by)
    x = counts.withColumn("upto", F.sum("c").over(w.orderBy(value))).withColumn("n", F.sum("c").over(w))
    pick = [F.min(F.when(F.col("upto") > F.expr(e), F.col(value))).alias(name) for name, e in at.items()]
    return x.groupBy(by).agg(F.max("n").alias("n"), F.min(value).alias("least"), *pick, F.max(value).alias("most"))


def scores(pairs: DataFrame, legacy: bool = False) -> DataFrame:
    """Micro precision, recall and F1 of label sets (truth, given).

    ``legacy`` keeps an old count: a record without truth is a match whatever was given, and an
    empty side adds 1 to its total.
    """
    t, g = F.size("truth"), F.size("given")
    match = F.size(F.array_intersect("truth", "given"))
    if legacy:
        match, t, g = F.when(t == 0, 1).otherwise(match), F.greatest(t, F.lit(1)), F.greatest(g, F.lit(1))
    sums = pairs.agg(F.sum(match).cast("double").alias("m"), F.sum(t).cast("double").alias("t"), F.sum(g).cast("double").alias("g"))
    p, r = F.try_divide("m", "g"), F.try_divide("m", "t")
    return sums.select(F.round(p, 4).alias("precision"), F.round(r, 4).alias("recall"), F.round(F.try_divide(2 * p * r, p + r), 4).alias("f1"))
