"""Thesauri as triples (s, p, o, lang, pos): patterns and label maps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pattern(triples: DataFrame, required: str, optional: dict[str, str]) -> DataFrame:
    """Subjects with a required predicate (o), and the objects of optional ones under the names given; several objects give several rows."""
    out = triples.where(F.col("p") == required).select("s", "o", "lang")
    for p, name in optional.items():
        out = out.join(triples.where(F.col("p") == p).select("s", F.col("o").alias(name)), "s", "left")
    return out


def label_maps(triples: DataFrame, predicates: list[str]) -> DataFrame:
    """(s, labels): map of language to labels, in the order of predicate and position, each once."""
    order = F.array_position(F.array(*[F.lit(p) for p in predicates]), F.col("p"))
    rows = triples.where(F.col("p").isin(predicates)).groupBy("s", "lang").agg(F.array_sort(F.collect_list(F.struct(order.alias("k"), "pos", "o"))).alias("x"))
    one = rows.select("s", "lang", F.array_distinct(F.transform("x", lambda v: v["o"])).alias("labels"))
    return one.groupBy("s").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.coalesce("lang", F.lit("")).alias("lang"), "labels")))).alias("labels"))
