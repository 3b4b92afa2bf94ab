"""Longest-processing-time sharding of groups that must stay together.

Groups (equal texts, by 64-bit hash) are summed up, distributed. Groups of one size are
interchangeable, so the schedule needs only how many groups there are of each size: sizes go by
falling value to the least-loaded shard through a heap, exactly as if each group were dealt on its
own. Sizes are whole numbers, so at most the root of twice the total bytes differ: that bounds
what the driver holds (16 bytes each). Which groups of a size go where follows from their rank
within the size; ranks are counted in parallel (salted, so that no size is a hot key).

Rows find their group's shard by a join on the hash. Groups of many rows (at least 1 / ``HEAVY`` of
all, so at most ``HEAVY`` groups) are broadcast instead, so no text is a hot key.

Null text counts as empty (size ``overhead``). Repeated rows are rows of one group and keep a slot
each. Ties: shards of equal load take turns by their number, groups of equal size rank by salt and
hash. Slots are gapless from 0 within a shard: chunks of rows get offsets from their counts, so no
task sorts a whole shard. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._common import session, staged

#: Parts of a size whose groups are ranked each on their own.
SALTS = 64
#: At most as many groups are joined by broadcast.
HEAVY = 8192
#: Rows of the schedule up to which it is broadcast (some 60 MB at most).
SCHEDULE = 200_000
#: Parts of a shard that are numbered each on their own.
CHUNKS = 256


def longest_first(sizes: np.ndarray, counts: np.ndarray, shards: int) -> list[tuple[int, list[int], list[int]]]:
    """For each size (falling) the ranks from which on groups go to a shard, and these shards."""
    loads = [0] * shards
    out = []
    for k in np.argsort(-sizes, kind="stable").tolist():
        w, n = int(sizes[k]), int(counts[k])
        given = _deal(loads, w, n)
        first, cuts, owners = 0, [], []
        for s, m in enumerate(given):
            if m:
                cuts.append(first)
                owners.append(s)
                first += m
                loads[s] += w * m
        out.append((w, cuts, owners))
    return out


def _deal(loads: list[int], w: int, n: int) -> list[int]:
    """How many of ``n`` groups of size ``w`` each shard gets, each to the least load so far (the first of equals)."""
    given = [0] * len(loads)
    if n > 16 * len(loads):
        # the j-th group of shard s comes at load + j * w: all those below the highest level that n groups reach
        at, low, high = np.array(loads, np.int64), min(loads), max(loads) + w * n
        below = lambda level: np.maximum(0, -(-(level - at) // w))
        while low < high:
            level = (low + high + 1) // 2
            low, high = (level, high) if int(below(level).sum()) <= n else (low, level - 1)
        given = below(low).tolist()
        n -= sum(given)
    heap = [(load + w * m, s) for s, (load, m) in enumerate(zip(loads, given, strict=True))]
    heapq.heapify(heap)
    for _ in range(n):
        load, s = heap[0]
        given[s] += 1
        heapq.heapreplace(heap, (load + w, s))
    return given


def shard(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", overhead: int = 8) -> DataFrame:
    """``id_col``, size, text_crc32, shard and slot of every row."""
    spark = session(docs)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = staged(docs.select(F.col(id_col), (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("h")))
    groups = rows.groupBy("h").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    groups = staged(groups.withColumn("salt", F.pmod(F.xxhash64("h"), F.lit(SALTS)).cast("int")))
    counts = groups.groupBy("bytes", "salt").agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.groupBy("bytes").agg(F.sum("n").alias("n")).toPandas()
    plan = longest_first(sizes["bytes"].to_numpy(np.int64), sizes["n"].to_numpy(np.int64), shards)
    schedule = spark.createDataFrame(pd.DataFrame(plan, columns=["bytes", "cuts", "owners"]), "bytes long, cuts array<long>, owners array<int>") if plan else spark.createDataFrame([], "bytes long, cuts array<long>, owners array<int>")
    schedule = F.broadcast(schedule) if len(plan) <= SCHEDULE else schedule
    before = Window.partitionBy("bytes").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("bytes", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("bytes", "salt").orderBy("h")
    ranked = groups.withColumn("rank", F.row_number().over(inside)).join(bases, ["bytes", "salt"]).join(schedule, "bytes")
    own = F.element_at("owners", F.size(F.filter("cuts", lambda c: c <= F.col("base") + F.col("rank") - 1)))
    placed = staged(ranked.select("h", "rows", own.alias("shard")))
    floor = -(-(placed.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]) // HEAVY)
    heavy = placed.where(F.col("rows") >= max(floor, 2)).orderBy(F.desc("rows"), "h").limit(HEAVY)
    first = rows.join(F.broadcast(heavy.select("h", F.col("shard").alias("own"))), "h", "left")
    light = first.where("own IS NULL").drop("own").join(placed.select("h", "shard"), "h")
    at = first.where("own IS NOT NULL").withColumnRenamed("own", "shard").select(light.columns).unionByName(light)
    at = staged(at.select(id_col, "size", "text_crc32", "shard", F.pmod(F.xxhash64(id_col, "h"), F.lit(CHUNKS)).cast("int").alias("chunk"), "h"))
    totals = at.groupBy("shard", "chunk").count()  # shards * CHUNKS rows
    earlier = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("shard", "chunk", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("base"))
    within = Window.partitionBy("shard", "chunk").orderBy(id_col, "h")
    numbered = at.withColumn("n", F.row_number().over(within)).join(F.broadcast(offsets), ["shard", "chunk"])
    return numbered.select(id_col, "size", "text_crc32", "shard", (F.col("base") + F.col("n") - 1).alias("slot"))
