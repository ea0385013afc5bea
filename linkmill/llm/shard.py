"""Sharding by Karmarkar-Karp differencing of indivisible groups, law ``bytes``.

Rows with equal texts are one group and stay in one shard, however many they are.  Groups
are dealt to buckets of about ``BUCKET_GROUPS`` by hash.  In a bucket the k-way differencing
method runs over the groups: every group starts as a partial partition with one filled
part; the two partial partitions of the largest spread are combined, the largest part of
one with the smallest of the other, until one is left.  The buckets' last partitions (40
numbers each) are combined by the same rule, ``FAN`` buckets at a time, until one is left;
that fixes which part goes to which shard and where its slots begin.

The shards' sizes are near equal, as near as whole groups allow: a group larger than the
ideal shard makes its shard as large as itself, and the other shards share the rest
evenly.

Rows that agree in id and text are counted, not listed, and the rows of hot groups are
ranked in salted pieces, so no task gets a group's rows at once.

Defined results: null text has size 16 and forms one group; empty texts are another
group; repeated rows get slots of their own, next to each other; ties are broken by hash
and id, and reruns agree.
"""

from __future__ import annotations

import heapq
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import store

SHARDS = 40
OVERHEAD = 16
#: Groups of one differencing task, and buckets that one task combines.
BUCKET_GROUPS = 20_000
FAN = 64
#: Pieces of a hot group's ids, and of one row's repetitions.
SALTS = 64
REPEATS = 16


def difference(sizes: list[int] | np.ndarray, k: int) -> tuple[list[list[int]], list[int]]:
    """k-way Karmarkar-Karp: for each part its items (indexes into ``sizes``), and the parts' sums."""
    return _combine([([[i]] + [None] * (k - 1), [int(s)] + [0] * (k - 1)) for i, s in enumerate(sizes)], k)


def _combine(partial: list[tuple[list, list[int]]], k: int) -> tuple[list, list[int]]:
    """Combine partial partitions, the two with the largest spread first; parts are lists or None if empty, sums descend."""
    if not partial:
        return [[] for _ in range(k)], [0] * k
    heap = [(s[-1] - s[0], i, p, s) for i, (p, s) in enumerate(partial)]
    heapq.heapify(heap)
    n = len(heap)
    while len(heap) > 1:
        _, _, p, s = heapq.heappop(heap)
        _, _, q, t = heapq.heappop(heap)
        sums = [a + b for a, b in zip(s, reversed(t), strict=True)]
        order = sorted(range(k), key=sums.__getitem__, reverse=True)
        # The shorter list joins the longer one, so an item moves at most log(n) times.
        parts = [_joined(p[i], q[k - 1 - i]) for i in range(k)]
        sums_sorted = [sums[i] for i in order]
        heapq.heappush(heap, (sums_sorted[-1] - sums_sorted[0], n, [parts[i] for i in order], sums_sorted))
        n += 1
    return [part or [] for part in heap[0][2]], heap[0][3]


def _joined(a: list | None, b: list | None) -> list | None:
    if not a or not b:
        return a or b
    if len(a) < len(b):
        a, b = b, a
    a.extend(b)
    return a


def shard_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, bucket_groups: int = BUCKET_GROUPS, fan: int = FAN) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of ``docs``."""
    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
        F.unhex(F.when(text.isNull(), F.lit("00")).otherwise(F.md5(text))).alias("group"),
        F.pmod(F.xxhash64(F.col(id_col), F.lit(7)), F.lit(SALTS)).cast("int").alias("salt"),
        # Which repetition has which number makes no difference to the result.
        (F.monotonically_increasing_id() % REPEATS).cast("int").alias("repeat"),
    )
    same = rows.groupBy("group", "salt", "doc_id", "repeat", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(W.partitionBy("group", "salt").orderBy("doc_id", "repeat")) - F.col("n")
    ranked, ranked_path = store.write_table(same.withColumn("before", before), "rows")
    salted = ranked.groupBy("group", "salt").agg(F.sum("n").alias("n"), F.first("size").alias("size"))
    salted = salted.withColumn("first", F.sum("n").over(W.partitionBy("group").orderBy("salt")) - F.col("n"))
    salted, salted_path = store.write_table(salted, "salted")
    groups = salted.groupBy("group").agg(F.sum("n").alias("n"), (F.first("size") * F.sum("n")).alias("bytes"))
    groups, groups_path = store.write_table(groups, "groups")
    buckets = max(1, -(-groups.count() // bucket_groups))
    units = groups.withColumn("bucket", F.pmod(F.xxhash64("group"), F.lit(buckets)))

    def deal(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("group", ignore_index=True)
        parts, _ = difference(pdf["bytes"].to_numpy(), shards)
        part = np.zeros(len(pdf), np.int32)
        begin = np.zeros(len(pdf), np.int64)
        n = pdf["n"].to_numpy()
        for j, items in enumerate(parts):
            at = np.sort(np.array(items, np.int64))
            part[at] = j
            begin[at] = np.cumsum(n[at]) - n[at]
        return pdf.assign(part=part, begin=begin)[["group", "bucket", "part", "begin", "bytes", "n"]]

    dealt, dealt_path = store.write_table(units.groupBy("bucket").applyInPandas(deal, "group binary, bucket long, part int, begin long, bytes long, n long"), "dealt")
    place, place_paths = _settled(dealt.groupBy("bucket", "part").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")), buckets, shards, fan)
    at = dealt.join(place, ["bucket", "part"]).select("group", "shard", (F.col("at") + F.col("begin")).alias("at"))
    slots = salted.join(at, "group").select("group", "salt", "shard", (F.col("at") + F.col("first")).alias("at"))
    placed, _ = store.write_table(ranked.join(slots, ["group", "salt"]).select("doc_id", "size", "text_crc32", "shard", (F.col("at") + F.col("before")).alias("slot"), "n"), "placed")
    store.remove(docs.sparkSession, ranked_path, salted_path, groups_path, dealt_path, *place_paths)
    every = placed.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    return every.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("slot") + F.col("k")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def _settled(sums: DataFrame, buckets: int, shards: int, fan: int) -> tuple[DataFrame, list[str]]:
    """(bucket, part, shard, at) of the buckets' parts (bucket, part, bytes, n), and the tables' paths: buckets are combined ``fan`` at a time."""

    def combine(pdf: pd.DataFrame) -> pd.DataFrame:
        partial = []
        for b, own in pdf.sort_values(["bucket", "part"]).groupby("bucket"):
            by = {int(p): int(s) for p, s in zip(own["part"], own["bytes"], strict=True)}
            order = sorted(range(shards), key=lambda p: (-by.get(p, 0), p))
            partial.append(([[(int(b), p)] for p in order], [by.get(p, 0) for p in order]))
        parts, _ = _combine(partial, shards)
        part_of = {key: j for j, keys in enumerate(parts) for key in keys}
        pdf["up_part"] = [part_of[int(b), int(p)] for b, p in zip(pdf["bucket"], pdf["part"], strict=True)]
        pdf = pdf.sort_values(["up_part", "bucket", "part"])
        pdf["begin"] = pdf.groupby("up_part")["n"].cumsum() - pdf["n"]
        return pdf[["bucket", "part", "up", "up_part", "begin", "bytes", "n"]]

    levels, paths = [], []
    while True:
        up = sums.withColumn("up", F.floor(F.col("bucket") / fan))
        level, path = store.write_table(up.groupBy("up").applyInPandas(combine, "bucket long, part int, up long, up_part int, begin long, bytes long, n long"), "settled")
        levels.append(level)
        paths.append(path)
        buckets = -(-buckets // fan)
        if buckets == 1:
            break
        sums = level.groupBy(F.col("up").alias("bucket"), F.col("up_part").alias("part")).agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
    place = levels[-1].select("bucket", "part", F.col("up_part").alias("shard"), F.col("begin").alias("at"))
    for level in reversed(levels[:-1]):
        above = place.select(F.col("bucket").alias("up"), F.col("part").alias("up_part"), "shard", "at")
        place = level.join(above, ["up", "up_part"]).select("bucket", "part", "shard", (F.col("at") + F.col("begin")).alias("at"))
    return place, paths
