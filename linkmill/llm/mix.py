"""Mixing sources to target weights, native: only DataFrame functions.

Every row gets a hash-random key (md5 over id, source and text).  The key's leading hex digits
are a range partition of known, even density: a source's rows are summed per range,
the ranges' sums are accumulated along the source, and inside a range the rows are
accumulated in key order.  Both together are a distributed prefix sum of word counts
in random order, without a sample and the same at every run.  A source with target T
and size S is taken T div S times whole; the last epoch is cut at T mod S words.

Targets: the weights share all words; targets stop at ``CAP`` times their source's
size and the excess is shared again by weight (water filling, in closed form over the
sources ordered by size per weight).

Defined results: null text has size 0; a null source is a source of its own, last;
rows without words are taken 0 times; equal rows share a key, which of them is counted
first makes no difference to the result as a multiset; rows that differ in any column
stay different rows in ``mixed``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

WEIGHTS = (5, 2, 1)
CAP = 3
DIGITS = 3  # 4096 ranges a source
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, target) from (source, source_size): one row a source."""
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    by_ratio = W.orderBy("full", F.col("source").asc_nulls_last())
    k = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (k % len(weights) + 1).cast("int")).cast("long")
    t = sizes.withColumn("weight", weight)
    t = t.withColumn("full", F.col("source_size").cast("double") / F.col("weight"))
    everything = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    t = t.withColumn("capped", F.sum(F.col("source_size") * cap).over(by_ratio.rowsBetween(W.unboundedPreceding, -1)))
    t = t.withColumn("open_weight", F.sum("weight").over(by_ratio.rowsBetween(0, W.unboundedFollowing)))
    t = t.withColumn("total", F.sum("source_size").over(everything))
    # The level if all sources before this one stop at their cap and this one and those after don't.
    t = t.withColumn("level", (F.col("total") - F.coalesce("capped", F.lit(0))).cast("double") / F.col("open_weight"))
    t = t.withColumn("level", F.max(F.when(F.col("level") * F.col("weight") <= F.col("source_size") * cap, F.col("level"))).over(everything))
    target = F.least((F.col("source_size") * cap).cast("double"), F.col("level") * F.col("weight"))
    return t.select("source", "source_size", F.coalesce(target, (F.col("source_size") * cap).cast("double")).alias("target"))


def row_key(seed: str, *columns: Column) -> Column:
    """Hash-random key of a row; null differs from empty."""
    return F.md5(F.concat_ws("\x1f", F.lit(seed), *[F.coalesce(c.cast("string"), F.lit("\x01")) for c in columns]))


def mix_plan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: str = "mix", whole: bool = False, more: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id, size, source_size, target, taken, key for every row; the key is over id, source, text and ``more`` columns.

    ``whole`` takes the row at the cut whole if the cut lies in its second half and not
    at all otherwise; without it that row is taken up to the exact budget.
    """
    text = F.col(text_col).cast("string")
    key = row_key(seed, F.col(id_col), F.col(source_col), text, *[F.col(f"`{c}`") for c in more])
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(text).alias("size"), key.alias("key"))
    rows = rows.withColumn("range", F.substring("key", 1, DIGITS))
    # Nulls don't meet in joins: the source's name as a key that is never null.
    rows = rows.withColumn("name", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    ranges = rows.groupBy("name", "source", "range").agg(F.sum("size").alias("range_size"))
    targets = source_targets(ranges.groupBy("source").agg(F.sum("range_size").alias("source_size")), weights, cap)
    targets = targets.withColumn("name", F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))).drop("source")
    before = F.sum("range_size").over(W.partitionBy("name").orderBy("range")) - F.col("range_size")
    starts = ranges.withColumn("start", before).join(targets, "name").select("name", "range", "start", "source_size", "target")
    inside = F.sum("size").over(W.partitionBy("name", "range").orderBy("key").rowsBetween(W.unboundedPreceding, 0)) - F.col("size")
    placed = rows.withColumn("inside", inside).join(starts, ["name", "range"])
    budget = F.floor("target")
    rest = F.when(F.col("source_size") > 0, budget % F.col("source_size")).otherwise(F.lit(0))
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    fits = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("start") - F.col("inside")))
    if whole:
        fits = F.when(fits * 2 > F.col("size"), F.col("size")).otherwise(F.lit(0))
    taken = (epochs * F.col("size") + fits).cast("long")
    return placed.select("doc_id", "size", "source_size", "target", taken.alias("taken"), "key")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix", **options) -> DataFrame:
    """The mix itself: each row of ``docs`` once for every time that it is taken, whole rows only."""
    from .ngram_join import fresh

    key, copies = fresh(docs, "linkmill_key"), fresh(docs, "linkmill_copies")
    more = tuple(c for c in docs.columns if c not in (id_col, text_col, source_col))
    plan = mix_plan(docs, id_col, text_col, source_col, seed=seed, whole=True, more=more, **options)
    # Rows with one key agree in all columns and may differ in what is taken: together they are so many copies of one.
    plan = plan.where(F.col("taken") > 0).groupBy("key").agg(F.sum(F.floor(F.col("taken") / F.col("size"))).alias("copies"))
    keyed = docs.withColumn(key, row_key(seed, F.col(id_col), F.col(source_col), F.col(text_col).cast("string"), *[F.col(f"`{c}`") for c in more]))
    out = keyed.dropDuplicates([key]).join(plan.select(F.col("key").alias(key), F.col("copies").alias(copies)), key)
    return out.withColumn(copies, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies)))).select(*[F.col(f"`{c}`") for c in docs.columns])
