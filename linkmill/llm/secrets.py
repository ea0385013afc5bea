"""Secret scans with an incremental blob ledger, native: only DataFrame functions.

Every version of a text is a blob, addressed by the SHA-256 of its content.  The
ledger is a Parquet table with one row for each (blob, rule, rule version) ever
scanned, findings included; a run scans only pairs that the ledger doesn't have, adds
them, and joins the findings back to every path (row) that holds the blob.  A blob is
scanned once however many rows hold it; a changed rule is scanned again, the others
are not.

Positions come from the pieces around the matches: ``split`` and ``regexp_extract_all``
walk the same matches, so a match begins where the pieces and matches before it end.
They are in code points, the end is exclusive.

Defined results: null text is the empty blob, without findings; repeated rows share a
blob and each get its findings; a text's time and memory are linear in its length and its
matches.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import store


#: Tasks that the rows of one blob are spread over when its findings come back to them.
SALTS = 16


@dataclass(frozen=True)
class Rule:
    """A kind of secret: all leftmost matches of ``pattern``; ``group`` must have ``least`` characters.

    ``hint``: a cheap pattern that every text with a finding meets.
    """

    kind: str
    version: int
    pattern: str
    hint: str
    group: int = 0
    least: int = 1


# The base kinds, in the order that decides between spans with the same start.
BASE_RULES = (
    Rule("assign", 1, r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", r"""(?i)(?:passw|secret|token|api_?key)""", 2, 12),
    Rule("access", 1, r"AKIA[A-Z0-9]+", r"AKIA[A-Z0-9]{14}", 0, 18),
    Rule("hex", 1, r"[0-9a-f]{16,}", r"[0-9a-f]{16}", 0, 16),
)
# Kinds of our own: well-known token formats.
MORE_RULES = (
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", r"eyJ[A-Za-z0-9_-]{8}"),
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", r"-----BEGIN "),
    Rule("live", 1, r"sk[-_][A-Za-z0-9_-]{20,}", r"sk[-_][A-Za-z0-9_-]{20}"),
)
RULES = BASE_RULES + MORE_RULES


STEP = "array<struct<rule:int,place:int,p:int,m:int,ok:boolean>>"
SPANS = "array<struct<start:int,end:int>>"


def steps(text: Column, rule: Rule, number: int) -> Column:
    """For each match of the rule in ``text``, failing ones too: the lengths of the piece before it and of itself, and if it counts."""
    # The pattern consumes what it matches; split and extract walk the same matches.
    matches = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    pieces = F.split(text, rule.pattern, -1)
    wanted = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    zipped = F.filter(F.arrays_zip(pieces.alias("p"), matches.alias("m"), wanted.alias("g")), lambda x: x["m"].isNotNull())
    found = F.transform(zipped, lambda x, i: F.struct(F.lit(number).alias("rule"), i.alias("place"), F.length(x["p"]).alias("p"), F.length(x["m"]).alias("m"), (F.length(x["g"]) >= rule.least).alias("ok")))
    return F.when(F.regexp(text, F.lit(rule.hint)), found).otherwise(F.array()).cast(STEP)


def findings(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, findings) of (blob, text, seen): for each rule that isn't ``seen`` its spans.

    Positions are running sums over a blob's matches, one row a match, so the time is
    linear in them.  The blobs are dealt by hash already, so nothing is shuffled again.
    """
    names = [f"{r.kind}:{r.version}" for r in rules]
    todo = [~F.array_contains("seen", n) for n in names]
    every = F.concat(*[F.when(t, steps(F.col("text"), r, k)).otherwise(F.array().cast(STEP)) for k, (t, r) in enumerate(zip(todo, rules, strict=True))])
    rows = blobs.select("blob", F.filter(F.array(*[F.when(t, F.lit(n)) for t, n in zip(todo, names, strict=True)]), lambda x: x.isNotNull()).alias("scanned"), F.explode_outer(every).alias("x"))
    rows = rows.select("blob", "scanned", "x.*")
    stop = F.sum(F.col("p") + F.col("m")).over(W.partitionBy("blob", "rule").orderBy("place")).cast("int")
    placed = rows.withColumn("end", stop).withColumn("start", F.col("end") - F.col("m"))
    spans = [F.array_sort(F.collect_list(F.when(F.col("ok") & (F.col("rule") == k), F.struct("start", "end")))).alias(f"s{k}") for k in range(len(rules))]
    lists = placed.groupBy("blob").agg(F.first("scanned").alias("scanned"), *spans)
    entries = F.array(*[F.struct(F.lit(n).alias("key"), F.col(f"s{k}").cast(SPANS).alias("value")) for k, n in enumerate(names)])
    return lists.select("blob", F.map_from_entries(F.filter(entries, lambda x: F.array_contains("scanned", x["key"]))).alias("findings"))


def blob_address(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.parquet(path) if store.exists(spark, path) else None


def scan(docs: DataFrame, ledger: str, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan what ``ledger`` hasn't seen, add it there, and return the whole ledger: blob, findings.

    The ledger holds one row a blob and run with the rules scanned then as a map
    ``kind:version -> spans``; a blob's rows together are its history.
    """
    spark = docs.sparkSession
    names = [f"{r.kind}:{r.version}" for r in rules]
    blobs = docs.select(blob_address(F.col(text_col).cast("string")).alias("blob"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).dropDuplicates(["blob"])
    old = read_ledger(spark, ledger)
    if old is None:
        unseen = blobs.withColumn("seen", F.array().cast("array<string>"))
    else:
        seen = old.select("blob", F.explode(F.map_keys("findings")).alias("rule")).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        unseen = blobs.join(seen, "blob", "left").withColumn("seen", F.coalesce("seen", F.array().cast("array<string>")))
        unseen = unseen.where(F.size(F.array_except(F.array(*[F.lit(n) for n in names]), "seen")) > 0)
    fresh = findings(unseen, rules)
    fresh.write.mode("append").parquet(ledger)
    return spark.read.parquet(ledger)


def findings_by_path(docs: DataFrame, ledger: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, blob and one array of spans for each rule, for every row of ``docs``."""
    paths = docs.select(F.col(id_col).alias("doc_id"), blob_address(F.col(text_col).cast("string")).alias("blob"))
    flat = ledger.select("blob", F.explode("findings").alias("rule", "spans")).where(F.size("spans") > 0)
    # Only blobs with findings come back; every row without one has none.
    per_blob = flat.groupBy("blob").agg(*[F.max(F.when(F.col("rule") == f"{r.kind}:{r.version}", F.col("spans"))).alias(r.kind) for r in rules])
    # A blob that many rows hold meets them in as many tasks as there are salts.
    salted = per_blob.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    paths = paths.withColumn("salt", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(SALTS)).cast("int"))
    joined = paths.join(salted, ["blob", "salt"], "left")
    return joined.select("doc_id", "blob", *[F.coalesce(r.kind, F.array().cast(SPANS)).alias(r.kind) for r in rules])


def span_list(kinds: list[str]) -> Column:
    """kind:start:end of the rules' spans, by start, then kind as listed, comma-joined."""

    def tagged(i: int, kind: str) -> Column:
        return F.transform(F.col(kind), lambda x: F.struct(x["start"].alias("start"), F.lit(i).alias("kind"), F.concat_ws(":", F.lit(kind), x["start"], x["end"]).alias("s")))

    every = F.concat(*[tagged(i, k) for i, k in enumerate(kinds)])
    return F.array_join(F.transform(F.array_sort(every), lambda x: x["s"]), ",")
