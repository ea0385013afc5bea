"""The registered queries of the ten operators and of the pipeline, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import decontaminate, html_extract, langid, licenses, media, mix, ngram_join, secrets, shard, store, token_store


def op1_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard.shard_plan(store.read(spark, sf_dir, "documents"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.summary(licenses.scan(store.read(spark, sf_dir, "documents"))).drop("places")


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.mix_plan(store.read(spark, sf_dir, "documents")).drop("key")


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(store.read(spark, sf_dir, "pages"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(store.read(spark, sf_dir, "documents"), store.read(spark, sf_dir, "benchmark"))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(store.read(spark, sf_dir, "documents"))


def op7_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, _ = store.write_table(media.encode_column(store.read(spark, sf_dir, "documents")), "media")
    return media.read_features(stored)


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    membership, _ = ngram_join.ngram_join(store.read(spark, sf_dir, "documents"))
    return membership.select("doc_id", "class_id", "n_links")


def op9_secrets(spark: SparkSession, sf_dir: str, ledger: str | None = None) -> DataFrame:
    """``ledger``: the path of a ledger that earlier runs filled; a new one without it."""
    docs = store.read(spark, sf_dir, "documents")
    ledger = secrets.scan(docs, ledger or store.new_path(spark, "ledger"))
    found = secrets.findings_by_path(docs, ledger)
    base = [r.kind for r in secrets.BASE_RULES]
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in base]
    return found.select("doc_id", *counts, F.sha2(secrets.span_list(base), 256).alias("base_sha256"), secrets.span_list([r.kind for r in secrets.RULES]).alias("spans"))


def op10_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.token_output(store.read(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = [op1_shard, op2_licenses, op3_mix, op4_html, op5_decontaminate, op6_langid, op7_media, op8_ngram_join, op9_secrets, op10_tokens]
    return {f.__name__: f for f in ops} | {"pipeline": corpus_pipeline.run}


MIX_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, length(regexp_replace(regexp_replace(coalesce(text, ''), '[^\x20\x09-\x0D]+', 'w', 'g'), '[\x20\x09-\x0D]+', '', 'g')) AS size,
         md5(concat_ws(chr(31), 'mix', coalesce(CAST(doc_id AS VARCHAR), chr(1)), coalesce(source, chr(1)), coalesce(text, chr(1)))) AS key
  FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source),
weighed AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM sizes),
ordered AS (
  SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) AS total,
         CAST(coalesce(sum(source_size * 3) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS capped,
         CAST(sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS open_weight
  FROM weighed WINDOW w AS (ORDER BY CAST(source_size AS DOUBLE) / weight, source NULLS LAST)),
levels AS (SELECT *, (total - capped) / open_weight AS lv FROM ordered),
level AS (SELECT max(lv) AS lv FROM levels WHERE lv * weight <= source_size * 3),
targets AS (
  SELECT source, source_size, coalesce(least(CAST(source_size * 3 AS DOUBLE), (SELECT lv FROM level) * weight), CAST(source_size * 3 AS DOUBLE)) AS target FROM levels),
placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS budget,
         CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - d.size AS before
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CASE WHEN source_size = 0 THEN 0 ELSE budget // source_size * size + greatest(0, least(size, budget % source_size - before)) END AS taken
FROM placed
"""

_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+"""
_ASSIGN_GROUP = r"""(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""


def _spans_sql() -> str:
    rules = [(r.kind, _ASSIGN if r.kind == "assign" else r.pattern, _ASSIGN_GROUP if r.kind == "assign" else f"({r.pattern})", r.least) for r in secrets.RULES]
    found = []
    for i, (kind, pattern, group, least) in enumerate(rules):
        found.append(f"""
  SELECT text, {i} AS k, '{kind}' AS kind, n,
         length(m) AS ml, length(g) >= {least} AS ok,
         CAST(sum(length(p) + length(m)) OVER (PARTITION BY text ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS stop
  FROM (SELECT text, n, ps[n] AS p, ms[n] AS m, gs[n] AS g FROM (
          SELECT text, ps, ms, gs, unnest(range(1, len(ms) + 1)) AS n FROM (
            SELECT text, string_split_regex(text, '{pattern}') AS ps, regexp_extract_all(text, '{pattern}') AS ms, regexp_extract_all(text, '{group}', 1) AS gs
            FROM blobs WHERE regexp_matches(text, '{pattern}'))))""")
    return " UNION ALL ".join(found)


SECRETS_SQL = f"""
WITH blobs AS (SELECT DISTINCT coalesce(text, '') AS text FROM documents),
spans AS (SELECT text, k, kind, stop - ml AS start, stop FROM ({_spans_sql()}) WHERE ok),
lists AS (
  SELECT text, count(*) FILTER (WHERE k = 0) AS n_assign, count(*) FILTER (WHERE k = 1) AS n_access, count(*) FILTER (WHERE k = 2) AS n_hex,
         coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k) FILTER (WHERE k < 3), '') AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k) AS spans
  FROM spans GROUP BY text)
SELECT d.doc_id, coalesce(l.n_assign, 0) AS n_assign, coalesce(l.n_access, 0) AS n_access, coalesce(l.n_hex, 0) AS n_hex,
       sha256(coalesce(l.base, '')) AS base_sha256, coalesce(l.spans, '') AS spans
FROM documents d LEFT JOIN lists l ON coalesce(d.text, '') = l.text
"""


def oracle_sql() -> dict[str, str]:
    """SQL only where it expresses the whole result; the others are tested against brute force."""
    return {"op3_mix": MIX_SQL, "op9_secrets": SECRETS_SQL}
