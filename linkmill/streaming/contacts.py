"""Contacts as a stream, matched with a stored registry batch by batch.

A contact's match depends on the registry alone, so each micro-batch is matched as a
table is; results and candidates are appended, by batch, so a batch that is replayed
after a failure replaces its own files.  Row numbers count within a batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from linkmill.config import MatchConfig
from linkmill.operators import contacts, matcher
from linkmill.operators.registry import Registry
from linkmill.sources.tabular import numbered


def match_stream(stream: DataFrame, columns: dict[str, str | None], registry: Registry, output: str, checkpoint: str, config: MatchConfig | None = None, order: str | None = None, only_missing: bool = True, **trigger) -> StreamingQuery:
    def one(batch: DataFrame, number: int) -> None:
        rows = contacts.normalise(batch if order else numbered(batch, "linkmill_row"), columns, order or "linkmill_row")
        result, candidates = matcher.match(rows, registry, config, only_missing)
        result.write.mode("overwrite").parquet(f"{output}/results/batch={number}")
        candidates.write.mode("overwrite").parquet(f"{output}/candidates/batch={number}")

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
