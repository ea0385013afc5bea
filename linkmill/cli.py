"""Command line: build-index, match, evaluate, inspect-index, flatten."""

from __future__ import annotations

import argparse
import json
import logging
import sys
from dataclasses import replace
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from linkmill.config import MatchConfig
from linkmill.functions.vocabulary import CONTACT_ALIASES, REFERENCE_ALIASES
from linkmill.operators import contacts, evaluate, flatten, matcher, registry
from linkmill.sources import sinks, tabular
from linkmill.sources.workspace import stored

VERSION = "1.0"
LOG = logging.getLogger("linkmill")
ROW = "linkmill_row"


def build_index(spark: SparkSession, a: argparse.Namespace) -> None:
    meta = {"include_establishments": a.include_establishments, "include_historical_addresses": a.include_historical_addresses}
    if a.reference:
        df = tabular.read_reference(spark, a.reference, a.encoding, a.delimiter)
        columns = tabular.resolve_columns(df.columns, REFERENCE_ALIASES, tabular.parse_column_map(a.column_map), ("enterprise_number", "company_name"))
        found = registry.from_flat(df, columns)
    else:
        raw = tabular.read_raw(spark, a.data_dir, a.include_establishments)
        found = registry.from_raw(raw["enterprise"], raw["denomination"], raw["address"], raw.get("establishment"), include_establishments=a.include_establishments, include_historical=a.include_historical_addresses)
    sinks.write_registry(found, a.index, a.overwrite, **meta)


def _contacts(spark: SparkSession, a: argparse.Namespace, required: tuple[str, ...]):
    original = stored(tabular.numbered(tabular.read_tabular(spark, a.input, a.sheet, a.encoding, a.delimiter), ROW), "input")
    columns = tabular.resolve_columns([c for c in original.columns if c != ROW], CONTACT_ALIASES, tabular.parse_column_map(a.column_map), required)
    return original, stored(contacts.normalise(original, columns, ROW), "contacts")


def match(spark: SparkSession, a: argparse.Namespace) -> None:
    config = MatchConfig.from_json(a.config)
    config = replace(config, top_k=a.top_k) if a.top_k else config
    original, rows = _contacts(spark, a, ())
    result, candidates = matcher.match(rows, sinks.read_registry(spark, a.index), config, only_missing=not a.match_all)
    merged = matcher.with_original(original, stored(result, "result"), ROW)
    status = "_match_match_status" if "match_status" in {c.lower() for c in original.columns} else "match_status"
    sinks.write_results(merged, candidates, a.output, a.output_format, status)


def run_evaluate(spark: SparkSession, a: argparse.Namespace) -> None:
    config = MatchConfig.from_json(a.config)
    config = replace(config, top_k=max(config.top_k, a.top_k or 0))
    original, rows = _contacts(spark, a, ("enterprise_number",))
    index = sinks.read_registry(spark, a.index)
    report, details, advice = evaluate.evaluate(rows, index, config, a.target_precision, a.target_probable_precision, a.min_predictions)
    excluded = original.join(evaluate.excluded_truth(rows).select((F.col("source_row_number") - 2).alias(ROW), "evaluation_exclusion_reason"), ROW).drop(ROW)
    sinks.write_evaluation(report, details.drop("source_row_number"), excluded, a.output, advice.to_json() if advice else None)
    result, candidates = matcher.match(evaluate.usable_truth(rows), index, config, only_missing=False)
    merged = matcher.with_original(original.join(result.select((F.col("source_row_number") - 2).alias(ROW)), ROW, "left_semi"), result, ROW)
    target = Path(a.output)
    sinks.write_results(merged, candidates, str(target.with_name(f"{target.stem}_matching.xlsx")), "xlsx")
    print(json.dumps(report, ensure_ascii=False, indent=2))


def inspect_index(spark: SparkSession, a: argparse.Namespace) -> None:
    print(json.dumps(sinks.inspect(spark, a.index), ensure_ascii=False, indent=2))


def run_flatten(spark: SparkSession, a: argparse.Namespace) -> None:
    raw = tabular.read_raw(spark, a.data_dir)
    sinks.write_flat(flatten.flatten(raw["enterprise"], raw["denomination"], raw["address"]), a.output)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="linkmill")
    p.add_argument("--version", action="version", version=VERSION)
    p.add_argument("--verbose", action="store_true")
    sub = p.add_subparsers(dest="command", required=True)
    b = sub.add_parser("build-index")
    source = b.add_mutually_exclusive_group(required=True)
    source.add_argument("--data-dir")
    source.add_argument("--reference")
    b.add_argument("--index", required=True)
    for flag in ("--overwrite", "--include-establishments", "--include-historical-addresses"):
        b.add_argument(flag, action="store_true")
    for flag in ("--column-map", "--encoding", "--delimiter"):
        b.add_argument(flag)
    # Reading in chunks and caching are Spark's; accepted so that existing calls work.
    for flag in ("--chunk-size", "--cache-mb"):
        b.add_argument(flag, type=int)
    b.set_defaults(run=build_index)
    for name, run in (("match", match), ("evaluate", run_evaluate)):
        m = sub.add_parser(name)
        for flag in ("--input", "--index", "--output"):
            m.add_argument(flag, required=True)
        for flag in ("--column-map", "--sheet", "--encoding", "--delimiter", "--config"):
            m.add_argument(flag)
        m.add_argument("--top-k", type=int)
        # Progress is Spark's to show; accepted so that existing calls work.
        m.add_argument("--progress-every", type=int, default=0)
        if name == "match":
            m.add_argument("--output-format", choices=("xlsx", "csv", "both"), default="both")
            m.add_argument("--match-all", action="store_true")
        else:
            m.add_argument("--target-precision", type=float, default=0.995)
            m.add_argument("--target-probable-precision", type=float, default=0.95)
            m.add_argument("--min-predictions", type=int, default=30)
        m.set_defaults(run=run)
    i = sub.add_parser("inspect-index")
    i.add_argument("--index", required=True)
    i.set_defaults(run=inspect_index)
    f = sub.add_parser("flatten")
    f.add_argument("--data-dir", required=True)
    f.add_argument("--output", required=True)
    f.set_defaults(run=run_flatten)
    return p


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """Exit code 0, 1 on an error, 130 on an interrupt."""
    a = parser().parse_args(args)
    logging.basicConfig(level=logging.DEBUG if a.verbose else logging.INFO)
    try:
        a.run(spark or SparkSession.builder.appName("linkmill").getOrCreate(), a)
    except KeyboardInterrupt:
        return 130
    except Exception as e:
        LOG.error("%s", e, exc_info=a.verbose)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
