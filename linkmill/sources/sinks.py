"""Registry tables, results and reports on disk."""

from __future__ import annotations

import json
import zipfile
from collections.abc import Mapping
from datetime import UTC, datetime
from pathlib import Path
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmill.operators.registry import Registry

SCHEMA_VERSION = 2
SHEET_ROWS = 1_000_000
TABLES = ("enterprise", "name", "address")


def write_registry(registry: Registry, path: str, overwrite: bool = False, **meta: object) -> None:
    """The three tables and a key-value table as Parquet; an existing registry is an error unless ``overwrite``."""
    mode = "overwrite" if overwrite else "errorifexists"
    for name in TABLES:
        getattr(registry, name).write.mode(mode).parquet(f"{path}/{name}")
    spark = registry.enterprise.sparkSession
    counts = {f"{name}_rows": str(spark.read.parquet(f"{path}/{name}").count()) for name in TABLES}
    values = {"schema_version": str(SCHEMA_VERSION), "built_at": datetime.now(UTC).isoformat(), **counts} | {k: v if isinstance(v, str) else json.dumps(v) for k, v in meta.items()}
    spark.createDataFrame(sorted(values.items()), "key string, value string").coalesce(1).write.mode(mode).parquet(f"{path}/meta")


def read_meta(spark: SparkSession, path: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.read.parquet(f"{path}/meta").collect()}


def upsert_meta(spark: SparkSession, path: str, **values: object) -> None:
    merged = read_meta(spark, path) | {k: v if isinstance(v, str) else json.dumps(v) for k, v in values.items()}
    spark.createDataFrame(sorted(merged.items()), "key string, value string").coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")


def read_registry(spark: SparkSession, path: str) -> Registry:
    version = read_meta(spark, path).get("schema_version")
    if version != str(SCHEMA_VERSION):
        raise ValueError(f"registry schema {version}, expected {SCHEMA_VERSION}")
    return Registry(*[spark.read.parquet(f"{path}/{name}") for name in TABLES])


def inspect(spark: SparkSession, path: str) -> dict:
    """Path, size on disk, version, meta and row counts."""
    meta = read_meta(spark, path)
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength()
    return {"path": path, "size_bytes": size, "schema_version": meta.get("schema_version"), "meta": meta, "rows": {name: spark.read.parquet(f"{path}/{name}").count() for name in TABLES}}


def _reference(row: int, col: int) -> str:
    letters = ""
    col += 1
    while col:
        col, r = divmod(col - 1, 26)
        letters = chr(65 + r) + letters
    return f"{letters}{row}"


def _sheet_xml(columns: list[str], rows: list[tuple]) -> str:
    widths = [min(55, max([len(str(c)), *(len(str(r[i])) for r in rows[:300])]) + 2) for i, c in enumerate(columns)]
    cols = "".join(f'<col min="{i + 1}" max="{i + 1}" width="{w}" customWidth="1"/>' for i, w in enumerate(widths))

    def cell(value: object, row: int, col: int) -> str:
        at = _reference(row, col)
        if isinstance(value, bool):
            return f'<c r="{at}" t="b"><v>{int(value)}</v></c>'
        if isinstance(value, (int, float)):
            return f'<c r="{at}"><v>{value}</v></c>'
        # Text stays text: formulas and links in it are inert.
        return "" if value is None or value == "" else f'<c r="{at}" t="inlineStr"><is><t xml:space="preserve">{escape(str(value))}</t></is></c>'

    body = "".join(f'<row r="{n}">' + "".join(cell(v, n, i) for i, v in enumerate(r)) + "</row>" for n, r in enumerate([tuple(columns), *rows], 1))
    last = _reference(len(rows) + 1, max(0, len(columns) - 1))
    return (
        '<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
        '<sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" activePane="bottomLeft" state="frozen"/></sheetView></sheetViews>'
        f'{f"<cols>{cols}</cols>" if cols else ""}<sheetData>{body}</sheetData><autoFilter ref="A1:{last}"/></worksheet>'
    )


def write_workbook(path: str, sheets: Mapping[str, DataFrame], sheet_rows: int = SHEET_ROWS, numbered: bool = False) -> None:
    """An .xlsx file on the driver's disk, for results small enough to be read by people.

    Rows come in one partition after the other; a sheet ends at ``sheet_rows`` and goes on in ``_2``, ``_3``;
    with ``numbered`` the first one is ``_1``.
    """
    parts: list[tuple[str, str]] = []
    for name, df in sheets.items():
        chunk, n = [], 0

        def close(columns: list[str], rows: list[tuple], n: int, name: str = name) -> None:
            tail = f"_{n + 1}" if n or numbered else ""
            parts.append((name[: 31 - len(tail)] + tail, _sheet_xml(columns, rows)))

        for row in df.toLocalIterator():
            chunk.append(tuple(row))
            if len(chunk) == sheet_rows:
                close(df.columns, chunk, n)
                chunk, n = [], n + 1
        if chunk or not n:
            close(df.columns, chunk, n)
    main, rel, ns = "application/vnd.openxmlformats-officedocument.spreadsheetml", "http://schemas.openxmlformats.org/officeDocument/2006/relationships", "http://schemas.openxmlformats.org"
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{main}.worksheet+xml"/>' for i in range(1, len(parts) + 1))
        z.writestr("[Content_Types].xml", f'<?xml version="1.0"?><Types xmlns="{ns}/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{main}.sheet.main+xml"/>{kinds}</Types>')
        z.writestr("_rels/.rels", f'<?xml version="1.0"?><Relationships xmlns="{ns}/package/2006/relationships"><Relationship Id="rId1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'<?xml version="1.0"?><workbook xmlns="{ns}/spreadsheetml/2006/main" xmlns:r="{rel}"><sheets>' + "".join(f'<sheet name="{escape(n)}" sheetId="{i}" r:id="rId{i}"/>' for i, (n, _) in enumerate(parts, 1)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", f'<?xml version="1.0"?><Relationships xmlns="{ns}/package/2006/relationships">' + "".join(f'<Relationship Id="rId{i}" Type="{rel}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(parts) + 1)) + "</Relationships>")
        for i, (_, xml) in enumerate(parts, 1):
            z.writestr(f"xl/worksheets/sheet{i}.xml", xml)


def write_csv_file(df: DataFrame, path: Path) -> None:
    """One CSV file with a byte-order mark on the driver's disk, written as rows arrive."""
    import csv

    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("w", encoding="utf-8-sig", newline="") as f:
        out = csv.writer(f)
        out.writerow(df.columns)
        for row in df.toLocalIterator():
            out.writerow(["" if v is None else v for v in row])


# Sheet names and file labels of the seven outputs.
SHEETS = {"all": "all_results", "certain": "match_certain", "to_review": "to_review", "no_match": "no_reliable_match", "skipped": "skipped", "errors": "errors", "candidates": "top_candidates"}


def write_results(result: DataFrame, candidates: DataFrame, output: str, kind: str = "both", status: str = "match_status") -> dict[str, Path]:
    """The seven outputs as a workbook, as CSV files in ``<stem>_csv``, or both."""
    from linkmill.operators.matcher import fan_out

    kept = result.persist()
    frames = fan_out(kept, status) | {"candidates": candidates.persist()}
    target, out = Path(output), {}
    if kind in ("xlsx", "both"):
        out["xlsx"] = target.with_suffix(".xlsx")
        write_workbook(str(out["xlsx"]), {SHEETS[k]: df for k, df in frames.items()})
    if kind in ("csv", "both"):
        for k, df in frames.items():
            out[k] = target.parent / f"{target.stem}_csv" / f"{target.stem}_{k}.csv"
            write_csv_file(df, out[k])
    for df in (kept, frames["candidates"]):
        df.unpersist()
    return out


def write_results_table(result: DataFrame, candidates: DataFrame, path: str, status: str = "match_status") -> None:
    """The outputs at scale: results partitioned by status, and the candidates, as Parquet."""
    result.withColumn("status", F.col(status)).write.mode("overwrite").partitionBy("status").parquet(f"{path}/results")
    candidates.write.mode("overwrite").parquet(f"{path}/candidates")


def write_evaluation(report: dict, rows: DataFrame, excluded: DataFrame, output: str, advice: str | None = None) -> None:
    """Report as JSON, details and excluded rows as CSV, and the recommended configuration if there is one."""
    target = Path(output)
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text(json.dumps(report, ensure_ascii=False, indent=2), encoding="utf-8")
    write_csv_file(rows, target.with_name(f"{target.stem}_details.csv"))
    write_csv_file(excluded, target.with_name(f"{target.stem}_excluded_invalid_truth.csv"))
    if advice:
        target.with_name(f"{target.stem}_recommended_config.json").write_text(advice, encoding="utf-8")


def write_flat(df: DataFrame, path: str) -> None:
    """The flattened registry: a table, or a workbook of sheets of a million rows if the path ends in .xlsx."""
    if path.endswith(".xlsx"):
        write_workbook(path, {"entreprises": df}, numbered=True)
    else:
        df.write.mode("overwrite").parquet(path)
