"""The matcher on small registries with known decisions, and its safety rules."""

import json

import pytest
from pyspark.sql import functions as F

from linkmill import cli
from linkmill.config import MatchConfig
from linkmill.functions import similarity
from linkmill.functions.vocabulary import CONTACT_ALIASES, REFERENCE_ALIASES
from linkmill.operators import contacts, evaluate, flatten, matcher, registry
from linkmill.sources import sinks, tabular
from linkmill.sources.workspace import stored
from linkmill.streaming.contacts import match_stream

REFERENCE = """numero_entreprise,nom_entreprise,street_name,house_number,box_number,postcode,city_name,status
0123.456.789,Les Jardins de Bruxelles SRL,Rue de la Loi,42,3,1000,Bruxelles,AC
0123.456.789,Jardins Bruxelles,Rue de la Loi,42,3,1000,Bruxelles,AC
0123.456.780,Les Jardins de Bruxelles Nord SRL,Rue de la Loi,44,,1000,Bruxelles,AC
0234.567.890,Garage Dupont SA,Rue des Cerisiers,14,,5030,Gembloux,AC
0567.890.123,Alpha Consulting SRL,Avenue Louise,100,,1050,Ixelles,AC
0678.901.234,Alpha Consulting BV,Avenue Louise,102,,1050,Ixelles,AC
"""
CONTACTS = """reference,company_name,street3,street_number,street_box,zip,city,enterprise_number
A1,Les jardin Bruxelles,rue de la loi,42,bte 3,1000,BRUXELLES,
A2,Garage Jean Dupont,rue des cerisiers,14,,5030,Gembloux,
A3,Alpha Consulting,Avenue Louise,,,1050,Ixelles,
A4,Entreprise inconnue,Rue Imaginaire,99,,9999,Nullepart,
A5,Garage Dupont,Rue des Cerisiers,14,,5030,Gembloux,0200.065.765
A6,Garage Dupont,Rue des Cerisiers,14,,5030,Gembloux,0123.456.789
"""


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    d = tmp_path_factory.mktemp("files")
    (d / "reference.csv").write_text(REFERENCE)
    (d / "contacts.csv").write_text(CONTACTS)
    return d


@pytest.fixture(scope="module")
def built(spark, files):
    df = tabular.read_reference(spark, str(files / "reference.csv"))
    r = registry.from_flat(df, tabular.resolve_columns(df.columns, REFERENCE_ALIASES))
    return registry.Registry(stored(r.enterprise, "e"), stored(r.name, "n"), stored(r.address, "a"))  # as an index is


@pytest.fixture(scope="module")
def rows(spark, files):
    df = tabular.read_tabular(spark, str(files / "contacts.csv"))
    return stored(contacts.normalise(df, tabular.resolve_columns(df.columns, CONTACT_ALIASES)), "c")


@pytest.fixture(scope="module")
def matched(built, rows):
    result, candidates = matcher.match(rows, built)
    return {r["source_id"]: r for r in result.collect()}, candidates.collect()


def test_registry_keys(built):
    assert (built.enterprise.count(), built.name.count(), built.address.count()) == (5, 6, 5)


def test_decisions(matched):
    result, candidates = matched
    assert {k: (r["match_status"], r["automatic_enterprise_number"]) for k, r in result.items()} == {
        "A1": ("MATCH_CERTAIN", "0123.456.789"), "A2": ("MATCH_CERTAIN", "0234.567.890"), "A3": ("NO_RELIABLE_MATCH", ""),
        "A4": ("NO_RELIABLE_MATCH", ""), "A5": ("SKIPPED_EXISTING_NUMBER", ""), "A6": ("MATCH_CERTAIN", "0234.567.890"),
    }
    assert result["A3"]["score_gap"] == 0.0 and result["A3"]["candidate_enterprise_number"] == "0567.890.123" and result["A3"]["house_match"] == "input_missing"
    assert not result["A6"]["existing_enterprise_number_valid"]
    a6 = result["A6"]
    assert (a6["match_score"], a6["second_best_score"], a6["score_gap"], a6["evidence_coverage"], a6["candidate_count"]) == (100.0, 0.0, 100.0, 0.98, 1)
    assert a6["candidate_generation_rules"] == "city_street | exact_name | exact_name_compact | name_prefix | postcode_house | postcode_street | street_house"
    assert max(c["candidate_rank"] for c in candidates) <= MatchConfig().top_k


def test_safety(matched):
    for r in matched[0].values():
        assert bool(r["automatic_enterprise_number"]) <= (r["match_status"] == "MATCH_CERTAIN")
        assert bool(r["suggested_enterprise_number"]) <= (r["match_status"] in ("MATCH_CERTAIN", "MATCH_PROBABLE"))
        assert not r["hard_contradictions"] or (r["match_status"] != "MATCH_CERTAIN" and r["match_score"] <= 84)


def test_raw_registry_with_establishments(spark, tmp_path):
    (tmp_path / "enterprise.csv").write_text("EnterpriseNumber,Status\n0403.449.823,AC\n")
    (tmp_path / "denomination.csv").write_text("EntityNumber,Language,TypeOfDenomination,Denomination\n0403.449.823,2,001,Example Belgium SRL\n0403.449.823,2,002,Example\n")
    with pytest.raises(FileNotFoundError, match="address.csv.*establishment.csv"):
        tabular.read_raw(spark, str(tmp_path), True)
    (tmp_path / "establishment.csv").write_text("EstablishmentNumber,StartDate,EnterpriseNumber\n2.000.000.339,x,0403.449.823\n")
    head = "EntityNumber,TypeOfAddress,CountryNL,CountryFR,Zipcode,MunicipalityNL,MunicipalityFR,StreetNL,StreetFR,HouseNumber,Box,ExtraAddressInfo,DateStrikingOff"
    (tmp_path / "address.csv").write_text(f"{head}\n0403.449.823,REGO,,,1000,Brussel,Bruxelles,Wetstraat,Rue de la Loi,10,,,\n2.000.000.339,BAET,,,5030,Gembloers,Gembloux,Kersenstraat,Rue des Cerisiers,14,,,\n")
    raw = tabular.read_raw(spark, str(tmp_path), True)
    found = registry.from_raw(raw["enterprise"], raw["denomination"], raw["address"], raw["establishment"], include_establishments=True)
    assert found.address.count() == 4
    one = spark.createDataFrame([("B1", "Example Belgium", "Rue des Cerisiers", "14", "5030", "Gembloux")], "id string, name string, street string, no string, zip string, city string")
    result, _ = matcher.match(contacts.normalise(one, tabular.resolve_columns(one.columns, CONTACT_ALIASES)), found)
    r = result.first()
    assert (r["match_status"], r["automatic_enterprise_number"], r["candidate_street_name"]) == ("MATCH_CERTAIN", "0403.449.823", "Rue des Cerisiers")
    flat = flatten.flatten(raw["enterprise"], raw["denomination"], raw["address"]).collect()
    assert [tuple(f) for f in flat] == [("0403.449.823", "Example Belgium SRL", "Rue de la Loi", "10", None, "1000", "Bruxelles")]


def test_workbook_round_trip(spark, tmp_path):
    a = spark.createDataFrame([("0111.111.111", "Première Société SRL", "=1+1 <&>")], "numero_entreprise string, nom_entreprise string, street string")
    b = spark.createDataFrame([("0222.222.222", "Deuxième Société SA", "")], a.schema)
    path = str(tmp_path / "w.xlsx")
    sinks.write_workbook(path, {"entreprises": a.union(b).coalesce(1)}, sheet_rows=1, numbered=True)
    assert list(tabular.workbook_sheets(path)) == ["entreprises_1", "entreprises_2"]
    df = tabular.read_reference(spark, path)
    assert sorted(r["street"] for r in df.collect()) == ["", "=1+1 <&>"]
    assert registry.from_flat(df, tabular.resolve_columns(df.columns, REFERENCE_ALIASES)).enterprise.count() == 2
    assert tabular.read_tabular(spark, path, "1").first()["nom_entreprise"] == "Deuxième Société SA"


def test_csv_quoting(spark, tmp_path):
    (tmp_path / "q.csv").write_bytes("﻿name;city\n\"a \"\"b\"\"\";\"x\ny\"\nc;\n".encode())
    assert [tuple(r) for r in tabular.read_tabular(spark, str(tmp_path / "q.csv")).collect()] == [('a "b"', "x\ny"), ("c", "")]


def test_evaluation(spark, built, rows):
    truth = rows.withColumn("existing_enterprise_number", F.expr("case source_id when 'A1' then '0123.456.789' when 'A2' then '0234.567.890' else '0999.999.999' end")).withColumn("existing_enterprise_number_valid", F.expr("source_id != 'A5'"))
    report, details, advice = evaluate.evaluate(truth, built, MatchConfig(), 0.6, 0.5, 1)
    assert report["evaluated_rows"] == 5 and report["excluded_invalid_truth_rows"] == 1
    assert report["certain_count"] == 3 and report["certain_precision"] == pytest.approx(2 / 3) and report["false_certain_count"] == 1
    best = report["recommended_certain_threshold"]
    assert best["score"] >= 92 and best["gap"] >= 8 and best["predictions"] == 3
    assert details.count() == 5 and (advice is None or advice.certain_score >= 92)


def test_grid_matches_plain_counting(spark):
    import random

    r = random.Random(1)
    data = [(r.random() < 0.8, round(r.uniform(60, 100), 2), round(r.uniform(0, 40), 2), r.random() < 0.9) for _ in range(300)]
    df = spark.createDataFrame(data, "prediction_correct boolean, match_score double, score_gap double, ok boolean")
    got = {(g["score"], g["gap"]): (g["predictions"], g["correct_predictions"]) for g in evaluate.threshold_grid(df, "ok", 70.25, 3.0).collect()}
    for s2 in range(141, 201):
        for g2 in range(6, 201):
            kept = [c for c, s, g, ok in data if ok and s >= s2 / 2 and g >= g2 / 2]
            assert got.get((s2 / 2, g2 / 2), (0, 0)) == (len(kept), sum(kept))


def test_command_line(spark, files, tmp_path):
    index = str(tmp_path / "index")
    assert cli.main(["build-index", "--reference", str(files / "reference.csv"), "--index", index], spark) == 0
    assert cli.main(["build-index", "--reference", str(files / "reference.csv"), "--index", index], spark) == 1
    assert cli.main(["inspect-index", "--index", index], spark) == 0
    out = tmp_path / "out" / "result.xlsx"
    assert cli.main(["match", "--input", str(files / "contacts.csv"), "--index", index, "--output", str(out)], spark) == 0
    sheets = tabular.workbook_sheets(str(out))
    assert [len(sheets[k]) - 1 for k in ("all_results", "match_certain", "to_review", "no_reliable_match", "skipped", "errors")] == [6, 3, 0, 2, 1, 0]
    assert (out.parent / "result_csv" / "result_candidates.csv").read_bytes().startswith(b"\xef\xbb\xbf")
    report = tmp_path / "report.json"
    assert cli.main(["evaluate", "--input", str(files / "contacts.csv"), "--index", index, "--output", str(report), "--min-predictions", "1"], spark) == 0
    assert json.loads(report.read_text())["evaluated_rows"] == 1


def test_stream(spark, built, files, tmp_path):
    stream = spark.readStream.schema("reference string, company_name string, street3 string, street_number string, street_box string, zip string, city string, enterprise_number string").option("header", True).csv(str(files / "contacts*.csv"))
    columns = tabular.resolve_columns(stream.columns, CONTACT_ALIASES)
    match_stream(stream.fillna(""), columns, built, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out" / "results")).where("match_status = 'MATCH_CERTAIN'").count() == 3


def test_a_row_that_raises_becomes_an_error_and_the_others_are_matched(spark, built, rows):
    def score(a, b):
        if "inconnue" in a or (a == "garage jean dupont" and b.startswith("garage")):
            raise ValueError(f"cannot read {a!r}")
        return similarity.scores(a, b)

    result, candidates = matcher.match(rows, built, similarity=similarity.scorer(score))
    got = {r["source_id"]: r for r in result.collect()}
    failed = got["A2"]
    assert (failed["match_status"], failed["match_error"]) == ("MATCH_ERROR", "cannot read 'garage jean dupont'")
    assert (failed["match_score"], failed["candidate_count"], failed["suggested_enterprise_number"], failed["candidate_enterprise_number"]) == (0.0, 0, "", "")
    plain = {r["source_id"]: r for r in matcher.match(rows, built)[0].collect()}
    assert all(got[k] == plain[k] for k in ("A1", "A3", "A5", "A6")) and plain["A2"]["match_error"] == ""
    assert failed["source_row_number"] not in {c["source_row_number"] for c in candidates.collect()}
    assert matcher.fan_out(result)["errors"].count() == 1


def test_row_numbers_are_positions(spark, tmp_path):
    """In a workbook, in a file of many splits and in one with line breaks inside quotes, whatever the partitions."""
    n = 3000
    (tmp_path / "long.csv").write_text("name,k\n" + "".join(f"n{k},{k}\n" for k in range(n)))
    (tmp_path / "quoted.csv").write_text("name,k\n" + "".join(f'"a\nb",{k}\n' for k in range(50)))
    sinks.write_workbook(str(tmp_path / "w.xlsx"), {"s": spark.createDataFrame([(f"n{k}", str(k)) for k in range(8)], "name string, k string").coalesce(1)})
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
        for file, rows, parts in (("long.csv", n, 2), ("quoted.csv", 50, 1), ("w.xlsx", 8, 2)):
            df = tabular.read_tabular(spark, str(tmp_path / file))
            assert df.rdd.getNumPartitions() >= parts
            got = tabular.numbered(df, "at").collect()
            assert len(got) == rows and all(int(r["k"]) == r["at"] for r in got)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_workbook_rows_are_numbered_as_in_the_sheet(spark, files, tmp_path):
    index = str(tmp_path / "index")
    assert cli.main(["build-index", "--reference", str(files / "reference.csv"), "--index", index, "--chunk-size", "10", "--cache-mb", "5"], spark) == 0
    df = tabular.read_tabular(spark, str(files / "contacts.csv"))
    sinks.write_workbook(str(tmp_path / "c.xlsx"), {"s": df})
    out = tmp_path / "out.xlsx"
    assert cli.main(["match", "--input", str(tmp_path / "c.xlsx"), "--index", index, "--output", str(out), "--progress-every", "2"], spark) == 0
    head, *body = tabular.workbook_sheets(str(out))["all_results"]
    at, who = head.index("source_row_number"), head.index("reference")
    assert {r[who]: r[at] for r in body} == {f"A{k}": str(k + 1) for k in range(1, 7)}
    assert sinks.inspect(spark, index)["size_bytes"] > 1000


def test_columns_resolve(tmp_path):
    aliases = {"id": ["id", "reference"], "name": ["company name", "nom"], "city": ["city"]}
    columns = ["Référence", "Nom", "NOM", "Ville"]
    assert tabular.resolve_columns(columns, aliases) == {"id": "Référence", "name": "Nom", "city": None}
    assert tabular.resolve_columns(columns, aliases, {"city": "ville", "name": "NOM", "other": "x"}) == {"id": "Référence", "name": "NOM", "city": "Ville"}
    with pytest.raises(ValueError, match="'Stad' for city"):
        tabular.resolve_columns(columns, aliases, {"city": "Stad"})
    with pytest.raises(ValueError, match="city"):
        tabular.resolve_columns(columns, aliases, required=("city", "name"))
    (tmp_path / "map.json").write_text('{"city": "Ville", "name": null}')
    assert tabular.parse_column_map(str(tmp_path / "map.json")) == tabular.parse_column_map('{"city": "Ville"}') == {"city": "Ville"}
    assert tabular.parse_column_map(None) == {}
    with pytest.raises(ValueError):
        tabular.parse_column_map("[1]")
