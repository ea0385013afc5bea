"""Codes of pairs are told from columns of the rows, not from texts taken apart again for each pair."""

import os

import pytest

from linkmill.plans import catalog

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
def test_no_text_is_taken_apart_for_a_pair(spark):
    """score_equality took the number out of both house numbers in every one of its pairs."""
    plan = catalog.queries()["score_equality"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "regexp" not in plan.lower() and "Join" in plan


def test_equal_rows_are_compared_once_and_every_pair_is_listed(spark):
    """score_equality compared house and box in every pair of a contact and an address, of copies as well."""
    import itertools

    from linkmill.operators import scoring

    # (street, city, house, base, box): copies, missing values, and a street that only one side has; numbers on both sides of a list's end.
    kinds = [("a", "x", "5", "5", ""), ("a", "x", "5a", "5", "1"), ("a", "x", "", "", "1"), ("a", "y", "5", "5", ""), ("", "", "7", "7", ""), ("b", "x", "5", "5", "")]
    left = [(n * 400_000, *kinds[n % 6]) for n in range(40)]
    right = [(n * 300_000 + 1, *kinds[n % 5]) for n in range(35)]
    contacts = spark.createDataFrame(left, "source_row_number long, street_core string, city_norm string, house_norm string, house_base string, box_norm string")
    addresses = spark.createDataFrame(right, "id long, street_core string, city_norm string, house_number_norm string, house_number_base string, box_norm string")

    def code(a, b, same_base=False):
        return "both_missing" if a == b == "" else "input_missing" if a == "" else "reference_missing" if b == "" else "exact" if a == b else "same_numeric_base" if same_base else "mismatch"

    want = [(r, i, code(h, k, g != "" and g == f), code(b, d)) for (r, s, c, h, g, b), (i, t, e, k, f, d) in itertools.product(left, right) if (s, c) == (t, e)]
    got = scoring.equalities(contacts, addresses)
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 200
    # The plan is read from the result down: pairs are listed after the join with kinds of addresses, in which the codes are told.
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode(ids") < plan.index("both_missing") < plan.index("Join Inner") and plan.count("both_missing") == 2


def test_pairs_are_listed_in_an_order_that_packs(spark, tmp_path):
    """score_equality failed by disk: it listed a contact's numbers kind by kind, at 0.48 bytes a pair here."""
    import itertools

    from linkmill.operators import scoring

    n = 2500
    left = [(i, "a", "x", str(i % 50), str(i % 50), str(i % 7)) for i in range(n)]
    right = [(3 * i, "a", "x", f"{i * 7 % 50}{'a' if i % 3 else ''}", str(i * 7 % 50), str(i % 11)) for i in range(n + 5)]
    contacts = spark.createDataFrame(left, "source_row_number long, street_core string, city_norm string, house_norm string, house_base string, box_norm string")
    addresses = spark.createDataFrame(right, "id long, street_core string, city_norm string, house_number_norm string, house_number_base string, box_norm string")
    scoring.equalities(contacts, addresses).write.parquet(str(tmp_path / "pairs"))
    pairs = spark.read.parquet(str(tmp_path / "pairs"))
    assert pairs.count() == n * (n + 5)
    alike = sum(a[3] == b[3] for a, b in itertools.product(left, right))
    assert pairs.where("house_match = 'exact'").count() == alike > 0
    assert sum(f.stat().st_size for f in (tmp_path / "pairs").glob("*.parquet")) < 0.3 * n * n


def test_an_address_is_shuffled_once(spark):
    """score_equality failed by disk: addresses went to sixteen shares of their place's contacts, in shuffle files of 0.26 GB at 60 times sf0.1."""
    from linkmill.operators import scoring

    contacts = spark.createDataFrame([(i, "a", "x", "1", "1", "") for i in range(40)], "source_row_number long, street_core string, city_norm string, house_norm string, house_base string, box_norm string")
    addresses = spark.range(30_000).selectExpr("id * 7919 % 1000003 AS id", "'a' AS street_core", "'x' AS city_norm", "string(id % 50) AS house_number_norm", "string(id % 50) AS house_number_base", "'' AS box_norm")

    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {(f.getName(), f.length()) for f in map(files.apply, range(files.size())) if f.getName().startswith("shuffle_") and f.getName().endswith(".data")}

    before, pairs = shuffled(), scoring.equalities(contacts, addresses)
    assert pairs.count() == 40 * 30_000
    made = sum(size for _, size in shuffled() - before)
    # Numbers of 8 bytes before packing, dealt to places with their texts, listed by kind, and with their tile.
    assert 0 < made < 5 * 8 * 30_000


def test_pairs_of_a_list_and_a_tile_are_never_held_at_once(spark):
    """score_equality held all pairs of a list of equal contacts and a tile in memory, and collected garbage for most of its time."""
    import re

    from linkmill.operators import scoring

    contacts = spark.createDataFrame([(i, "a", "x", "1", "1", "") for i in range(40)], "source_row_number long, street_core string, city_norm string, house_norm string, house_base string, box_norm string")
    addresses = spark.createDataFrame([(i, "a", "x", "1", "1", "") for i in range(40)], "id long, street_core string, city_norm string, house_number_norm string, house_number_base string, box_norm string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else the plan lacks the marks of compiled stages
    try:
        plan = scoring.equalities(contacts, addresses)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert re.search(r"\*\(\d+\) Generate explode\(ids", plan) and re.search(r"Generate explode\((?:array_sort\()?rows#", plan)
    assert not re.search(r"\*\(\d+\) Generate explode\((?:array_sort\()?rows#", plan)
    # Many addresses get more tasks than few shuffle partitions have, so that a file names few of them.
    tasks = lambda count: {int(n) for n in re.findall(r"RepartitionByExpression [^\n]*, (\d+)", scoring.equalities(contacts, addresses, count)._jdf.queryExecution().optimizedPlan().toString())}
    assert max(tasks(0)) == 32 and max(tasks(204_800)) == 200


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
def test_places_of_addresses_need_no_other_text(spark):
    """score_equality shuffled and stored all columns of the registry's addresses."""
    from linkmill.operators import registry
    from linkmill.plans import derived as D

    flat = D.reference(spark, FOLDER)
    flat = flat.unionByName(flat.limit(50).selectExpr("seq + 100000 as seq", *[c for c in flat.columns if c != "seq"]))
    own = registry.address_places(registry.flat_addresses(flat, D.REFERENCE_COLUMNS))
    whole = registry.from_flat(flat, D.REFERENCE_COLUMNS).address.select(*own.columns)
    assert sorted(map(tuple, own.collect())) == sorted(map(tuple, whole.collect())) and own.count() == 200
    assert D.derived_addresses(spark, FOLDER)[1].columns == own.columns
