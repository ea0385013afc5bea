"""Contacts are matched in waves, and what a wave wrote is gone before the next."""

import os
import subprocess

import pytest

from linkmill.config import MatchConfig
from linkmill.operators import matcher, shortlist
from linkmill.plans import derived as D
from linkmill.sources import workspace

FOLDER = "/root/testdata/sf0.001"


def _shuffle_files(spark) -> int:
    """Bytes of shuffle files of this application."""
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return sum(os.path.getsize(os.path.join(at, f)) for d in manager.localDirs() for at, _, files in os.walk(d.getPath()) for f in files if f.startswith("shuffle_"))


def test_stored_leaves_no_shuffle_files(spark):
    """match_candidates and match_end_to_end failed by disk: shuffle files stayed until the driver's garbage was collected."""
    before = _shuffle_files(spark)
    table = workspace.stored(spark.range(300_000).repartition(5, "id").groupBy("id").count(), "t")
    assert table.count() == 300_000
    assert _shuffle_files(spark) < before + 100_000
    with workspace.lent(table.where("id < 10"), "lent") as some:
        path = some.inputFiles()[0].removeprefix("file://")
        assert some.count() == 10 and os.path.exists(path)
    assert not os.path.exists(os.path.dirname(path))
    assert spark.conf.get(workspace._SWEEP, "false") == "false"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
def test_waves_find_what_one_wave_finds(spark, monkeypatch):
    contacts, registry, config = D.derived_contacts(spark, FOLDER).where("source_row_number % 3 = 0"), D.derived_registry(spark, FOLDER), MatchConfig()
    rows = lambda tables: [sorted(map(repr, t.collect())) for t in tables]
    once = rows(matcher.ranked_candidates(contacts, registry, config))
    held, lent = [], workspace.lent

    def watched(df, name):
        folder = workspace.folder(spark).removeprefix("file://")
        held.append(len(subprocess.run(["find", folder, "-maxdepth", "1", "-name", "merged-*"], capture_output=True).stdout.split()))
        return lent(df, name)

    monkeypatch.setattr(shortlist, "lent", watched)
    monkeypatch.setattr(shortlist, "WAVE", 30)
    monkeypatch.setattr(matcher, "WAVE", 30)
    assert rows(matcher.ranked_candidates(contacts, registry, config)) == once and len(once[0]) > 100
    assert len(held) > 1 and not any(held)


def test_waves_are_bounded_and_cover_all(spark):
    ids = spark.range(5000).withColumnRenamed("id", "source_row_number")
    for n, size, most, want in ((0, 10, 4, 1), (10, 10, 4, 1), (19, 10, 4, 1), (20, 10, 4, 2), (5000, 10, 4, 4)):
        waves = shortlist.in_waves(n, size, most)
        assert len(waves) == want and sum(ids.where(w).count() for w in waves) == 5000
