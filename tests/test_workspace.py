"""Tables that don't depend on each other are stored at the same time."""

import threading

from linkmill.plans import derived as D
from linkmill.sources import workspace

FOLDER = "/root/testdata/sf0.001"


def test_registry_and_contacts_are_stored_together(spark, monkeypatch):
    met, stored = threading.Barrier(4), workspace.stored

    def waiting(df, name):
        met.wait(60)  # breaks unless all four are on their way
        return stored(df, name)

    monkeypatch.setattr(D, "_BUILT", {})
    D._dealt_part(spark, FOLDER)
    monkeypatch.setattr(workspace, "stored", waiting)
    contacts, registry = D.derived(spark, FOLDER)
    rows = D.part(spark, FOLDER).count()
    assert contacts.count() == registry.enterprise.count() == registry.address.count() == rows
    assert D.derived(spark, FOLDER) == (contacts, registry)  # built once
