"""The stream of file changes: changed and removed files, repeated batches, a crash before the commit."""

import pytest

from meterstone.sources.zone import Zone
from meterstone.streaming import changes

CONTRACT = {"t": (["ID", "NAME"], True)}


@pytest.fixture
def place(tmp_path):
    def send(month, rows):
        folder = tmp_path / "raw" / "t" / f"year_month={month}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / "x.csv").write_text("ID,NAME\n" + "".join(f"{i},{n}\n" for i, n in rows))

    return tmp_path, send


def go(spark, at):
    changes.note_changes(spark, f"{at}/raw", ["t"], f"{at}/journal")
    changes.curate_noted(spark, f"{at}/journal", f"{at}/raw", f"{at}/zone", f"{at}/ckpt", CONTRACT, "s").awaitTermination()
    return sorted(r.NAME for r in Zone(spark, f"{at}/zone").read("t").collect())


def test_changed_and_removed_files(spark, place):
    at, send = place
    send("2024-01", [(1, "a")])
    send("2024-02", [(2, "b"), (3, "c")])
    assert go(spark, at) == ["a", "b", "c"]
    zone = Zone(spark, f"{at}/zone")
    first = zone.snapshot()
    send("2024-02", [(2, "bb")])  # the same path
    send("2024-03", [(4, "d")])
    assert go(spark, at) == ["a", "bb", "d"]
    assert zone.snapshot().tables["t"].parts["2024-01"] == first.tables["t"].parts["2024-01"]
    (at / "raw" / "t" / "year_month=2024-01" / "x.csv").unlink()
    assert go(spark, at) == ["bb", "d"]
    version = zone.snapshot().version
    assert go(spark, at) == ["bb", "d"] and zone.snapshot().version == version  # nothing changed, nothing loaded
    entries = changes.noted(spark, f"{at}/journal")
    mark = zone.snapshot().marks["s"]
    assert not changes.apply_batch(entries, mark, f"{at}/raw", f"{at}/zone", CONTRACT, "s")  # a batch that was committed
    assert zone.snapshot().version == version
    assert sorted(r.path[-18:-6] for r in zone.files(zone.snapshot()).collect()) == ["month=2024-02", "month=2024-03"] or zone.files(zone.snapshot()).count() == 2


def test_a_crash_before_the_commit_is_made_good(spark, place, monkeypatch):
    at, send = place
    send("2024-01", [(1, "a")])
    assert go(spark, at) == ["a"]
    send("2024-01", [(1, "a"), (2, "b")])
    commit = Zone.commit
    monkeypatch.setattr(Zone, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(Exception, match="lost"):
        go(spark, at)
    assert [r.NAME for r in Zone(spark, f"{at}/zone").read("t").collect()] == ["a"]
    monkeypatch.setattr(Zone, "commit", commit)
    assert go(spark, at) == ["a", "b"]
