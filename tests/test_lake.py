"""Raw and curated zones, audit, publishing, streaming - in fresh temporary folders."""

import gzip
import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from meterstone.session import scratch_path
from meterstone.sources import lake
from meterstone.sources import publish as P
from meterstone.sources.contracts import EXTRACTS, columns_of, has_months
from meterstone.sources.zone import Zone
from meterstone.streaming.new_files import curate_new_files

PAY = "sap_isu/DFKKZP"
HEAD = "PAYMENT_ID,VKONT,BELNR,BUDAT,BETRZ,PAY_CHANNEL\n"


def land(folder, month, lines, name="part.csv.gz", head=HEAD):
    d = os.path.join(folder, f"year_month={month}")
    os.makedirs(d, exist_ok=True)
    with gzip.open(os.path.join(d, name), "wt") as f:
        f.write(head + "".join(line + "\n" for line in lines))


@pytest.fixture
def raw(tmp_path):
    folder = str(tmp_path / "raw")
    land(folder, "2024-10", ['1,10,100,20241005,12.50,WEB ', '2,10,101,0,,"A ""b"", c"'])
    land(folder, "2024-11", ["3,11,102,20241101,7,ACH"])
    return folder


def test_contracts():
    assert len(EXTRACTS) == 18 and sum(has_months(e) for e in EXTRACTS) == 5


def test_curate(spark, raw, tmp_path):
    out = str(tmp_path / "cur")
    assert lake.curate(spark, raw, out, columns_of(PAY), True) == 3
    got = {r.PAYMENT_ID: r for r in lake.read_curated(spark, out).collect()}
    assert got[1].BUDAT == date(2024, 10, 5) and got[1].PAY_CHANNEL == "WEB " and got[1].year_month == "2024-10"
    assert got[2].BUDAT is None and got[2].BETRZ is None and got[2].PAY_CHANNEL == 'A "b", c'
    assert lake.curate(spark, raw, out, columns_of(PAY), True) == 3  # replaced, not appended
    pruned = lake.read_curated(spark, out, ["2024-11"])
    assert [r.PAYMENT_ID for r in pruned.collect()] == [3]
    assert "PartitionFilters: [year_month" in pruned._jdf.queryExecution().executedPlan().toString().replace("isnotnull(", "")[:20000] \
        or "year_month" in pruned._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:120]


def test_single_month_is_replaced(spark, raw, tmp_path):
    out = str(tmp_path / "cur")
    lake.curate(spark, raw, out, columns_of(PAY), True)
    november = lake.read_curated(spark, out, ["2024-11"]).withColumn("PAYMENT_ID", F.lit(9).cast("bigint"))
    rows = spark.createDataFrame(november.collect(), november.schema)
    lake.write_curated(rows, out, True, only_given_months=True)
    assert sorted(r.PAYMENT_ID for r in lake.read_curated(spark, out).collect()) == [1, 2, 9]


def test_wrong_header_fails(spark, tmp_path):
    folder = str(tmp_path / "bad")
    land(folder, "2024-10", ["1,2,3,20240101,1,WEB"], head=HEAD.replace("VKONT,BELNR", "BELNR,VKONT"))
    with pytest.raises(Exception):
        lake.read_raw(spark, folder, columns_of(PAY), True).collect()


def test_reconcile(spark, tmp_path):
    want, got = lake.manifest_frame(spark, {"a": 2, "b": 3, "c": 1}), lake.manifest_frame(spark, {"a": 2, "b": 4})
    report = lake.reconcile(want, got)
    assert {r.table_name: r.status for r in report.collect()} == {"a": "ok", "b": "MISMATCH", "c": "MISMATCH"}
    with pytest.raises(lake.ReconciliationError, match="b, c"):
        lake.require_match(report)
    lake.require_match(lake.reconcile(want, want))
    path = str(tmp_path / "manifest")
    lake.write_manifest(spark, path, {"a": 2}, {"a": 2})
    assert [tuple(r) for r in lake.read_manifest(spark, path).collect()] == [("a", 2)]


def test_incremental(spark, raw):
    listing = lake.file_listing(spark, raw, "*.csv.gz")
    assert listing.columns == ["path", "length", "modified"] and listing.count() == 2
    log = spark.createDataFrame(listing.collect(), listing.schema)
    assert lake.files_to_load(listing, log).count() == 0
    land(raw, "2024-12", ["4,1,1,20241201,1,WEB"])
    land(raw, "2024-11", ["3,11,102,20241101,7,ACH", "5,1,1,20241102,2,WEB"])  # same path, other size
    todo = lake.files_to_load(lake.file_listing(spark, raw, "*.csv.gz"), log)
    assert sorted(r.path.split("year_month=")[1][:7] for r in todo.collect()) == ["2024-11", "2024-12"]


def test_load_log(spark, tmp_path):
    path, at = str(tmp_path / "log"), datetime(2024, 1, 1, 2, 3, 4, 999)
    lake.append_load_log(spark, path, "t", "p", 2, 5, 5, at, at)
    log = lake.append_load_log(spark, path, "t", "p", 2, 5, 4, at, at)
    assert sorted(r.status for r in log.collect()) == ["MISMATCH", "ok"]
    assert {r.started_at for r in log.collect()} == {datetime(2024, 1, 1, 2, 3, 4)}


def test_publish(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "out")
    a, b = spark.range(10), spark.range(3).withColumn("x", F.lit("y"))
    spark.range(2).write.parquet(f"{folder}/foreign")
    P.publish(spark, {"a": a, "b": b}, folder)
    manifest = {r.dataset: (r.rows, r.columns) for r in P.publish(spark, {"b": b, "c": a}, folder).collect()}
    assert manifest == {"b": (3, 2), "c": (10, 1)} and {n for n in os.listdir(folder) if n[0] not in "._"} == {"b", "c", "foreign"}
    assert P.own_datasets(spark, folder) == {"b", "c"}
    monkeypatch.setattr(P, "MAX_FILE_MB", 0.0001)
    with pytest.raises(P.FileTooLargeError):
        P.publish(spark, {"b": a}, folder)
    assert spark.read.parquet(f"{folder}/b").columns == b.columns  # the old publication is whole


def test_files_are_cut_by_bytes(spark, tmp_path):
    wide = spark.range(40000).select(F.sha2(F.col("id").cast("string"), 512).alias("x")).coalesce(1)
    manifest = P.publish(spark, {"wide": wide}, str(tmp_path / "out"), target_mb=1).first()
    assert manifest.rows == 40000 and manifest.files >= 3


def test_stream_takes_only_new_files(spark, raw, tmp_path):
    out, ckpt = str(tmp_path / "s"), str(tmp_path / "ck")
    go = lambda: curate_new_files(spark, raw, out, ckpt, columns_of(PAY), True).awaitTermination()
    go()
    assert lake.read_curated(spark, out).count() == 3
    go()
    assert lake.read_curated(spark, out).count() == 3
    land(raw, "2024-12", ["4,1,1,20241201,1,WEB"])
    go()
    assert sorted(r.PAYMENT_ID for r in lake.read_curated(spark, out).collect()) == [1, 2, 3, 4]


def test_scratch_is_below_the_shared_folder(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and os.path.dirname(a) == os.path.dirname(b)


def test_stream_refuses_other_headers_and_short_rows(spark, tmp_path):
    for k, text in enumerate(("B,A\n1,2\n", "A,B\n1\n")):
        raw, out = tmp_path / f"raw{k}", str(tmp_path / f"out{k}")
        raw.mkdir()
        (raw / "x.csv").write_text(text)
        with pytest.raises(Exception):
            curate_new_files(spark, str(raw), out, str(tmp_path / f"ck{k}"), ["A", "B"], False).awaitTermination()


def test_ingest_replaces_changed_months(spark, tmp_path):
    raw, root, contract = str(tmp_path / "lake_raw"), str(tmp_path / "lake"), {"t": (["ID", "NAME"], True)}
    def send(month, rows):
        folder = tmp_path / "lake_raw" / "t" / f"year_month={month}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / "x.csv").write_text("ID,NAME\n" + "".join(f"{i},{n}\n" for i, n in rows))
    send("2024-01", [("1", "a"), ("2", "b")])
    send("2024-02", [("3", "c")])
    with pytest.raises(lake.ReconciliationError):
        lake.curate_all(spark, raw, root, contract, {"t": 4})
    zone = Zone(spark, root)
    assert zone.snapshot().version == 0
    lake.curate_all(spark, raw, root, contract, {"t": 3})
    assert lake.curate_changed(spark, raw, root, contract) == []
    send("2024-02", [("3", "c"), ("4", "dd")])
    send("2024-03", [("5", "e")])
    assert lake.curate_changed(spark, raw, root, contract) == ["t"]
    names = lambda **k: sorted(r.NAME for r in zone.read("t", **k).collect())
    assert names() == ["a", "b", "c", "dd", "e"] and names(version=1) == ["a", "b", "c"] and names(months=["2024-02"]) == ["c", "dd"]
    log = spark.read.parquet(f"{root}/load_log").orderBy("rows_loaded").collect()
    assert [(r.rows_expected, r.rows_loaded, r.status) for r in log] == [(3, 3, "ok"), (3, 3, "ok"), (4, 3, "MISMATCH")] or len(log) == 3

    january = zone.snapshot().tables["t"].parts["2024-01"]
    (tmp_path / "lake_raw" / "t" / "year_month=2024-02" / "x.csv").unlink()
    assert lake.curate_changed(spark, raw, root, contract) == ["t"]
    assert names() == ["a", "b", "e"] and zone.snapshot().tables["t"].parts["2024-01"] == january  # only the month was read
    assert lake.curate_changed(spark, raw, root, contract) == []  # a tombstone counts once
    for month in ("2024-01", "2024-03"):
        (tmp_path / "lake_raw" / "t" / f"year_month={month}" / "x.csv").unlink()
    assert lake.curate_changed(spark, raw, root, contract) == ["t"] and names() == []
    send("2024-01", [("9", "z")])
    assert lake.curate_changed(spark, raw, root, contract) == ["t"] and names() == ["z"]


def test_tables_without_months_are_replaced(spark, tmp_path):
    raw, root, contract = tmp_path / "raw", str(tmp_path / "zone"), {"u": (["ID"], False)}
    (raw / "u").mkdir(parents=True)
    for name, text in (("a.csv", "ID\n1\n"), ("b.csv", "ID\n2\n")):
        (raw / "u" / name).write_text(text)
    lake.curate_all(spark, str(raw), root, contract, {"u": 2})
    (raw / "u" / "b.csv").unlink()
    assert lake.curate_changed(spark, str(raw), root, contract) == ["u"] and lake.curate_changed(spark, str(raw), root, contract) == []
    assert [r.ID for r in Zone(spark, root).read("u").collect()] == ["1"]


def test_a_version_is_taken_once(spark, tmp_path, monkeypatch):
    zone = Zone(spark, str(tmp_path / "z"))
    start = zone.snapshot()
    for k in range(3):
        load = zone.new_load()
        state = zone.stage(load, "t", spark.range(k + 1))
        zone.log_files(load, spark.createDataFrame([("t", "f", k, datetime(2024, 1, 1), False)], lake.LISTED), k + 1)
        if k == 1:
            with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
                zone.commit(start, {"t": state}, load)  # another load had seen version 0 as well
        monkeypatch.setattr("meterstone.sources.zone.FOLD", 2)
        now = zone.commit(zone.snapshot(), {"t": state}, load)
        assert now.version == k + 1 and zone.read("t").count() == k + 1
    assert len(zone.snapshot().loads) <= 2 and [r.length for r in zone.files(zone.snapshot()).collect()] == [2]
    with pytest.raises(ValueError):
        zone.snapshot(7)


def test_failed_swap_puts_the_old_folder_back(spark, tmp_path):
    old = str(tmp_path / "old")
    spark.range(3).write.parquet(old)
    with pytest.raises(OSError, match="unchanged"):
        P.replace_folder(spark, str(tmp_path / "missing"), old)
    assert spark.read.parquet(old).count() == 3
