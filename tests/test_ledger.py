"""Slices, the commit ledger, load history and quoted line breaks: what holds when writers die, race or repeat."""

import os
import threading
import time

import pytest
from conftest import route_row, routes_df
from test_landing import GOOD, HEADER, _local, _write

from routeflow.operators.curate import curate
from routeflow.plans.layers import load_raw_rows
from routeflow.schemas import CURATED_SCHEMA, RAW_SCHEMA
from routeflow.sources import landing, ledger
from routeflow.sources.landing import files_with_quoted_breaks, list_files, load_files, load_history, load_landing, read_rejects
from routeflow.sources.ledger_stream import LedgerReader
from routeflow.sources.tables import conform, read_curated, read_layer, read_raw, reset_layer, stage_slice, sweep, write_layer
from routeflow.streaming.incremental import create_change_stream, has_data, run_curation, run_ingest, stream_tag


def _rows(spark, tag, n):
    return routes_df(spark, [route_row(flight_number=f"{tag}{i}") for i in range(n)])


# --- ledger -----------------------------------------------------------------------------------


def test_positions_snapshots_and_order(spark, fresh, monkeypatch):
    monkeypatch.setattr(ledger, "SNAPSHOT_EVERY", 3)
    assert ledger.entries(spark, fresh.raw) == [] and ledger.head(spark, fresh.raw) == -1
    for k in range(8):
        assert ledger.commit(spark, fresh.raw, f"load-{k}", f"folder-{k}").position == k
    found = ledger.entries(spark, fresh.raw)
    assert [(e.position, e.load_id, e.folder) for e in found] == [(k, f"load-{k}", f"folder-{k}") for k in range(8)]
    assert ledger.commit(spark, fresh.raw, "load-3", "other") is None  # committed once
    assert ledger.head(spark, fresh.raw) == 7
    ledger.commit(spark, fresh.raw, "reset-1", "", kind=ledger.RESET)
    ledger.commit(spark, fresh.raw, "load-9", "folder-9")
    assert [e.load_id for e in ledger.live(ledger.entries(spark, fresh.raw))] == ["load-9"]
    assert ledger.commit(spark, fresh.raw, "load-3", "other") is None  # nor after a reset


def test_writers_at_once_get_positions_of_their_own(spark, fresh):
    def write(k):
        for j in range(4):
            ledger.commit(spark, fresh.raw, f"load-{k}-{j}", f"folder-{k}-{j}")

    threads = [threading.Thread(target=write, args=(k,)) for k in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    found = ledger.entries(spark, fresh.raw)
    assert [e.position for e in found] == list(range(16))
    assert len({e.load_id for e in found}) == 16


def test_expected_head_that_has_moved(spark, fresh):
    ledger.commit(spark, fresh.raw, "a", "a")
    with pytest.raises(ledger.LedgerMoved):
        ledger.commit(spark, fresh.raw, "b", "b", expected=-1)
    assert ledger.commit(spark, fresh.raw, "b", "b", expected=0).position == 1


def test_sweep_takes_only_abandoned_slices(spark, fresh):
    write_layer(_rows(spark, "A", 2), fresh.raw, "first", RAW_SCHEMA)
    reset_layer(spark, fresh.raw, RAW_SCHEMA)
    write_layer(_rows(spark, "B", 3), fresh.raw, "second", RAW_SCHEMA)
    torn = stage_slice({"rows": conform(_rows(spark, "T", 4), RAW_SCHEMA)}, fresh.raw, "torn")
    left = os.path.join(_local(fresh.raw), ledger.LEDGER, "." + "0" * 32)
    with open(left, "w") as f:
        f.write("cut off")
    before = {e.folder for e in ledger.entries(spark, fresh.raw) if e.folder}
    assert sweep(spark, fresh.raw) == [] and os.path.exists(left)  # younger than a week
    assert sweep(spark, fresh.raw, abandoned_s=0) == [torn] and not os.path.exists(left)
    assert set(os.listdir(os.path.join(_local(fresh.raw), "data"))) - {torn} >= before  # the slice before the reset too
    assert sweep(spark, fresh.raw, abandoned_s=0) == []
    assert read_raw(spark, fresh.raw).count() == 3
    write_layer(_rows(spark, "T", 4), fresh.raw, "torn", RAW_SCHEMA)  # the load is repeated
    assert read_raw(spark, fresh.raw).count() == 7
    assert sweep(spark, fresh.curated) == []  # no such table yet


def test_slices_are_unseen_until_committed(spark, fresh):
    folder = stage_slice({"rows": conform(_rows(spark, "T", 3), RAW_SCHEMA)}, fresh.raw, "torn")
    assert read_raw(spark, fresh.raw).count() == 0
    assert not has_data(spark, fresh.raw, fresh.checkpoint("c"))
    ledger.commit(spark, fresh.raw, "torn", folder)
    assert read_raw(spark, fresh.raw).count() == 3
    assert {r["load_id"] for r in read_layer(spark, fresh.raw, RAW_SCHEMA, with_load_id=True).collect()} == {"torn"}


# --- streams ----------------------------------------------------------------------------------


def test_curation_after_torn_commits(spark, fresh):
    ckpt = fresh.checkpoint("curate")
    rows = _rows(spark, "A", 4)
    stage_slice({"rows": conform(rows, RAW_SCHEMA)}, fresh.raw, "ingest-1")
    run_curation(spark, fresh.raw, fresh.curated, ckpt)
    assert read_curated(spark, fresh.curated).count() == 0
    write_layer(rows, fresh.raw, "ingest-1", RAW_SCHEMA)
    stage_slice({"rows": conform(curate(rows), CURATED_SCHEMA)}, fresh.curated, f"curate-{stream_tag(ckpt)}-{0:010d}")
    for _ in range(2):
        run_curation(spark, fresh.raw, fresh.curated, ckpt)
    assert read_curated(spark, fresh.curated).count() == 4


def test_batch_that_died_after_its_commit_adds_nothing(spark, fresh):
    """The slice is committed but the stream's own commit is lost: the batch is replayed."""
    ckpt = fresh.checkpoint("curate")
    load_raw_rows(_rows(spark, "A", 4), fresh)
    run_curation(spark, fresh.raw, fresh.curated, ckpt)
    local = _local(ckpt)
    os.replace(f"{local}/commits/0", f"{local}/lost-commit")
    if os.path.exists(f"{local}/commits/.0.crc"):
        os.replace(f"{local}/commits/.0.crc", f"{local}/.lost-commit.crc")
    assert has_data(spark, fresh.raw, ckpt)
    load_raw_rows(_rows(spark, "B", 3), fresh)
    run_curation(spark, fresh.raw, fresh.curated, ckpt)
    got = [r["flight_number"] for r in read_curated(spark, fresh.curated).collect()]
    assert sorted(got) == ["A0", "A1", "A2", "A3", "B0", "B1", "B2"]


def test_bounded_batches_and_has_data(spark, fresh):
    ckpt = fresh.checkpoint("curate")
    assert not has_data(spark, fresh.raw, ckpt)
    for k in range(3):
        load_raw_rows(_rows(spark, f"S{k}-", 2), fresh)
    assert has_data(spark, fresh.raw, ckpt)
    run_curation(spark, fresh.raw, fresh.curated, ckpt, max_slices_per_trigger=1)
    assert not has_data(spark, fresh.raw, ckpt)
    assert read_curated(spark, fresh.curated).count() == 6
    assert len(ledger.entries(spark, fresh.curated)) == 3  # one slice per batch
    load_raw_rows(_rows(spark, "L", 1), fresh)
    assert has_data(spark, fresh.raw, ckpt)


def test_change_stream_created_on_an_empty_table_sees_the_first_load(spark, fresh):
    ckpt = fresh.checkpoint("curate")
    create_change_stream(spark, fresh.raw, ckpt)
    load_raw_rows(_rows(spark, "F", 2), fresh)
    run_curation(spark, fresh.raw, fresh.curated, ckpt)
    assert read_curated(spark, fresh.curated).count() == 2


def test_reader_asks_for_new_positions_only(spark, fresh, monkeypatch):
    for k in range(5):
        ledger.commit(spark, fresh.raw, f"l{k}", f"f{k}")
    folder = f"{fresh.raw}/{ledger.LEDGER}"
    asked = []
    reader = LedgerReader({"ledger": folder, "from": "3"}, ledger.DIGITS)
    whole = LedgerReader._file
    monkeypatch.setattr(LedgerReader, "_file", lambda self, root, k: asked.append(k) or whole(self, root, k))
    assert reader.latestOffset() == {"position": 5} and min(asked) == 3
    part = reader.partitions({"position": 3}, {"position": 5})
    assert [r[1:3] for r in reader.read(part[0])] == [("l3", "f3"), ("l4", "f4")]
    assert reader.latestOffset() == {"position": 5} and reader.partitions({"position": 5}, {"position": 5}) == []
    assert LedgerReader({"ledger": folder, "most": "2"}, ledger.DIGITS).latestOffset() == {"position": 2}


# --- load history -----------------------------------------------------------------------------


def test_each_file_is_loaded_once_whatever_load_takes_it(spark, fresh):
    home = _local(fresh.landing)
    _write(home, "a.csv", [HEADER, GOOD, GOOD.replace(",220,", ",x,")])
    assert load_landing(spark, fresh.landing, fresh.raw, "one") == 1
    assert load_landing(spark, fresh.landing, fresh.raw, "two") == 0
    _write(home, "b.csv", [HEADER, GOOD, GOOD])
    run_ingest(spark, fresh.landing, fresh.raw, fresh.checkpoint("ingest"))  # a is delivered to the stream, but known
    assert read_raw(spark, fresh.raw).count() == 3
    assert load_landing(spark, fresh.landing, fresh.raw, "three") == 0
    names = sorted(r["path"].rsplit("/", 1)[1] for r in load_history(spark, fresh.raw).collect())
    assert names == ["a.csv", "b.csv"] and read_rejects(spark, fresh.raw).count() == 1
    assert load_landing(spark, fresh.landing, fresh.raw, "again", force=True) == 2
    assert read_raw(spark, fresh.raw).count() == 6


def test_a_changed_file_counts_as_new_and_a_reset_table_starts_anew(spark, fresh):
    home = _local(fresh.landing)
    _write(home, "a.csv", [HEADER, GOOD])
    load_landing(spark, fresh.landing, fresh.raw, "one")
    _write(home, "a.csv", [HEADER, GOOD, GOOD])
    os.utime(f"{home}/a.csv", (time.time() + 5, time.time() + 5))
    assert load_landing(spark, fresh.landing, fresh.raw, "two") == 1
    assert read_raw(spark, fresh.raw).count() == 3
    reset_layer(spark, fresh.raw, RAW_SCHEMA)
    assert load_landing(spark, fresh.landing, fresh.raw, "three") == 1
    assert read_raw(spark, fresh.raw).count() == 2


def test_a_load_that_loses_the_race_takes_only_what_is_left(spark, fresh, monkeypatch):
    home = _local(fresh.landing)
    _write(home, "a.csv", [HEADER, GOOD])
    _write(home, "b.csv", [HEADER, GOOD, GOOD])
    files = sorted(list_files(spark, fresh.landing).collect())
    real, raced = landing.pending, []

    def pending(*args):
        out = real(*args)
        if not raced:  # the other load commits between our look at the history and our commit
            raced.append(1)
            load_files(spark, files[:1], fresh.raw, "other")
        return out

    monkeypatch.setattr(landing, "pending", pending)
    assert load_files(spark, files, fresh.raw, "mine") == 1
    assert read_raw(spark, fresh.raw).count() == 3


def test_load_of_an_empty_folder(spark, fresh):
    os.makedirs(_local(fresh.landing))
    assert load_landing(spark, fresh.landing, fresh.raw, "none") == 0
    assert read_raw(spark, fresh.raw).count() == 0 and load_history(spark, fresh.raw).count() == 0


# --- quoted line breaks -----------------------------------------------------------------------


def test_only_files_with_quoted_breaks_are_read_whole(spark, fresh):
    home = _local(fresh.landing)
    _write(home, "plain.csv", [HEADER, GOOD, GOOD.replace("American Airlines", '"q""t, u"')])
    _write(home, "broken.csv", [HEADER, GOOD.replace("American Airlines", '"Three\nlines, ""and""\na quote"'), GOOD])
    files = list_files(spark, fresh.landing).collect()
    assert [p.rsplit("/", 1)[1] for p in files_with_quoted_breaks(spark, files)] == ["broken.csv"]
    load_landing(spark, fresh.landing, fresh.raw, "one")
    names = [r["airline_name"] for r in read_raw(spark, fresh.raw).collect()]
    assert sorted(names) == sorted(["American Airlines", 'q"t, u', 'Three\nlines, "and"\na quote', "American Airlines"])
    assert read_raw(spark, fresh.raw).where("flight_quarter is null").count() == 0
    plan = landing.read_files(spark, files)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 2  # one scan of split files, one of whole files
    assert landing.read_files(spark, files, options={"multiLine": "false"}).count() == 6  # told not to look: fragments
