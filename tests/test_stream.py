"""ST1-ST3: the report stream gives the same state as the batch daily runs."""

import datetime as dt
import os

import pytest

from adlens.operators import extract as E
from adlens.plans import daily as D
from adlens.sinks import writers as W
from adlens.sources import reports as R
from adlens.streaming import report_stream as S
from support import RAW_REPORT


def _day_report(day: dt.date, keys: list[str]) -> str:
    blocks = []
    for k in keys:
        blocks.append("\n".join([
            f"https://ss.lv/msg/lv/real-estate/flats/testa-nov/ezerpils/{k}.html",
            "Iela:><b>Egļu laukums 9", "Istabas:>5", "Platība:>118 m²", "Stāvs:>6/8",
            "Price:>149 860 € (1 270 €/m²)", f"Date:>{day.strftime('%d.%m.%Y')}"]))
    return "\n".join(blocks) + "\n"


def test_stream_equals_batch(spark, tmp_dir):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(4)]
    keys = [["a", "b", "c"], ["a", "c", "d"], ["c", "d"], ["a", "c", "d", "e"]]
    inbox = os.path.join(tmp_dir, "inbox")
    os.makedirs(inbox)
    for d, ks in zip(days, keys):
        path = os.path.join(inbox, f"report-{d.isoformat()}.txt")
        with open(path, "w", encoding="utf-8") as f:
            f.write(_day_report(d, ks))
        ts = 1_700_000_000 + days.index(d) * 100
        os.utime(path, (ts, ts))   # arrival order = date order
    stream_store = D.StateStore(os.path.join(tmp_dir, "stream_state"))
    q = S.start(spark, inbox, stream_store, os.path.join(tmp_dir, "ckpt"))
    q.awaitTermination(300)
    assert q.exception() is None
    batch_store = D.StateStore(os.path.join(tmp_dir, "batch_state"))
    clean, _ = E.report_to_clean_ads(R.read_report_blocks(spark, inbox))
    D.run_days(spark, batch_store, clean)
    for read in (D.read_listed, D.read_removed):
        a = sorted(map(tuple, read(spark, stream_store).collect()))
        b = sorted(map(tuple, read(spark, batch_store).collect()))
        assert a == b and len(a) > 0
    m = {r["run_date"]: (r["new_ads"], r["removed"], r["active_total"]) for r in D.read_metrics(spark, stream_store).collect()}
    assert m == {days[0]: (3, 0, 3), days[1]: (1, 1, 3), days[2]: (0, 1, 2), days[3]: (2, 0, 4)}
    # ST1: a second start processes nothing new (files are tracked by the checkpoint)
    q2 = S.start(spark, inbox, stream_store, os.path.join(tmp_dir, "ckpt"))
    q2.awaitTermination(120)
    assert D.read_metrics(spark, stream_store).count() == 4


def _put(inbox, name, text, at):
    path = os.path.join(inbox, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    os.utime(path, (1_700_000_000 + at * 100,) * 2)


def _state(spark, store):
    return {"open": sorted(r["url_hash"] for r in D.read_listed(spark, store).collect()),
            "removed": sorted((r["url_hash"], r["removed_date"]) for r in D.read_removed(spark, store).collect()),
            "metrics": {r["run_date"]: (r["new_ads"], r["removed"], r["active_total"]) for r in D.read_metrics(spark, store).collect()}}


@pytest.mark.parametrize("per_trigger", [None, 1])
def test_several_files_of_a_day_and_late_files(spark, tmp_dir, per_trigger):
    # day 2 comes as two files, day 1 as three of which two come after day 3
    d1, d2, d3 = (dt.date(2024, 1, i) for i in (1, 2, 3))
    inbox = os.path.join(tmp_dir, "inbox")
    os.makedirs(inbox)
    store = D.StateStore(os.path.join(tmp_dir, "state"))
    start = lambda: S.start(spark, inbox, store, os.path.join(tmp_dir, "ckpt"), max_files_per_trigger=per_trigger).awaitTermination(300)
    _put(inbox, f"part-1-{d1}.txt", _day_report(d1, ["a", "b"]), 0)
    _put(inbox, f"part-1-{d2}.txt", _day_report(d2, ["a", "b"]), 1)
    _put(inbox, f"part-2-{d2}.txt", _day_report(d2, ["c", "d"]), 2)
    _put(inbox, f"part-1-{d3}.txt", _day_report(d3, ["a", "d"]), 3)
    start()
    assert _state(spark, store) == {"open": ["a", "d"], "removed": [("b", d3), ("c", d3)],
                                    "metrics": {d1: (2, 0, 2), d2: (2, 0, 4), d3: (0, 2, 2)}}
    _put(inbox, f"part-2-{d1}.txt", _day_report(d1, ["c", "x"]), 4)
    _put(inbox, f"part-3-{d1}.txt", _day_report(d1, ["y"]), 5)
    start()
    late = _state(spark, store)
    assert late == {"open": ["a", "d"], "removed": [("b", d3), ("c", d3), ("x", d2), ("y", d2)],
                    "metrics": {d1: (5, 0, 5), d2: (1, 2, 4), d3: (0, 2, 2)}}
    assert {r["url_hash"] for r in D.read_clean(spark, store, d3).collect()} == {"a", "d"}   # the report finds its ads
    # the same files as one batch give the same state
    whole = D.StateStore(os.path.join(tmp_dir, "whole"))
    D.run_report(spark, whole, inbox)
    assert _state(spark, whole) == late


def test_late_and_bad_records_all_reach_the_quarantine(spark, tmp_dir):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    bad = lambda d, keys: _day_report(d, keys).replace("Stāvs:>6/8", "Stāvs:>jumts")
    store = D.StateStore(os.path.join(tmp_dir, "state"))
    boxes = [[(d1, "1", _day_report(d1, ["a", "b", "c"]))],
             [(d2, "1", _day_report(d2, ["a", "b"])), (d2, "2", bad(d2, ["c", "n"]))],
             [(d1, "2", bad(d1, ["p", "q"]))], [(d1, "3", bad(d1, ["r"]))],
             [(dt.date(2024, 1, 3), "1", bad(dt.date(2024, 1, 3), ["a", "b", "c"]))]]
    for k, box in enumerate(boxes):
        inbox = os.path.join(tmp_dir, f"in{k}")
        os.makedirs(inbox)
        for d, n, text in box:
            _put(inbox, f"part-{n}-{d}.txt", text, 0)
        D.run_report(spark, store, inbox)
    # c did not parse on day 2 and nothing did on day 3: all are still listed
    state = _state(spark, store)
    assert state["open"] == ["a", "b", "c"] and state["removed"] == []
    assert [state["metrics"][d][0] for d in sorted(state["metrics"])] == [3, 0, 0]
    q = sorted((r["run_date"].day, r["reason"]) for r in D.read_quarantine(spark, store).collect())
    assert q == [(1, "bad_floor")] * 3 + [(2, "bad_floor")] * 2 + [(3, "bad_floor")] * 3
    assert set(D.run_report(spark, store, os.path.join(tmp_dir, "in1")).values()) == {"skipped"}


def test_nothing_is_left_in_the_shared_folder(spark, tmp_dir):
    from adlens.session import ensure_checkpoint_dir
    shared = ensure_checkpoint_dir(spark).removeprefix("file:")
    inbox = os.path.join(tmp_dir, "in")
    os.makedirs(inbox)
    _put(inbox, "r-2024-01-01.txt", _day_report(dt.date(2024, 1, 1), ["a"]), 0)
    before = set(os.listdir(shared))
    D.run_report(spark, D.StateStore(os.path.join(tmp_dir, "s1")), inbox)
    S.start(spark, inbox, D.StateStore(os.path.join(tmp_dir, "s2")), os.path.join(tmp_dir, "ckpt")).awaitTermination(300)
    assert set(os.listdir(shared)) == before


def test_a_lost_table_is_an_error(spark, tmp_dir):
    inbox = os.path.join(tmp_dir, "in")
    os.makedirs(inbox)
    _put(inbox, "r-2024-01-01.txt", _day_report(dt.date(2024, 1, 1), ["a"]), 0)
    store = D.StateStore(os.path.join(tmp_dir, "s"))
    assert D.read_removed(spark, store).count() == 0
    D.run_report(spark, store, inbox)
    os.rename(store.path("removed"), store.path("elsewhere"))
    with pytest.raises(FileNotFoundError):
        D.read_removed(spark, store).count()


def test_report_files_round_trip(spark, tmp_dir):
    path = os.path.join(tmp_dir, "r-2024-11-09.txt")
    with open(path, "w", encoding="utf-8") as f:
        f.write(RAW_REPORT)
    clean, _ = E.report_to_clean_ads(R.read_report_blocks(spark, tmp_dir))
    out = os.path.join(tmp_dir, "out")
    W.write_report_files(clean, out)
    again, q = E.report_to_clean_ads(R.read_report_blocks(spark, out + "/*"))
    cols = ["url_hash", "room_count", "apt_floor", "house_floors", "has_lift", "street", "pub_date",
            "size_sqm", "price_eur", "sqm_price_eur", "run_date"]
    assert sorted(map(tuple, again.select(cols).collect())) == sorted(map(tuple, clean.select(cols).collect()))
    assert q.count() == 0


def test_stream_undated_file_is_quarantined(spark, tmp_dir):
    inbox = os.path.join(tmp_dir, "inbox")
    os.makedirs(inbox)
    with open(os.path.join(inbox, "report.txt"), "w", encoding="utf-8") as f:
        f.write(RAW_REPORT)
    store = D.StateStore(os.path.join(tmp_dir, "state"))
    q = S.start(spark, inbox, store, os.path.join(tmp_dir, "ckpt"))
    q.awaitTermination(300)
    assert D.read_metrics(spark, store).count() == 0
    undated = spark.read.parquet(store.path("quarantine_undated"))
    assert undated.count() == 5 and {r["reason"] for r in undated.collect()} == {"no_run_date"}
