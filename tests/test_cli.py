import glob
import os

from adlens.__main__ import main
from support import RAW_REPORT


def test_cli_run_report_sql(spark, tmp_dir):
    inbox = os.path.join(tmp_dir, "in")
    os.makedirs(inbox)
    with open(os.path.join(inbox, "report-2024-11-09.txt"), "w", encoding="utf-8") as f:
        f.write(RAW_REPORT)
    state = os.path.join(tmp_dir, "state")
    assert main(["run", "--state", state, "--report", inbox]) == 0
    out = os.path.join(tmp_dir, "report")
    assert main(["report", "--state", state, "--run-date", "2024-11-09", "--out", out]) == 0
    text = "".join(open(f, encoding="utf-8").read() for f in sorted(glob.glob(out + "/part-*"))).splitlines()
    assert text[0] == "=== Apartment Report — 2024-11-09 ==="
    assert text[1] == "Total active listings: 4"
    assert "1 room apartment segment:" in text
    assert any(line.startswith("all | 4 |") for line in text)
    assert text[-1].startswith("09.11.2024: Scraped today: 4")
    q = os.path.join(tmp_dir, "q")
    assert main(["sql", "--state", state, "--out", q,
                 "--query", "SELECT room_count, count(*) AS n FROM listed_ads GROUP BY room_count"]) == 0
    assert sorted(map(tuple, spark.read.parquet(q).collect())) == [(1, 1), (2, 1), (3, 1), (4, 1)]
    assert main(["validate", "--state", state]) == 0
    empty_out = os.path.join(tmp_dir, "empty")
    assert main(["report", "--state", state, "--run-date", "2023-02-18", "--out", empty_out]) == 0
    assert "No data was collected" in "".join(open(f, encoding="utf-8").read() for f in glob.glob(empty_out + "/part-*"))


def test_cli_stream_with_bucketed_store(spark, tmp_dir):
    from adlens.plans import daily as D
    inbox = os.path.join(tmp_dir, "inbox")
    os.makedirs(inbox)
    with open(os.path.join(inbox, "report-2024-11-09.txt"), "w", encoding="utf-8") as f:
        f.write(RAW_REPORT)
    state = os.path.join(tmp_dir, "state")
    args = ["stream", "--state", state, "--inbox", inbox, "--checkpoint", os.path.join(tmp_dir, "ckpt"),
            "--buckets", "4"]
    assert main(args) == 0
    store = D.StateStore(state, buckets=4)
    assert D.read_listed(spark, store).count() == 4
    assert [r["reason"] for r in D.read_quarantine(spark, store).collect()] == ["missing:Price"]
    assert main(args) == 0                      # nothing new: the checkpoint remembers the file
    assert D.read_metrics(spark, store).count() == 1


def test_cli_with_a_change_log(spark, tmp_dir):
    from adlens.plans import delta_store as DS
    inbox, state = os.path.join(tmp_dir, "inbox"), os.path.join(tmp_dir, "state")
    os.makedirs(inbox)
    with open(os.path.join(inbox, "report-2024-11-09.txt"), "w", encoding="utf-8") as f:
        f.write(RAW_REPORT)
    args = ["stream", "--log", "--state", state, "--inbox", inbox, "--checkpoint", os.path.join(tmp_dir, "ckpt")]
    assert main(args) == 0 == main(args)
    assert DS.read_open(spark, DS.DeltaStore(state)).count() == 4 and DS.read_metrics(spark, DS.DeltaStore(state)).count() == 1
    assert main(["run", "--log", "--state", state, "--report", inbox]) == 0      # the same ads as another batch
    assert DS.read_open(spark, DS.DeltaStore(state)).count() == 4
    assert main(["compact", "--state", state]) == 0 == main(["validate", "--log", "--state", state])
    q = os.path.join(tmp_dir, "q")
    assert main(["sql", "--log", "--state", state, "--out", q, "--query", "SELECT count(*) AS n FROM listed_ads"]) == 0
    assert spark.read.parquet(q).first()["n"] == 4
