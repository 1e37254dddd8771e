"""Command line for the daily job (use with spark-submit on a cluster).

    python -m adlens run    --state DIR --report PATH [--run-date D] [--force] [--buckets B]
    python -m adlens stream --state DIR --inbox DIR --checkpoint DIR [--buckets B]
    python -m adlens report --state DIR --run-date D --out DIR [--title T]
    python -m adlens sql    --state DIR --query "SELECT … :name" [--arg name=value] [--out DIR]
    python -m adlens validate --state DIR [--run-date D]
    python -m adlens compact --state DIR

``run`` applies a day's raw report to the state store (Entry A), ``stream``
processes the report files that arrived (one trigger), ``report`` writes the
combined daily report (R6) as ordered text, ``sql`` runs a read-only query
over ``listed_ads``, ``removed_ads``, ``run_metrics`` and ``clean_ads``,
``validate`` checks that the tables load, prints their counts and exits
non-zero when an open-ads snapshot holds a key twice (V7). With ``--log`` the
state is kept as a log of changes (``plans.delta_store``) instead of a
snapshot per run date; ``compact`` merges such a log into a new base.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from .operators import report as RP
from .plans import adhoc as Z
from .plans import daily as D
from .plans import delta_store as DS
from .session import apply_codegen_limit, ensure_checkpoint_dir
from .sinks.writers import export_lines
from .streaming import report_stream as S


# Rows of a query that go to the terminal; ``--out`` writes the whole result.
SHOWN_ROWS = 1000


def _session() -> SparkSession:
    spark = SparkSession.builder.appName("adlens").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    apply_codegen_limit(spark)
    ensure_checkpoint_dir(spark)
    return spark


def _read_open(spark: SparkSession, store, run_date=None):
    return DS.read_open(spark, store, run_date) if isinstance(store, DS.DeltaStore) else D.read_listed(spark, store, run_date)


def _views(spark: SparkSession, store) -> dict:
    at = DS if isinstance(store, DS.DeltaStore) else D
    return {"listed_ads": _read_open(spark, store), "removed_ads": at.read_removed(spark, store),
            "run_metrics": at.read_metrics(spark, store), "clean_ads": at.read_clean(spark, store)}


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="adlens")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("run", "stream", "report", "sql", "validate", "compact"):
        p = sub.add_parser(name)
        p.add_argument("--state", required=True)
        p.add_argument("--buckets", type=int, default=None)
        p.add_argument("--log", action="store_true")
        if name == "run":
            p.add_argument("--report", required=True)
            p.add_argument("--run-date")
            p.add_argument("--force", action="store_true")
        if name == "stream":
            p.add_argument("--inbox", required=True)
            p.add_argument("--checkpoint", required=True)
        if name == "report":
            p.add_argument("--run-date", required=True)
            p.add_argument("--out", required=True)
            p.add_argument("--title", default="=== Apartment Report — {date} ===")
        if name == "sql":
            p.add_argument("--query", required=True)
            p.add_argument("--arg", action="append", default=[], metavar="NAME=VALUE")
            p.add_argument("--out")
        if name == "validate":
            p.add_argument("--run-date")
    a = ap.parse_args(argv)
    spark = _session()
    store = DS.DeltaStore(a.state) if a.log or a.cmd == "compact" else D.StateStore(a.state, buckets=a.buckets)
    at = DS if isinstance(store, DS.DeltaStore) else D
    if a.cmd == "run":
        out = at.run_report(spark, store, a.report, run_date=a.run_date, force=a.force)
        print(json.dumps({str(k): v for k, v in out.items()}))
    elif a.cmd == "stream":
        q = S.start(spark, a.inbox, store, a.checkpoint)
        q.awaitTermination()
    elif a.cmd == "report":
        ads = at.read_clean(spark, store, a.run_date)
        if ads.isEmpty():
            lines = RP.no_data_report(spark)
        else:
            lines = RP.combined_report(ads, D._date(a.run_date), at.read_metrics(spark, store), title=a.title)
        export_lines(lines, a.out, ["section", "segment", "line_no"])
    elif a.cmd == "compact":
        DS.compact(spark, store)
    elif a.cmd == "validate":
        from .operators.quality import validate_snapshot
        row = validate_snapshot(_read_open(spark, store, a.run_date), at.read_removed(spark, store)).first()
        print(json.dumps(row.asDict()))
        return 0 if row["duplicate_open_keys"] == 0 else 1
    elif a.cmd == "sql":
        given = dict(x.split("=", 1) for x in a.arg)
        df = Z.run_sql(spark, a.query, _views(spark, store), args=given, with_functions=True)
        if a.out:
            df.write.mode("overwrite").parquet(a.out)
        else:
            shown = df.limit(SHOWN_ROWS + 1).collect()
            print("\t".join(df.columns))
            for row in shown[:SHOWN_ROWS]:
                print("\t".join("" if v is None else str(v) for v in row))
            if len(shown) > SHOWN_ROWS:
                print(f"-- cut: the first {SHOWN_ROWS} rows; --out writes all of them")
    return 0


if __name__ == "__main__":
    sys.exit(main())
