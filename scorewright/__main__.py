"""Run the whole scorecard refresh: ``python -m scorewright --out DIR`` and one kind of source.

``--tables DIR``   driver-format tables, mapped by ``plans.testbed``;
``--sources DIR``  one Parquet table per field of ``ReportSources`` (history.parquet, current.parquet ...; contracts in
                   ``plans/dimension.py`` and ``plans/facts.py``), with ``--config FILE``, a JSON object with the fields
                   of ``ReportConfig``: report_date, total_label, manager_title_prefix, and optionally keep and order
                   (SQL expressions), region_suffix, short_code_len, source_labels, tooltip_sources.

Every report table is written to a new version of the output folder, which is then made current.
"""

from __future__ import annotations

import argparse
import dataclasses
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from scorewright.plans import report, testbed
from scorewright.session import local_session
from scorewright.sources.tables import scan


def own_sources(spark: SparkSession, root: str) -> report.ReportSources:
    names = [f.name for f in dataclasses.fields(report.ReportSources) if f.name != "work"]
    return report.ReportSources(**{n: scan(spark, n, root=root) for n in names})


def own_config(text: str) -> report.ReportConfig:
    given = json.loads(text)
    if "keep" in given:
        given["keep"] = F.expr(given["keep"])
    if "order" in given:
        given["order"] = [F.expr(x.removesuffix(" DESC")).desc() if x.endswith(" DESC") else F.expr(x) for x in given["order"]]
    if "tooltip_sources" in given:
        given["tooltip_sources"] = {int(k): v for k, v in given["tooltip_sources"].items()}
    return report.ReportConfig(**given)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="scorewright")
    kind = ap.add_mutually_exclusive_group(required=True)
    kind.add_argument("--tables", help="folder with <table>.parquet files of the driver format")
    kind.add_argument("--sources", help="folder with one <field>.parquet table per source")
    ap.add_argument("--config", help="JSON file, with --sources")
    ap.add_argument("--out", required=True, help="folder for the report tables (shared storage on a cluster)")
    ap.add_argument("--report-date", default=testbed.REPORT_DATE, help="with --tables")
    ap.add_argument("--master", default=None, help="local[N] for a local run; omit under spark-submit")
    args = ap.parse_args(argv)
    if args.sources and not args.config:
        ap.error("--sources needs --config")
    if args.master:
        spark = local_session(cores=args.master.removeprefix("local[").rstrip("]") or "*")
    else:
        spark = SparkSession.builder.appName("scorewright").getOrCreate()
    if args.sources:
        cfg = own_config(spark.read.text(args.config, wholetext=True).first()[0])
        src = own_sources(spark, args.sources)
    else:
        cfg, src = testbed.config(report_date=args.report_date), testbed.sources(spark, args.tables)
    print(json.dumps(report.refresh(spark, src, cfg, args.out)))


if __name__ == "__main__":
    main()
