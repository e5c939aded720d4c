"""Command line: ``spark-submit`` or ``python -m tenderloom <command> …`` over stored tables."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import functions as F

from tenderloom import schemas as S
from tenderloom.operators import kpi, outcomes, retention
from tenderloom.plans import cycles, report
from tenderloom.session import build_session
from tenderloom.sources.archive_files import archive_files
from tenderloom.sources.tables import keyed


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="tenderloom")
    ap.add_argument("command", choices=["scrape-only", "process-only", "report-only", "stats", "reset-errors"])
    ap.add_argument("--tenders", required=True)
    ap.add_argument("--pvs")
    ap.add_argument("--out", help="folder for the new tables, sheets and summaries")
    ap.add_argument("--as-of", type=dt.date.fromisoformat, required=True)
    ap.add_argument("--base", default="index.php")
    ap.add_argument("--listing-pages"), ap.add_argument("--detail-pages"), ap.add_argument("--minutes-pages")
    ap.add_argument("--archives", help="folder of zip files; with --links (url, archive) they are claimed by the download queue")
    ap.add_argument("--links"), ap.add_argument("--documents")
    ap.add_argument("--sheets", help="folder of the sheets, the same for all runs; --out when absent")
    ap.add_argument("--batch", help="name of this export; a repeated one replaces itself; the day when absent")
    ap.add_argument("--files", help="stored artefacts (file_id, kind, modified_at); those past retention are listed in --out")
    ap.add_argument("--threshold", type=float, default=S.BUDGET_THRESHOLD)
    ap.add_argument("--limit", type=int, help="rows per queue; all when absent")
    args = ap.parse_args(argv)

    spark = build_session()
    now = F.lit(f"{args.as_of} 00:00:00").cast("timestamp")
    tenders = keyed(spark, args.tenders, S.TENDERS)
    tables = cycles.Tables(tenders, keyed(spark, args.pvs, S.PVS) if args.pvs else spark.createDataFrame([], S.PVS))
    page = lambda path: spark.read.parquet(path)

    if args.command == "stats":
        print("\n".join(report.stats_lines(kpi.kpis(tenders, args.as_of, args.threshold), kpi.status_counts(tenders))))
    elif args.command == "report-only":
        lines = kpi.report_lines(tables.tenders, tables.pvs, args.as_of, args.threshold)
        for line in report.text_lines(lines, args.as_of, threshold=args.threshold):
            print(line)
    elif args.command == "reset-errors":
        print(f"{outcomes.reset_count(tenders).first().n_reset} tenders reset")
        outcomes.reset_errors(tenders, now).write.parquet(f"{args.out}/tenders")
    else:
        before = tables
        if args.command == "scrape-only":
            if args.listing_pages:
                tables, _ = cycles.collect_listing(tables, page(args.listing_pages), args.base, now)
            if args.detail_pages:
                tables = cycles.enrich(tables, page(args.detail_pages), args.base, now, args.limit)
            if args.minutes_pages:
                tables = cycles.collect_minutes(tables, page(args.minutes_pages), page(args.detail_pages), args.base, now)
        else:
            sources = {name: page(path) for name, path in (("minutes_pages", args.minutes_pages), ("detail_pages", args.detail_pages),
                                                           ("documents", args.documents)) if path}
            if args.archives:
                stored = archive_files(spark, args.archives)
                links = page(args.links) if args.links else tenders.select(F.col("lien_dce").alias("url"), F.col("zip_path").alias("archive")).distinct()
                sources["downloads"] = stored.join(links, "archive")
            sheets = args.sheets or args.out
            tables, summaries = cycles.process(tables, sources, args.base, f"{sheets}/tenders-sheet", f"{sheets}/minutes-sheet",
                                               args.batch or str(args.as_of), now, args.limit, args.threshold)
            if summaries is not None:
                summaries.write.parquet(f"{args.out}/summaries")
            if args.files:
                survivors, expired = retention.split(page(args.files), now)
                survivors.write.parquet(f"{args.out}/files"), expired.write.parquet(f"{args.out}/expired-files")
        tables.tenders.write.parquet(f"{args.out}/tenders")
        tables.pvs.write.parquet(f"{args.out}/pvs")
        cycles.changes(before, tables, now).write.parquet(f"{args.out}/history")


if __name__ == "__main__":
    main()
