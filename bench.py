"""Headline queries at one scale: one JSON line with seconds per query.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default all), ``BENCH_RUNS`` timed runs (default 1; the
median counts) after one warm-up each over the smallest scale beside it, ``BENCH_ONLY`` comma-separated names.
Every query is worked off whole into a sink that drops its rows.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tenderloom.plans.catalog import QUERIES  # noqa: E402
from tenderloom.session import build_session  # noqa: E402

HEADLINE = [
    "s01_scan_tenders", "s03_scan_document_layers", "s04_archive_entries", "x01_listing_rows", "x02_detail_records",
    "x03_minutes_rows", "x04_minutes_link", "t02_tender_hash", "t04_parse_amount_text", "t06_normalize_date", "t07_days_left",
    "t08_normalize_phone", "t15_key_points", "t16_parse_reply", "t20_find_amount", "t21_text_cascade", "t21_tiers_to_columns",
    "f01_enrich_queue", "f01_whole_queue", "f09_expiring", "f16_expired_counts", "o02_top_budgets", "a01_status_counts", "a08_kpis",
    "a09_stage_metrics", "a11_first_findings", "a12_joined_texts", "u01_upsert", "u02_upsert_counters", "w05_change_flags",
    "u03_merge_details", "u04_failures", "u07_save_minutes", "u09_reset_errors", "u10_backfill_url_id", "u11_export_source",
    "h03_change_log", "j01_drop_known", "j03_link_by_reference", "j04_link_with_orphans", "j06_not_exported", "j08_foreign_keys",
    "k01_tender_export_all", "k02_minutes_export", "k04_summaries", "k05_report_lines", "k06_mark_exported", "d01_uniqueness",
    "d03_null_counts", "r01_listing_stream", "r02_minutes_stream", "r03_stage_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    only = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    warm_dir = small if os.path.isdir(small) else sf_dir
    work = lambda name, where: QUERIES[name](spark, where).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in only or HEADLINE:
        if not name.startswith("r0"):   # a stream run is its own warm-up: it plans its steps anew each time
            work(name, warm_dir)
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            work(name, sf_dir)
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
        print(f"{name:32s} {seconds[name]:8.3f}", file=sys.stderr)
    spark.stop()
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
                      "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
