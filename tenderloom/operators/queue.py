"""Work queues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderloom import schemas as S

QUEUE_COLUMNS = {
    "TO_ENRICH": ["id", "url_id", "reference", "lien_detail", "date_publication"],
    "TO_DOWNLOAD": ["id", "reference", "lien_dce"],
    "TO_ANALYZE": ["id", "reference", "zip_path", "estimation"],
}


def newest(df: DataFrame, limit: int | None) -> DataFrame:
    """Newest first, ties by id; sort and limit fuse into one top-k."""
    ordered = df.orderBy(F.desc("created_at"), F.asc("id"))
    return ordered if limit is None else ordered.limit(limit)


def may_retry(max_retry: int = S.MAX_RETRY) -> Column:
    return F.col("retry_count").isNull() | (F.col("retry_count") < max_retry)


def queue(tenders: DataFrame, status: str, limit: int | None = None, max_retry: int = S.MAX_RETRY,
          columns: list[str] | None = None, extra: Column | None = None) -> DataFrame:
    """Rows waiting for a stage, newest first. ``extra`` narrows the queue further."""
    waiting = tenders.filter((F.col("status") == status) & may_retry(max_retry))
    if status == "TO_DOWNLOAD":
        waiting = waiting.filter(F.length("lien_dce") > 0)
    if extra is not None:
        waiting = waiting.filter(extra)
    return newest(waiting, limit).select(*(columns or QUEUE_COLUMNS.get(status, tenders.columns)))


def dead_letters(tenders: DataFrame, max_retry: int = S.MAX_RETRY) -> DataFrame:
    """Waiting rows that no queue hands out any more."""
    waiting = F.col("status").isin(["TO_ENRICH", "TO_DOWNLOAD", "TO_ANALYZE"])
    return tenders.filter(waiting & (F.col("retry_count") >= max_retry))


def pending_files(pvs: DataFrame, limit: int | None = S.PENDING_PV_LIMIT) -> DataFrame:
    """Minutes with an address and no local file yet."""
    waiting = pvs.filter((F.length("pdf_url") > 0) & (F.coalesce(F.length("pdf_path"), F.lit(0)) == 0))
    return newest(waiting, limit).select("id", "reference", "pdf_url")


def unexported(pvs: DataFrame, limit: int | None = S.QUEUE_LIMITS["TO_SYNC"]) -> DataFrame:
    return newest(pvs.filter(F.col("synced_to_sheets") == 0), limit).select(
        "id", "reference", "procedure_type", "date_publication", "pdf_url")


def export_source(tenders: DataFrame, limit: int | None = S.QUEUE_LIMITS["TO_SYNC"]) -> DataFrame:
    """Rows to export: ``TO_SYNC`` rows, or ``TO_ANALYZE`` rows when there is not one of the former.

    Which of the two is a scalar subquery: one flag per table, no join.
    """
    any_sync = tenders.agg(F.coalesce(F.bool_or(F.col("status") == "TO_SYNC"), F.lit(False))).scalar()
    wanted = F.when(any_sync, F.lit("TO_SYNC")).otherwise(F.lit("TO_ANALYZE"))
    rows = tenders.filter(F.col("status").isin("TO_SYNC", "TO_ANALYZE") & (F.col("status") == wanted)).orderBy("id")
    return rows if limit is None else rows.limit(limit)
