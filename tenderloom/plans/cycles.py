"""Whole runs, composed of the operators: collecting, processing, reporting.

Each takes and returns DataFrames; where a step would otherwise be worked off again by later steps, its
result is written to the shared folder and read back.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderloom import schemas as S
from tenderloom.functions.links import first_minutes_href, rebuild_pdf
from tenderloom.operators import enrichment, exports, history, minutes, outcomes, queue, summary, upsert
from tenderloom.session import cut_lineage as kept
from tenderloom.sources import archives, pages

WATCHED = ["status", "estimation"]


@dataclass
class Tables:
    tenders: DataFrame
    pvs: DataFrame


def collect_listing(tables: Tables, listing_pages: DataFrame, base: str, as_of: Column) -> tuple[Tables, DataFrame]:
    """Listing pages (page_id, html) into the tenders table. Also returns the effects."""
    rows = pages.listing_rows(listing_pages, base).select(
        F.col("page_id").alias("page"), F.col("row_no").alias("row"), "url_id", "reference", "date_publication",
        "date_limite", "lien_detail", "objet", "acheteur", "page_hash")
    effects = kept(upsert.upsert_effects(tables.tenders, kept(rows, "listing")), "effects")
    return Tables(kept(upsert.apply_effects(tables.tenders, effects, as_of), "tenders"), tables.pvs), effects


def one_per_url(stored_pages: DataFrame) -> DataFrame:
    """(url, html): the page with the lowest ``page_id`` if there is such a column, else the lowest hash of its text."""
    order = F.col("page_id") if "page_id" in stored_pages.columns else F.md5("html")
    return stored_pages.groupBy("url").agg(F.min_by("html", order).alias("html"))


def enrich(tables: Tables, detail_pages: DataFrame, base: str, as_of: Column, limit: int | None = None,
           max_retry: int = S.MAX_RETRY) -> Tables:
    """Detail pages (url, html) of the queued tenders into the tenders table.

    Pages are joined to the queue before they are read, so only queued ones are parsed. A queued tender without a link or without a stored page
    gets a failure.
    """
    waiting = queue.queue(tables.tenders, "TO_ENRICH", limit, max_retry)
    links = waiting.select(F.col("id").alias("page_id"), F.col("lien_detail").alias("url"))
    wanted = one_per_url(detail_pages.join(links.select("url").distinct(), "url", "left_semi")).join(links, "url")
    details = kept(pages.detail_records(wanted, base), "details").withColumnRenamed("page_id", "id")
    failed = enrichment.missing_links(waiting).unionByName(enrichment.missing_pages(waiting, detail_pages))
    merged = enrichment.merge_details(outcomes.apply_outcomes(tables.tenders, failed, as_of), details, as_of)
    return Tables(kept(merged, "tenders"), tables.pvs)


def _in_order(page: str, row: str) -> Column:
    """One number for page and row in it: 38 digits have room for any page id, hashed or negative, and any row number."""
    return (F.col(page).cast("decimal(19,0)") * F.lit(1 << 31).cast("decimal(10,0)") + F.col(row).cast("decimal(10,0)")).cast("decimal(38,0)")


def collect_minutes(tables: Tables, minutes_pages: DataFrame, detail_pages: DataFrame, base: str,
                    as_of: Column) -> Tables:
    """Minutes pages (page_id, procedure_code, html) into the minutes table; orphans become tenders."""
    codes = minutes_pages.select("page_id", "procedure_code").distinct()
    rows = pages.minutes_rows(minutes_pages, base).join(codes, "page_id")
    found = minutes.tag_procedure(rows).withColumn("seq", _in_order("page_id", "row_no"))
    new = kept(minutes.drop_known(kept(found, "minutes"), tables.tenders, tables.pvs), "new-minutes")
    linked = one_per_url(detail_pages.join(new.select(F.col("lien").alias("url")).distinct(), "url", "left_semi")).select(F.col("url").alias("lien"), rebuild_pdf(first_minutes_href(F.col("html")), base).alias("pv_pdf_url"))
    candidates = kept(new.join(linked, "lien", "left").withColumn("pv_pdf_url", F.coalesce("pv_pdf_url", F.lit(""))), "candidates")
    matched, orphans = minutes.link_with_orphans(candidates, tables.tenders)
    incoming = matched.withColumnRenamed("pv_pdf_url", "pdf_url")
    return Tables(kept(minutes.add_orphans(tables.tenders, orphans, as_of), "tenders"),
                  kept(minutes.save_minutes(tables.pvs, incoming, as_of), "pvs"))


def download(tables: Tables, downloads: DataFrame, as_of: Column, limit: int | None = None, max_retry: int = S.MAX_RETRY) -> Tables:
    """Stored archives (url, archive, content or length) claimed by the tenders queued for download: those with a valid one go on with its path, the others fail.

    Archives are joined to the queue before they are opened, so only queued ones are read.
    """
    waiting = kept(queue.queue(tables.tenders, "TO_DOWNLOAD", limit, max_retry), "waiting")
    wanted = downloads.join(waiting.select(F.col("lien_dce").alias("url")).distinct(), "url", "left_semi")
    results = outcomes.download_outcomes(waiting, kept(archives.stored_files(wanted), "files"))
    return Tables(kept(outcomes.apply_outcomes(tables.tenders, results, as_of), "tenders"), tables.pvs)


def analyze(tables: Tables, stored_archives: DataFrame, documents: DataFrame, as_of: Column,
            limit: int | None = None, max_retry: int = S.MAX_RETRY) -> tuple[Tables, DataFrame]:
    """Archives (archive, content or length) and document texts (tiers in columns) of the queued tenders.

    Returns the tables and the summaries (tender_id, reference, amount, summary).
    """
    waiting = kept(queue.queue(tables.tenders, "TO_ANALYZE", limit, max_retry), "waiting")
    wanted = stored_archives.join(waiting.select(F.col("zip_path").alias("archive")).distinct(), "archive", "left_semi")
    entries = kept(archives.listed(wanted), "entries")
    failed = archives.archive_outcomes(waiting, entries)
    good = waiting.join(failed.select(F.col("tender_id").alias("id")), "id", "left_anti")
    texts = kept(summary.cascade(documents.join(good.select(F.col("id").alias("tender_id")), "tender_id", "left_semi")), "texts")
    found = summary.first_findings(texts).select(F.col("tender_id").alias("id"), "amount")
    done = good.join(found, "id", "left").select(
        "id", F.coalesce(F.nullif("estimation", F.lit(0.0)), "amount").alias("estimation"),
        F.concat(F.col("id").cast("string"), F.lit(".txt")).alias("resume_txt"), F.lit("TO_SYNC").alias("status"))
    tenders = outcomes.set_fields(outcomes.apply_outcomes(tables.tenders, failed, as_of), done, as_of)
    read = tables.tenders.join(done.select("id"), "id", "left_semi")
    return Tables(kept(tenders, "tenders"), tables.pvs), summary.summaries(read, texts, without_texts=True)


def export(tables: Tables, tender_target: str, pv_target: str, as_of: Column, fmt: str = "csv",
           limit: int | None = S.QUEUE_LIMITS["TO_SYNC"], threshold: float = S.BUDGET_THRESHOLD,
           references: DataFrame | None = None, coupled: bool = False, batch: str | None = None) -> Tables:
    """Append both sheets and mark what was written. ``coupled`` skips minutes when no tender waits.

    With ``batch`` the sheets are kept batch by batch: what other batches have exported isn't written again, and a batch that broke off can be repeated.
    """
    rows = kept(queue.export_source(tables.tenders, limit), "export")
    nothing = rows.isEmpty()
    tenders, pvs = tables.tenders, tables.pvs
    if not nothing:
        tenders = (exports.export_tenders(tenders, rows, tender_target, as_of, fmt, threshold, references) if batch is None
                   else exports.export_tenders_once(tenders, rows, tender_target, batch, as_of, fmt, threshold))
    if coupled and nothing:
        return tables
    files = kept(queue.unexported(pvs, limit), "export-pvs")
    if not files.isEmpty():
        pvs = (exports.export_pvs(pvs, files, pv_target, fmt, as_of) if batch is None
               else exports.export_pvs_once(pvs, files, pv_target, batch, as_of, fmt))
    return Tables(tenders, pvs)


def process(tables: Tables, sources: dict[str, DataFrame], base: str, tender_target: str, pv_target: str, batch: str, as_of: Column,
            limit: int | None = None, threshold: float = S.BUDGET_THRESHOLD) -> tuple[Tables, DataFrame | None]:
    """A processing run in its order: minutes, downloads, analysis, export. Steps whose sources aren't given are left out.

    ``sources``: minutes_pages and detail_pages, downloads (url, archive, content or length), documents. Analysis reads the archives that were downloaded. Returns
    the tables and the summaries.
    """
    if {"minutes_pages", "detail_pages"} <= set(sources):
        tables = collect_minutes(tables, sources["minutes_pages"], sources["detail_pages"], base, as_of)
    summaries = None
    if "downloads" in sources:
        tables = download(tables, sources["downloads"], as_of, limit)
        if "documents" in sources:
            tables, summaries = analyze(tables, sources["downloads"].drop("url"), sources["documents"], as_of, limit)
    return export(tables, tender_target, pv_target, as_of, limit=limit, threshold=threshold, batch=batch), summaries


def changes(before: Tables, after: Tables, as_of: Column) -> DataFrame:
    return history.change_log(before.tenders, after.tenders, WATCHED, as_of)


