"""Whole runs over tables derived from the given ones."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tenderloom import schemas as S
from tenderloom.operators import kpi, outcomes, queue
from tenderloom.plans import cycles, report
from tenderloom.sources import bindings as B
from tenderloom.sources.tables import keyed

DAY = dt.date(1998, 6, 15)


def now(day=15):
    return F.lit(f"1998-06-{day} 00:00:00").cast("timestamp")


@pytest.fixture(scope="module")
def collected(spark, sf):
    empty = cycles.Tables(spark.createDataFrame([], S.TENDERS), spark.createDataFrame([], S.PVS))
    return cycles.collect_listing(empty, B.listing_pages(spark, sf), B.BASE, now())


def test_listing_run(spark, sf, collected):
    tables, effects = collected
    n = B.tenders(spark, sf).select(F.when(F.col("id") % 11 == 0, F.col("reference")).otherwise(F.col("id").cast("string")).alias("k")).distinct().count()
    assert tables.tenders.count() == n == effects.filter("is_new").count()
    assert tables.tenders.filter("status = 'TO_ENRICH' AND retry_count = 0").count() == n
    assert tables.tenders.schema.names == S.TENDERS.names
    again, effects2 = cycles.collect_listing(tables, B.listing_pages(spark, sf), B.BASE, now(16))
    assert effects2.filter("is_new").count() == 0
    assert cycles.changes(tables, again, now(16)).count() == 0


def tables_updates(collected):
    """Updates a second look at the same listing brings: rows without a number that share a reference."""
    tables, effects = collected
    spark = tables.tenders.sparkSession
    again, seen = cycles.collect_listing(tables, B.listing_pages(spark, "/root/testdata/sf0.001"), B.BASE, now(16))
    return seen.agg(F.sum("n_updated")).first()[0]


def test_enrich_analyze_export(spark, sf, collected, tmp_path):
    tables, _ = collected
    linked = tables.tenders.filter("lien_detail <> ''")
    details = B.detail_pages(spark, sf).join(linked.select(F.expr("bigint(url_id)").alias("page_id"), F.col("lien_detail").alias("url")), "page_id")
    stored = details.select("url", "html")
    enriched = cycles.enrich(tables, stored.union(stored.limit(50)), B.BASE, now(16))
    t = enriched.tenders
    assert t.count() == t.select("id").distinct().count() == tables.tenders.count()     # a page stored twice is one page
    assert t.filter("status = 'TO_DOWNLOAD'").count() + t.filter("last_error IS NOT NULL").count() >= linked.count()
    assert t.filter(F.col("tender_hash").isNotNull()).groupBy("tender_hash").count().filter("count > 1").count() == 0
    assert t.filter("status = 'TO_DOWNLOAD' AND detail_hash IS NULL").count() == 0
    # the listing's own hash is kept, so the same listing finds nothing changed
    _, seen = cycles.collect_listing(enriched, B.listing_pages(spark, sf), B.BASE, now(17))
    assert seen.agg(F.sum("n_updated")).first()[0] == tables_updates(collected)
    # the page of a tender without a link is missing: one retry more, status kept
    missing = t.filter("lien_detail = ''")
    assert missing.filter(F.col("last_error") == S.ERROR_NO_LINK).count() == missing.count() > 0

    # a page that isn't stored is a failure as well
    unstored = linked.join(details.select("url"), F.col("lien_detail") == F.col("url"), "left_anti").select("id")
    assert t.join(unstored, "id").filter(F.col("last_error") != S.ERROR_UNRESOLVED).count() == 0

    # downloads: each stored archive answers the link of its tender; damaged ones and links without a file fail
    got = t.filter("status = 'TO_DOWNLOAD'").select(F.col("id").alias("tender_id"), F.expr("bigint(url_id)").alias("n"))
    one_link = t.withColumn("lien_dce", F.when(F.col("status") == "TO_DOWNLOAD", F.concat(F.lit("/dce?"), "url_id")).otherwise(F.col("lien_dce")))
    downloads = B.archives(spark, sf).select(F.concat(F.lit("/dce?"), F.regexp_extract("archive", r"(\d+)", 1)).alias("url"), "archive", "content")
    queued = queue.queue(one_link, "TO_DOWNLOAD", None).select("id", F.regexp_extract("lien_dce", r"(\d+)", 1).cast("long").alias("n"))
    ready = cycles.download(cycles.Tables(cycles.kept(one_link, "queued"), enriched.pvs), downloads, now(17))
    stored_ids = downloads.select(F.regexp_extract("url", r"(\d+)", 1).cast("long").alias("n"))
    valid = queued.join(stored_ids, "n").filter("n % 4 < 3").count()
    assert ready.tenders.filter("status = 'TO_ANALYZE' AND zip_path = concat('/dce/', url_id, '.zip')").count() == valid > 0
    assert ready.tenders.filter(F.col("last_error") == S.ERROR_UNRESOLVED).join(queued, "id").count() == queued.count() - valid > 0
    docs = B.documents(spark, sf).drop("ord").join(got.withColumnRenamed("tender_id", "id"), F.col("tender_id") == F.col("n")).select(
        F.col("id").alias("tender_id"), "doc_path", F.lit(0).alias("ord"), "native", "tables", "ocr", "reply")
    analyzed, summaries = cycles.analyze(ready, B.archives(spark, sf), docs, now(18))
    a = analyzed.tenders
    with_pdf = B.archives(spark, sf).filter("tender_id % 4 < 2").select("archive")     # damaged ones were not downloaded
    good = ready.tenders.filter("status = 'TO_ANALYZE'").join(with_pdf, F.col("zip_path") == F.col("archive"), "left_semi")
    assert a.filter("status = 'TO_SYNC'").count() == good.count() > 0
    errors = {r.last_error: r.n for r in a.filter("status = 'TO_ANALYZE'").groupBy("last_error").agg(F.count("*").alias("n")).collect()}
    assert set(errors) == {S.ERROR_NO_PDF}
    assert summaries.filter(F.col("summary").startswith("=== RÉSUMÉ — R")).count() == summaries.count() > 0

    sheet = str(tmp_path / "sheet")
    n = queue.export_source(a, None).count()
    done = cycles.export(analyzed, sheet, str(tmp_path / "pvs"), now(19), limit=None)
    assert done.tenders.filter("status = 'DONE'").count() == n
    header = spark.createDataFrame([], ", ".join(f"`{h}` string" for h in S.TENDER_HEADERS)).schema
    assert keyed(spark, sheet, header, "csv").count() == n


def test_an_export_that_breaks_off_is_repeated(spark, sf, tmp_path, monkeypatch):
    """Stopped between write and mark and repeated, each row is in the sheet once; the next batch appends nothing."""
    from tenderloom.operators import exports
    from tenderloom.operators.quality import conform
    tables = cycles.Tables(cycles.kept(conform(B.tenders(spark, sf), S.TENDERS).dropDuplicates(["reference"]), "t"), conform(B.pvs(spark, sf), S.PVS))
    sheet, minutes_sheet = str(tmp_path / "sheet"), str(tmp_path / "pvs")
    run = lambda t, batch, day: cycles.export(t, sheet, minutes_sheet, now(day), limit=None, batch=batch)
    header = spark.createDataFrame([], ", ".join(f"`{h}` string" for h in S.TENDER_HEADERS)).schema
    with monkeypatch.context() as m:
        m.setattr(exports, "mark", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            run(tables, "a", 16)
    done = run(tables, "a", 16)
    n = queue.export_source(tables.tenders, None).count()
    assert keyed(spark, sheet, header, "csv").count() == n == keyed(spark, sheet, header, "csv").distinct().count() > 0
    assert queue.export_source(done.tenders, None).filter("status = 'TO_SYNC'").count() == 0 and done.pvs.filter("synced_to_sheets = 0").count() == 0
    # the unmarked tables in a later batch: the rows are there already, so they are marked only
    later = run(tables, "b", 17)
    assert keyed(spark, sheet, header, "csv").count() == n
    assert later.tenders.filter("status = 'DONE'").count() == done.tenders.filter("status = 'DONE'").count()


def test_minutes_run(spark, sf, collected):
    tables, _ = collected
    mp = B.minutes_pages(spark, sf).withColumn("procedure_code", F.lit("40"))
    t = B.tenders(spark, sf).filter("id % 7 <> 0 AND id % 3 > 0")
    details = t.select(F.concat(F.lit("/x?EntrepriseDetailConsultation&id="), F.col("id")).alias("url"),
                       F.concat(F.lit("<a href='?page=EntrepriseDownloadAvis&amp;i="), F.expr("id DIV 2"), F.lit("'>pv</a>")).alias("html"))
    out = cycles.collect_minutes(tables, mp, details, B.BASE, now(16))
    want = {r.h for r in t.filter("id % 10 <> 0").select(F.md5(F.concat(
        F.lit(f"{B.BASE}?page=EntrepriseDownloadAvis&i="), F.expr("id DIV 2"))).alias("h")).collect()}
    assert {r.hash_pdf for r in out.pvs.collect()} == want and out.pvs.count() == len(want)
    assert out.pvs.filter("procedure_type <> 'Concours Architectural'").count() == 0
    assert out.pvs.join(out.tenders, F.col("tender_id") == out.tenders.id, "left_anti").count() == 0
    again = cycles.collect_minutes(out, mp, details, B.BASE, now(17))
    assert again.pvs.count() == out.pvs.count() and again.tenders.count() == out.tenders.count()


def test_report_text(spark, sf):
    t, p = B.tenders(spark, sf), B.pvs(spark, sf)
    text = report.render(t, p, DAY, B.THRESHOLD, footer="fin")
    lines = text.split("\n")
    assert lines[0] == "📊 RAPPORT QUOTIDIEN — Marchés Publics — 15/06/1998" and lines[1] == "=" * 60 and lines[-1] == "fin"
    assert f"📁 Total en base               : {t.count()}" in lines
    top = kpi.priorities(t, B.THRESHOLD).first()
    assert next(x for x in lines if x.startswith("  [")).startswith(f"  [{top.reference}] ")
    assert sum(x.startswith("    Budget   : ") for x in lines) == 10
    assert sum(" jour(s)" in x for x in lines) == kpi.expiring(t, DAY).count()
    none = report.render(t.filter("FALSE"), p.filter("FALSE"), DAY)
    assert "OFFRES" not in none and "── Statuts ──" in none


def test_stats_print(spark, sf):
    t = B.tenders(spark, sf)
    lines = report.stats_lines(kpi.kpis(t, DAY), kpi.status_counts(t))
    assert lines[-5] == f"  {'Total':<25} : {t.count()}"


def test_command_line(spark, sf, tmp_path, capsys):
    from tenderloom.operators.quality import conform
    conform(B.tenders(spark, sf), S.TENDERS).write.parquet(str(tmp_path / "t"))
    import tenderloom.__main__ as cli
    cli.main(["report-only", "--tenders", str(tmp_path / "t"), "--as-of", "1998-06-15", "--threshold", "450000"])
    assert "RAPPORT QUOTIDIEN" in capsys.readouterr().out
    cli.main(["reset-errors", "--tenders", str(tmp_path / "t"), "--as-of", "1998-06-15", "--out", str(tmp_path / "out")])
    assert spark.read.parquet(str(tmp_path / "out/tenders")).filter("status LIKE 'ERROR_%' AND status <> 'error_old'").count() == 0
