"""Filters, queues, sorts, aggregates, joins, outcomes, history, exports and audits over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tenderloom import schemas as S
from tenderloom.functions import amounts, dates, text
from tenderloom.operators import (enrichment, exports, history, kpi, minutes, outcomes, quality, queue, retention, upsert)
from tenderloom.plans import prelude as P
from tenderloom.plans.registry import query
from tenderloom.session import scratch_path
from tenderloom.sources import bindings as B
from tenderloom.sources.tables import append, given, keyed

TH = B.THRESHOLD
DAY = "DATE '1998-06-15'"


def _as_of():
    return F.lit(B.AS_OF)


def _now():
    return F.lit("1998-06-15 00:00:00").cast("timestamp_ntz")


def _stamp(name: str):
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


# ---------------------------------------------------------------- scans

@query("s01_scan_tenders", "SELECT id, reference, status, retry_count, estimation FROM tenders")
def s01(spark, d):
    return B.tenders(spark, d).select("id", "reference", "status", "retry_count", "estimation")


@query("s02_scan_pages", "SELECT page_id, url, CAST(length(html) AS BIGINT) AS n_chars FROM pages")
def s02(spark, d):
    return given(spark, d, "pages").select("page_id", "url", F.length("html").cast("long").alias("n_chars"))


@query("s03_scan_document_layers", """SELECT tier, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM (
    SELECT 'native' AS tier, native AS text FROM docs UNION ALL SELECT 'tables', tables FROM docs
    UNION ALL SELECT 'ocr', ocr FROM docs) GROUP BY tier""")
def s03(spark, d):
    return B.document_layers(spark, d).groupBy("tier").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("n_chars"))


# ---------------------------------------------------------------- filters and queues

_RETRY = "(retry_count IS NULL OR retry_count < 3)"


def _queue_sql(status: str, cols: str, limit: int, extra: str = "") -> str:
    return (f"SELECT {cols} FROM tenders WHERE status = '{status}' AND {_RETRY} {extra} "
            f"ORDER BY created_at DESC, id LIMIT {limit}")


@query("f01_enrich_queue", _queue_sql("TO_ENRICH", "id, url_id, reference, lien_detail, date_publication", 50))
def f01e(spark, d):
    return queue.queue(B.tenders(spark, d), "TO_ENRICH", S.QUEUE_LIMITS["TO_ENRICH"])


@query("f01_analyze_queue", _queue_sql("TO_ANALYZE", "id, reference, zip_path, estimation", 20))
def f01a(spark, d):
    return queue.queue(B.tenders(spark, d), "TO_ANALYZE", S.QUEUE_LIMITS["TO_ANALYZE"])


@query("f01_whole_queue", f"SELECT id, reference, zip_path, estimation FROM tenders WHERE status = 'TO_ANALYZE' AND {_RETRY}")
def f01w(spark, d):
    return queue.queue(B.tenders(spark, d), "TO_ANALYZE")


@query("f02_download_queue", _queue_sql("TO_DOWNLOAD", "id, reference, lien_dce", 30, "AND lien_dce IS NOT NULL AND lien_dce <> ''"))
def f02(spark, d):
    return queue.queue(B.tenders(spark, d), "TO_DOWNLOAD", S.QUEUE_LIMITS["TO_DOWNLOAD"])


@query("f03_valid_references", "SELECT page, row_no AS position, reference FROM listing WHERE length(reference) > 2")
def f03(spark, d):
    return B.listing_batch(spark, d).filter(F.length("reference") > 2).select("page", F.col("row").alias("position"), "reference")


@query("f04_high_budget", f"SELECT id, estimation FROM tenders WHERE estimation > {TH}")
def f04(spark, d):
    return B.tenders(spark, d).filter(F.col("estimation") > TH).select("id", "estimation")


@query("f05_error_rows", "SELECT id, status, last_error FROM tenders WHERE status ILIKE 'ERROR%'")
def f05(spark, d):
    return B.tenders(spark, d).filter(kpi.is_error()).select("id", "status", "last_error")


@query("f06_active_rows", """SELECT id, date_limite FROM tenders WHERE status IN ('TO_ENRICH', 'TO_DOWNLOAD', 'TO_ANALYZE', 'TO_SYNC', 'DONE')
    AND date_limite IS NOT NULL""")
def f06(spark, d):
    return B.tenders(spark, d).filter(F.col("status").isin(S.STATUS_FLOW) & F.col("date_limite").isNotNull()).select("id", "date_limite")


@query("f07_unexported_minutes", """SELECT id, reference, procedure_type, date_publication, pdf_url FROM pvs WHERE synced_to_sheets = 0
    ORDER BY created_at DESC, id LIMIT 100""")
def f07(spark, d):
    return queue.unexported(B.pvs(spark, d))


@query("f08_minutes_without_file", """SELECT id, reference, pdf_url FROM pvs WHERE pdf_url <> '' AND (pdf_path IS NULL OR pdf_path = '')
    ORDER BY created_at DESC, id LIMIT 50""")
def f08(spark, d):
    return queue.pending_files(B.pvs(spark, d))


_EXP = f"""SELECT id, reference, objet, acheteur, date_limite, {P.days_left('date_limite')} AS jours FROM tenders
    WHERE status IN ('TO_ENRICH', 'TO_DOWNLOAD', 'TO_ANALYZE', 'TO_SYNC', 'DONE') AND {P.days_left('date_limite')} BETWEEN 0 AND 7"""


@query("f09_expiring", _EXP)
def f09(spark, d):
    return kpi.expiring(B.tenders(spark, d), B.AS_OF)


@query("f10_dead_letters", "SELECT id, status, retry_count FROM tenders WHERE status IN ('TO_ENRICH', 'TO_DOWNLOAD', 'TO_ANALYZE') AND retry_count >= 3")
def f10(spark, d):
    return queue.dead_letters(B.tenders(spark, d)).select("id", "status", "retry_count")


@query("f11_created_on_day", f"SELECT id, reference FROM tenders WHERE CAST(created_at AS DATE) = {DAY}")
def f11(spark, d):
    return B.tenders(spark, d).filter(kpi.on_day("created_at", B.AS_OF)).select("id", "reference")


@query("f12_keep_non_empty", """SELECT t.id, CASE WHEN n.objet <> '' THEN n.objet ELSE t.objet END AS objet,
    CASE WHEN n.acheteur <> '' THEN n.acheteur ELSE t.acheteur END AS acheteur
    FROM tenders t JOIN (SELECT id, CASE WHEN id % 3 = 0 THEN '' ELSE objet END AS objet,
    CASE WHEN id % 2 = 0 THEN NULL ELSE upper(acheteur) END AS acheteur FROM tenders) n USING (id)""")
def f12(spark, d):
    new_objet = F.when(F.col("id") % 3 == 0, "").otherwise(F.col("objet"))
    new_buyer = F.when(F.col("id") % 2 != 0, F.upper("acheteur"))
    return B.tenders(spark, d).select("id", text.keep_non_empty(new_objet, F.col("objet")).alias("objet"),
                                      text.keep_non_empty(new_buyer, F.col("acheteur")).alias("acheteur"))


@query("f13_null_defaults", """SELECT id, COALESCE(objet, '') AS objet, COALESCE(CAST(NULLIF(nb_soumissionnaires, 0) AS VARCHAR), '') AS nb,
    COALESCE(estimation, 0) AS estimation FROM tenders""")
def f13(spark, d):
    return B.tenders(spark, d).select(
        "id", text.or_default(F.col("objet"), "").alias("objet"),
        F.coalesce(F.nullif("nb_soumissionnaires", F.lit(0)).cast("string"), F.lit("")).alias("nb"),
        text.or_default(F.col("estimation"), 0.0, falsy=0.0).alias("estimation"))


@query("f14_priority_flag", f"""SELECT id, CASE WHEN COALESCE(estimation, 0) > {TH} THEN 'OUI' ELSE 'NON' END AS budget_only,
    CASE WHEN COALESCE(estimation, 0) > {TH} AND COALESCE({P.days_left('date_limite')} > 30, FALSE) THEN 'OUI' ELSE 'NON' END AS budget_and_days FROM tenders""")
def f14(spark, d):
    days = dates.days_left(F.col("date_limite"), _as_of())
    return B.tenders(spark, d).select("id", amounts.priority_flag(F.col("estimation"), TH).alias("budget_only"),
                                      amounts.priority_flag(F.col("estimation"), TH, days).alias("budget_and_days"))


@query("f15_merge_estimate", "SELECT id, COALESCE(NULLIF(estimation, 0), montant_reel) AS estimation FROM tenders")
def f15(spark, d):
    return B.tenders(spark, d).select("id", amounts.merge_estimate(F.col("estimation"), F.col("montant_reel")).alias("estimation"))


_END = "TIMESTAMP '2024-01-31 12:00:00'"
_GONE = (f"CASE WHEN (date_diff('microsecond', modified_at, {_END}) // 1000000) // 86400 > CASE kind WHEN 'archive' THEN 7 WHEN 'temp' THEN 7 "
         "WHEN 'log' THEN 30 WHEN 'summary' THEN 30 END THEN TRUE ELSE FALSE END")


def _end():
    return F.lit("2024-01-31 12:00:00").cast("timestamp_ntz")


@query("f16_expired_counts", f"SELECT k.kind, count(files.file_id) AS n_expired FROM (VALUES ('archive'), ('temp'), ('log'), ('summary')) k(kind) LEFT JOIN files ON files.kind = k.kind AND {_GONE.replace('kind WHEN', 'files.kind WHEN')} GROUP BY k.kind")
def f16(spark, d):
    return retention.expired_counts(B.kept_files(spark, d), _end())


@query("f16_survivors", f"SELECT file_id, kind FROM files WHERE NOT {_GONE}")
def f16s(spark, d):
    return retention.split(B.kept_files(spark, d), _end())[0].select("file_id", "kind")


# ---------------------------------------------------------------- sorts and top-k

@query("o01_newest_first", "SELECT id, reference FROM tenders ORDER BY created_at DESC, id LIMIT 100")
def o01(spark, d):
    return queue.newest(B.tenders(spark, d), 100).select("id", "reference")


@query("o02_top_budgets", f"""SELECT id, reference, objet, acheteur, estimation, date_limite FROM tenders
    WHERE status = 'DONE' AND estimation > {TH} ORDER BY estimation DESC, id LIMIT 10""")
def o02(spark, d):
    return kpi.priorities(B.tenders(spark, d), TH)


@query("o03_status_order", "SELECT status, count(*) AS n FROM tenders GROUP BY status ORDER BY n DESC, status")
def o03(spark, d):
    return kpi.status_counts(B.tenders(spark, d))


@query("o04_expiring_by_text", _EXP + " ORDER BY date_limite, id")
def o04(spark, d):
    return kpi.expiring_sorted(B.tenders(spark, d), B.AS_OF)


@query("o04_expiring_by_time", _EXP + " ORDER BY jours, id")
def o04c(spark, d):
    return kpi.expiring_sorted(B.tenders(spark, d), B.AS_OF, chronological=True)


@query("o05_export_batch", "SELECT id, reference FROM tenders WHERE status = 'TO_SYNC' ORDER BY id LIMIT 100")
def o05(spark, d):
    return queue.export_source(B.tenders(spark, d)).select("id", "reference")


# ---------------------------------------------------------------- set operations

@query("e01_procedures_together", """SELECT procedure_type, seq, reference FROM candidates""")
def e01(spark, d):
    tagged = minutes.tag_procedure(B.pv_candidates(spark, d).drop("procedure_type"))
    return tagged.select("procedure_type", "seq", "reference")


@query("e03_phone_union", f"SELECT id, {P.normalize_phone('contact_tel')} AS phones FROM tenders WHERE contact_tel LIKE '%/%'")
def e03(spark, d):
    from tenderloom.functions.phones import phone_numbers
    rows = B.tenders(spark, d).filter(F.col("contact_tel").contains("/"))
    return rows.select("id", F.array_join(phone_numbers(F.col("contact_tel")), "\n").alias("phones"))


# ---------------------------------------------------------------- aggregates

@query("a01_status_counts", "SELECT status, count(*) AS n FROM tenders GROUP BY status ORDER BY n DESC, status")
def a01(spark, d):
    return kpi.status_counts(B.tenders(spark, d))


@query("a02_total", "SELECT count(*) AS total FROM tenders")
def a02(spark, d):
    return B.tenders(spark, d).agg(F.count(F.lit(1)).alias("total"))


@query("a03_new_today", f"SELECT count(*) AS new_today FROM tenders WHERE CAST(created_at AS DATE) = {DAY}")
def a03(spark, d):
    return B.tenders(spark, d).agg(F.count_if(kpi.on_day("created_at", B.AS_OF)).alias("new_today"))


@query("a04_high_budget_count", f"SELECT count(*) AS high_budget FROM tenders WHERE estimation > {TH}")
def a04(spark, d):
    return B.tenders(spark, d).agg(F.count_if(F.col("estimation") > TH).alias("high_budget"))


@query("a05_error_count", "SELECT count(*) AS errors FROM tenders WHERE status ILIKE 'ERROR%'")
def a05(spark, d):
    return B.tenders(spark, d).agg(F.count_if(kpi.is_error()).alias("errors"))


@query("a06_without_url_id", "SELECT count(*) AS without_url_id FROM tenders WHERE url_id IS NULL")
def a06(spark, d):
    return B.tenders(spark, d).agg(F.count_if(F.col("url_id").isNull()).alias("without_url_id"))


@query("a07_minutes_today", f"SELECT count(*) AS pvs_today FROM pvs WHERE CAST(created_at AS DATE) = {DAY}")
def a07(spark, d):
    return kpi.pvs_today(B.pvs(spark, d), B.AS_OF)


@query("a08_kpis", f"""SELECT count(*) AS total, count(*) FILTER (CAST(created_at AS DATE) = {DAY}) AS new_today,
    count(*) FILTER (estimation > {TH}) AS high_budget, count(*) FILTER (status ILIKE 'ERROR%') AS errors,
    count(*) FILTER (url_id IS NULL) AS without_url_id FROM tenders""")
def a08(spark, d):
    return kpi.kpis(B.tenders(spark, d), B.AS_OF, TH)


@query("a09_stage_metrics", """SELECT stage, count(*) FILTER (ok) AS n_ok, count(*) FILTER (NOT ok) AS n_errors, count(*) AS n_processed
    FROM outcomes GROUP BY stage""")
def a09(spark, d):
    return outcomes.run_metrics(B.outcomes(spark, d))


# ---------------------------------------------------------------- outcomes and transitions

def _effects(keep: bool) -> str:
    said = "NOT ok AND error IS NOT NULL" if keep else "NOT ok"
    err = "error" if keep else "COALESCE(error, 'None')"
    return f"""eff AS (SELECT tender_id AS id, CAST(count(*) FILTER (NOT ok) AS INTEGER) AS n_failed,
    arg_max({err}, seq) FILTER ({said}) AS new_error, arg_max(next_status, seq) FILTER (next_status IS NOT NULL) AS new_status,
    arg_max(path, seq) FILTER (path IS NOT NULL) AS new_path FROM outcomes GROUP BY 1)"""


def _applied(keep: bool) -> str:
    return f"""WITH {_effects(keep)} SELECT t.id, CAST(CASE WHEN n_failed > 0 THEN COALESCE(retry_count, 0) + n_failed ELSE retry_count END AS INTEGER)
    AS retry_count, COALESCE(new_error, last_error) AS last_error, COALESCE(new_status, status) AS status,
    COALESCE(new_path, zip_path) AS zip_path FROM tenders t LEFT JOIN eff USING (id)"""


def _apply(spark, d, keep):
    t = outcomes.apply_outcomes(B.tenders(spark, d), B.outcomes(spark, d), keep_previous_error=keep)
    return t.select("id", "retry_count", "last_error", "status", "zip_path")


@query("u04_failures", _applied(True))
def u04(spark, d):
    return _apply(spark, d, True)


@query("u04_failures_overwrite_error", _applied(False))
def u04o(spark, d):
    return _apply(spark, d, False)


@query("u05_mark_done", """SELECT id, CASE WHEN status = 'TO_SYNC' THEN 'DONE' ELSE status END AS status FROM tenders""")
def u05(spark, d):
    t = B.tenders(spark, d)
    return outcomes.mark(t, queue.export_source(t, None), status="DONE").select("id", "status")


@query("u06_set_file_path", """SELECT id, CASE WHEN pdf_url <> '' AND (pdf_path IS NULL OR pdf_path = '') THEN '/pv/new/' || id || '.pdf'
    ELSE pdf_path END AS pdf_path FROM pvs""")
def u06(spark, d):
    p = B.pvs(spark, d)
    done = queue.pending_files(p, None).select("id", F.concat(F.lit("/pv/new/"), F.col("id"), F.lit(".pdf")).alias("pdf_path"))
    return outcomes.set_fields(p, done).select("id", "pdf_path")


_RESET = "status IN ('ERROR_ENRICH', 'ERROR_DOWNLOAD', 'ERROR_ANALYZE', 'ERROR_SYNC')"


@query("u09_reset_errors", f"""SELECT id, CASE WHEN {_RESET} THEN replace(status, 'ERROR_', 'TO_') ELSE status END AS status,
    CASE WHEN {_RESET} THEN 0 ELSE retry_count END AS retry_count, CASE WHEN {_RESET} THEN NULL ELSE last_error END AS last_error FROM tenders""")
def u09(spark, d):
    return outcomes.reset_errors(B.tenders(spark, d)).select("id", "status", "retry_count", "last_error")


@query("u09_reset_count", f"SELECT count(*) AS n_reset FROM tenders WHERE {_RESET}")
def u09c(spark, d):
    return outcomes.reset_count(B.tenders(spark, d))


@query("u11_export_source", "SELECT id, status FROM tenders WHERE status = 'TO_SYNC'")
def u11(spark, d):
    return queue.export_source(B.tenders(spark, d), None).select("id", "status")


@query("u11_export_fallback", "SELECT id, status FROM tenders WHERE status = 'TO_ANALYZE'")
def u11f(spark, d):
    t = B.tenders(spark, d)
    exported = outcomes.mark(t, queue.export_source(t, None), status="DONE")
    return queue.export_source(exported, None).select("id", "status")


_MISSING = "lien_detail IS NULL AND status = 'TO_ENRICH' AND " + _RETRY


@query("u04_missing_links", f"SELECT id, CASE WHEN {_MISSING} THEN COALESCE(retry_count, 0) + 1 ELSE retry_count END AS retry_count, "
       f"CASE WHEN {_MISSING} THEN 'Pas de lien détail' ELSE last_error END AS last_error FROM tenders")
def u04m(spark, d):
    t = B.tenders(spark, d)
    failed = enrichment.missing_links(queue.queue(t, "TO_ENRICH"))
    return outcomes.apply_outcomes(t, failed).select("id", "retry_count", "last_error")


# ---------------------------------------------------------------- upsert with change detection

LISTING_SQL = """WITH l AS (SELECT *, CASE WHEN url_id <> '' THEN 'u:' || url_id ELSE 'r:' || reference END AS key FROM listing),
 st AS (SELECT *, CASE WHEN url_id <> '' THEN 'u:' || url_id ELSE 'r:' || reference END AS key FROM stored_tenders),
 seed AS (SELECT st.key, st.id AS sid, st.hash_content AS shash FROM st JOIN (SELECT key, min(id) AS id FROM st GROUP BY key) m USING (key, id)),
 chain AS (SELECT l.*, sid, shash, lag(page_hash) OVER w AS before, row_number() OVER w AS pos, count(*) OVER (PARTITION BY key) AS n
  FROM l LEFT JOIN seed USING (key) WINDOW w AS (PARTITION BY key ORDER BY page, row_no)),
 flagged AS (SELECT *, CASE WHEN pos > 1 THEN page_hash IS DISTINCT FROM before WHEN sid IS NOT NULL THEN page_hash IS DISTINCT FROM shash
  ELSE FALSE END AS applied FROM chain),
 eff AS (SELECT key, any_value(sid) AS sid, count(*) FILTER (applied) AS n_updated,
  arg_max(date_limite, pos) FILTER (applied) AS limit_set, arg_max(objet, pos) FILTER (applied AND objet <> '') AS objet_set,
  arg_max(acheteur, pos) FILTER (applied AND acheteur <> '') AS acheteur_set FROM flagged GROUP BY key),
 head AS (SELECT key, url_id, reference, date_publication, date_limite, lien_detail, objet, acheteur FROM flagged WHERE pos = 1),
 tail AS (SELECT key, page_hash AS new_hash FROM flagged WHERE pos = n)
"""


@query("u01_upsert", LISTING_SQL + """SELECT s.id, s.url_id, s.reference, s.date_publication, COALESCE(e.limit_set, s.date_limite) AS date_limite,
  s.lien_detail, COALESCE(e.objet_set, s.objet) AS objet, COALESCE(e.acheteur_set, s.acheteur) AS acheteur,
  CASE WHEN e.key IS NULL THEN s.hash_content ELSE tail.new_hash END AS hash_content,
  CASE WHEN e.n_updated > 0 THEN 'TO_ENRICH' ELSE s.status END AS status, s.retry_count,
  CASE WHEN e.key IS NULL THEN strftime(s.last_seen, '%Y-%m-%d') ELSE '1998-06-15' END AS last_seen
 FROM stored_tenders s LEFT JOIN eff e ON e.sid = s.id LEFT JOIN tail ON tail.key = e.key
 UNION ALL SELECT NULL, NULLIF(url_id, ''), reference, date_publication, COALESCE(e.limit_set, head.date_limite), lien_detail,
  COALESCE(e.objet_set, head.objet), COALESCE(e.acheteur_set, head.acheteur), new_hash, 'TO_ENRICH', 0, '1998-06-15'
 FROM eff e JOIN head USING (key) JOIN tail USING (key) WHERE e.sid IS NULL""")
def u01(spark, d):
    stored = B.stored_tenders(spark, d)
    out = upsert.upsert(stored, B.listing_batch(spark, d), _now())
    is_new = F.col("created_at") == _now()
    return out.select(F.when(~is_new, F.col("id")).alias("id"), "url_id", "reference", "date_publication", "date_limite",
                      "lien_detail", "objet", "acheteur", "hash_content", "status", "retry_count",
                      F.date_format("last_seen", "yyyy-MM-dd").alias("last_seen"))


@query("u02_upsert_counters", LISTING_SQL + "SELECT count(*) FILTER (sid IS NULL) AS n_new, CAST(sum(n_updated) AS BIGINT) AS n_updated FROM eff")
def u02(spark, d):
    return upsert.upsert_counters(upsert.upsert_effects(B.stored_tenders(spark, d), B.listing_batch(spark, d)))


@query("w05_change_flags", LISTING_SQL + "SELECT page, row_no AS position, key, CASE WHEN pos = 1 AND sid IS NULL THEN TRUE ELSE applied END AS is_change FROM flagged")
def w05(spark, d):
    from tenderloom.functions.keys import tender_key
    stored = B.stored_tenders(spark, d).withColumn("key", tender_key(F.col("url_id"), F.col("reference")))
    flags = upsert.change_flags(B.listing_batch(spark, d), stored.select("key", "id", "hash_content"))
    return flags.select("page", F.col("row").alias("position"), "key", "is_change")


@query("a09_listing_metrics", LISTING_SQL + """SELECT (SELECT count(DISTINCT page) FROM l) AS pages, (SELECT count(*) FROM l) AS seen,
    count(*) FILTER (sid IS NULL) AS n_new, CAST(sum(n_updated) AS BIGINT) AS n_updated FROM eff""")
def a09l(spark, d):
    batch = B.listing_batch(spark, d)
    return outcomes.listing_metrics(batch, upsert.upsert_effects(B.stored_tenders(spark, d), batch))


# ---------------------------------------------------------------- enrichment

def _details(spark, d):
    """Detail records of the tenders that wait for them, by rule."""
    t = B.tenders(spark, d).filter("status = 'TO_ENRICH'")
    return t.select("id", F.expr("CASE WHEN id % 2 = 0 THEN '' ELSE concat('Détail ', id) END").alias("objet"),
                    F.expr("CASE WHEN id % 5 = 0 OR id % 10 = 9 THEN '' ELSE 'Commune ' END").alias("acheteur"),
                    F.expr("double(id * 10)").alias("estimation"), F.lit("").alias("domaines"), "contact_nom", "contact_email",
                    "contact_tel", "contact_fax", F.expr("concat('/f/', id)").alias("lien_dce"), "attributaire", "montant_reel",
                    "date_attribution", "nb_soumissionnaires", F.expr("md5(concat('page', id))").alias("hash_content"))


_DETAIL = """det AS (SELECT id, CASE WHEN id % 2 = 0 THEN '' ELSE 'Détail ' || id END AS n_objet,
    CASE WHEN id % 5 = 0 OR id % 10 = 9 THEN '' ELSE 'Commune ' END AS n_acheteur, CAST(id * 10 AS DOUBLE) AS n_estimation, '/f/' || id AS n_dce,
    md5('page' || id) AS n_hash, sha256(reference || '|' || trim(date_publication) || '|' || CASE WHEN id % 5 = 0 OR id % 10 = 9 THEN '' ELSE 'commune' END) AS th
    FROM tenders WHERE status = 'TO_ENRICH'),
 firsts AS (SELECT th, min(id) AS first_id FROM det GROUP BY th),
 held AS (SELECT tender_hash AS th, min(id) AS low, max(id) AS high FROM tenders WHERE tender_hash IS NOT NULL GROUP BY 1),
 judged AS (SELECT det.*, NOT CASE WHEN low IS NOT NULL THEN low = id AND high = id ELSE id = first_id END AS dup
  FROM det JOIN firsts USING (th) LEFT JOIN held USING (th))"""


@query("u03_merge_details", f"""WITH {_DETAIL} SELECT t.id, CASE WHEN NOT dup AND n_objet <> '' THEN n_objet ELSE objet END AS objet,
    CASE WHEN NOT dup AND n_acheteur <> '' THEN n_acheteur ELSE acheteur END AS acheteur,
    CASE WHEN NOT dup THEN n_estimation ELSE estimation END AS estimation, CASE WHEN NOT dup THEN n_dce ELSE lien_dce END AS lien_dce,
    CASE WHEN NOT dup THEN n_hash ELSE hash_content END AS hash_content, CASE WHEN NOT dup THEN th ELSE tender_hash END AS tender_hash,
    CASE WHEN NOT dup THEN 'TO_DOWNLOAD' ELSE status END AS status,
    CASE WHEN dup THEN COALESCE(retry_count, 0) + 1 ELSE retry_count END AS retry_count,
    CASE WHEN dup THEN 'UNIQUE constraint failed: tenders.tender_hash' ELSE last_error END AS last_error
    FROM tenders t LEFT JOIN judged USING (id)""")
def u03(spark, d):
    t = enrichment.merge_details(B.tenders(spark, d), _details(spark, d), _now(), shared_hash=True)
    return t.select("id", "objet", "acheteur", "estimation", "lien_dce", "hash_content", "tender_hash", "status", "retry_count", "last_error")


@query("w04_hash_guard", f"WITH {_DETAIL} SELECT id, th AS new_hash, dup AS is_duplicate FROM judged")
def w04(spark, d):
    t = B.tenders(spark, d)
    j = enrichment.hash_winners(enrichment.with_hash(t, _details(spark, d)), t)
    return j.select("id", "new_hash", "is_duplicate")


_BACK = r"""before AS (SELECT id, CASE WHEN id % 4 = 0 THEN NULL ELSE url_id END AS url_id,
    CASE WHEN id % 6 = 0 THEN 'index.php?refConsultation=' || (id // 5) ELSE lien_detail END AS lien_detail FROM tenders),
 f AS (SELECT id, NULLIF(regexp_extract(lien_detail, '[?&]refConsultation=(\d+)', 1), '') AS found FROM before WHERE url_id IS NULL),
 win AS (SELECT found, min(id) AS id FROM f WHERE found IS NOT NULL AND found NOT IN (SELECT url_id FROM before WHERE url_id IS NOT NULL) GROUP BY found)"""


def _before_backfill(spark, d):
    return B.tenders(spark, d).withColumns({
        "url_id": F.expr("CASE WHEN id % 4 = 0 THEN NULL ELSE url_id END"),
        "lien_detail": F.expr("CASE WHEN id % 6 = 0 THEN concat('index.php?refConsultation=', id DIV 5) ELSE lien_detail END")})


@query("u10_backfill_url_id", f"WITH {_BACK} SELECT b.id, COALESCE(b.url_id, win.found) AS url_id FROM before b LEFT JOIN win ON win.id = b.id")
def u10(spark, d):
    return enrichment.backfill_url_id(_before_backfill(spark, d)).select("id", "url_id")


@query("w02_first_per_number", f"WITH {_BACK} SELECT win.id, win.found AS url_id FROM win")
def w02(spark, d):
    before = _before_backfill(spark, d)
    after = enrichment.backfill_url_id(before).select("id", "url_id")
    old = before.select("id", F.col("url_id").alias("old"))
    return after.join(old, "id").filter("old IS NULL AND url_id IS NOT NULL").select("id", "url_id")


# ---------------------------------------------------------------- history

_LOG = """SELECT id AS tender_id, n.reference, '{f}' AS field, CAST(o.{f} AS VARCHAR) AS old_value, CAST(n.{f} AS VARCHAR) AS new_value
    FROM tenders o JOIN next_tenders n USING (id) WHERE {w}"""
_STATUS_LOG = _LOG.format(f="status", w="o.status <> n.status")
_EST_LOG = _LOG.format(f="estimation", w="o.estimation IS DISTINCT FROM n.estimation")
_OBJ_LOG = _LOG.format(f="objet", w="o.objet IS DISTINCT FROM n.objet")


@query("h01_status_log", _STATUS_LOG)
def h01(spark, d):
    return history.status_log(B.tenders(spark, d), B.next_snapshot(spark, d), _now()).drop("changed_at")


@query("h02_estimate_log", _EST_LOG)
def h02(spark, d):
    return history.estimate_log(B.tenders(spark, d), B.next_snapshot(spark, d), _now()).drop("changed_at")


@query("h03_change_log", f"{_STATUS_LOG} UNION ALL {_EST_LOG} UNION ALL {_OBJ_LOG}")
def h03(spark, d):
    return history.change_log(B.tenders(spark, d), B.next_snapshot(spark, d), ["status", "estimation", "objet"], _now()).drop("changed_at")


@query("h04_updated_at", """SELECT id, CASE WHEN status = 'TO_SYNC' THEN '1998-06-15 00:00:00' ELSE strftime(updated_at, '%Y-%m-%d %H:%M:%S') END AS updated_at FROM tenders""")
def h04(spark, d):
    t = B.tenders(spark, d)
    return history.bump_updated_at(t, t.filter("status = 'TO_SYNC'"), _now()).select("id", _stamp("updated_at"))


# ---------------------------------------------------------------- minutes: joins, orphans, storing

@query("j01_drop_known", """SELECT c.seq, c.reference, c.lien FROM candidates c
    WHERE NOT (c.uid IS NOT NULL AND EXISTS (SELECT 1 FROM stored_pvs p JOIN stored_tenders t ON p.tender_id = t.id WHERE t.url_id = c.uid))
    AND NOT EXISTS (SELECT 1 FROM stored_pvs p WHERE p.reference = c.reference)""")
def j01(spark, d):
    c = minutes.drop_known(B.pv_candidates(spark, d), B.stored_tenders(spark, d), B.stored_pvs(spark, d))
    return c.select("seq", "reference", "lien")


@query("j01_drop_known_files", """SELECT c.seq, c.reference, c.lien FROM candidates c
    WHERE c.pv_pdf_url = '' OR NOT EXISTS (SELECT 1 FROM stored_pvs p WHERE p.hash_pdf = md5(c.pv_pdf_url))""")
def j01f(spark, d):
    c = minutes.drop_known(B.pv_candidates(spark, d), B.stored_tenders(spark, d), B.stored_pvs(spark, d), per="file")
    return c.select("seq", "reference", "lien")


@query("j02_link_by_number", """SELECT c.seq, t.id AS id_by_uid FROM candidates c JOIN stored_tenders t ON t.url_id = c.uid""")
def j02(spark, d):
    linked = minutes.link(B.pv_candidates(spark, d), B.stored_tenders(spark, d))
    return linked.filter("id_by_uid IS NOT NULL").select("seq", "id_by_uid")


_NEWEST = """newest AS (SELECT reference, id FROM (SELECT *, row_number() OVER (PARTITION BY reference ORDER BY created_at DESC, id) AS rn
    FROM stored_tenders) WHERE rn = 1)"""


@query("j03_link_by_reference", f"""WITH {_NEWEST} SELECT c.seq, t.id AS id_by_uid, CASE WHEN t.id IS NULL THEN n.id END AS id_by_ref
    FROM candidates c LEFT JOIN stored_tenders t ON t.url_id = c.uid LEFT JOIN newest n ON n.reference = c.reference""")
def j03(spark, d):
    return minutes.link(B.pv_candidates(spark, d), B.stored_tenders(spark, d)).select("seq", "id_by_uid", "id_by_ref")


@query("w01_newest_by_reference", f"WITH {_NEWEST} SELECT reference, id AS id_by_ref FROM newest")
def w01(spark, d):
    return minutes.newest_by_reference(B.stored_tenders(spark, d))


# first come, first served: the rows in order are folded into the lists of founders, their numbers and their references
_ORPHANS = f"""WITH {_NEWEST}, base AS (
    SELECT c.*, t.id AS id_by_uid, CASE WHEN t.id IS NULL THEN n.id END AS id_by_ref FROM candidates c
    LEFT JOIN (SELECT url_id, min(id) AS id FROM stored_tenders WHERE url_id IS NOT NULL GROUP BY url_id) t ON t.url_id = c.uid
    LEFT JOIN newest n ON n.reference = c.reference WHERE c.pv_pdf_url <> ''),
 free AS (SELECT uid, reference, min(seq) AS seq FROM base WHERE id_by_uid IS NULL AND id_by_ref IS NULL GROUP BY uid, reference),
 founders AS (SELECT unnest(list_reduce(list(struct_pack(u := CASE WHEN uid IS NULL THEN CAST([] AS VARCHAR[]) ELSE [uid] END, r := [reference], f := [seq]) ORDER BY seq),
    lambda held, x: CASE WHEN list_has_any(held.u, x.u) OR list_has_any(held.r, x.r) THEN held
    ELSE struct_pack(u := held.u || x.u, r := held.r || x.r, f := held.f || x.f) END).f) AS seq FROM free),
 orphans AS (SELECT b.* FROM base b JOIN founders USING (seq))"""


@query("j04_link_with_orphans", _ORPHANS + """
SELECT b.seq, CASE WHEN b.id_by_uid IS NOT NULL THEN b.id_by_uid WHEN u.seq <= b.seq THEN NULL ELSE b.id_by_ref END AS stored_id,
  CASE WHEN b.id_by_uid IS NOT NULL THEN NULL WHEN u.seq <= b.seq THEN u.seq WHEN b.id_by_ref IS NULL THEN r.seq END AS founder_seq
FROM base b LEFT JOIN orphans u ON u.uid = b.uid LEFT JOIN orphans r ON r.reference = b.reference""")
def j04(spark, d):
    linked, orphans = minutes.link_with_orphans(B.pv_candidates(spark, d), B.stored_tenders(spark, d))
    founded = orphans.select(F.col("id").alias("tender_id"), F.col("seq").alias("founder_seq"))
    j = linked.join(founded, "tender_id", "left")
    return j.select("seq", F.when(F.col("founder_seq").isNull(), F.col("tender_id")).alias("stored_id"), "founder_seq")


@query("w03_orphan_tenders", _ORPHANS + " SELECT uid, reference, seq, lien, objet FROM orphans")
def w03(spark, d):
    _, orphans = minutes.link_with_orphans(B.pv_candidates(spark, d), B.stored_tenders(spark, d))
    return orphans.select("uid", "reference", "seq", "lien", "objet")


@query("j05_upsert_match", LISTING_SQL + "SELECT DISTINCT key, sid AS stored_id FROM flagged")
def j05(spark, d):
    e = upsert.upsert_effects(B.stored_tenders(spark, d), B.listing_batch(spark, d))
    return e.select("key", F.when(~F.col("is_new"), F.col("id")).alias("stored_id"))


_TARGET = "(SELECT DISTINCT replace('''' || reference, '''', '') AS reference FROM tenders WHERE status = 'DONE')"


def _target(spark, d):
    """An export target that already holds the finished tenders."""
    done = B.tenders(spark, d).filter("status = 'DONE'")
    return exports.exported_references(done.select(F.concat(F.lit("'"), F.col("reference")).alias("Référence")))


@query("j06_not_exported", f"SELECT id, reference FROM tenders WHERE status = 'TO_SYNC' AND reference NOT IN {_TARGET}")
def j06(spark, d):
    rows = queue.export_source(B.tenders(spark, d), None)
    return exports.not_exported(rows, _target(spark, d)).select("id", "reference")


@query("e04_exported_keys", _TARGET[1:-1])
def e04(spark, d):
    return _target(spark, d)


@query("j07_merge_stage_results", """SELECT id, CASE WHEN id % 2 = 0 THEN '/new/' || id ELSE zip_path END AS zip_path,
    CASE WHEN id % 2 = 0 THEN NULL ELSE estimation END AS estimation FROM tenders""")
def j07(spark, d):
    t = B.tenders(spark, d)
    results = t.filter("id % 2 = 0").select("id", F.concat(F.lit("/new/"), F.col("id")).alias("zip_path"),
                                            F.lit(None).cast("double").alias("estimation"))
    return outcomes.set_fields(t, results).select("id", "zip_path", "estimation")


@query("j08_foreign_keys", "SELECT id, tender_id FROM pvs WHERE tender_id NOT IN (SELECT id FROM stored_tenders)")
def j08(spark, d):
    return quality.without_tender(B.pvs(spark, d), B.stored_tenders(spark, d)).select("id", "tender_id")


@query("j09_cascade_delete", "SELECT id, tender_id FROM pvs WHERE tender_id IN (SELECT id FROM tenders WHERE status <> 'DONE')")
def j09(spark, d):
    return minutes.cascade_delete(B.pvs(spark, d), B.tenders(spark, d).filter("status <> 'DONE'")).select("id", "tender_id")


@query("j10_mark_by_ids", "SELECT id, CASE WHEN synced_to_sheets = 0 THEN 1 ELSE synced_to_sheets END AS synced_to_sheets FROM pvs")
def j10(spark, d):
    p = B.pvs(spark, d)
    return outcomes.mark(p, queue.unexported(p, None), synced_to_sheets=1).select("id", "synced_to_sheets")


@query("j11_procedure_names", "SELECT seq, procedure_code, procedure_type FROM candidates")
def j11(spark, d):
    tagged = minutes.tag_procedure(B.pv_candidates(spark, d).drop("procedure_type"))
    return tagged.select("seq", "procedure_code", "procedure_type")


_SAVED = """old AS (SELECT hash_pdf, arg_min(tender_id, id) AS tender_id, arg_min(reference, id) AS reference, arg_min(procedure_type, id) AS procedure_type,
  COALESCE(arg_min(date_publication, id) FILTER (date_publication <> ''), '') AS d FROM stored_pvs WHERE hash_pdf IS NOT NULL GROUP BY 1),
 new AS (SELECT hash_pdf, arg_min(tender_id, id) AS tender_id, arg_min(reference, id) AS reference, arg_min(procedure_type, id) AS procedure_type,
  COALESCE(arg_min(date_publication, id) FILTER (date_publication <> ''), '') AS d FROM pvs WHERE hash_pdf IS NOT NULL GROUP BY 1)"""


def _stored_minutes(spark, d):
    """Stored minutes without repeats, as the save operator itself leaves them."""
    rows = B.stored_pvs(spark, d)
    empty = spark.createDataFrame([], rows.drop("procedure_code").schema)
    return minutes.save_minutes(empty, rows.withColumn("seq", F.col("id")), _now())


@query("u07_save_minutes", f"""WITH {_SAVED} SELECT hash_pdf, COALESCE(old.tender_id, new.tender_id) AS tender_id,
    COALESCE(old.reference, new.reference) AS reference, COALESCE(old.procedure_type, new.procedure_type) AS procedure_type,
    CASE WHEN old.d <> '' THEN old.d ELSE new.d END AS date_publication FROM new LEFT JOIN old USING (hash_pdf)""")
def u07(spark, d):
    out = minutes.save_minutes(_stored_minutes(spark, d), B.pvs(spark, d).withColumn("seq", F.col("id")), _now())
    return out.select("hash_pdf", "tender_id", "reference", "procedure_type", "date_publication")


@query("w06_first_minutes", f"WITH {_SAVED} SELECT hash_pdf, tender_id, reference, d AS date_publication FROM new")
def w06(spark, d):
    f = minutes.first_minutes(B.pvs(spark, d).withColumn("seq", F.col("id")))
    return f.select("hash_pdf", "r.tender_id", "r.reference", F.col("d").alias("date_publication"))


@query("u08_minutes_with_address", "SELECT seq, reference FROM candidates WHERE pv_pdf_url <> ''")
def u08(spark, d):
    return minutes.with_address(B.pv_candidates(spark, d)).select("seq", "reference")


# ---------------------------------------------------------------- exports and report

def _export_sql(where: str, days_rule: bool = False) -> str:
    flag = f"COALESCE(estimation, 0) > {TH}" + (f" AND COALESCE({P.days_left('date_limite')} > 30, FALSE)" if days_rule else "")
    values = ["'''' || reference", P.normalize_date("date_publication"), P.normalize_date("date_limite"), "COALESCE(objet, '')",
              "COALESCE(acheteur, '')", P.format_amount("estimation"), "COALESCE(domaines, '')", "COALESCE(contact_nom, '')",
              "COALESCE(contact_email, '')", P.normalize_phone("contact_tel"), P.normalize_phone("contact_fax"), "COALESCE(attributaire, '')",
              P.format_amount("montant_reel"), P.normalize_date("date_attribution"),
              "COALESCE(CAST(NULLIF(nb_soumissionnaires, 0) AS VARCHAR), '')", P.days_label("date_limite"),
              f"CASE WHEN {flag} THEN 'OUI' ELSE 'NON' END"]
    cols = ", ".join(f'{v} AS "{h}"' for v, h in zip(values, S.TENDER_HEADERS))
    return f"SELECT id, {cols} FROM tenders WHERE {where}"


@query("k01_tender_export", _export_sql(f"status = 'TO_SYNC' AND reference NOT IN {_TARGET}"))
def k01(spark, d):
    rows = exports.not_exported(queue.export_source(B.tenders(spark, d), None), _target(spark, d))
    return exports.tender_export(rows, _as_of(), TH, keep=["id"])


@query("k01_tender_export_all", _export_sql("TRUE", days_rule=True))
def k01a(spark, d):
    return exports.tender_export(B.tenders(spark, d), _as_of(), TH, rule="budget_and_days", keep=["id"])


_PV_EXPORT = (f"""SELECT id, reference AS "Référence", procedure_type AS "Procédure", {P.normalize_date('date_publication')} AS "Date Publication",
    pdf_url AS "Lien PDF", '✓' AS "Synchronisé" FROM pvs WHERE synced_to_sheets = 0""")


@query("k02_minutes_export", _PV_EXPORT)
def k02(spark, d):
    return exports.pv_export(B.pvs(spark, d).filter("synced_to_sheets = 0"), keep=["id"])


@query("k03_csv_target", _PV_EXPORT)
def k03(spark, d):
    """Written to a new CSV target with a header and read back."""
    path = scratch_path(spark, "export")
    rows = exports.pv_export(B.pvs(spark, d).filter("synced_to_sheets = 0"), keep=["id"])
    append(rows, path, "csv")
    return keyed(spark, path, rows.schema, "csv")


@query("k06_mark_exported", f"""SELECT id, CASE WHEN status = 'TO_SYNC' THEN 'DONE' ELSE status END AS status,
    CASE WHEN status = 'TO_SYNC' THEN '1998-06-15 00:00:00' ELSE strftime(updated_at, '%Y-%m-%d %H:%M:%S') END AS updated_at FROM tenders""")
def k06(spark, d):
    t = B.tenders(spark, d)
    path = scratch_path(spark, "sheet")
    out = exports.export_tenders(t, queue.export_source(t, None), path, _as_of(), "parquet", TH, _target(spark, d))
    return out.select("id", "status", _stamp("updated_at"))


_REPORT = f"""WITH soon AS ({_EXP}),
 k AS (SELECT count(*) AS total, count(*) FILTER (CAST(created_at AS DATE) = {DAY}) AS new_today, count(*) FILTER (status ILIKE 'ERROR%') AS errors FROM tenders),
 p AS (SELECT count(*) AS pvs_today FROM pvs WHERE CAST(created_at AS DATE) = {DAY}),
 top AS (SELECT * FROM tenders WHERE status = 'DONE' AND estimation > {TH} ORDER BY estimation DESC, id LIMIT 10)
 SELECT 1 AS section, 0::DOUBLE AS weight, '' AS sort_text, 0::BIGINT AS id, '🆕 Nouvelles offres aujourd''hui : ' || new_today AS line FROM k
 UNION ALL SELECT 1, -1, '', 0, '📋 Nouveaux PVs aujourd''hui    : ' || pvs_today FROM p
 UNION ALL SELECT 1, -2, '', 0, '📁 Total en base               : ' || total FROM k
 UNION ALL SELECT 1, -3, '', 0, '❌ Erreurs pipeline            : ' || errors FROM k
 UNION ALL SELECT 2, n, status, 0, '  ' || rpad(status, 20, ' ') || ': ' || n FROM (SELECT status, count(*) AS n FROM tenders GROUP BY 1)
 UNION ALL SELECT 3, estimation, '', id, '  [' || reference || '] ' || left(COALESCE(objet, ''), 50) || chr(10) || '    Acheteur : '
  || COALESCE(NULLIF(acheteur, ''), 'N/A') || chr(10) || '    Budget   : ' || replace(format('{{:,}}', CAST(trunc(estimation) AS BIGINT)), ',', ' ')
  || ' DH | Limite : ' || COALESCE(NULLIF(date_limite, ''), 'N/A') FROM top
 UNION ALL SELECT 4, 0, date_limite, id, '  [' || reference || '] ' || left(COALESCE(objet, ''), 50) || chr(10) || '    Limite : ' || date_limite
  || ' — dans ' || jours || ' jour(s)' FROM soon"""


@query("k05_report_lines", _REPORT)
def k05(spark, d):
    return kpi.report_lines(B.tenders(spark, d), B.pvs(spark, d), B.AS_OF, TH)


@query("a10_report_bundle", f"""WITH soon AS ({_EXP}) SELECT (SELECT count(*) FROM tenders) AS total,
    (SELECT count(*) FROM tenders WHERE CAST(created_at AS DATE) = {DAY}) AS new_today,
    (SELECT count(*) FROM tenders WHERE status ILIKE 'ERROR%') AS errors,
    (SELECT count(*) FROM pvs WHERE CAST(created_at AS DATE) = {DAY}) AS pvs_today,
    (SELECT count(DISTINCT status) FROM tenders) AS n_statuses,
    (SELECT least(10, count(*)) FROM tenders WHERE status = 'DONE' AND estimation > {TH}) AS n_priorities,
    (SELECT count(*) FROM soon) AS n_expiring""")
def a10(spark, d):
    t, p = B.tenders(spark, d), B.pvs(spark, d)
    n = lambda df: df.agg(F.count(F.lit(1))).scalar()
    return kpi.kpis(t, B.AS_OF, TH).select(
        "total", "new_today", "errors", kpi.pvs_today(p, B.AS_OF).scalar().alias("pvs_today"),
        n(kpi.status_counts(t)).alias("n_statuses"), n(kpi.priorities(t, TH)).alias("n_priorities"),
        n(kpi.expiring(t, B.AS_OF)).alias("n_expiring"))


# ---------------------------------------------------------------- data quality

@query("d01_uniqueness", """SELECT 'url_id' AS field, url_id AS value, count(*) AS n FROM tenders WHERE url_id IS NOT NULL GROUP BY url_id HAVING n > 1
    UNION ALL SELECT 'tender_hash', tender_hash, count(*) AS n FROM tenders WHERE tender_hash IS NOT NULL GROUP BY tender_hash HAVING n > 1
    UNION ALL SELECT 'hash_pdf', hash_pdf, count(*) AS n FROM pvs WHERE hash_pdf IS NOT NULL GROUP BY hash_pdf HAVING n > 1""")
def d01(spark, d):
    return quality.uniqueness_audit(B.tenders(spark, d), B.pvs(spark, d)).select("field", "value", "n")


@query("d02_foreign_key_count", "SELECT count(*) AS n_broken FROM pvs WHERE tender_id NOT IN (SELECT id FROM stored_tenders)")
def d02(spark, d):
    return quality.without_tender(B.pvs(spark, d), B.stored_tenders(spark, d)).agg(F.count(F.lit(1)).alias("n_broken"))


def _gaps(*columns):
    """Some required values left out, so that the audit has something to find."""
    return {c: F.when(F.col("id") % p != 0, F.col(c)) for c, p in columns}


@query("d03_null_counts", """SELECT 'tenders' AS "table", 'reference' AS field, count(*) FILTER (reference IS NULL OR id % 31 = 0) AS n_null FROM tenders
    UNION ALL SELECT 'tenders', 'status', count(*) FILTER (status IS NULL OR id % 37 = 0) FROM tenders
    UNION ALL SELECT 'pvs', 'tender_id', count(*) FILTER (tender_id IS NULL OR id % 41 = 0) FROM pvs
    UNION ALL SELECT 'history', 'field', 0""")
def d03(spark, d):
    tenders = B.tenders(spark, d)
    log = history.change_log(tenders, B.next_snapshot(spark, d), ["status", "estimation"], _now())
    return quality.required_audit({"tenders": tenders.withColumns(_gaps(("reference", 31), ("status", 37))),
                                   "pvs": B.pvs(spark, d).withColumns(_gaps(("tender_id", 41))), "history": log})


@query("d04_conform_schema", """SELECT id, reference, status, CAST(NULL AS VARCHAR) AS url_id, CAST(NULL AS VARCHAR) AS tender_hash, 0 AS retry_count,
    CAST(NULL AS DOUBLE) AS montant_reel, CAST(NULL AS VARCHAR) AS last_error FROM tenders""")
def d04(spark, d):
    old = B.tenders(spark, d).drop(*S.ADDED_COLUMNS)
    new = quality.conform(old, S.TENDERS, quality.TENDER_DEFAULTS)
    return new.select("id", "reference", "status", "url_id", "tender_hash", "retry_count", "montant_reel", "last_error")


@query("d05_insert_defaults", """SELECT id, CASE WHEN id % 2 = 0 THEN 'TO_ENRICH' ELSE status END AS status, COALESCE(retry_count, 0) AS retry_count FROM tenders""")
def d05(spark, d):
    rows = B.tenders(spark, d).withColumn("status", F.when(F.col("id") % 2 != 0, F.col("status")))
    return quality.insert_defaults(rows, _now()).select("id", "status", "retry_count")
