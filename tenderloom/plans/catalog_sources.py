"""Pages, archives and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from tenderloom.functions import links, text
from tenderloom.operators import summary
from tenderloom.plans import prelude as P
from tenderloom.plans.catalog_text import CASCADE_SQL
from tenderloom.plans.registry import query
from tenderloom.schemas import KEY_POINTS
from tenderloom.session import scratch_path
from tenderloom.sources import archive_files, archives, bindings as B, pages
from tenderloom.sources.tables import given

# ---------------------------------------------------------------- pages


@query("x01_listing_rows", f"""SELECT id // 500 AS page_id, reference, strftime(created_at, '%d/%m/%Y') AS date_publication,
    COALESCE(date_limite, '') AS date_limite,
    CASE WHEN id % 11 = 0 THEN '' ELSE '{P.BASE}?page=entreprise.EntrepriseDetailConsultation&refConsultation=' || id END AS lien_detail,
    CASE id % 3 WHEN 0 THEN 'Voirie & eau n° ' || id WHEN 1 THEN 'Pont ' || id || 'suite' ELSE '' END AS objet, acheteur,
    CASE id % 2 WHEN 0 THEN 'Rabat' ELSE 'Fès' END AS lieu, CASE WHEN id % 11 = 0 THEN '' ELSE CAST(id AS VARCHAR) END AS url_id
    FROM tenders WHERE length(reference) > 2""")
def x01(spark, d):
    return pages.listing_rows(B.listing_pages(spark, d), B.BASE).drop("row_no", "page_hash")


@query("x02_detail_records", f"""SELECT id AS page_id,
    CASE id % 3 WHEN 0 THEN 'Route ' || id WHEN 1 THEN 'Pont ' || id ELSE '' END AS objet, acheteur, 'Oujda' AS lieu, '' AS domaines,
    CASE WHEN estimation IS NULL THEN NULL ELSE CAST((id % 900 + 100) * 1000 + id % 1000 AS DOUBLE) + 0.5 END AS estimation,
    CASE WHEN id % 6 = 0 THEN '' ELSE contact_nom END AS contact_nom, CASE WHEN id % 6 = 0 THEN '' ELSE contact_email END AS contact_email,
    CASE WHEN id % 6 = 0 THEN '' ELSE COALESCE(trim(contact_tel), '') END AS contact_tel, '' AS contact_fax,
    id || ' DH' AS caution, '' AS qualifications, '' AS agrements, 'A : 2' AS lieu_ouverture, '' AS adresse_retrait, '' AS adresse_depot,
    '' AS reunion, '' AS visites, '' AS variante,
    CASE id % 4 WHEN 0 THEN '{P.BASE}?page=EntrepriseDemandeTelechargement&id=' || id WHEN 1 THEN '/g/' || id WHEN 2 THEN '/h/telecharger' ELSE '' END AS lien_dce,
    CASE WHEN id % 5 = 0 THEN 'SA ' || id ELSE '' END AS attributaire,
    CASE WHEN id % 5 = 0 THEN {P.parse_amount("(id % 90 + 10) || ' 500,25' || chr(10) || (id % 9 + 1) || ' '")} END AS montant_reel,
    '' AS date_attribution, CASE WHEN id % 5 = 0 THEN CAST(id % 9 + 1 AS INTEGER) END AS nb_soumissionnaires FROM tenders""")
def x02(spark, d):
    return pages.detail_records(B.detail_pages(spark, d), B.BASE).drop("hash_content")


@query("x03_minutes_rows", """SELECT id // 500 AS page_id, reference, 'Plis ' || id AS objet,
    CASE WHEN id % 7 = 0 THEN '' ELSE '/x?EntrepriseDetailConsultation&id=' || id END AS lien,
    CASE WHEN id % 4 = 0 THEN '' ELSE strftime(created_at, '%d/%m/%Y') END AS date_publication FROM tenders WHERE id % 10 <> 0""")
def x03(spark, d):
    return pages.minutes_rows(B.minutes_pages(spark, d), B.BASE).drop("row_no")


_LINKED = """CASE page_id % 3 WHEN 0 THEN '<a class="k" href="/dl?page=EntrepriseDownloadAvis&amp;id=' || page_id || '?x">pv</a>'
    WHEN 1 THEN '<a href=''EntrepriseDownloadAvis/' || page_id || '''>pv</a><a href="?EntrepriseDownloadAvis2">b</a>' ELSE '' END"""


@query("x04_minutes_link", f"""WITH h AS (SELECT page_id, html || {_LINKED} AS html FROM pages),
    m AS (SELECT page_id, COALESCE(replace(list_extract(regexp_extract_all(html, '<a [^>]*href\\s*=\\s*["'']([^"'']*EntrepriseDownloadAvis[^"'']*)["'']', 1), 1), '&amp;', '&'), '') AS href FROM h)
    SELECT page_id, href, CASE WHEN contains(href, '?') THEN '{P.BASE}?' || split_part(href, '?', 2) ELSE href END AS pdf_url FROM m""")
def x04(spark, d):
    linked = F.expr("""CASE page_id % 3 WHEN 0 THEN concat('<a class="k" href="/dl?page=EntrepriseDownloadAvis&amp;id=', page_id, '?x">pv</a>')
        WHEN 1 THEN concat('<a href=\\'EntrepriseDownloadAvis/', page_id, '\\'>pv</a><a href="?EntrepriseDownloadAvis2">b</a>') ELSE '' END""")
    p = given(spark, d, "pages").select("page_id", links.first_minutes_href(F.concat(F.col("html"), linked)).alias("href"))
    return p.select("page_id", "href", links.rebuild_pdf(F.col("href"), B.BASE).alias("pdf_url"))


@query("x05_best_text", """SELECT id, CASE WHEN COALESCE(objet, '') <> '' THEN objet WHEN trim(COALESCE(domaines, '')) <> '' THEN domaines
    ELSE 'N/A' END AS best FROM tenders""")
def x05(spark, d):
    candidates = F.array(F.lit(" - "), F.lit(""), F.concat(F.lit("Objet : "), F.nullif("objet", F.lit(""))), F.col("domaines"), F.lit("Label:"))
    return B.tenders(spark, d).select("id", text.best_text(F.filter(candidates, lambda c: c.isNotNull())).alias("best"))


@query("x06_contact_fields", """SELECT id, CASE WHEN contact_nom = 'N/A' THEN contact_email ELSE contact_nom END AS contact,
    COALESCE(NULLIF(contact_tel, ''), NULLIF(contact_fax, ''), '') AS phone FROM tenders""")
def x06(spark, d):
    return B.tenders(spark, d).select(
        "id", text.first_text(F.array("contact_nom", "contact_email")).alias("contact"),
        text.first_text(F.array(F.lit("-"), F.coalesce("contact_tel", F.lit("")), F.col("contact_fax"))).alias("phone"))


@query("x07_link_choice", f"""SELECT id AS page_id,
    CASE id % 4 WHEN 0 THEN '{P.BASE}?page=EntrepriseDemandeTelechargement&id=' || id WHEN 1 THEN '/g/' || id WHEN 2 THEN '/h/telecharger' ELSE '' END AS lien_dce FROM tenders""")
def x07(spark, d):
    return pages.detail_records(B.detail_pages(spark, d), B.BASE).select("page_id", "lien_dce")


@query("x08_award_block", """SELECT id AS page_id, CASE WHEN id % 5 = 0 THEN 'SA ' || id ELSE '' END AS attributaire,
    CASE WHEN id % 5 = 0 THEN CAST(id % 9 + 1 AS INTEGER) END AS nb_soumissionnaires FROM tenders""")
def x08(spark, d):
    return pages.detail_records(B.detail_pages(spark, d), B.BASE).select("page_id", "attributaire", "nb_soumissionnaires")


# ---------------------------------------------------------------- archives

_ENTRIES = """entries AS (SELECT doc_id, 'avis.pdf' AS entry_path, 0 AS depth, encode(COALESCE(text, '')) AS content FROM documents WHERE doc_id % 4 = 0
    UNION ALL SELECT doc_id, 'lisez-moi.txt', 0, encode('x') FROM documents WHERE doc_id % 4 = 0
    UNION ALL SELECT doc_id, 'a.txt', 0, encode('y') FROM documents WHERE doc_id % 4 = 1
    UNION ALL SELECT doc_id, 'lot/sub/B.PDF', 1, encode(COALESCE(text, '')) FROM documents WHERE doc_id % 4 = 1
    UNION ALL SELECT doc_id, 'lot/b.pdf', 1, encode(COALESCE(text, '') || chr(10) || COALESCE(text, '')) FROM documents WHERE doc_id % 4 = 1
    UNION ALL SELECT doc_id, 'notes.txt', 0, encode(COALESCE(text, '')) FROM documents WHERE doc_id % 4 = 2)"""


@query("s04_archive_entries", f"""WITH {_ENTRIES} SELECT '/dce/' || doc_id || '.zip' AS archive, entry_path, CAST(depth AS INTEGER) AS depth,
    CAST(octet_length(content) AS BIGINT) AS size, md5(content) AS content_md5 FROM entries""")
def s04(spark, d):
    e = archives.expand(B.archives(spark, d)).filter("entry_path IS NOT NULL AND part = 0")
    return e.select("archive", "entry_path", "depth", "size", F.coalesce("content_md5", F.md5("content")).alias("content_md5"))


def _stored(spark, d):
    """The archives as inner archives of larger ones, which are files in the shared folder: (archive, length)."""
    inner = B.archives(spark, d).select(F.concat(F.col("tender_id"), F.lit(".zip")).alias("entry_path"), "content")
    return archive_files.store(inner, scratch_path(spark, "archives"))


@query("s04_entries_of_files", f"""WITH {_ENTRIES} SELECT doc_id || '/' || entry_path AS entry_path, CAST(depth + 1 AS INTEGER) AS depth,
    CAST(octet_length(content) AS BIGINT) AS size, md5(content) AS content_md5, true AS is_valid, false AS failed FROM entries
    UNION ALL SELECT NULL, 1, NULL, NULL, true, true FROM documents WHERE doc_id % 4 = 3""")
def s04_files(spark, d):
    e = archive_files.scan(_stored(spark, d))
    return e.select("entry_path", "depth", "size", "content_md5", "is_valid", F.col("error").isNotNull().alias("failed"))


@query("s06_bytes_of_documents", f"""WITH {_ENTRIES} SELECT doc_id || '/' || entry_path AS entry_path, 0::INTEGER AS part, md5(content) AS content_md5
    FROM entries WHERE entry_path LIKE '%.pdf' OR entry_path LIKE '%.PDF'""")
def s06_bytes(spark, d):
    read = archive_files.read_contents(archives.select_documents(archive_files.scan(_stored(spark, d))))
    return read.select("entry_path", "part", F.md5("content").alias("content_md5"))


@query("s05_archive_valid", "SELECT '/dce/' || doc_id || '.zip' AS archive, doc_id % 4 < 3 AS is_valid FROM documents")
def s05(spark, d):
    e = archives.expand(B.archives(spark, d), with_content=False)
    return e.groupBy("archive").agg(F.bool_and("is_valid").alias("is_valid"))


@query("s06_document_entries", f"""WITH {_ENTRIES} SELECT '/dce/' || doc_id || '.zip' AS archive, entry_path, entry_path LIKE '%.PDF' AS is_upper
    FROM entries WHERE entry_path LIKE '%.pdf' OR entry_path LIKE '%.PDF'""")
def s06(spark, d):
    e = archives.expand(B.archives(spark, d), with_content=False)
    return archives.select_documents(e).select("archive", "entry_path", "is_upper")


@query("e02_both_endings", f"""WITH {_ENTRIES} SELECT count(*) FILTER (entry_path LIKE '%.pdf') AS n_lower,
    count(*) FILTER (entry_path LIKE '%.PDF') AS n_upper FROM entries""")
def e02(spark, d):
    e = archives.select_documents(archives.expand(B.archives(spark, d), with_content=False))
    return e.agg(F.count_if(~F.col("is_upper")).alias("n_lower"), F.count_if("is_upper").alias("n_upper"))


_ARCHIVED = "zip_path IN (SELECT '/dce/' || doc_id || '.zip' FROM documents{0})"


@query("s07_failed_archives", f"""SELECT id AS tender_id, CASE WHEN {_ARCHIVED.format('')} THEN 'Aucun PDF dans le ZIP' ELSE 'ZIP introuvable' END AS error
    FROM tenders WHERE status = 'TO_ANALYZE' AND (retry_count IS NULL OR retry_count < 3)
    AND (zip_path IS NULL OR NOT {_ARCHIVED.format(' WHERE doc_id % 4 < 2')})""")
def s07(spark, d):
    from tenderloom.operators.queue import queue
    e = archives.expand(B.archives(spark, d), with_content=False)
    return archives.archive_outcomes(queue(B.tenders(spark, d), "TO_ANALYZE"), e).select("tender_id", "error")


# ---------------------------------------------------------------- documents of a tender

_FOUND = """fnd AS (SELECT tender_id, arg_min(amount, ord) FILTER (amount IS NOT NULL AND amount <> 0) AS amount,
    arg_min(j, ord) FILTER (j IS NOT NULL) AS j, bool_or(text <> '') AS has_text, count(*) AS n_docs FROM casc GROUP BY 1)"""


@query("a11_first_findings", CASCADE_SQL + f", {_FOUND} SELECT tender_id, amount, j IS NOT NULL AS has_reply, n_docs, has_text FROM fnd")
def a11(spark, d):
    f = summary.first_findings(summary.cascade(B.documents(spark, d)))
    return f.select("tender_id", "amount", F.col("reply").isNotNull().alias("has_reply"), "n_docs", "has_text")


_JOINED = "jt AS (SELECT tender_id, string_agg(text, chr(10) || chr(10) ORDER BY ord) AS text FROM casc WHERE text <> '' GROUP BY 1)"


@query("a12_joined_texts", CASCADE_SQL + f", {_JOINED} SELECT tender_id, 0::BIGINT AS piece, md5(text) AS text_md5 FROM jt")
def a12(spark, d):
    t = summary.join_texts(summary.cascade(B.documents(spark, d)))
    return t.select("tender_id", "piece", F.md5("text").alias("text_md5"))


def _summary_sql() -> str:
    lab = lambda s: f"rpad('{s}', 20, ' ') || ': ' || "
    points = ", ".join(f"{lab(label)}left(trim({P.first_group('jt.text', p)}), 150)" for label, p in KEY_POINTS)
    return CASCADE_SQL + f""", {_FOUND}, {_JOINED}
 SELECT t.id AS tender_id, t.reference, f.amount, concat_ws(chr(10), '=== RÉSUMÉ — ' || t.reference || ' ===' || chr(10),
  CASE WHEN j IS NOT NULL THEN concat_ws(chr(10), '── Extraction IA (Mistral) ──', NULLIF(json_extract_string(j, '$.resume'), '') || chr(10),
   '── Données extraites ──', {lab('Objet')}json_extract_string(j, '$.objet'), {lab('Acheteur')}json_extract_string(j, '$.acheteur'),
   {lab('Montant estimé')}json_extract_string(j, '$.montant_estime'))
  ELSE concat_ws(chr(10), '── Points clés (extraction regex) ──', {points}) END,
  CASE WHEN f.amount IS NOT NULL THEN chr(10) || {lab('Montant PDF')}format('{{:,}}', CAST(round_even(f.amount, 0) AS BIGINT)) || ' DH' END,
  chr(10) || '── Niveau d''extraction utilisé ──',
  {lab('Source')}CASE WHEN j IS NOT NULL THEN 'Ollama/Mistral' WHEN has_text THEN 'OCR' ELSE 'PyMuPDF' END) AS summary
 FROM tenders t JOIN fnd f ON f.tender_id = t.id LEFT JOIN jt ON jt.tender_id = t.id"""


@query("k04_summaries", _summary_sql())
def k04(spark, d):
    return summary.summaries(B.tenders(spark, d), summary.cascade(B.documents(spark, d)))


@query("f15_analysis_outcomes", CASCADE_SQL + f""", {_FOUND}, q AS (SELECT id, estimation FROM tenders WHERE status = 'TO_ANALYZE'
    AND (retry_count IS NULL OR retry_count < 3))
    SELECT q.id AS tender_id, n_docs IS NOT NULL AS ok, CASE WHEN n_docs IS NULL THEN 'ZIP introuvable' END AS error,
    CASE WHEN n_docs IS NOT NULL THEN 'TO_SYNC' END AS next_status, COALESCE(NULLIF(q.estimation, 0), f.amount) AS estimation
    FROM q LEFT JOIN fnd f ON f.tender_id = q.id""")
def f15a(spark, d):
    from tenderloom.operators.queue import queue
    docs = summary.cascade(B.documents(spark, d))
    entries = docs.groupBy("tender_id").agg(F.count(F.lit(1)).alias("n_pdf"))
    out = summary.analysis_outcomes(queue(B.tenders(spark, d), "TO_ANALYZE"), entries, docs)
    return out.select("tender_id", "ok", "error", "next_status", "estimation")
