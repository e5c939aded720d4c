"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tenderloom import schemas as S
from tenderloom.functions import amounts, dates, keys, links, phones, text
from tenderloom.operators import summary
from tenderloom.plans import prelude as P
from tenderloom.plans.registry import query
from tenderloom.sources import bindings as B
from tenderloom.sources.tables import given



def _as_of():
    return F.lit(B.AS_OF)


@query("t01_content_hash", "SELECT doc_id, md5(text) AS content_hash FROM documents")
def t01(spark, d):
    return given(spark, d, "documents").select("doc_id", keys.content_hash(F.col("text")).alias("content_hash"))


@query("t02_tender_hash", """SELECT id, sha256(trim(reference) || '|' || trim(COALESCE(date_publication, '')) || '|'
    || lower(trim(COALESCE(acheteur, '')))) AS tender_hash FROM tenders""")
def t02(spark, d):
    return B.tenders(spark, d).select(
        "id", keys.tender_hash(F.col("reference"), F.col("date_publication"), F.col("acheteur")).alias("tender_hash"))


@query("t03_url_id", r"SELECT id, COALESCE(regexp_extract(lien_detail, '[?&]refConsultation=(\d+)', 1), '') AS url_id FROM tenders")
def t03(spark, d):
    return B.tenders(spark, d).select("id", links.url_id(F.col("lien_detail")).alias("url_id"))


@query("t03_url_parameter", r"SELECT page_id, COALESCE(regexp_extract(url, '[?&]page=(\d+)', 1), '') AS page_no FROM pages")
def t03p(spark, d):
    return given(spark, d, "pages").select("page_id", links.url_id(F.col("url"), "page").alias("page_no"))


_AMOUNT_SQL = """CASE id % 6 WHEN 0 THEN (id % 900) || ' ' || lpad(CAST(id % 1000 AS VARCHAR), 3, '0') || ',50 DH'
    WHEN 1 THEN 'Lot ' || id || ': 3000' WHEN 2 THEN (id % 9) || '.500.000,00' WHEN 3 THEN (id % 900) || chr(160) || '234,5 Dhs'
    WHEN 4 THEN 'N/A' ELSE NULL END"""
_AMOUNT = """CASE id % 6 WHEN 0 THEN concat(id % 900, ' ', lpad(string(id % 1000), 3, '0'), ',50 DH')
    WHEN 1 THEN concat('Lot ', id, ': 3000') WHEN 2 THEN concat(id % 9, '.500.000,00') WHEN 3 THEN concat(id % 900, ' ', '234,5 Dhs')
    WHEN 4 THEN 'N/A' ELSE NULL END"""


@query("t04_parse_amount", f"""WITH a AS (SELECT id, {_AMOUNT_SQL} AS raw FROM tenders)
    SELECT id, {P.parse_amount('raw')} AS amount FROM a""")
def t04(spark, d):
    return B.tenders(spark, d).select("id", F.expr(_AMOUNT).alias("raw")).select(
        "id", amounts.parse_amount(F.col("raw")).alias("amount"))


@query("t04_parse_amount_text", f"SELECT doc_id, {P.parse_amount('native')} AS amount FROM docs")
def t04t(spark, d):
    return B.documents(spark, d).select(F.expr("bigint(substring(doc_path, 4, length(doc_path) - 7))").alias("doc_id"),
                                        amounts.parse_amount(F.col("native")).alias("amount"))


@query("t05_format_amount", f"""SELECT id, {P.format_amount('estimation')} AS estimation,
    {P.format_amount('(id * 1000 + 0.5)::DOUBLE')} AS half FROM tenders""")
def t05(spark, d):
    return B.tenders(spark, d).select(
        "id", amounts.format_amount(F.col("estimation")).alias("estimation"),
        amounts.format_amount(F.expr("double(id * 1000 + 0.5BD)")).alias("half"))


@query("t05_format_amount_text", f"""WITH a AS (SELECT id, CASE id % 3 WHEN 0 THEN 'abc' || id WHEN 1 THEN CAST(id AS VARCHAR) END AS raw FROM tenders)
    SELECT id, CASE WHEN raw IS NULL THEN '' WHEN TRY_CAST(raw AS DOUBLE) IS NULL THEN raw
    ELSE {P.format_amount('TRY_CAST(raw AS DOUBLE)')} END AS shown FROM a""")
def t05t(spark, d):
    raw = F.expr("CASE id % 3 WHEN 0 THEN concat('abc', id) WHEN 1 THEN string(id) END")
    return B.tenders(spark, d).select("id", amounts.format_amount_text(raw).alias("shown"))


@query("t06_normalize_date", f"""SELECT id, {P.normalize_date('date_publication')} AS publication, {P.normalize_date('date_limite')} AS limite,
    {P.normalize_date("'  ' || date_limite || ' '")} AS spaced, {P.normalize_date('date_attribution')} AS attribution FROM tenders""")
def t06(spark, d):
    return B.tenders(spark, d).select(
        "id", dates.normalize_date(F.col("date_publication")).alias("publication"),
        dates.normalize_date(F.col("date_limite")).alias("limite"),
        dates.normalize_date(F.concat(F.lit("  "), F.col("date_limite"), F.lit(" "))).alias("spaced"),
        dates.normalize_date(F.col("date_attribution")).alias("attribution"))


@query("t07_days_left", f"SELECT id, {P.days_left('date_limite')} AS days, {P.days_label('date_limite')} AS label FROM tenders")
def t07(spark, d):
    days = dates.days_left(F.col("date_limite"), _as_of())
    return B.tenders(spark, d).select("id", days.alias("days"), dates.days_left_label(days).alias("label"))


@query("t08_normalize_phone", f"SELECT id, {P.normalize_phone('contact_tel')} AS tel, {P.normalize_phone('contact_fax')} AS fax FROM tenders")
def t08(spark, d):
    return B.tenders(spark, d).select("id", phones.normalize_phone(F.col("contact_tel")).alias("tel"),
                                      phones.normalize_phone(F.col("contact_fax")).alias("fax"))


@query("t09_collapse_space", r"SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS text FROM documents")
def t09(spark, d):
    return given(spark, d, "documents").select("doc_id", text.collapse(F.col("text")).alias("text"))


@query("t10_resolve_link", f"SELECT id, CASE WHEN starts_with(lien_dce, '?') THEN '{B.BASE}' || lien_dce ELSE lien_dce END AS link FROM tenders")
def t10(spark, d):
    return B.tenders(spark, d).select("id", links.resolve(F.col("lien_dce"), B.BASE).alias("link"))


@query("t11_rebuild_pdf_link", f"""SELECT id, CASE WHEN contains(raw, '?') THEN '{B.BASE}?' || split_part(raw, '?', 2) ELSE raw END AS link
    FROM (SELECT id, CASE WHEN id % 2 = 0 THEN lien_dce ELSE lien_dce || '?b?c' END AS raw FROM tenders)""")
def t11(spark, d):
    raw = F.expr("CASE WHEN id % 2 = 0 THEN lien_dce ELSE concat(lien_dce, '?b?c') END")
    return B.tenders(spark, d).select("id", links.rebuild_pdf(raw, B.BASE).alias("link"))


@query("t12_absolute_link", """SELECT id, CASE WHEN starts_with(lien_dce, 'http') THEN lien_dce
    ELSE 'https://portal.example/' || ltrim(lien_dce, '/') END AS link FROM tenders""")
def t12(spark, d):
    return B.tenders(spark, d).select("id", links.absolute(F.col("lien_dce"), B.BASE).alias("link"))


@query("t13_file_safe_name", """SELECT id, 'DCE_' || replace(reference, '/', '_') || '.zip' AS archive_name,
    'PV_' || replace(reference, '/', '_') || '_' AS pv_prefix, id || '_' || replace(reference, '/', '_') AS folder FROM tenders""")
def t13(spark, d):
    ref = F.col("reference")
    return B.tenders(spark, d).select(
        "id", text.file_safe(ref, "DCE_", ".zip").alias("archive_name"), text.file_safe(ref, "PV_", "_").alias("pv_prefix"),
        F.concat(F.col("id").cast("string"), F.lit("_"), text.file_safe(ref)).alias("folder"))


@query("t14_archive_url", f"""WITH p AS (SELECT id, NULLIF(regexp_extract(lien_dce, '[?&]refConsultation=([^&]*)', 1), '') AS r,
    NULLIF(regexp_extract(lien_dce, '[?&]orgAcronyme=([^&]*)', 1), '') AS o FROM tenders)
    SELECT id, '{B.BASE}?page=entreprise.EntrepriseDownloadCompleteDce&reference=' || r || '&orgAcronym=' || url_decode(o) AS url FROM p""")
def t14(spark, d):
    return B.tenders(spark, d).select("id", links.archive_url(F.col("lien_dce"), B.BASE).alias("url"))


def _points(x: str) -> str:
    return ", ".join(f'left(trim({P.first_group(x, p)}), 150) AS "{label}"' for label, p in S.KEY_POINTS)


_DOC_ID = "bigint(substring(doc_path, 4, length(doc_path) - 7)) AS doc_id"


@query("t15_key_points", f"SELECT doc_id, {_points('native')} FROM docs")
def t15(spark, d):
    return B.documents(spark, d).select(F.expr(_DOC_ID), text.key_points(F.col("native")).alias("k")).select("doc_id", "k.*")


@query("t16_parse_reply", r"""WITH c AS (SELECT doc_id, regexp_replace(regexp_replace(reply, '^```(?:json)?\s*', ''), '\s*```$', '') AS j FROM docs
    WHERE reply IS NOT NULL), v AS (SELECT doc_id, CASE WHEN json_valid(j) THEN j END AS j FROM c)
    SELECT doc_id, j IS NOT NULL AS parsed, CAST(json_extract_string(j, '$.montant_estime') AS DOUBLE) AS montant,
    json_extract_string(j, '$.objet') AS objet, json_extract_string(j, '$.acheteur') AS acheteur,
    json_extract_string(j, '$.resume') AS resume FROM v""")
def t16(spark, d):
    r = B.documents(spark, d).filter("reply IS NOT NULL").select(F.expr(_DOC_ID), summary.parse_reply(F.col("reply")).alias("r"))
    return r.select("doc_id", F.col("r").isNotNull().alias("parsed"), F.col("r.montant_estime").alias("montant"),
                    "r.objet", "r.acheteur", "r.resume")


_AWARD = """concat(CASE id % 4 WHEN 0 THEN 'ATTRIBUTAIRE : ' WHEN 1 THEN 'titulaire ' WHEN 2 THEN 'Adjudicataire: ' ELSE 'Aucun ' END,
    acheteur, ' SARL \\nMontant attribué : ', id % 900 + 100, ' 567,89 DH\\n', id % 9, ' soumissionnaires')"""
_AWARD_SQL = """CASE id % 4 WHEN 0 THEN 'ATTRIBUTAIRE : ' WHEN 1 THEN 'titulaire ' WHEN 2 THEN 'Adjudicataire: ' ELSE 'Aucun ' END ||
    acheteur || ' SARL ' || chr(10) || 'Montant attribué : ' || (id % 900 + 100) || ' 567,89 DH' || chr(10) || (id % 9) || ' soumissionnaires'"""
_AW = f"WITH a AS (SELECT id, {_AWARD_SQL} AS t FROM tenders) "


@query("t17_awardee", _AW + f"SELECT id, trim({P.first_group('t', S.PATTERN_AWARDEE)}) AS awardee FROM a")
def t17(spark, d):
    return B.tenders(spark, d).select("id", text.strip(text.first_group(F.expr(_AWARD), S.PATTERN_AWARDEE)).alias("awardee"))


@query("t18_awarded_amount", _AW + f"SELECT id, {P.parse_amount(P.first_group('t', S.PATTERN_AWARD_AMOUNT))} AS amount FROM a")
def t18(spark, d):
    return B.tenders(spark, d).select("id", amounts.awarded_amount(F.expr(_AWARD)).alias("amount"))


@query("t19_bidder_count", _AW + f"SELECT id, TRY_CAST({P.first_group('t', S.PATTERN_BIDDERS)} AS INTEGER) AS bidders FROM a")
def t19(spark, d):
    return B.tenders(spark, d).select("id", amounts.bidder_count(F.expr(_AWARD)).alias("bidders"))


def _find(x: str) -> str:
    return P.find_amount(x, S.PATTERN_AMOUNT_LABELLED, S.PATTERN_AMOUNT_GROUPED)


@query("t20_find_amount", f"SELECT doc_id, {_find('native')} AS native, {_find('tables')} AS tables, {_find('ocr')} AS ocr FROM docs")
def t20(spark, d):
    return B.documents(spark, d).select(F.expr(_DOC_ID), *[amounts.find_amount(F.col(c)).alias(c) for c in ("native", "tables", "ocr")])


CASCADE_SQL = f"""WITH c1 AS (SELECT *, tables <> '' AND NOT contains(native, tables) AS use_tables FROM docs),
 c2 AS (SELECT *, CASE WHEN use_tables THEN CASE WHEN native = '' THEN tables ELSE native || chr(10) || tables END ELSE native END AS text2 FROM c1),
 c3 AS (SELECT *, length(text2) < 100 AND ocr <> '' AS use_ocr FROM c2),
 c4 AS (SELECT *, CASE WHEN use_ocr THEN CASE WHEN text2 = '' THEN ocr ELSE text2 || chr(10) || ocr END ELSE text2 END AS text,
  COALESCE({_find('native')}, CASE WHEN use_tables THEN {_find('tables')} END, CASE WHEN use_ocr THEN {_find('ocr')} END) AS found FROM c3),
 c5 AS (SELECT *, CASE WHEN found IS NULL AND length(text) > 100 THEN
  regexp_replace(regexp_replace(reply, '^```(?:json)?\\s*', ''), '\\s*```$', '') END AS raw FROM c4),
 c6 AS (SELECT *, CASE WHEN raw IS NOT NULL AND json_valid(raw) THEN raw END AS j FROM c5),
 casc AS (SELECT doc_id, tender_id, doc_path, ord, text, j, COALESCE(found, NULLIF(CAST(json_extract_string(j, '$.montant_estime') AS DOUBLE), 0)) AS amount,
  CASE WHEN j IS NOT NULL THEN 'reply' WHEN use_ocr THEN 'ocr' WHEN use_tables THEN 'tables' WHEN text <> '' THEN 'native' END AS tier FROM c6)
"""


@query("t21_text_cascade", CASCADE_SQL + "SELECT tender_id, doc_path, ord, md5(text) AS text_md5, amount, j IS NOT NULL AS has_reply, tier FROM casc")
def t21(spark, d):
    c = summary.cascade(B.documents(spark, d))
    return c.select("tender_id", "doc_path", "ord", F.md5("text").alias("text_md5"), "amount",
                    F.col("reply").isNotNull().alias("has_reply"), "tier")


@query("t21_tiers_to_columns", """SELECT tender_id, doc_path, ord, md5(native) AS native, md5(tables) AS tables, md5(ocr) AS ocr FROM docs""")
def t21t(spark, d):
    t = summary.tiers_to_columns(B.document_layers(spark, d))
    return t.select("tender_id", "doc_path", "ord", *[F.md5(c).alias(c) for c in ("native", "tables", "ocr")])


@query("t22_find_date", r"SELECT doc_id, COALESCE(regexp_extract(native, '\d{2}/\d{2}/\d{4}', 0), '') AS found FROM docs")
def t22(spark, d):
    return B.documents(spark, d).select(F.expr(_DOC_ID), text.find_date(F.col("native")).alias("found"))


@query("t23_drop_labels", r"""SELECT id, trim(regexp_replace('OBJET  : ' || COALESCE(objet, ''), '^Objet\s*:\s*', '', 'i')) AS objet,
    trim(regexp_replace('Acheteur public: ' || acheteur, '^Acheteur public\s*:\s*', '', 'i')) AS acheteur,
    trim(regexp_replace('Ville, LIEU D''EXÉCUTION : ' || domaines, 'Lieu d''exécution\s*:?\s*', '', 'gi')) AS lieu FROM tenders""")
def t23(spark, d):
    return B.tenders(spark, d).select(
        "id", text.drop_label(F.concat(F.lit("OBJET  : "), F.coalesce("objet", F.lit(""))), S.PATTERN_LABEL_OBJECT).alias("objet"),
        text.drop_label(F.concat(F.lit("Acheteur public: "), F.col("acheteur")), S.PATTERN_LABEL_BUYER).alias("acheteur"),
        text.drop_label(F.concat(F.lit("Ville, LIEU D'EXÉCUTION : "), F.col("domaines")), S.PATTERN_LABEL_PLACE).alias("lieu"))


@query("t24_display_formats", """SELECT id, left(objet, 50) AS shown,
    CASE WHEN estimation IS NULL OR estimation = 0 THEN 'N/A' ELSE replace(format('{:,}', CAST(trunc(estimation) AS BIGINT)), ',', ' ') END AS budget
    FROM tenders""")
def t24(spark, d):
    return B.tenders(spark, d).select("id", F.left("objet", F.lit(S.REPORT_OBJECT_CHARS)).alias("shown"),
                                      amounts.truncated_amount(F.col("estimation")).alias("budget"))


@query("t24_model_excerpt", "SELECT doc_id, md5(left(text, 4000)) AS excerpt_md5 FROM documents")
def t24m(spark, d):
    return given(spark, d, "documents").select("doc_id", F.md5(text.model_excerpt(F.col("text"))).alias("excerpt_md5"))


@query("t25_table_line", """SELECT id, trim(reference) || ' | ' || COALESCE(trim(objet), '') || ' | ' || COALESCE(trim(domaines), '')
    || ' | ' || trim(contact_nom) AS line FROM tenders""")
def t25(spark, d):
    cells = F.array("reference", F.concat(F.lit(" "), F.col("objet"), F.lit("\t")), "domaines", "contact_nom")
    return B.tenders(spark, d).select("id", text.table_line(cells).alias("line"))
