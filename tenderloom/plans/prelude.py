"""The derived domain tables once more, in DuckDB SQL, for the side-by-side check."""

from __future__ import annotations

import re

BASE = "https://portal.example/index.php"


def _link(k: str) -> str:
    return (f"CASE WHEN {k} % 11 = 0 THEN '{BASE}?page=detail&id=' || {k} "
            f"ELSE '{BASE}?page=detail&refConsultation=' || {k} || '&orgAcronyme=o' || ({k} % 7) END")


TENDERS = f"""tenders AS (
SELECT k AS id,
 CASE WHEN k % 97 = 0 OR k % 11 = 0 THEN NULL ELSE CAST(k AS VARCHAR) END AS url_id,
 'R' || (k % 5000) || '/' || year(d) AS reference,
 CASE WHEN k % 10 < 7 THEN strftime(d, '%d/%m/%Y') WHEN k % 10 = 7 THEN strftime(d, '%Y-%m-%d')
  WHEN k % 10 = 8 THEN strftime(d, '%Y-%m-%d') || 'T10:30:59' ELSE '' END AS date_publication,
 CASE WHEN k % 12 < 8 THEN strftime(dl, '%d/%m/%Y') || ' 10:00' WHEN k % 12 = 8 THEN strftime(dl, '%d/%m/%Y')
  WHEN k % 12 = 9 THEN strftime(dl, '%Y-%m-%d') WHEN k % 12 = 10 THEN NULL ELSE '31/02/1998' END AS date_limite,
 CASE WHEN k % 97 = 0 THEN NULL ELSE {_link('k')} END AS lien_detail,
 CASE WHEN k % 29 = 0 THEN NULL WHEN k % 23 = 0 THEN '' ELSE 'Travaux ' || pr || ' de la province, tranche ' || k END AS objet,
 CASE WHEN k % 31 = 0 THEN '' ELSE 'Customer#' || lpad(CAST(c AS VARCHAR), 9, '0') END AS acheteur,
 CASE WHEN k % 13 = 0 THEN NULL WHEN k % 17 = 0 THEN 0.0::DOUBLE ELSE p END AS estimation,
 CASE WHEN k % 4 = 0 THEN NULL ELSE pr END AS domaines,
 CASE WHEN k % 37 = 0 THEN 'N/A' ELSE 'Contact ' || c END AS contact_nom,
 'c' || c || '@example.com' AS contact_email,
 CASE k % 5 WHEN 0 THEN '+212 5 ' || n WHEN 1 THEN '05' || n || '/' || lpad(CAST(k % 100 AS VARCHAR), 2, '0')
  WHEN 2 THEN 'néant' WHEN 3 THEN NULL ELSE '05' || n || ' / 0612345678' END AS contact_tel,
 CASE WHEN k % 3 = 0 THEN '00212.5.' || n ELSE '' END AS contact_fax,
 CASE k % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'index.php?page=dce&refConsultation=' || k
  WHEN 3 THEN '?page=dce&refConsultation=' || k || '&orgAcronyme='
  WHEN 4 THEN '{BASE}?page=dce&refConsultation=' || k || '&orgAcronyme=o%20' || (k % 7)
  ELSE '/files/' || k || '.zip' END AS lien_dce,
 CASE WHEN k % 8 = 0 THEN 'Titulaire ' || c END AS attributaire,
 CASE WHEN k % 8 = 0 THEN CAST(floor(p) AS DOUBLE) END AS montant_reel,
 CASE WHEN k % 8 = 0 THEN strftime(d, '%Y-%m-%d') END AS date_attribution,
 CASE WHEN k % 8 = 0 THEN CAST(k % 6 AS INTEGER) END AS nb_soumissionnaires,
 CASE WHEN k % 19 = 0 THEN NULL ELSE '/dce/' || k || '.zip' END AS zip_path,
 CAST(NULL AS VARCHAR) AS resume_txt,
 CASE WHEN k % 9 = 0 THEN NULL ELSE sha256('R' || (k % 5000) || '/' || year(d) || '||') END AS tender_hash,
 CASE WHEN k % 41 = 0 THEN NULL ELSE md5(k || 'N') END AS hash_content,
 d + INTERVAL 1 DAY AS last_seen,
 CASE WHEN k % 7 = 0 THEN NULL ELSE CAST(k % 5 AS INTEGER) END AS retry_count,
 CASE WHEN k % 5 = 0 THEN NULL ELSE 'err ' || (k % 5) END AS last_error,
 CASE k % 9 WHEN 0 THEN 'TO_ENRICH' WHEN 1 THEN 'TO_DOWNLOAD' WHEN 2 THEN 'TO_ANALYZE' WHEN 3 THEN 'TO_SYNC'
  WHEN 4 THEN 'DONE' WHEN 5 THEN 'ERROR_ENRICH' WHEN 6 THEN 'ERROR_DOWNLOAD' WHEN 7 THEN 'ERROR_ANALYZE'
  ELSE CASE WHEN k % 18 = 17 THEN 'error_old' ELSE 'ERROR_SYNC' END END AS status,
 d + to_seconds(k % 86400) AS created_at, d + to_seconds(k % 86400) AS updated_at
FROM (SELECT o_orderkey AS k, o_custkey AS c, o_orderdate AS d, o_totalprice AS p, o_orderpriority AS pr,
  lpad(CAST(o_custkey % 100000000 AS VARCHAR), 8, '0') AS n,
  o_orderdate + to_days(CAST(o_orderkey % 60 AS INTEGER)) AS dl FROM orders))"""

STORED_TENDERS = "stored_tenders AS (SELECT * FROM tenders WHERE created_at < TIMESTAMP '1999-01-01')"

LINES = """lines AS (SELECT l_orderkey AS k, l_linenumber AS ln, l_shipdate AS d, l_returnflag AS rf, l_linestatus AS ls,
 datediff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) * 10000000000000 + l_partkey * 100000000
 + CAST(round(l_extendedprice * 100) AS BIGINT) AS seq FROM lineitem)"""

_PDF = f"'{BASE}?page=entreprise.EntrepriseDownloadAvis&idAvis=' || k || '-' || ln"
_PROC = """CASE rf WHEN 'A' THEN '40' WHEN 'N' THEN '4' ELSE '47' END AS procedure_code,
 CASE rf WHEN 'A' THEN 'Concours Architectural' WHEN 'N' THEN 'Concours Phase 1' ELSE 'Concours Phase 2' END AS procedure_type,
 CASE WHEN ls = 'O' THEN strftime(d, '%Y-%m-%d') ELSE '' END AS date_publication"""

PVS = f"""pvs AS (SELECT seq AS id, k AS tender_id, 'R' || (k % 5000) || '/' || year(d) AS reference,
 CASE WHEN k % 43 = 0 THEN '' ELSE {_PDF} END AS pdf_url,
 CASE k % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE '/pv/' || k || '-' || ln || '.pdf' END AS pdf_path,
 {_PROC},
 CASE WHEN k % 43 = 0 THEN NULL ELSE md5({_PDF}) END AS hash_pdf,
 CAST(k % 2 AS INTEGER) AS synced_to_sheets, d + to_seconds(k % 86400) AS created_at FROM lines)"""

STORED_PVS = "stored_pvs AS (SELECT * FROM pvs WHERE created_at < TIMESTAMP '1999-01-01')"

CANDIDATES = f"""candidates AS (SELECT seq, 'R' || (k % 5000) || '/' || year(d) AS reference,
 CASE WHEN k % 23 = 0 THEN '' ELSE 'Objet PV ' || k END AS objet, {_link('k')} AS lien,
 CASE WHEN k % 11 = 0 THEN NULL ELSE CAST(k AS VARCHAR) END AS uid,
 {_PROC}, CASE WHEN k % 43 = 0 THEN '' ELSE {_PDF} END AS pv_pdf_url FROM lines)"""

LISTING = f"""listing AS (SELECT CAST(datediff('day', DATE '1995-01-01', CAST(d AS DATE)) AS BIGINT) AS page,
 seq % 10000000000000 AS row_no, CASE WHEN k % 11 = 0 THEN '' ELSE CAST(k AS VARCHAR) END AS url_id,
 'R' || (k % 5000) || '/' || (1995 + k % 6) AS reference, strftime(d, '%d/%m/%Y') AS date_publication,
 strftime(d + INTERVAL 30 DAY, '%d/%m/%Y') || ' 10:00' AS date_limite, {_link('k')} AS lien_detail,
 CASE WHEN ln % 3 = 0 THEN '' ELSE 'Objet ' || k || ' v' || ln END AS objet,
 CASE WHEN ln % 2 = 0 THEN '' ELSE 'Acheteur ' || (k % 100) || ' v' || ln END AS acheteur,
 CASE WHEN k % 53 = 0 THEN NULL ELSE md5(k || rf) END AS page_hash FROM lines)"""

NEXT = """next_tenders AS (SELECT * REPLACE (
 CASE WHEN id % 4 = 0 AND status = 'TO_SYNC' THEN 'DONE' WHEN id % 5 = 0 THEN 'TO_ENRICH' ELSE status END AS status,
 CASE WHEN id % 13 = 0 AND id % 2 = 0 THEN CAST(id + 1000000 AS DOUBLE) WHEN id % 17 = 0 THEN NULL
  WHEN id % 19 = 0 THEN floor(estimation) + 0.5 ELSE estimation END AS estimation,
 CASE WHEN id % 21 = 0 THEN objet || ' bis' ELSE objet END AS objet) FROM tenders)"""

OUTCOMES = """outcomes AS (SELECT CASE event_type WHEN 'view' THEN 'enrich' WHEN 'click' THEN 'download'
  WHEN 'signup' THEN 'analyze' WHEN 'purchase' THEN 'sync'
  ELSE CASE user_id % 4 WHEN 0 THEN 'enrich' WHEN 1 THEN 'download' WHEN 2 THEN 'analyze' ELSE 'sync' END END AS stage,
 user_id AS tender_id, event_id AS seq, event_type <> 'error' AS ok,
 CASE WHEN event_type = 'error' AND event_id % 3 > 0 THEN 'échec ' || event_id END AS error,
 CASE event_type WHEN 'view' THEN 'TO_DOWNLOAD' WHEN 'click' THEN 'TO_ANALYZE' WHEN 'signup' THEN 'TO_SYNC'
  WHEN 'purchase' THEN 'DONE' END AS next_status,
 CASE WHEN event_type = 'click' THEN '/dce/new/' || event_id || '.zip' END AS path FROM events)"""

FILES = """files AS (SELECT event_id AS file_id, CASE event_type WHEN 'view' THEN 'archive' WHEN 'click' THEN 'temp'
 WHEN 'signup' THEN 'log' WHEN 'purchase' THEN 'summary' ELSE 'other' END AS kind, ts AS modified_at FROM events)"""

DOCS = r"""docs AS (SELECT doc_id, doc_id // 3 AS tender_id, 'doc' || doc_id || '.pdf' AS doc_path, CAST(doc_id % 3 AS INTEGER) AS ord,
 CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN text || chr(10) || 'Estimation : ' || (doc_id * 1000 + 500) || ',50 DH'
  WHEN 2 THEN 'Objet : ' || source || chr(10) || 'Acheteur public : Commune ' || lang || chr(10) || text
  WHEN 3 THEN 'Date limite : ' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') || '/05/1998 10:00' || chr(10)
   || 'Tél : 05' || lpad(CAST(doc_id AS VARCHAR), 8, '0') || chr(10) || text ELSE text END AS native,
 CASE doc_id % 4 WHEN 0 THEN text WHEN 1 THEN 'Lot | ' || (doc_id % 900 + 100) || ' '
  || lpad(CAST(doc_id % 1000 AS VARCHAR), 3, '0') || ' DH' ELSE '' END AS tables,
 CASE WHEN doc_id % 7 = 0 THEN '' WHEN doc_id % 3 = 0 THEN text || chr(10) || 'Budget prévisionnel 900 puis 2 000 000 DH'
  ELSE text END AS ocr,
 CASE doc_id % 6 WHEN 0 THEN '```json' || chr(10) || '{"montant_estime": ' || (doc_id + 5000) || ', "objet": "o' || doc_id
  || '", "resume": "r' || doc_id || '"}' || chr(10) || '```' WHEN 1 THEN 'pas de json'
  WHEN 2 THEN '{"montant_estime": null, "acheteur": "Ville"}' END AS reply FROM documents)"""

# Amount reading, phone reading and friends as SQL macros cannot be assumed, so they are spliced in as text.


def parse_amount(x: str) -> str:
    return (f"TRY_CAST(NULLIF(regexp_extract(regexp_replace(replace({x}, ',', '.'), "
            f"'[A-Za-zÀ-ÿ\\s\\x{{00a0}}]', '', 'g'), '[0-9][0-9.]*'), '') AS DOUBLE)")


def format_amount(x: str) -> str:
    return f"COALESCE(replace(format('{{:,}}', CAST(round_even({x}, 0) AS BIGINT)), ',', ' '), '')"


def first_group(x: str, pattern: str, flags: str = "i") -> str:
    quoted = pattern.replace("'", "''")
    return f"NULLIF(regexp_extract({x}, '{quoted}', 1, '{flags}'), '')"


def find_amount(x: str, labelled: str, grouped: str) -> str:
    a, b = parse_amount(first_group(x, labelled, "is")), parse_amount(first_group(x, grouped, "i"))
    return f"CASE WHEN {a} > 1000 THEN {a} WHEN {b} > 1000 THEN {b} END"


def normalize_date(x: str) -> str:
    iso = r"^(\d{4})-(\d{2})-(\d{2})"
    return (f"CASE WHEN {x} IS NULL THEN '' WHEN regexp_matches(trim({x}), '^\\d{{2}}/\\d{{2}}/\\d{{4}}') THEN trim({x}) "
            f"WHEN regexp_matches(trim({x}), '{iso}[ T]\\d{{2}}:\\d{{2}}') THEN "
            f"regexp_replace(trim({x}), '{iso}[ T](\\d{{2}}:\\d{{2}}).*$', '\\3/\\2/\\1 \\4') "
            f"WHEN regexp_matches(trim({x}), '{iso}') THEN regexp_replace(trim({x}), '{iso}.*$', '\\3/\\2/\\1') "
            f"ELSE trim({x}) END")


def days_left(x: str, as_of: str = "1998-06-15") -> str:
    return (f"CAST(datediff('day', DATE '{as_of}', CAST(try_strptime(split_part({x}, ' ', 1), '%d/%m/%Y') AS DATE)) "
            f"AS INTEGER)")


def days_label(x: str) -> str:
    d = days_left(x)
    return f"CASE WHEN {d} IS NULL THEN '' WHEN {d} < 0 THEN 'Expiré' ELSE CAST({d} AS VARCHAR) END"


def normalize_phone(x: str) -> str:
    p = f"translate({x}, ' -.', '')"
    rng = r"(?:\+212|00212|0)([5-7]\d{6})(\d{2})/(\d{2})"
    nums = f"list_transform(regexp_extract_all({p}, '(?:\\+212|00212|0)([5-7]\\d{{8}})', 1), lambda n: '0' || n)"
    g = lambda i: f"regexp_extract({p}, '{rng}', {i})"
    both = f"list_concat({nums}, ['0' || {g(1)} || {g(2)}, '0' || {g(1)} || {g(3)}])"
    uniq = f"list_filter({both}, lambda n, i: list_position({both}, n) = i)"
    return (f"CASE WHEN {x} IS NULL THEN '' WHEN {g(1)} <> '' THEN array_to_string({uniq}, chr(10)) "
            f"WHEN len({nums}) > 0 THEN array_to_string({nums}, chr(10)) ELSE {x} END")


_ALL = {
    "tenders": (TENDERS, []), "stored_tenders": (STORED_TENDERS, ["tenders"]), "lines": (LINES, []),
    "pvs": (PVS, ["lines"]), "stored_pvs": (STORED_PVS, ["pvs"]), "candidates": (CANDIDATES, ["lines"]),
    "listing": (LISTING, ["lines"]), "next_tenders": (NEXT, ["tenders"]), "outcomes": (OUTCOMES, []),
    "files": (FILES, []), "docs": (DOCS, []),
}


def with_tables(sql: str) -> str:
    """Put the derived tables a query names in front of it."""
    order: list[str] = []

    def need(name: str) -> None:
        if name in order:
            return
        for parent in _ALL[name][1]:
            need(parent)
        order.append(name)

    for name in _ALL:
        if re.search(rf"\b{name}\b", sql):
            need(name)
    if not order:
        return sql
    head = ",\n".join(_ALL[name][0] for name in order)
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {head},\n{body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {head},\n{body[5:]}"
    return f"WITH {head}\n{body}"
