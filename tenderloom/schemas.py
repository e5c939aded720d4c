"""Table schemas and the fixed values of the domain."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _I, _D, _TS = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.TimestampType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


TENDERS = _struct(
    ("id", _L), ("url_id", _S), ("reference", _S), ("date_publication", _S), ("date_limite", _S),
    ("lien_detail", _S), ("objet", _S), ("acheteur", _S), ("estimation", _D), ("domaines", _S),
    ("contact_nom", _S), ("contact_email", _S), ("contact_tel", _S), ("contact_fax", _S),
    ("lien_dce", _S), ("attributaire", _S), ("montant_reel", _D), ("date_attribution", _S),
    ("nb_soumissionnaires", _I), ("zip_path", _S), ("resume_txt", _S), ("drive_folder_url", _S),
    ("tender_hash", _S), ("hash_content", _S), ("hash_dce", _S), ("last_seen", _TS),
    ("retry_count", _I), ("last_error", _S), ("status", _S), ("created_at", _TS), ("updated_at", _TS),
    ("detail_hash", _S),   # hash of the detail page, apart from the listing's hash_content
)

PVS = _struct(
    ("id", _L), ("tender_id", _L), ("reference", _S), ("pdf_url", _S), ("pdf_path", _S),
    ("procedure_type", _S), ("date_publication", _S), ("hash_pdf", _S), ("synced_to_sheets", _I),
    ("created_at", _TS), ("updated_at", _TS),
)

HISTORY = _struct(
    ("tender_id", _L), ("reference", _S), ("field", _S), ("old_value", _S), ("new_value", _S),
    ("changed_at", _TS),
)

LISTING = _struct(
    ("url_id", _S), ("reference", _S), ("date_publication", _S), ("date_limite", _S),
    ("lien_detail", _S), ("objet", _S), ("acheteur", _S), ("lieu", _S),
)

OUTCOMES = _struct(
    ("stage", _S), ("tender_id", _L), ("seq", _L), ("ok", T.BooleanType()), ("error", _S),
    ("next_status", _S),
)

REPLY = _struct(
    ("montant_estime", _D), ("objet", _S), ("acheteur", _S), ("date_limite", _S),
    ("lieu_execution", _S), ("domaines", _S), ("contact_email", _S), ("contact_tel", _S),
    ("resume", _S),
)

# ---------------------------------------------------------------------------------------------
# Fixed values. They must equal the portal's and the stored tables' for results to be right.
# ---------------------------------------------------------------------------------------------
STATUS_FLOW = ["TO_ENRICH", "TO_DOWNLOAD", "TO_ANALYZE", "TO_SYNC", "DONE"]
RESET_STATUS = {
    "ERROR_ENRICH": "TO_ENRICH",
    "ERROR_DOWNLOAD": "TO_DOWNLOAD",
    "ERROR_ANALYZE": "TO_ANALYZE",
    "ERROR_SYNC": "TO_SYNC",
}
PROCEDURES = {
    "40": "Concours Architectural",
    "4": "Concours Phase 1",
    "47": "Concours Phase 2",
}
ADDED_COLUMNS = [
    "url_id", "tender_hash", "hash_content", "hash_dce", "last_seen", "retry_count", "last_error",
    "attributaire", "montant_reel", "date_attribution", "nb_soumissionnaires",
]
TENDER_HEADERS = [
    "Référence", "Date Publication", "Date Limite", "Objet", "Acheteur", "Estimation (DH)",
    "Domaines", "Contact Nom", "Contact Email", "Contact Tél", "Contact Fax", "Attributaire",
    "Montant Réel (DH)", "Date Attribution", "Nb Soumissionnaires", "Jours Restants", "STATUS",
]
PV_HEADERS = ["Référence", "Procédure", "Date Publication", "Lien PDF", "Synchronisé"]
RETENTION_DAYS = {"archive": 7, "temp": 7, "log": 30, "summary": 30}
BUDGET_THRESHOLD = 70_000_000.0
ALERT_DAYS = 7
MAX_RETRY = 3
QUEUE_LIMITS = {"TO_ENRICH": 50, "TO_DOWNLOAD": 30, "TO_ANALYZE": 20, "TO_SYNC": 100}
PENDING_PV_LIMIT = 50
ERROR_NO_LINK = "Pas de lien détail"
ERROR_NO_ARCHIVE = "ZIP introuvable"
ERROR_UNRESOLVED = "Lien non résolu"
ERROR_NO_PDF = "Aucun PDF dans le ZIP"
ERROR_HASH_TAKEN = "UNIQUE constraint failed: tenders.tender_hash"

# Portal markup: element-id fragments, classes and link fragments.
DETAIL_FIELDS = {
    "caution": "cautionProvisoire",
    "qualifications": "_qualification",
    "agrements": "_agrements",
    "lieu_ouverture": "lieuOuverturePlis",
    "adresse_retrait": "adresseRetraitDossiers",
    "adresse_depot": "adresseDepotOffres",
    "reunion": "dateReunion",
    "visites": "panelRepeaterVisitesLieux",
    "variante": "varianteValeur",
}
CONTACT_FIELDS = {
    "contact_email": "_email",
    "contact_tel": "_telephone",
    "contact_fax": "_telecopieur",
}
ID_ESTIMATE = "labelReferentielZoneText"
ID_CONTACT_BLOCK = "panelContcatAdministratif"
ID_CONTACT_NAME = "contactAdministratif"
ID_OBJECT = "_panelBlocObjet"
ID_BUYER = "_panelBlocDenomination"
ID_PLACE = "_panelBlocLieuxExec"
AWARD_IDS = ["resultat", "attribution", "Attribution"]
DCE_HREFS = ["EntrepriseDemandeTelechargement", "DCE", "telecharger"]
DCE_TEXTS = ["DCE", "Télécharger le dossier"]
HREF_DETAIL = "EntrepriseDetailConsultation"
HREF_MINUTES = "EntrepriseDownloadAvis"
CLASS_REFERENCE = "ref"
CLASS_BUBBLE = "info-bulle"
CLASS_DEADLINE = "cloture-line"
BLANK_TEXTS = ["", "N/A", "-"]

# Text patterns (host-neutral; flags are added where they are used).
PATTERN_DATE = r"\d{2}/\d{2}/\d{4}"
PATTERN_PHONE = r"(?:\+212|00212|0)([5-7]\d{8})"
PATTERN_PHONE_RANGE = r"(?:\+212|00212|0)([5-7]\d{6})(\d{2})/(\d{2})"
PATTERN_LABEL_OBJECT = r"^Objet\s*:\s*"
PATTERN_LABEL_BUYER = r"^Acheteur public\s*:\s*"
PATTERN_LABEL_PLACE = r"Lieu d'exécution\s*:?\s*"
PATTERN_LABEL_ANY = r"^[^:]+:\s*"
PATTERN_AMOUNT_LABELLED = (
    r"(?:Estimation|Montant\s+du\s+programme|Budget\s+pr[ée]visionnel|"
    r"Valeur\s+estim[ée]e|Prix\s+de\s+r[ée]f[ée]rence|Enveloppe\s+budg[ée]taire)"
    r".{0,120}?(\d[\d\s,.]+)\s*(?:DH|MAD|Dhs)?"
)
PATTERN_AMOUNT_GROUPED = r"(\d{1,3}(?:[\s.]\d{3})+(?:[,.]\d{1,2})?)\s*(?:DH|MAD|Dhs)"
PATTERN_AWARDEE = r"(?:Attributaire|Titulaire|Adjudicataire)\s*:?\s*([^\n]{3,80})"
PATTERN_AWARD_AMOUNT = r"(?:Montant\s+attribu[ée]|Prix\s+retenu).{0,40}?(\d[\d\s,.]+)"
PATTERN_BIDDERS = r"(\d+)\s+(?:soumissionnaire|candidat)"
KEY_POINTS = [
    ("Objet", r"Objet.{0,5}:?\s*([^\n]{5,200})"),
    ("Acheteur", r"Acheteur.{0,5}:?\s*([^\n]{3,100})"),
    ("Estimation", r"(?:Estimation|Montant).{0,30}?(\d[\d\s,.]+\s*(?:DH|MAD)?)"),
    ("Date limite", r"Date.limite.{0,10}:?\s*(\d{2}[/\-]\d{2}[/\-]\d{4}.{0,6})"),
    ("Lieu", r"Lieu.d.ex[ée]cution.{0,10}:?\s*([^\n]{3,80})"),
    ("Email", r"([a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,})"),
    ("Téléphone", r"(?:Tél|Tel)[^\d]*(\+?212[\s.\-]?[5-7]\d{8}|0[5-7]\d{8})"),
]
REPLY_LABELS = [
    ("Objet", "objet"),
    ("Acheteur", "acheteur"),
    ("Montant estimé", "montant_estime"),
    ("Date limite", "date_limite"),
    ("Lieu exécution", "lieu_execution"),
    ("Domaines", "domaines"),
    ("Email", "contact_email"),
    ("Téléphone", "contact_tel"),
]
KEY_POINT_CHARS = 150
REPORT_OBJECT_CHARS = 50
MODEL_EXCERPT_CHARS = 4000
# ---------------------------------------------------------------------------------------------
