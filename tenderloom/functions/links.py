"""Links of the portal. The base address is always an argument."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tenderloom import schemas as S


def url_id(link: Column, parameter: str = "refConsultation") -> Column:
    """Digits of the identifying query parameter; empty when there is none."""
    return F.coalesce(F.regexp_extract(link, rf"[?&]{parameter}=(\d+)", 1), F.lit(""))


def resolve(href: Column, base: str) -> Column:
    """A link that is only a query string is put behind the base."""
    return F.when(href.startswith("?"), F.concat(F.lit(base), href)).otherwise(href)


def rebuild_pdf(href: Column, base: str) -> Column:
    """Base plus what stands between the first and the second question mark."""
    query = F.get(F.split(href, r"\?"), F.lit(1))
    return F.when(href.contains("?"), F.concat(F.lit(base + "?"), query)).otherwise(href)


def absolute(link: Column, base: str) -> Column:
    """Links without a scheme are put behind the site root."""
    root = base.split("index.php")[0].rstrip("/")
    return F.when(link.startswith("http"), link).otherwise(
        F.concat(F.lit(root + "/"), F.ltrim(link, F.lit("/"))))


def query_value(link: Column, key: str) -> Column:
    """Decoded value of a query parameter; null when absent or blank."""
    raw = F.try_parse_url(link, F.lit("QUERY"), F.lit(key))
    return F.nullif(F.coalesce(F.try_url_decode(raw), raw), F.lit(""))


def archive_url(link: Column, base: str) -> Column:
    """Direct archive address; null unless both identifying parameters are there."""
    ref, org = query_value(link, "refConsultation"), query_value(link, "orgAcronyme")
    return F.concat(F.lit(f"{base}?page=entreprise.EntrepriseDownloadCompleteDce&reference="), ref,
                    F.lit("&orgAcronym="), org)


def first_minutes_href(html: Column) -> Column:
    """Target of the first anchor that leads to published minutes; empty when there is none."""
    hrefs = F.regexp_extract_all(
        html, F.lit(rf"""(?is)<a\b[^>]*?\shref\s*=\s*["']([^"']*{S.HREF_MINUTES}[^"']*)["']"""), F.lit(1))
    return F.coalesce(F.replace(F.get(hrefs, F.lit(0)), F.lit("&amp;"), F.lit("&")), F.lit(""))
