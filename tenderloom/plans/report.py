"""The daily report as text, streamed from its rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderloom import schemas as S
from tenderloom.operators.kpi import report_lines

# Fixed headings.
TITLE = "📊 RAPPORT QUOTIDIEN — Marchés Publics — {day}"
HEADINGS = {
    2: ["", "── Statuts ──"],
    3: ["", "🚨 OFFRES PRIORITAIRES (Budget > {millions}M DH) :", "─" * 40],
    4: ["", "⏰ OFFRES EXPIRANT DANS {days} JOURS :", "─" * 40],
}


def ordered(lines: DataFrame) -> DataFrame:
    return lines.orderBy("section", F.desc("weight"), "sort_text", "id")


def text_lines(lines: DataFrame, as_of: dt.date, days: int = S.ALERT_DAYS, threshold: float = S.BUDGET_THRESHOLD,
               footer: str | None = None) -> Iterator[str]:
    """Report lines in order of reading. Rows come partition by partition, never as a whole."""
    yield TITLE.format(day=as_of.strftime("%d/%m/%Y"))
    yield "=" * 60
    yield ""
    section = 1
    for row in ordered(lines).select("section", "line").toLocalIterator():
        while section < row.section:
            section += 1
            if section == row.section or section == 2:
                yield from (h.format(days=days, millions=f"{threshold / 1e6:g}") for h in HEADINGS[section])
        yield row.line
    if section < 2:   # this heading stands even over no rows
        yield from HEADINGS[2]
    yield ""
    yield "─" * 60
    if footer:
        yield footer


def render(tenders: DataFrame, pvs: DataFrame, as_of: dt.date, threshold: float = S.BUDGET_THRESHOLD,
           days: int = S.ALERT_DAYS, expiring_limit: int | None = None, footer: str | None = None) -> str:
    lines = report_lines(tenders, pvs, as_of, threshold, days, expiring_limit)
    return "\n".join(text_lines(lines, as_of, days, threshold, footer))


def stats_lines(kpis: DataFrame, statuses: DataFrame) -> list[str]:
    """Statistics print of the tables: a line per status (a handful) and the counters (one row)."""
    k = kpis.first()
    out = [f"  {r.status:<25} : {r.n}" for r in statuses.toLocalIterator()]
    named = [("Total", k.total), ("Nouvelles aujourd'hui", k.new_today), ("Budget > 70M", k.high_budget),
             ("Erreurs", k.errors), ("Sans url_id", k.without_url_id)]
    return out + [f"  {label:<25} : {value}" for label, value in named]
