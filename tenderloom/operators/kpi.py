"""Indicators and the lists of the daily report."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderloom import schemas as S
from tenderloom.functions.amounts import truncated_amount
from tenderloom.functions.dates import days_left
from tenderloom.functions.text import padded


def on_day(column: str, as_of: dt.date):
    return F.col(column).cast("date") == F.lit(as_of)


def is_error():
    return F.col("status").ilike("ERROR%")


def status_counts(tenders: DataFrame) -> DataFrame:
    return tenders.groupBy("status").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "status")


def kpis(tenders: DataFrame, as_of: dt.date, threshold: float = S.BUDGET_THRESHOLD) -> DataFrame:
    """All counters in one pass over four columns."""
    return tenders.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(on_day("created_at", as_of)).alias("new_today"),
        F.count_if(F.col("estimation") > threshold).alias("high_budget"),
        F.count_if(is_error()).alias("errors"),
        F.count_if(F.col("url_id").isNull()).alias("without_url_id"))


def pvs_today(pvs: DataFrame, as_of: dt.date) -> DataFrame:
    return pvs.agg(F.count_if(on_day("created_at", as_of)).alias("pvs_today"))


def priorities(tenders: DataFrame, threshold: float = S.BUDGET_THRESHOLD, limit: int = 10) -> DataFrame:
    """Largest exported tenders above the threshold (top-k, no full sort)."""
    rows = tenders.filter((F.col("status") == "DONE") & (F.col("estimation") > threshold))
    return rows.orderBy(F.desc("estimation"), "id").limit(limit).select(
        "id", "reference", "objet", "acheteur", "estimation", "date_limite")


def expiring(tenders: DataFrame, as_of: dt.date, days: int = S.ALERT_DAYS) -> DataFrame:
    """Active tenders whose deadline falls within the next days. Not ordered."""
    rows = tenders.filter(F.col("status").isin(S.STATUS_FLOW) & F.col("date_limite").isNotNull()).select(
        "id", "reference", "objet", "acheteur", "date_limite", days_left(F.col("date_limite"), F.lit(as_of)).alias("jours"))
    return rows.filter(F.col("jours").between(0, days))


def expiring_sorted(tenders: DataFrame, as_of: dt.date, days: int = S.ALERT_DAYS, chronological: bool = False,
                    limit: int | None = None) -> DataFrame:
    """By deadline text as stored, or by time; a range-partitioned sort, or a top-k with a limit."""
    rows = expiring(tenders, as_of, days).orderBy("jours" if chronological else "date_limite", "id")
    return rows if limit is None else rows.limit(limit)


def report_lines(tenders: DataFrame, pvs: DataFrame, as_of: dt.date, threshold: float = S.BUDGET_THRESHOLD,
                 days: int = S.ALERT_DAYS, expiring_limit: int | None = None) -> DataFrame:
    """The report as rows ``(section, weight, sort_text, id, line)``.

    Sorting by ``section, weight desc, sort_text, id`` gives the order of reading; no step numbers rows.
    """
    row = lambda df, section, line, weight=None, sort=None, rid=None: df.select(
        F.lit(section).alias("section"), (weight if weight is not None else F.lit(0.0)).cast("double").alias("weight"),
        (sort if sort is not None else F.lit("")).alias("sort_text"),
        (rid if rid is not None else F.lit(0)).cast("long").alias("id"), line.alias("line"))
    text = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("N/A"))
    shown = F.left(F.coalesce("objet", F.lit("")), F.lit(S.REPORT_OBJECT_CHARS))
    head = F.concat(F.lit("  ["), F.col("reference"), F.lit("] "), shown, F.lit("\n"))
    k = kpis(tenders, as_of, threshold).withColumn("pvs_today", pvs_today(pvs, as_of).scalar())
    counters = [("Nouvelles offres aujourd'hui", "new_today", "🆕"), ("Nouveaux PVs aujourd'hui   ", "pvs_today", "📋"),
                ("Total en base              ", "total", "📁"), ("Erreurs pipeline           ", "errors", "❌")]
    lines = k.select(F.posexplode(F.array(*[
        F.concat(F.lit(f"{mark} {label} : "), F.col(c).cast("string")) for label, c, mark in counters])).alias("n", "line"))
    out = row(lines, 1, F.col("line"), weight=-F.col("n"))
    out = out.unionByName(row(status_counts(tenders), 2, F.concat(
        F.lit("  "), padded(F.col("status")), F.lit(": "), F.col("n").cast("string")),
        weight=F.col("n"), sort=F.col("status")))
    out = out.unionByName(row(priorities(tenders, threshold), 3, F.concat(
        head, F.lit("    Acheteur : "), text("acheteur"), F.lit("\n    Budget   : "),
        truncated_amount(F.col("estimation")), F.lit(" DH | Limite : "), text("date_limite")),
        weight=F.col("estimation"), rid=F.col("id")))
    soon = expiring(tenders, as_of, days) if expiring_limit is None else expiring_sorted(
        tenders, as_of, days, limit=expiring_limit)
    return out.unionByName(row(soon, 4, F.concat(
        head, F.lit("    Limite : "), F.col("date_limite"), F.lit(" — dans "), F.col("jours").cast("string"),
        F.lit(" jour(s)")), sort=F.col("date_limite"), rid=F.col("id")))
