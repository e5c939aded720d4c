"""Export projections and marking exported rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderloom import schemas as S
from tenderloom.functions.amounts import format_amount, priority_flag
from tenderloom.functions.dates import days_left, days_left_label, normalize_date
from tenderloom.functions.keys import tender_key
from tenderloom.functions.phones import normalize_phone
from tenderloom.functions.text import or_default
from tenderloom.operators.outcomes import mark
from tenderloom.sources.tables import append, exists, keyed, put


def exported_references(target: DataFrame, column: str = "Référence") -> DataFrame:
    """References in an export target, without the leading quote mark."""
    return target.select(F.replace(F.col(column), F.lit("'"), F.lit("")).alias("reference")).distinct()


def not_exported(rows: DataFrame, references: DataFrame, by: str = "reference") -> DataFrame:
    """Rows the target does not hold. ``by="key"`` expects ``key`` in ``references``."""
    if by == "key":
        keyed = rows.withColumn("key", tender_key(F.col("url_id"), F.col("reference")))
        return keyed.join(references.select("key").distinct(), "key", "left_anti").select(*rows.columns)
    return rows.join(references.select("reference").distinct(), "reference", "left_anti").select(*rows.columns)


def tender_export(rows: DataFrame, as_of: Column, threshold: float = S.BUDGET_THRESHOLD,
                  rule: str = "budget_only", keep: list[str] | None = None) -> DataFrame:
    """The 17 text columns of the tender sheet, one projection."""
    text = lambda name: or_default(F.col(name), "")
    days = days_left(F.col("date_limite"), as_of)
    values = [
        F.concat(F.lit("'"), F.col("reference")),
        normalize_date(F.col("date_publication")), normalize_date(F.col("date_limite")),
        text("objet"), text("acheteur"), format_amount(F.col("estimation")), text("domaines"),
        text("contact_nom"), text("contact_email"), normalize_phone(F.col("contact_tel")),
        normalize_phone(F.col("contact_fax")), text("attributaire"), format_amount(F.col("montant_reel")),
        normalize_date(F.col("date_attribution")),
        F.coalesce(F.nullif(F.col("nb_soumissionnaires"), F.lit(0)).cast("string"), F.lit("")),
        days_left_label(days),
        priority_flag(F.col("estimation"), threshold, days if rule == "budget_and_days" else None),
    ]
    return rows.select(*(keep or []), *[v.alias(h) for v, h in zip(values, S.TENDER_HEADERS)])


def pv_export(rows: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The 5 text columns of the minutes sheet."""
    text = lambda name: or_default(F.col(name), "")
    values = [text("reference"), text("procedure_type"), normalize_date(F.col("date_publication")), text("pdf_url"),
              F.lit("✓")]
    return rows.select(*(keep or []), *[v.alias(h) for v, h in zip(values, S.PV_HEADERS)])


def export_tenders(tenders: DataFrame, rows: DataFrame, target: str, as_of: Column, fmt: str = "csv",
                   threshold: float = S.BUDGET_THRESHOLD, references: DataFrame | None = None) -> DataFrame:
    """Append the rows the target lacks, then return the table with all of ``rows`` marked done.

    Marking follows the write, so a failed write marks nothing.
    """
    new = rows if references is None else not_exported(rows, references)
    append(tender_export(new, as_of, threshold), target, fmt)
    return mark(tenders, rows, as_of.cast("timestamp"), status="DONE")


def export_pvs(pvs: DataFrame, rows: DataFrame, target: str, fmt: str = "csv", as_of: Column | None = None) -> DataFrame:
    append(pv_export(rows), target, fmt)
    return mark(pvs, rows, as_of, synced_to_sheets=1)


def exported_before(spark: SparkSession, target: str, batch: str, headers: list[str], fmt: str = "csv") -> DataFrame:
    """References that other batches have put into a batch-wise target; none if there is no target yet."""
    schema = T.StructType([T.StructField(h, T.StringType()) for h in headers] + [T.StructField("batch", T.StringType())])
    if not exists(spark, target):
        return spark.createDataFrame([], "reference string")
    return exported_references(keyed(spark, target, schema, fmt).filter(F.col("batch") != batch), headers[0])


def write_batch(rows: DataFrame, sheet: DataFrame, target: str, batch: str, fmt: str = "csv") -> DataFrame:
    """Puts ``sheet`` into the target's folder of this batch and returns the ids to be marked, as read back.

    Both the folder and the list of ids beside the target are overwritten, and the list follows the sheet. So a batch that broke off at any point is
    repeated as it is: what it had written is written anew, other batches aren't touched, and nothing is marked that isn't in the target.
    """
    put(sheet, f"{target}/batch={batch}", fmt)
    listed = f"{target.rstrip('/')}-ids/batch={batch}"
    rows.select("id").write.mode("overwrite").parquet(listed)
    return rows.sparkSession.read.schema("id long").parquet(listed)


def export_tenders_once(tenders: DataFrame, rows: DataFrame, target: str, batch: str, as_of: Column, fmt: str = "csv",
                        threshold: float = S.BUDGET_THRESHOLD) -> DataFrame:
    """Rows the target doesn't hold from other batches go into this batch's folder; all of ``rows`` are marked done. Safe to repeat.

    Of several rows with one reference all are written, as the target is looked at before the batch only.
    """
    new = not_exported(rows, exported_before(rows.sparkSession, target, batch, S.TENDER_HEADERS, fmt))
    done = write_batch(rows, tender_export(new, as_of, threshold), target, batch, fmt)
    return mark(tenders, done, as_of.cast("timestamp"), status="DONE")


def export_pvs_once(pvs: DataFrame, rows: DataFrame, target: str, batch: str, as_of: Column | None = None, fmt: str = "csv") -> DataFrame:
    """Minutes into this batch's folder, then marked. Safe to repeat."""
    return mark(pvs, write_batch(rows, pv_export(rows), target, batch, fmt), as_of, synced_to_sheets=1)
