"""Change log between two states of the tenders table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def number_text(c: Column) -> Column:
    """A double as plain decimal text with at least one decimal place; one that this form can't hold as the double is printed."""
    plain = c.try_cast("decimal(38,10)")
    return F.when(plain.cast("double") == c, F.regexp_replace(plain.cast("string"), r"(\.\d+?)0+$", "$1")).otherwise(c.cast("string"))


def _as_text(df: DataFrame, side: str, field: str) -> Column:
    c = F.col(f"{side}.{field}")
    if isinstance(df.schema[field].dataType, (T.DoubleType, T.FloatType)):
        return number_text(c)
    return c.cast("string")


def change_log(old: DataFrame, new: DataFrame, fields: list[str], changed_at: Column,
               strict: tuple[str, ...] = ("status",), within: str | None = None) -> DataFrame:
    """One row per changed field. Fields in ``strict`` compare with plain inequality (a null on either
    side is no change), the others null-safely. One join, then the watched fields are unfolded in place.
    Where both sides are dealt by a column that a row keeps (``within``), they are joined on it and ids are compared there."""
    if within is None:
        joined = old.select("id", *fields).alias("o").join(new.select("id", "reference", *fields).alias("n"), "id")
    else:
        same = (F.col("_o") == F.col("_n")) & F.col("o.id").between(F.col("n.id"), F.col("n.id"))
        joined = old.select(F.col(within).alias("_o"), F.struct("id", *fields).alias("o")).join(
            new.select(F.col(within).alias("_n"), F.struct("id", "reference", *fields).alias("n")), same).withColumn("id", F.col("o.id"))
    events = []
    for f in fields:
        before, after = F.col(f"o.{f}"), F.col(f"n.{f}")
        differs = F.coalesce(before != after, F.lit(False)) if f in strict else ~before.eqNullSafe(after)
        events.append(F.struct(differs.alias("differs"), F.lit(f).alias("field"),
                               _as_text(old, "o", f).alias("old_value"), _as_text(new, "n", f).alias("new_value")))
    log = joined.select(
        F.col("id").alias("tender_id"), F.col("n.reference").alias("reference"),
        F.explode(F.filter(F.array(*events), lambda e: e.differs)).alias("e"))
    return log.select("tender_id", "reference", "e.field", "e.old_value", "e.new_value", changed_at.alias("changed_at"))


def status_log(old: DataFrame, new: DataFrame, changed_at: Column) -> DataFrame:
    return change_log(old, new, ["status"], changed_at)


def estimate_log(old: DataFrame, new: DataFrame, changed_at: Column) -> DataFrame:
    return change_log(old, new, ["estimation"], changed_at)


def bump_updated_at(table: DataFrame, touched: DataFrame, as_of: Column) -> DataFrame:
    """New modification time for every touched row, also where no value moved."""
    ids = touched.select("id").distinct().withColumn("_hit", F.lit(True))
    return table.join(ids, "id", "left").withColumn(
        "updated_at", F.when(F.col("_hit"), as_of).otherwise(F.col("updated_at"))).select(*table.columns)
