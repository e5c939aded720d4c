"""Data-quality audits and schema conformance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderloom import schemas as S


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; null is no value."""
    return (df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
            .agg(F.count(F.lit(1)).alias("n")).filter("n > 1").withColumn("field", F.lit(column)))


def uniqueness_audit(tenders: DataFrame, pvs: DataFrame) -> DataFrame:
    return (duplicates(tenders, "url_id").unionByName(duplicates(tenders, "tender_hash"))
            .unionByName(duplicates(pvs, "hash_pdf")))


def without_tender(pvs: DataFrame, tenders: DataFrame) -> DataFrame:
    """Minutes that point to no tender."""
    return pvs.join(tenders.select(F.col("id").alias("tender_id")), "tender_id", "left_anti")


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing values per column: one pass, then the single row is unfolded."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "field", "n_null")


def required_audit(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, field, n_null) of every required column of the tables given: one pass over each."""
    counts = [null_counts(df, REQUIRED[name]).select(F.lit(name).alias("table"), "field", "n_null") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def conform(df: DataFrame, schema: T.StructType, defaults: dict | None = None) -> DataFrame:
    """Add missing columns with their default, cast and order as declared."""
    defaults = defaults or {}
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(defaults.get(f.name))).cast(f.dataType).alias(f.name)
        for f in schema.fields])


def added_columns(df: DataFrame, schema: T.StructType) -> list[str]:
    have = set(df.columns)
    return [f.name for f in schema.fields if f.name not in have]


def insert_defaults(df: DataFrame, as_of) -> DataFrame:
    """Declared defaults for new rows."""
    values = {"status": F.lit("TO_ENRICH"), "retry_count": F.lit(0), "synced_to_sheets": F.lit(0),
              "created_at": as_of, "updated_at": as_of}
    return df.withColumns({c: F.coalesce(c, v) for c, v in values.items() if c in df.columns})


TENDER_DEFAULTS = {"retry_count": 0, "status": "TO_ENRICH"}
REQUIRED = {"tenders": ["reference", "status"], "pvs": ["tender_id"], "history": ["field"]}
ADDED = S.ADDED_COLUMNS
