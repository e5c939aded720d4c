"""Retention by kind and age."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderloom import schemas as S


def is_expired(kind: Column, modified_at: Column, as_of: Column, days: dict[str, int] = S.RETENTION_DAYS) -> Column:
    """Whole days of age above the kind's limit; kinds without a limit never expire.

    The limits are a literal map in the projection, so no join is planned.
    """
    limits = F.create_map(*[F.lit(x) for pair in days.items() for x in pair])
    age = F.floor(F.timestamp_diff("SECOND", modified_at, as_of) / 86400)
    return F.coalesce(age > limits[kind], F.lit(False))


def split(files: DataFrame, as_of: Column, days: dict[str, int] = S.RETENTION_DAYS) -> tuple[DataFrame, DataFrame]:
    """(survivors, expired)"""
    gone = is_expired(F.col("kind"), F.col("modified_at"), as_of, days)
    return files.filter(~gone), files.filter(gone)


def expired_counts(files: DataFrame, as_of: Column, days: dict[str, int] = S.RETENTION_DAYS) -> DataFrame:
    """Expired files of each kind that has a limit, also where there is none: one pass, then the single row is unfolded."""
    gone = is_expired(F.col("kind"), F.col("modified_at"), as_of, days)
    counts = files.agg(*[F.count_if(gone & (F.col("kind") == kind)).alias(kind) for kind in days])
    return counts.unpivot([], list(days), "kind", "n_expired")
