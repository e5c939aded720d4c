"""Small join helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def spread_nulls(key: Column, salt: Column) -> Column:
    """A join key whose missing values are spread over all partitions and match nothing.

    Outer joins send every null key to one task; the zero character keeps the stand-ins apart from
    real keys.
    """
    return F.coalesce(key, F.concat(F.lit("\u0000"), salt.cast("string")))
