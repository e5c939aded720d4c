"""Phone numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tenderloom import schemas as S


def phone_numbers(c: Column) -> Column:
    """National numbers in reading order; a ``…NN/NN`` range adds both ends and removes repeats."""
    packed = F.translate(c, " -.", "")
    plain = F.transform(F.regexp_extract_all(packed, F.lit(S.PATTERN_PHONE), F.lit(1)),
                        lambda n: F.concat(F.lit("0"), n))
    stem, first, second = (F.regexp_extract(packed, S.PATTERN_PHONE_RANGE, g) for g in (1, 2, 3))
    ends = F.array(F.concat(F.lit("0"), stem, first), F.concat(F.lit("0"), stem, second))
    return F.when(stem != "", F.array_distinct(F.concat(plain, ends))).otherwise(plain)


def normalize_phone(c: Column) -> Column:
    """One number per line; a text without any number stays as it is."""
    numbers = phone_numbers(c)
    return (F.when(c.isNull(), F.lit(""))
            .when(F.size(numbers) > 0, F.array_join(numbers, "\n")).otherwise(c))
