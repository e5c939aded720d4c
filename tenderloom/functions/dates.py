"""Dates kept as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tenderloom.functions.text import strip


def normalize_date(c: Column) -> Column:
    """``dd/mm/yyyy`` texts stay, ISO texts are turned round without seconds, others stay; null is empty."""
    s = strip(c)
    iso = r"(?s)\A(\d{4})-(\d{2})-(\d{2})"
    return (
        F.when(c.isNull(), F.lit(""))
        .when(s.rlike(r"\A\d{2}/\d{2}/\d{4}"), s)
        .when(s.rlike(iso + r"[ T]\d{2}:\d{2}"),
              F.regexp_replace(s, iso + r"[ T](\d{2}:\d{2}).*\z", "$3/$2/$1 $4"))
        .when(s.rlike(iso), F.regexp_replace(s, iso + r".*\z", "$3/$2/$1"))
        .otherwise(s)
    )


def days_left(deadline: Column, as_of: Column) -> Column:
    """Days from ``as_of`` to the deadline; null when the text before the first space is no date."""
    part = F.split_part(deadline, F.lit(" "), F.lit(1))
    day = F.when(part.rlike(r"\A\d{1,2}/\d{1,2}/\d{4}\z"),
                 F.try_to_timestamp(part, F.lit("d/M/yyyy")).cast("date"))
    return F.datediff(day, as_of)


def days_left_label(days: Column) -> Column:
    return (F.when(days.isNull(), F.lit("")).when(days < 0, F.lit("Expiré"))
            .otherwise(days.cast("string")))
