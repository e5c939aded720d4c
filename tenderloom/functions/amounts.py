"""Amounts of money: reading, searching and printing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tenderloom import schemas as S
from tenderloom.functions.text import SPACE, first_group

_ARABIC = "٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹"
_ASCII = "01234567890123456789"


def parse_amount(c: Column) -> Column:
    """First number of the text once letters and white space are gone; a comma is a decimal point."""
    plain = F.translate(c, _ARABIC + ",", _ASCII + ".")
    bare = F.regexp_replace(plain, rf"[A-Za-zÀ-ÿ{SPACE}]", "")
    return F.nullif(F.regexp_extract(bare, r"[0-9][0-9.]*", 0), F.lit("")).try_cast("double")


def format_amount(c: Column) -> Column:
    """Whole number, halves to even, thousands apart by a space; null gives an empty text. What 38 digits don't hold, infinity and NaN among
    it, is printed as the double is."""
    whole = F.bround(c, 0).try_cast("decimal(38,0)")
    return F.coalesce(F.replace(F.format_number(whole, 0), F.lit(","), F.lit(" ")), c.cast("string"), F.lit(""))


def format_amount_text(c: Column) -> Column:
    """As :func:`format_amount` for a text column; a text that is no number stays as it is."""
    number = c.try_cast("double")
    return F.when(c.isNull(), F.lit("")).when(number.isNull(), c).otherwise(format_amount(number))


def truncated_amount(c: Column) -> Column:
    """Cut to a whole number, thousands apart by a space; ``N/A`` for null and zero."""
    cut = F.when(c >= 0, F.floor(c)).otherwise(F.ceil(c)).cast("decimal(38,0)")
    whole = F.when(F.abs(c) < 2.0 ** 53, cut).otherwise(c.try_cast("decimal(38,0)"))     # beyond, a double has no fraction
    text = F.coalesce(F.replace(F.format_number(whole, 0), F.lit(","), F.lit(" ")), c.cast("string"))
    return F.when(c.isNull() | (c == 0), F.lit("N/A")).otherwise(text)


def find_amount(text: Column, floor: float = 1000.0) -> Column:
    """Labelled amount, else a grouped amount with a currency; only values above the floor count."""
    labelled = parse_amount(first_group(text, S.PATTERN_AMOUNT_LABELLED, dot_all=True))
    grouped = parse_amount(first_group(text, S.PATTERN_AMOUNT_GROUPED))
    return F.coalesce(F.when(labelled > floor, labelled), F.when(grouped > floor, grouped))


def merge_estimate(stored: Column, found: Column) -> Column:
    """Stored estimate unless it is null or zero."""
    return F.coalesce(F.nullif(stored, F.lit(0.0)), found)


def awarded_amount(text: Column) -> Column:
    return parse_amount(first_group(text, S.PATTERN_AWARD_AMOUNT))


def bidder_count(text: Column) -> Column:
    return first_group(text, S.PATTERN_BIDDERS).try_cast("int")


def priority_flag(estimate: Column, threshold: float = S.BUDGET_THRESHOLD, days: Column | None = None,
                  min_days: int = 30) -> Column:
    """OUI above the budget threshold. With ``days`` given, the deadline must also be far enough."""
    hit = F.coalesce(estimate.try_cast("double"), F.lit(0.0)) > threshold
    if days is not None:
        hit = hit & F.coalesce(days > min_days, F.lit(False))
    return F.when(hit, "OUI").otherwise("NON")
