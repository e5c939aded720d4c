"""Hashes and keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tenderloom.functions.text import strip


def content_hash(text: Column) -> Column:
    return F.md5(text)


def tender_hash(reference: Column, published: Column, buyer: Column) -> Column:
    """SHA-256 over the stripped reference, date and lower-case buyer; nulls count as empty."""
    part = lambda c: strip(F.coalesce(c, F.lit("")))
    return F.sha2(F.concat_ws("|", part(reference), part(published), F.lower(part(buyer))), 256)


def tender_key(uid: Column, reference: Column) -> Column:
    """Identity of a tender: its portal number, else its reference. The two spaces never meet."""
    return F.when(uid != "", F.concat(F.lit("u:"), uid)).otherwise(F.concat(F.lit("r:"), reference))


def surrogate_id(key: Column) -> Column:
    """Stable row id for new rows; no counter, so no single-partition step."""
    return F.xxhash64(key)


def packed(text: Column) -> Column:
    """A text as bytes for a move: a hash takes half its digits and one byte, any other text its own and one. Null stays null; nothing is lost."""
    plain = F.concat(F.unhex(F.lit("00")), text.cast("binary"))
    return F.when(text.rlike(r"\A(?:[0-9a-f]{2}){16,32}\z"), F.concat(F.unhex(F.lit("01")), F.unhex(text))).otherwise(plain)


def unpacked(data: Column) -> Column:
    """The text that was :func:`packed`."""
    rest = F.substring(data, 2, (1 << 31) - 1)
    return F.when(F.substring(data, 1, 1) == F.unhex(F.lit("01")), F.lower(F.hex(rest))).otherwise(rest.cast("string"))
