"""Text helpers, all ``Column -> Column``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tenderloom import schemas as S

# The characters that count as white space (Unicode, with the four ASCII separators).
SPACE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE_CHARS = "".join(chr(i) for i in (
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
_FLAGS = "(?idU)"  # ignore case, only \n ends a line, Unicode classes


def strip(c: Column) -> Column:
    """White space off both ends (a character set, so no regular expression is run)."""
    return F.btrim(c, F.lit(SPACE_CHARS))


def collapse(c: Column) -> Column:
    """One space for every run of white space, none at the ends."""
    return strip(F.regexp_replace(c, rf"[{SPACE}]+", " "))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def keep_non_empty(new: Column, old: Column) -> Column:
    """The new value unless it is null or empty."""
    return F.when(new != "", new).otherwise(old)


def or_default(c: Column, default, falsy=None) -> Column:
    """Null, and the falsy value if one is named, become the default."""
    value = c if falsy is None else F.nullif(c, F.lit(falsy))
    return F.coalesce(value, F.lit(default))


def pattern(regex: str, dot_all: bool = False) -> str:
    """The same pattern for the JVM: case-insensitive with Unicode classes."""
    return (_FLAGS.replace("d", "ds") if dot_all else _FLAGS) + regex


def first_group(c: Column, regex: str, group: int = 1, dot_all: bool = False) -> Column:
    """Group of the leftmost match, null when nothing matches."""
    return blank_to_null(F.regexp_extract(c, pattern(regex, dot_all), group))


def find_date(c: Column) -> Column:
    """First ``dd/mm/yyyy`` in the text, empty when there is none."""
    return F.coalesce(F.regexp_extract(c, S.PATTERN_DATE, 0), F.lit(""))


def drop_label(c: Column, regex: str) -> Column:
    return strip(F.regexp_replace(c, pattern(regex), ""))


def best_text(candidates: Column) -> Column:
    """First candidate that is not blank, without its leading label; ``N/A`` when none is left."""
    first = F.get(F.filter(F.transform(candidates, strip), lambda x: ~x.isin(S.BLANK_TEXTS)), F.lit(0))
    bare = strip(F.regexp_replace(first, rf"\A[^:]+:[{SPACE}]*", ""))
    return F.coalesce(blank_to_null(bare), F.lit("N/A"))


def first_text(candidates: Column) -> Column:
    """First candidate that is not blank, as it stands; empty when there is none."""
    kept = F.filter(F.transform(candidates, strip), lambda x: ~x.isin(S.BLANK_TEXTS))
    return F.coalesce(F.get(kept, F.lit(0)), F.lit(""))


def file_safe(reference: Column, prefix: str = "", suffix: str = "") -> Column:
    return F.concat(F.lit(prefix), F.replace(reference, F.lit("/"), F.lit("_")), F.lit(suffix))


def table_line(cells: Column) -> Column:
    """Cells of one table row, stripped, joined with a bar; null cells stay as empty cells."""
    return F.array_join(F.transform(cells, lambda c: F.coalesce(strip(c), F.lit(""))), " | ")


def padded(label: Column, width: int = 20) -> Column:
    """Left-aligned to a width, never cut."""
    return F.concat(label, F.repeat(F.lit(" "), F.greatest(F.lit(0), F.lit(width) - F.length(label))))


def key_points(text: Column) -> Column:
    """Struct of the labelled key points found in the text, each stripped and shortened for display."""
    return F.struct(*[
        F.left(strip(first_group(text, regex)), F.lit(S.KEY_POINT_CHARS)).alias(label)
        for label, regex in S.KEY_POINTS
    ])


def model_excerpt(text: Column) -> Column:
    """The part of a text that an outside model is shown. Only the display column is shortened."""
    return F.left(text, F.lit(S.MODEL_EXCERPT_CHARS))
