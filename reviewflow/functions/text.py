"""String expressions: Unicode trim, blank test, review text assembly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space str.strip removes (every character str.isspace accepts: ASCII
# controls 9-13 and 28-31, space, and the Unicode spaces and line separators; all lie
# below U+3001), built from that rule rather than listed.
WHITE_SPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def utrim(c: Column | str) -> Column:
    """Strip white space at both ends, as str.strip does. ``btrim`` walks in from the
    two ends only, so a long text costs no more than its edges (a regex replace would
    scan and copy the whole text)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.btrim(c, F.lit(WHITE_SPACE))


def nonblank(c: Column | str) -> Column:
    """True when the value has a character other than white space; null counts as blank."""
    c = F.col(c) if isinstance(c, str) else c
    return utrim(F.coalesce(c, F.lit(""))) != ""


def present(c: Column | str) -> Column:
    """Python truthiness of an optional string: not null and not empty."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c, F.lit("")) != ""


def fill_blank(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c, F.lit(""))


# Fixed value: the separator between headline and body of a review.
TITLE_TEXT_SEPARATOR = ". "


def full_text(title: Column | str, text: Column | str, fill: bool = False) -> Column:
    """``title + '. ' + text``. Without ``fill`` a missing side gives a missing result
    (string addition with a missing value); ``fill`` joins the empty-filled columns."""
    title = F.col(title) if isinstance(title, str) else title
    text = F.col(text) if isinstance(text, str) else text
    if fill:
        title, text = fill_blank(title), fill_blank(text)
    return F.concat(title, F.lit(TITLE_TEXT_SEPARATOR), text)


def first_element(arr: Column) -> Column:
    """First array element, null for an empty or null array.

    Same answer as ``try_element_at(arr, 1)``, which fails whole-stage code
    generation on Spark 4.1 for arrays of structs; this form compiles."""
    return F.when(F.size(arr) > 0, F.element_at(arr, 1))


def nth_element(arr: Column, n: int) -> Column:
    """``n``-th (1-based) array element, null when the array is shorter or null."""
    return F.when(F.size(arr) >= n, F.element_at(arr, n))
