"""Column functions that repair messy text, numbers, dates and categories."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

# Spellings found in the incident data and what they stand for.
YES = ("true", "yes", "1")
NO = ("false", "no", "0")

CASE_STATUS = {
    "Open": ("open",),
    "Closed": ("closed",),
    "Pending": ("pending", "pendng"),
    "Under Investigation": ("under investigation", "investgation"),
    "Resolved": ("resolved",),
}
RESOLUTION = {
    "Arrest Made": ("arrest made", "arres made"),
    "No Arrest": ("no arrest",),
    "Case Dismissed": ("dismissed", "case dismissed"),
    "Warning Issued": ("warning", "warning issued"),
}
GENDER = {"Male": ("male", "m"), "Female": ("female", "f"), "Other": ("other",)}

# Date formats in the order in which they are tried, so that an
# ambiguous day and month is read month first.
DATE_FORMATS = ("yyyy-MM-dd HH:mm:ss", "MM-dd-yyyy", "dd-MM-yyyy", "MM/dd/yyyy HH:mm")

# What the fields of a date format can look like.
FIELD_SHAPES = {
    "yyyy": r"[+-]?\d{4,}",
    "MM": r"(?:0[1-9]|1[0-2])",
    "dd": r"(?:0[1-9]|[12]\d|3[01])",
    "HH": r"(?:[01]\d|2[0-3])",
    "mm": r"[0-5]\d",
    "ss": r"[0-5]\d",
}

# Upper bounds (exclusive) of the age groups.
AGE_GROUPS = ((18, "Minor"), (30, "Young Adult"), (60, "Adult"))

REVIEW = "NEEDS_REVIEW"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalised(c: Column | str) -> Column:
    return F.lower(F.trim(_col(c)))


def parse_boolean(c: Column | str, yes: Sequence[str] = YES, no: Sequence[str] = NO) -> Column:
    """Yes and no words to a boolean; anything else is NULL."""
    word = normalised(c)
    return F.when(word.isin(*yes), True).when(word.isin(*no), False)


def shape_of(pattern: str) -> str:
    """A regular expression that every text in the date format matches; ``.*`` for formats with other parts."""
    if not re.fullmatch(f"(?:{'|'.join(FIELD_SHAPES)}|[-/:. ])+", pattern):
        return ".*"
    escaped = pattern.replace(".", r"\.")
    return "^" + re.sub("|".join(FIELD_SHAPES), lambda field: FIELD_SHAPES[field[0]], escaped) + "$"


def parse_timestamp(c: Column | str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """The first format that fits; NULL if none does.

    A failed parse throws inside the JVM and is far slower than a match, so each format
    is tried only on text of its shape.
    """
    text = _col(c)
    return F.coalesce(*[F.when(text.rlike(shape_of(f)), F.try_to_timestamp(text, F.lit(f))) for f in formats])


def standardise(c: Column | str, variants: Mapping[str, Sequence[str]], default: str | None = None) -> Column:
    """Map spellings to their category, ignoring case and outer spaces."""
    word = normalised(c)
    result = F.lit(default)
    for category, spellings in reversed(list(variants.items())):
        result = F.when(word.isin(*spellings), F.lit(category)).otherwise(result)
    return result


def standardise_gender(c: Column | str) -> Column:
    return standardise(c, GENDER)


def repair_number(c: Column | str) -> Column:
    """Text to double; ``46792.6.0`` loses its extra ``.0``, other junk becomes NULL."""
    text = F.regexp_replace(_col(c), r"(\.\d+)\.0$", "$1")
    return F.when(text.rlike(r"(?i)\d|nan|inf"), text.try_cast("double"))


def review_flag(c: Column | str) -> Column:
    """Marks a negative value, to be read before the value is removed."""
    return F.when(_col(c) < 0, REVIEW)


def non_negative(c: Column | str, null_as: object = None) -> Column:
    """Negative values to NULL; a NULL becomes ``null_as``."""
    value = _col(c)
    kept = F.when(value >= 0, value)
    return kept if null_as is None else F.when(value.isNull(), F.lit(null_as)).otherwise(kept)


def in_range(c: Column | str, low: float, high: float) -> Column:
    """Values outside the closed range to NULL."""
    value = _col(c)
    return F.when(value.between(low, high), value)


def band(
    c: Column | str,
    bounds: Sequence[tuple[float, str]] = AGE_GROUPS,
    above: str = "Senior",
    missing: str = "Unknown",
) -> Column:
    """Label by the first upper bound (exclusive) that exceeds the value."""
    value = _col(c)
    result = F.when(value.isNull(), missing)
    for bound, label in bounds:
        result = result.when(value < bound, label)
    return result.otherwise(above)


def optional_range(c: Column | str, low: object = None, high: object = None) -> Column:
    """``low <= c <= high`` where a bound of None is open."""
    value, test = _col(c), F.lit(True)
    if low is not None:
        test = test & (value >= F.lit(low))
    if high is not None:
        test = test & (value <= F.lit(high))
    return test
