"""Column expressions used by the cleaning layer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# URL pattern stripped from free-text category values, and the text with which each match begins.
URL_PATTERN, URL_BEGIN = r"https?://\S+", "http"


def strip_urls(col: Column | str) -> Column:
    """Remove URLs, then trim spaces at both ends (tabs are kept, inner
    double spaces left by the removal stay). Text without a URL's beginning
    is not put through the pattern."""
    c = F.col(col) if isinstance(col, str) else col
    return F.trim(F.when(c.contains(URL_BEGIN), F.regexp_replace(c, URL_PATTERN, "")).otherwise(c))


def blank_to_null(col: Column | str) -> Column:
    """The empty string becomes null; anything else (including a tab) is kept."""
    c = F.col(col) if isinstance(col, str) else col
    return F.nullif(c, F.lit(""))


def negative_flag(col: Column | str) -> Column:
    """True for a negative value, false for zero, positive or null."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c < 0, F.lit(False))
