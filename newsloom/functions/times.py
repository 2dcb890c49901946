"""Column functions over publication times given as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_instant(c: Column) -> Column:
    """ISO text to a timestamp, without an offset as UTC; anything that does not begin with a date is null.

    The session's time zone must be UTC, as everywhere in the engine.
    """
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(c))


def rfc822_instant(c: Column) -> Column:
    """'Wed, 15 Jan 2025 06:00:00 +0000' to a timestamp; the weekday is not checked, names as offsets are read as Spark reads them."""
    bare = F.regexp_replace(F.trim(c), r"^\p{Alpha}{3},\s*", "")
    return F.coalesce(F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss Z")), F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss z")))


def epoch_instant(c: Column) -> Column:
    """Seconds, or milliseconds above 10^10, to a timestamp."""
    n = c.cast("double")
    return F.timestamp_micros((F.when(n > 1e10, n * 1000).otherwise(n * 1_000_000)).cast("long"))


def hours_before(instant: Column, as_of: Column, unknown: int = 999) -> Column:
    """Whole hours from an instant to `as_of`, 0 for later ones, `unknown` for null."""
    hours = F.floor((F.unix_timestamp(as_of) - F.unix_timestamp(instant)) / 3600).cast("int")
    return F.when(hours.isNull(), unknown).otherwise(F.greatest(F.lit(0), hours))


def address_date(c: Column) -> Column:
    """A date in an address: /2025/01/31/, /2025-01-31 or /01/31/2025/."""
    ymd = F.regexp_extract(c, r"/((?:19|20)\d{2})[/-]?(\d{2})[/-]?(\d{2})(?:\D|$)", 0)
    us = F.regexp_extract(c, r"/(\d{2})/(\d{2})/((?:19|20)\d{2})(?:/|$)", 0)
    digits = F.regexp_replace(ymd, r"\D", "")
    parts = F.regexp_replace(us, r"\D", "")
    return F.coalesce(F.try_to_date(F.when(digits != "", digits), "yyyyMMdd"), F.try_to_date(F.when(parts != "", parts), "MMddyyyy"))


def within_address_horizon(c: Column, as_of: Column, hours: int) -> Column:
    """True where the address has no date or one within the lookback, counted in days, two at least."""
    d = address_date(c)
    return d.isNull() | (d >= F.date_sub(F.to_date(as_of), max(2, hours // 24 + 1)))
