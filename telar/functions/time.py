"""Dates and instants. ``as_of`` is always a parameter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE = "America/Lima"


def local_date(ts: Column, zone: str = ZONE) -> Column:
    """Calendar date of an instant in a zone (the session's zone is UTC)."""
    return F.to_date(F.from_utc_timestamp(ts.cast("timestamp"), zone))


def today(as_of: str | None = None, zone: str = ZONE) -> Column:
    """The local date of ``as_of`` (an ISO instant, UTC if naive), or of now."""
    return local_date(F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp(), zone)


def parse_source_date(c: Column, source_zone: str = "UTC") -> Column:
    """``dd/mm/yyyy HH:MM:SS`` (also unpadded) to an instant; null if it is no date."""
    ts = F.try_to_timestamp(F.trim(c), F.lit("d/M/yyyy H:m:s"))
    return ts if source_zone == "UTC" else F.to_utc_timestamp(ts, source_zone)


def parse_iso(c: Column) -> Column:
    """ISO text with or without zone (Z allowed) to an instant; null if it is none."""
    return F.nullif(F.trim(c), F.lit("")).try_cast("timestamp")


def iso_or_null(c: Column) -> Column:
    """The trimmed text itself if it reads as an instant."""
    return F.when(parse_iso(c).isNotNull(), F.trim(c))


def positive_id(c: Column) -> Column:
    """A positive integer, also from text or an integral number; else null."""
    n = c.cast("string").try_cast("decimal(20,4)")
    return F.when((n > 0) & (n == F.floor(n)) & (n <= 9223372036854775807), n.try_cast("long"))


def window_open(end: Column, now: Column) -> Column:
    """Whether the window's end is known and after now."""
    return F.coalesce(end > now, F.lit(False))
