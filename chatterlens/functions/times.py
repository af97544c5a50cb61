"""Timestamp helpers that give UTC results whatever the session time zone is."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

# Calendar form of ISO 8601; the offset is looked at on its own.
ISO_SHAPE = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.,]\d{1,9})?)?([Zz]|[+-]\d{2}(:?\d{2})?)?)?$"
ISO_OFFSET = r"[T ].*([Zz]|[+-]\d{2}(:?\d{2})?)$"


def ntz_to_utc(ts_ntz: Column) -> Column:
    """Read a wall-clock timestamp as UTC. Built from its fields: a difference would be taken in session time."""
    minutes = (F.unix_date(ts_ntz.cast("date")).cast("bigint") * 24 + F.hour(ts_ntz)) * 60 + F.minute(ts_ntz)
    second_micros = (F.extract(F.lit("SECOND"), ts_ntz) * 1_000_000).cast("bigint")
    return F.timestamp_micros(minutes * 60_000_000 + second_micros)


def utc_to_ntz(ts: Column) -> Column:
    """The UTC wall clock of an instant."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), F.expr(EPOCH_NTZ))


def iso_utc(ts: Column) -> Column:
    """ISO 8601 text with ``+00:00``; six fraction digits, or none when they are zero."""
    text = F.replace(utc_to_ntz(ts).cast("string"), F.lit(" "), F.lit("T"))
    padded = F.when(F.length(text) > 19, F.rpad(text, 26, "0")).otherwise(text)
    return F.concat(padded, F.lit("+00:00"))


def hour_utc(ts: Column) -> Column:
    """Start of the UTC hour."""
    return F.timestamp_seconds(F.floor(F.unix_seconds(ts) / 3600) * 3600)


def date_utc(ts: Column) -> Column:
    return utc_to_ntz(ts).cast("date")


def parse_iso(text: Column) -> Column:
    """Timestamp of ISO text, NULL where it is not ISO; text without an offset is read as UTC."""
    shaped = F.when(text.rlike(ISO_SHAPE), F.replace(text, F.lit(","), F.lit(".")))
    instant = shaped.try_cast("timestamp")
    wall = ntz_to_utc(shaped.try_cast("timestamp_ntz"))
    return F.when(text.rlike(ISO_OFFSET), instant).otherwise(wall)
