"""Temporal source columns to text, in two profiles.

``plain`` writes what the Kafka consumers read: ``2023-07-01``, ``12:33:09``,
``2023-07-01 12:33:09``. ``lake`` writes ISO text with a zone. Fractions are
written only when they are not zero. ``zone`` is the database's zone.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _wall(source: str, target: str, value: Column) -> Column:
    return F.convert_timezone(F.lit(source), F.lit(target), value)


def _iso(value: Column) -> Column:
    return F.replace(value.cast("string"), F.lit(" "), F.lit("T"))


def date_plain(value: Column) -> Column:
    """A date, or an epoch day already turned into one by ``to_date``."""
    return value.cast("date").cast("string")


def duration_plain(micros: Column) -> Column:
    """A duration in microseconds as clock text.

    Database times may be negative or beyond a day; those keep their sign and
    their hours.
    """
    micros = micros.cast("bigint")
    size = F.abs(micros)
    seconds = F.call_function("div", size, F.lit(1000000).cast("bigint"))
    pad = lambda n: F.lpad(n.cast("string"), 2, "0")
    hours = F.call_function("div", seconds, F.lit(3600).cast("bigint"))
    hour_text = F.when(hours < 100, pad(hours)).otherwise(hours.cast("string"))
    minutes = F.call_function("div", seconds % 3600, F.lit(60).cast("bigint"))
    fraction = F.rtrim(F.lpad((size % 1000000).cast("string"), 6, "0"), F.lit("0"))
    return F.concat(
        F.when(micros < 0, F.lit("-")).otherwise(F.lit("")),
        hour_text, F.lit(":"), pad(minutes), F.lit(":"), pad(seconds % 60),
        F.when(fraction == "", F.lit("")).otherwise(F.concat(F.lit("."), fraction)),
    )


def datetime_plain(value: Column) -> Column:
    return value.cast("timestamp_ntz").cast("string")


def timestamp_plain(value: Column, snapshot: Column, zone: str) -> Column:
    """A TIMESTAMP column: snapshot rows carry local time and go to UTC, later
    changes carry UTC and go to local time."""
    return F.when(snapshot, _wall(zone, "UTC", value)).otherwise(
        _wall("UTC", zone, value)).cast("string")


def date_zulu(value: Column) -> Column:
    return F.concat(date_plain(value), F.lit("Z"))


def duration_zulu(micros: Column) -> Column:
    return F.concat(duration_plain(micros), F.lit("Z"))


def datetime_zulu(value: Column, zone: str, instant: Column | None = None) -> Column:
    """A DATETIME in UTC. Rows flagged ``instant`` hold UTC already."""
    shifted = _iso(_wall(zone, "UTC", value))
    if instant is not None:
        shifted = F.when(instant, _iso(value.cast("timestamp_ntz"))).otherwise(shifted)
    return F.concat(shifted, F.lit("Z"))


def timestamp_zulu(value: Column, snapshot: Column, zone: str) -> Column:
    """As ``timestamp_plain``, in ISO text with the offset of the result's zone."""
    local = _wall("UTC", zone, value)
    return F.when(snapshot, F.concat(_iso(_wall(zone, "UTC", value)), F.lit("Z"))).otherwise(
        F.concat(_iso(local), _offset_text(value, local)))


def epoch_micros(value: Column) -> Column:
    """Microseconds since 1970 of a timestamp without zone. Built from its fields,
    because a difference of timestamps would pass through the session's zone."""
    seconds = F.unix_date(value.cast("date")).cast("bigint") * 86400 + (
        F.hour(value) * 3600 + F.minute(value) * 60 + F.second(value))
    fraction = (F.extract(F.lit("SECOND"), value) * 1000000).cast("bigint") % 1000000
    return seconds * 1000000 + fraction


def _offset_text(utc: Column, local: Column) -> Column:
    days = F.unix_date(local.cast("date")) - F.unix_date(utc.cast("date"))
    minutes = days * 1440 + (F.hour(local) - F.hour(utc)) * 60 + F.minute(local) - F.minute(utc)
    size = F.abs(minutes)
    sign = F.when(minutes < 0, F.lit("-")).otherwise(F.lit("+"))
    hours = F.call_function("div", size, F.lit(60))
    text = F.concat(sign, F.lpad(hours.cast("string"), 2, "0"), F.lit(":"),
                    F.lpad((size % 60).cast("string"), 2, "0"))
    return F.when(minutes == 0, F.lit("Z")).otherwise(text)


def temporal_rule(source_type: str, profile: str, zone: str):
    """The rule for one source column as ``f(value, snapshot) -> text``, or None
    when the column is not temporal.

    ``value`` is a date for DATE, microseconds for TIME and a timestamp without
    zone for DATETIME and TIMESTAMP.
    """
    word = source_type.strip().upper().split("(")[0].strip()
    plain = {
        "DATE": lambda v, s: date_plain(v),
        "TIME": lambda v, s: duration_plain(v),
        "DATETIME": lambda v, s: datetime_plain(v),
        "TIMESTAMP": lambda v, s: timestamp_plain(v, s, zone),
    }
    lake = {
        "DATE": lambda v, s: date_zulu(v),
        "TIME": lambda v, s: duration_zulu(v),
        "DATETIME": lambda v, s: datetime_zulu(v, zone),
        "TIMESTAMP": lambda v, s: timestamp_zulu(v, s, zone),
    }
    if profile not in ("plain", "lake"):
        raise ValueError(f"unknown temporal profile {profile!r}")
    return (plain if profile == "plain" else lake).get(word)


def temporal_columns(source_types: Mapping[str, str], profile: str, zone: str,
                     snapshot: Column, prefix: str = "") -> dict[str, Column]:
    """The rules of a table as ``{column: text}``, for ``withColumns``; columns of
    other types are left out. ``prefix`` names a struct the columns are in."""
    found = {}
    for name, source_type in source_types.items():
        rule = temporal_rule(source_type, profile, zone)
        if rule is not None:
            found[name] = rule(F.col(f"{prefix}{name}"), snapshot)
    return found


def write_time(at: Column | None = None) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text; the time of the run unless ``at`` is given."""
    return F.date_format(F.current_timestamp() if at is None else at, "yyyy-MM-dd HH:mm:ss")
