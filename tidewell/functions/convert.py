"""Change-record values to typed columns.

Every converter takes a column and gives a column, stays inside the JVM, and
maps null to null. ``strict`` converters fail the job on a bad value; the
lenient form gives null, which callers turn into a reject.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def _cast(value: Column, to: str, strict: bool) -> Column:
    return value.cast(to) if strict else value.try_cast(to)


def to_boolean(value: Column) -> Column:
    """Booleans as they are; text ``true`` (any case) and the number 1 are true."""
    text = F.lower(F.trim(value.cast("string")))
    return F.when(text.isNotNull(), text.isin("1", "true"))


def _ranged(value: Column, to: str, bits: int, strict: bool) -> Column:
    """An integer, null (or an error) outside its range. Read as a long and
    compared: a failing cast costs far more than a comparison."""
    if strict:
        return value.cast("string").cast(to)
    number = value.try_cast("bigint")
    limit = 1 << (bits - 1)
    return F.when(number.between(-limit, limit - 1), number.cast(to))


def to_byte(value: Column, strict: bool = False) -> Column:
    return _ranged(value, "tinyint", 8, strict)


def to_short(value: Column, strict: bool = False) -> Column:
    return _ranged(value, "smallint", 16, strict)


def to_int(value: Column, strict: bool = False) -> Column:
    return _ranged(value, "int", 32, strict)


def narrow_to_int(value: Column) -> Column:
    """A long cut to its low 32 bits, the way an integer column receives one."""
    return F.shiftright(F.shiftleft(value.cast("bigint"), 32), 32).cast("int")


def to_long(value: Column, strict: bool = False) -> Column:
    return _cast(value, "bigint", strict)


def to_float(value: Column, strict: bool = False) -> Column:
    return _cast(value, "float", strict)


def to_double(value: Column, strict: bool = False) -> Column:
    return _cast(value, "double", strict)


def to_year_month_interval(months: Column) -> Column:
    return F.make_ym_interval(F.lit(0), months.cast("int"))


def to_day_time_interval(micros: Column) -> Column:
    seconds = micros.cast("bigint").cast("decimal(20,0)") / F.lit(1000000)
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def to_date(epoch_day: Column) -> Column:
    return F.date_from_unix_date(epoch_day.cast("int"))


def is_date_text(text: Column) -> Column:
    """Whether a temporal value is ISO text and not a number."""
    return F.substring(text, 5, 1) == "-"


def text_to_date(text: Column) -> Column:
    """The date at the start of ISO text, with or without a zone mark behind it."""
    return F.substring(text, 1, 10).try_cast("date")


def text_to_timestamp(text: Column, zone: str = "UTC") -> Column:
    """ISO date-time text to wall-clock time. Text with ``Z`` or an offset names
    an instant and is read in ``zone``; text without one is local already."""
    # The instant passes through the session's zone and back out of it.
    instant = F.convert_timezone(F.current_timezone(), F.lit(zone),
                                 text.try_cast("timestamp").cast("timestamp_ntz"))
    offset = F.substring(text, -6, 1).isin("+", "-") & (F.substring(text, -3, 1) == ":")
    return F.when(text.endswith("Z") | offset, instant).otherwise(text.try_cast("timestamp_ntz"))


def to_time_millis(value: Column, unit: str) -> Column:
    """Milliseconds of the day. ``unit``: ``millis``, ``micros``, ``nanos`` or ``text``."""
    if unit == "millis":
        return value.cast("int")
    if unit in ("micros", "nanos"):
        step = 1000 if unit == "micros" else 1000000
        # Divide as a long: the quotient fits an int, the input does not.
        return _floor_div(value.cast("bigint"), step).cast("int")
    if unit == "text":
        part = F.split(value, ":")
        seconds = F.regexp_extract(F.coalesce(F.get(part, F.lit(2)), F.lit("0")), r"^\d+", 0)
        return (
            F.get(part, F.lit(0)).try_cast("int") * 3600
            + F.get(part, F.lit(1)).try_cast("int") * 60
            + seconds.try_cast("int")
        ) * 1000
    raise ValueError(f"unknown time unit {unit!r}")


def _floor_div(value: Column, step: int) -> Column:
    """Exact floor division of a long; ``div`` alone rounds toward zero."""
    by = F.lit(step).cast("bigint")
    return F.call_function("div", value - F.pmod(value, by), by)


def to_timestamp(value: Column, unit: str) -> Column:
    """Epoch ``millis``, ``micros`` or ``nanos``, or ISO ``text``, to a timestamp
    without zone.

    Spark keeps microseconds, so nanoseconds are floored.
    """
    if unit == "text":
        return text_to_timestamp(value)
    epoch = F.expr(EPOCH)
    number = value.cast("bigint")
    if unit == "millis":
        return F.timestamp_add("MILLISECOND", number, epoch)
    if unit == "micros":
        return F.timestamp_add("MICROSECOND", number, epoch)
    if unit == "nanos":
        return F.timestamp_add("MICROSECOND", _floor_div(number, 1000), epoch)
    raise ValueError(f"unknown timestamp unit {unit!r}")


def epoch_millis_local(value: Column, zone: str) -> Column:
    """Epoch milliseconds to wall-clock time in ``zone``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), to_timestamp(value, "millis"))


def epoch_millis_local_date(value: Column, zone: str) -> Column:
    return epoch_millis_local(value, zone).cast("date")


def to_local_timestamp(text: Column, zone: str) -> Column:
    """ISO instant text (``...Z``) to wall-clock time in ``zone``; other text is null."""
    instant = F.when(text.rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d(:\d\d(\.\d+)?)?Z$"),
                     F.regexp_replace(F.regexp_replace(text, "Z$", ""), "T", " "))
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), instant.try_cast("timestamp_ntz"))


def to_text(value: Column) -> Column:
    return value.cast("string")


def to_binary(base64_text: Column) -> Column:
    return F.unbase64(base64_text)


TWO_64 = "18446744073709551616"


def _hex_with_sign(raw: Column) -> tuple[Column, Column]:
    """Hex digits of two's-complement bytes, and the digit that widens them."""
    digits = F.hex(raw)
    negative = F.substring(digits, 1, 1).isin(*"89ABCDEF")
    return digits, F.when(negative, F.lit("F")).otherwise(F.lit("0"))


def _narrow_integer(raw: Column) -> Column:
    """Integer of at most eight big-endian bytes."""
    digits, fill = _hex_with_sign(raw)
    return F.conv(F.lpad(digits, F.lit(16), fill), 16, -10).cast("decimal(20,0)")


def _wide_integer(raw: Column) -> Column:
    """Integer of at most sixteen bytes as ``decimal(38,0)``; null beyond 38 digits.

    The bytes are widened to 128 bits and read as two halves; the high half
    carries the sign. A negative value takes its high half one closer to zero
    and a negative low half, so that no step is larger than the value itself.
    """
    digits, fill = _hex_with_sign(raw)
    padded = F.lpad(digits, F.lit(32), fill)
    high = F.conv(F.substring(padded, 1, 16), 16, -10).cast("decimal(38,0)")
    low = F.conv(F.substring(padded, 17, 16), 16, 10).cast("decimal(38,0)")
    two_64 = F.lit(TWO_64).cast("decimal(20,0)")
    up = F.when(fill == "F", F.lit(1)).otherwise(F.lit(0)).cast("decimal(1,0)")
    product = F.try_multiply((high + up).cast("decimal(38,0)"), two_64)
    return F.try_add(product.try_cast("decimal(38,0)"),
                     (low - up * two_64).cast("decimal(38,0)")).try_cast("decimal(38,0)")


def _unscaled_text(raw: Column) -> Column:
    size = F.octet_length(raw)
    return F.when((size > 0) & (size <= 8), _narrow_integer(raw).cast("string")).when(
        (size > 8) & (size <= 16), _wide_integer(raw).cast("string"))


def _with_scale(unscaled: Column, scale: Column) -> Column:
    """Decimal text of an integer's text with ``scale`` digits after the point."""
    sign = F.when(unscaled.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    body = F.regexp_replace(unscaled, "^-", "")
    body = F.lpad(body, F.greatest(F.length(body), scale + 1), F.lit("0"))
    point = F.concat(sign, F.substr(body, F.lit(1), F.length(body) - scale), F.lit("."),
                     F.right(body, scale))
    return F.when(scale > 0, point).otherwise(F.concat(unscaled, F.repeat(F.lit("0"), -scale)))


def _bytes_to_decimal(raw: Column, scale: int, target: str) -> Column:
    """Unscaled bytes with a scale known beforehand. Up to eight bytes need no
    text: one multiplication by a power of ten, exact for scales up to 16."""
    if not 0 <= scale <= 16:
        return _with_scale(_unscaled_text(raw), F.lit(scale)).try_cast(target)
    step = F.lit(f"{10 ** -scale:.{scale}f}").cast(f"decimal({scale + 1},{scale})")
    size = F.octet_length(raw)
    return F.when((size > 0) & (size <= 8), (_narrow_integer(raw) * step).try_cast(target)).when(
        (size > 8) & (size <= 16),
        _with_scale(_wide_integer(raw).cast("string"), F.lit(scale)).try_cast(target))


def to_decimal(value: Column, precision: int, scale: int, encoding: str = "text",
               strict: bool = False) -> Column:
    """Decimal from one of the encodings a connector may emit.

    ``text`` and ``double`` are plain values, ``bytes`` is base64 of the
    unscaled integer, ``struct`` has its own ``scale`` next to base64 ``value``.
    Values that need more than 38 digits are null.
    """
    target = f"decimal({precision},{scale})"
    if encoding == "text":
        return _cast(value.cast("string"), target, strict)
    if encoding == "double":
        return _cast(value, target, strict)
    if encoding == "bytes":
        return _bytes_to_decimal(F.unbase64(value), scale, target)
    if encoding == "struct":
        text = _unscaled_text(F.unbase64(value.getField("value")))
        return _with_scale(text, value.getField("scale").cast("int")).try_cast(target)
    raise ValueError(f"unknown decimal encoding {encoding!r}")


Converter = Callable[[Column], Column]


def json_value(value: Column, to: T.DataType, zone: str = "UTC",
               converters: Mapping[str, Converter] | None = None, name: str | None = None,
               source_type: str = "") -> Column:
    """A JSON scalar, given as text, to ``to``.

    ``converters`` maps a column name or a type name to a function that wins
    over the rules below. Temporal values are epoch milliseconds, read in
    ``zone``, or text as the temporal profiles write it; booleans come as 0/1.
    A ``source_type`` of TIME marks an integer column as milliseconds of a day.
    """
    for choice in (name, to.typeName()):
        if converters and choice in converters:
            return converters[choice](value)
    if isinstance(to, T.BooleanType):
        return to_boolean(value)
    if isinstance(to, T.DateType):
        return F.when(is_date_text(value), text_to_date(value)).otherwise(
            epoch_millis_local_date(value.try_cast("bigint"), zone))
    if isinstance(to, (T.TimestampNTZType, T.TimestampType)):
        return F.when(is_date_text(value), text_to_timestamp(value, zone)).otherwise(
            epoch_millis_local(value.try_cast("bigint"), zone)).cast(to)
    if isinstance(to, T.IntegerType) and source_type.strip().lower().split("(")[0] == "time":
        return F.when(value.contains(":"), to_time_millis(value, "text")).otherwise(
            value.try_cast("int"))
    if isinstance(to, T.BinaryType):
        return to_binary(value)
    if isinstance(to, (T.ArrayType, T.MapType)):
        raise TypeError(f"unsupported type {to.simpleString()}")
    if isinstance(to, T.StringType):
        return value
    return value.try_cast(to)
