import base64
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import values
from tidewell.functions import convert, temporal

SHANGHAI = "Asia/Shanghai"


def test_boolean(spark):
    assert values(spark, convert.to_boolean, ["1", "true", "TRUE", "0", "no", None], "string") == [
        True, True, True, False, False, None]
    assert values(spark, convert.to_boolean, [1, 0, 2, None], "tinyint") == [True, False, False, None]
    assert values(spark, convert.to_boolean, [True, False, None], "boolean") == [True, False, None]


def test_integers_check_their_range(spark):
    assert values(spark, convert.to_byte, ["127", "128", "-128", "x", None], "string") == [
        127, None, -128, None, None]
    assert values(spark, convert.to_short, ["32767", "32768"], "string") == [32767, None]
    with pytest.raises(Exception, match="CAST"):
        values(spark, lambda c: convert.to_byte(c, strict=True), ["128"], "string")


def test_narrow_to_int_keeps_the_low_bits(spark):
    numbers = [0, 1, -1, 2**31, 2**31 - 1, 2**32 + 5, -(2**31) - 1]
    wrapped = [(n + 2**31) % 2**32 - 2**31 for n in numbers]
    assert values(spark, convert.narrow_to_int, numbers, "bigint") == wrapped


def test_intervals(spark):
    text = lambda f: lambda c: f(c).cast("string")
    assert values(spark, text(convert.to_year_month_interval), [14], "int") == ["INTERVAL '1-2' YEAR TO MONTH"]
    assert values(spark, text(convert.to_day_time_interval), [86400000001], "bigint") == [
        "INTERVAL '1 00:00:00.000001' DAY TO SECOND"]


def encoded(number):
    size = max(1, (number.bit_length() + 8) // 8)
    return base64.b64encode(number.to_bytes(size, "big", signed=True)).decode()


NUMBERS = [0, 1, -1, 127, 128, -128, -129, 255, 256, 10**9, -(10**9), 2**63 - 1, -(2**63), 2**63,
           -(2**63) - 1, 2**64, 10**30, -(10**30), 10**37, 10**38 - 1, -(10**38) + 1]


def test_decimal_bytes_of_any_length(spark):
    got = values(spark, lambda c: convert.to_decimal(c, 38, 0, "bytes"), [encoded(n) for n in NUMBERS], "string")
    assert got == [Decimal(n) for n in NUMBERS]
    for scale in (5, 16, 20):
        got = values(spark, lambda c: convert.to_decimal(c, 38, scale, "bytes"), [encoded(n) for n in NUMBERS], "string")
        assert got == [Decimal(f"{n}E-{scale}") for n in NUMBERS]


def test_decimal_beyond_38_digits_is_null(spark):
    too_big = [encoded(10**38), encoded(-(10**38)), encoded(2**127 - 1), encoded(10**50), ""]
    assert values(spark, lambda c: convert.to_decimal(c, 38, 0, "bytes"), too_big, "string") == [None] * 5


def test_decimal_other_encodings(spark):
    assert values(spark, lambda c: convert.to_decimal(c, 10, 2), ["12.345", "-1", "x", None], "string") == [
        Decimal("12.35"), Decimal("-1.00"), None, None]
    assert values(spark, lambda c: convert.to_decimal(c, 10, 2, "double"), [1.5, None], "double") == [
        Decimal("1.50"), None]
    structs = [(3, encoded(-12345)), (0, encoded(7)), (-2, encoded(7)), None]
    got = values(spark, lambda c: convert.to_decimal(c, 20, 4, "struct"), structs, "struct<scale:int,value:string>")
    assert got == [Decimal("-12.3450"), Decimal(7), Decimal(700), None]


def test_date_and_time(spark):
    assert values(spark, convert.to_date, [0, 19539, -1], "int") == [
        date(1970, 1, 1), date(2023, 7, 1), date(1969, 12, 31)]
    # Above 35 minutes the microseconds do not fit an int; the quotient does.
    micros = [0, 2_147_484_000, 45_189_123_456]
    assert values(spark, lambda c: convert.to_time_millis(c, "micros"), micros, "bigint") == [0, 2147484, 45189123]
    assert values(spark, lambda c: convert.to_time_millis(c, "nanos"), [m * 1000 for m in micros], "bigint") == [
        0, 2147484, 45189123]
    assert values(spark, lambda c: convert.to_time_millis(c, "text"), ["12:33:09.5", "00:01", "x"], "string") == [
        45189000, 60000, None]


def test_timestamps(spark):
    assert values(spark, lambda c: convert.to_timestamp(c, "millis"), [1688214789123, -1], "bigint") == [
        datetime(2023, 7, 1, 12, 33, 9, 123000), datetime(1969, 12, 31, 23, 59, 59, 999000)]
    assert values(spark, lambda c: convert.to_timestamp(c, "nanos"), [-1, 1999], "bigint") == [
        datetime(1969, 12, 31, 23, 59, 59, 999999), datetime(1970, 1, 1, 0, 0, 0, 1)]
    assert values(spark, lambda c: convert.epoch_millis_local(c, SHANGHAI), [0], "bigint") == [
        datetime(1970, 1, 1, 8)]
    assert values(spark, lambda c: convert.epoch_millis_local_date(c, SHANGHAI), [57600000], "bigint") == [
        date(1970, 1, 2)]


def test_instant_text(spark):
    texts = ["2020-08-18T20:50:47Z", "2020-08-18T20:50:47.25Z", "2020-08-18 20:50:47", "nope", None]
    assert values(spark, lambda c: convert.to_local_timestamp(c, SHANGHAI), texts, "string") == [
        datetime(2020, 8, 19, 4, 50, 47), datetime(2020, 8, 19, 4, 50, 47, 250000), None, None, None]


def test_epoch_micros_does_not_pass_through_the_session_zone(spark):
    moments = [datetime(1969, 12, 31, 23, 59, 59, 999999), datetime(2024, 7, 1, 0, 0, 7, 179575), datetime(2024, 3, 10, 2, 30)]
    expected = [(m - datetime(1970, 1, 1)) // timedelta(microseconds=1) for m in moments]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for session_zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", session_zone)
            assert values(spark, temporal.epoch_micros, moments, "timestamp_ntz") == expected
            got = values(spark, lambda c: convert.text_to_timestamp(c, SHANGHAI), ["2023-07-01T12:33:09Z"], "string")
            assert got == [datetime(2023, 7, 1, 20, 33, 9)]
            offset = values(spark, lambda c: temporal.timestamp_zulu(c, F.lit(False), SHANGHAI), moments[1:2], "timestamp_ntz")
            assert offset == ["2024-07-01T08:00:07.179575+08:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_temporal_text_reads_back(spark):
    at = datetime(2023, 7, 1, 12, 33, 9)
    texts = ["2023-07-01 12:33:09", "2023-07-01T12:33:09", "2023-07-01T12:33:09Z", "2023-07-01T20:33:09+08:00",
             "2023-07-01T10:03:09-02:30", "x", None]
    got = values(spark, convert.text_to_timestamp, texts, "string")
    assert got == [at, at, at, at, at, None, None]
    assert values(spark, lambda c: convert.text_to_timestamp(c, SHANGHAI), texts[1:4], "string") == [
        at, at.replace(hour=20), at.replace(hour=20)]
    ntz = lambda c: convert.json_value(c, T.TimestampNTZType(), SHANGHAI)
    assert values(spark, ntz, ["2023-07-01 12:33:09", "1688185989000", None], "string") == [at, at, None]
    day = lambda c: convert.json_value(c, T.DateType())
    assert values(spark, day, ["2023-07-01", "2023-07-01Z", "1688185989000", "x"], "string") == [
        at.date(), at.date(), at.date(), None]
    clock = lambda c: convert.json_value(c, T.IntegerType(), source_type="time(3)")
    assert values(spark, clock, ["12:33:09", "45189000", None], "string") == [45189000, 45189000, None]


def test_binary_and_custom_converter(spark):
    assert values(spark, convert.to_binary, [base64.b64encode(b"\x00\xff").decode()], "string") == [
        bytearray(b"\x00\xff")]
    custom = {"st": lambda c: F.upper(c)}
    assert values(spark, lambda c: convert.json_value(c, T.StringType(), converters=custom, name="st"),
                  ["ab"], "string") == ["AB"]
    with pytest.raises(TypeError):
        convert.json_value(F.lit("x"), T.ArrayType(T.StringType()))


def test_plain_temporal_text(spark):
    at = datetime(2023, 7, 1, 12, 33, 9)
    assert values(spark, temporal.date_plain, [at.date()], "date") == ["2023-07-01"]
    assert values(spark, temporal.datetime_plain, [at, at.replace(microsecond=250000)], "timestamp_ntz") == [
        "2023-07-01 12:33:09", "2023-07-01 12:33:09.25"]
    micros = [45_189_000_000, 45_189_500_000, -3_600_000_000, 838 * 3_600_000_000]
    assert values(spark, temporal.duration_plain, micros, "bigint") == [
        "12:33:09", "12:33:09.5", "-01:00:00", "838:00:00"]


def test_timestamp_phases(spark):
    at = datetime(2023, 7, 1, 12, 0, 0)
    plain = lambda snap: lambda c: temporal.timestamp_plain(c, F.lit(snap), SHANGHAI)
    assert values(spark, plain(True), [at], "timestamp_ntz") == ["2023-07-01 04:00:00"]
    assert values(spark, plain(False), [at], "timestamp_ntz") == ["2023-07-01 20:00:00"]
    lake = lambda snap, zone: lambda c: temporal.timestamp_zulu(c, F.lit(snap), zone)
    assert values(spark, lake(True, SHANGHAI), [at], "timestamp_ntz") == ["2023-07-01T04:00:00Z"]
    assert values(spark, lake(False, SHANGHAI), [at], "timestamp_ntz") == ["2023-07-01T20:00:00+08:00"]
    assert values(spark, lake(False, "America/St_Johns"), [at], "timestamp_ntz") == ["2023-07-01T09:30:00-02:30"]
    assert values(spark, lake(False, "UTC"), [at], "timestamp_ntz") == ["2023-07-01T12:00:00Z"]


def test_zulu_text(spark):
    at = datetime(2023, 7, 1, 12, 33, 9)
    assert values(spark, temporal.date_zulu, [at.date()], "date") == ["2023-07-01Z"]
    assert values(spark, temporal.duration_zulu, [45_189_000_000], "bigint") == ["12:33:09Z"]
    assert values(spark, lambda c: temporal.datetime_zulu(c, SHANGHAI), [at], "timestamp_ntz") == [
        "2023-07-01T04:33:09Z"]


def test_temporal_columns_of_a_table(spark):
    at = datetime(2023, 7, 1, 12, 33, 9)
    frame = spark.createDataFrame([(1, at, at.date(), at)], "id int, made timestamp_ntz, day date, seen timestamp_ntz")
    types = {"id": "int(11)", "made": "datetime(3)", "day": "date", "seen": "timestamp"}
    rules = temporal.temporal_columns(types, "lake", SHANGHAI, F.lit(False))
    assert sorted(rules) == ["day", "made", "seen"]
    row = frame.withColumns(rules).first()
    assert (row.id, row.made, row.day, row.seen) == (
        1, "2023-07-01T04:33:09Z", "2023-07-01Z", "2023-07-01T20:33:09+08:00")


def test_temporal_rules(spark):
    rule = temporal.temporal_rule("datetime(6)", "plain", SHANGHAI)
    at = datetime(2023, 7, 1, 12, 33, 9)
    assert values(spark, lambda c: rule(c, F.lit(True)), [at], "timestamp_ntz") == ["2023-07-01 12:33:09"]
    assert temporal.temporal_rule("varchar(3)", "lake", SHANGHAI) is None
    with pytest.raises(ValueError):
        temporal.temporal_rule("date", "other", SHANGHAI)


def test_sql_functions_are_the_converters(spark):
    from pyspark.sql import functions as F
    from tidewell.functions.sql import register_converters
    register_converters(spark)
    numbers = [0, 1, -1, 999, -999, 86_400_000_000, -90_061_000_001, 360_000_000_000 + 5, 127, 128, -129, 2 ** 31, -2 ** 63 + 5000]
    rows = spark.createDataFrame([(n,) for n in numbers] + [(None,)], "n bigint")
    c, n = F.col, F.col("n")
    pairs = {
        "cdc_duration_plain(n)": temporal.duration_plain(n), "cdc_to_byte(n)": convert.to_byte(n.cast("string")),
        "cdc_to_short(n)": convert.to_short(n), "cdc_to_int(n)": convert.to_int(n),
        "cdc_narrow_to_int(n)": convert.narrow_to_int(n),
        "cdc_time_millis(n % 86400000000, 'nanos')": convert.to_time_millis(n % 86400000000, "nanos"),
        "cdc_integer_of_bytes(unhex(lpad(hex(n), 16, '0')))":
            convert.to_decimal(F.base64(F.unhex(F.lpad(F.hex(n), 16, "0"))), 20, 0, "bytes"),
        **{f"cdc_to_timestamp(n % 100000000000000, '{u}')": convert.to_timestamp(n % 100000000000000, u)
           for u in ("millis", "micros", "nanos")}}
    for text, column in pairs.items():
        got = rows.select(F.expr(text).cast("string").alias("a"), column.cast("string").alias("b"), "n")
        assert got.filter("NOT (a <=> b)").collect() == [], text
    texts = spark.createDataFrame([(t,) for t in ("true", " TRUE ", "1", "0", "x", "", None, "1.5", "2024-01-02T03:04:05.6Z",
                                                  "2024-01-02T03:04Z", "2024-01-02 03:04:05")], "t string")
    for text, column in {"cdc_to_boolean(t)": convert.to_boolean(c("t")), "cdc_to_double(t)": convert.to_double(c("t")),
                         "cdc_to_long(t)": convert.to_long(c("t")), "cdc_date_plain(cdc_local_timestamp(t, 'Asia/Tokyo'))":
                             temporal.date_plain(convert.to_local_timestamp(c("t"), "Asia/Tokyo")),
                         "cdc_local_timestamp(t, 'Asia/Tokyo')": convert.to_local_timestamp(c("t"), "Asia/Tokyo")}.items():
        got = texts.select(F.expr(text).cast("string").alias("a"), column.cast("string").alias("b"), "t")
        assert got.filter("NOT (a <=> b)").collect() == [], text


def test_sql_functions_are_put_in_place(spark):
    from tidewell.plans.values import sql_converters
    text = sql_converters(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "cdc_" not in text and "Python" not in text and "Exchange" not in text


def test_a_table_function_of_the_user(spark):
    from tidewell.functions.sql import register_table_function

    class Words:
        def eval(self, line: str):
            for at, word in enumerate((line or "").split()):
                yield at, word

    register_table_function(spark, "words_of", Words, "at int, word string")
    lines = spark.createDataFrame([(1, "to be or"), (2, ""), (3, None)], "id int, line string")
    got = spark.sql("SELECT id, at, word FROM {l} AS l, LATERAL words_of(l.line)", l=lines).collect()
    assert sorted(tuple(r) for r in got) == [(1, 0, "to"), (1, 1, "be"), (1, 2, "or")]
