"""Text forms of values and records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerolake.schemas import ENRICHED_FIELDS, STATE_FIELDS

UNKNOWN_KEY = "unknown"


def ts_to_iso(ts: Column) -> Column:
    """ISO text of the time in UTC, without zone; the fraction is left out when it is zero.

    The session's time zone plays no part.
    """
    seconds = (F.unix_micros(ts).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    utc = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
    iso = F.replace(utc.cast("string"), F.lit(" "), F.lit("T"))
    return F.when(iso.contains("."), F.rpad(iso, 26, "0")).otherwise(iso)


def event_time_text(ts: Column) -> Column:
    """ISO text in UTC with offset; the fraction is left out when it is zero."""
    return F.concat(ts_to_iso(ts), F.lit("+00:00"))


def _plain_decimal(text: Column) -> Column:
    """``1.25E-4`` or ``1.25E7`` written out, with at least one decimal."""
    digits = text.try_cast("decimal(38,21)").cast("string")
    return F.regexp_replace(digits, r"(\.\d+?)0+$", "$1")


def float_text(x: Column) -> Column:
    """The shortest text of a double in the style of the feed's JSON records.

    It agrees with the JVM's text between 1e-3 and 1e7. Outside, the JVM turns to an
    exponent earlier and writes it differently.
    """
    jvm = x.cast("string")
    size = F.abs(x)
    exponent = F.replace(F.regexp_replace(jvm, r"E(\d)", "E+$1"), F.lit("E"), F.lit("e"))
    exponent = F.regexp_replace(F.regexp_replace(exponent, r"e([+-])(\d)$", "e$10$2"), r"\.0e", "e")
    return (
        F.when(((size >= 1e-3) & (size < 1e7)) | (x == 0), jvm)
        .when(F.isnan(x), F.lit("nan"))
        .when(size == float("inf"), F.when(x > 0, F.lit("inf")).otherwise(F.lit("-inf")))
        .when((size >= 1e-4) & (size < 1e16), _plain_decimal(jvm))
        .otherwise(exponent)
    )


def location(latitude: Column, longitude: Column) -> Column:
    return F.concat(float_text(latitude), F.lit(","), float_text(longitude))


def publish_key(icao24: Column) -> Column:
    return F.coalesce(F.nullif(icao24, F.lit("")), F.lit(UNKNOWN_KEY))


def json_with_nulls(record: Column) -> Column:
    return F.to_json(record, {"ignoreNullFields": "false"})


def state_to_json(prefix: str = "") -> Column:
    """All fields of a state record; nulls are written."""
    fields = []
    for name in STATE_FIELDS:
        value = F.col(prefix + name)
        if name in ("time_position", "last_contact"):
            value = ts_to_iso(value)
        fields.append(value.alias(name))
    return json_with_nulls(F.struct(*fields))


def enriched_to_json() -> Column:
    return json_with_nulls(F.struct(*ENRICHED_FIELDS))


def encode_envelope(text: Column) -> Column:
    """Base64 on one line."""
    return F.replace(F.base64(F.encode(text, "UTF-8")), F.lit("\r\n"), F.lit(""))
