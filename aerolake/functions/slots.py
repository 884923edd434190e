"""Casts for one slot of a positional state array.

The array is a VARIANT, so every slot still knows whether it is text, a number, a
boolean or a container. A cast yields null both for an absent and for an uncastable
value; the ``*_is_bad`` companions tell the two apart, so that a bad slot can reject its
row.

The expressions are kept short, and what common values need comes first: all of them
end up in one compiled method, and the JVM does not optimise a method that is too long.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters stripped from both ends of a callsign.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# JSON texts that count as no value.
EMPTY_JSON = ["0", "0.0", "-0.0", "false", '""', "[]", "{}"]

# JSON texts of the position source codes.
SOURCE_CODES = {
    "0": 0, "1": 1, "2": 2, "3": 3, "4": 4,
    "0.0": 0, "1.0": 1, "2.0": 2, "3.0": 3, "4.0": 4, "false": 0, "true": 1,
}

# Seconds of 0001-01-01 and of 10000-01-01, between which a time may lie.
FIRST_SECOND, END_SECOND = -62135596800, 253402300800


def typed(raw: Column, slot: int, kind: str) -> Column:
    """The slot as ``kind``; null if it is absent or does not fit."""
    return F.try_variant_get(raw, f"$[{slot}]", kind)


def present(raw: Column, slot: int) -> Column:
    """Whether the array has this slot, be it null."""
    return typed(raw, slot, "variant").isNotNull()


def json_text(raw: Column, slot: int) -> Column:
    """JSON text of the slot; 'null' for a null slot, null for an absent one."""
    return F.to_json(typed(raw, slot, "variant"))


def text(raw: Column, slot: int) -> Column:
    return typed(raw, slot, "string")


def clean_callsign(raw: Column, slot: int) -> Column:
    """Blank text becomes '', not null."""
    return F.btrim(text(raw, slot), F.lit(WHITESPACE))


def number(raw: Column, slot: int) -> Column:
    """DOUBLE; number text is accepted, true and false count as 1 and 0.

    Reading the number from its JSON text takes half the time of the typed access, which
    is left for text and booleans.
    """
    return F.coalesce(json_text(raw, slot).try_cast("double"), typed(raw, slot, "double"))


def number_is_bad(raw: Column, slot: int) -> Column:
    return number(raw, slot).isNull() & (json_text(raw, slot) != "null")


def flag(raw: Column, slot: int) -> Column:
    """BOOLEAN: whether there is a value; never bad."""
    json = json_text(raw, slot)
    return F.when(json != "null", ~json.isin(EMPTY_JSON))


def _is_time(seconds: Column) -> Column:
    middle, reach = (END_SECOND + FIRST_SECOND) / 2, (END_SECOND - FIRST_SECOND) / 2
    return F.abs(seconds - middle) < reach


def epoch_to_ts(raw: Column, slot: int) -> Column:
    """TIMESTAMP of epoch seconds with an optional fraction; 0 and '' are null."""
    seconds = number(raw, slot)
    usable = _is_time(seconds) & ~json_text(raw, slot).isin(EMPTY_JSON)
    return F.timestamp_micros(F.when(usable, F.rint(seconds * 1e6).cast("bigint")))


def epoch_is_bad(raw: Column, slot: int) -> Column:
    """Text, or a number outside the years a time may have."""
    json = json_text(raw, slot)
    usable = F.coalesce(_is_time(json.try_cast("double")), F.lit(False))
    return ~usable & ~json.isin(*EMPTY_JSON, "true", "null")


def sensor_ids(raw: Column, slot: int) -> Column:
    """ARRAY<BIGINT>; an empty list is null, a fraction is cut off."""
    return F.when(~json_text(raw, slot).isin(EMPTY_JSON), typed(raw, slot, "array<bigint>"))


def sensors_are_bad(raw: Column, slot: int) -> Column:
    """Not a list, or an element that is no number."""
    numbers = F.to_json(typed(raw, slot, "array<bigint>"))
    return ~json_text(raw, slot).isin(*EMPTY_JSON, "null") & F.coalesce(
        numbers.contains("null"), F.lit(True)
    )


def position_source(raw: Column, slot: int) -> Column:
    """INT code 0 to 4; code text is not a code."""
    pairs = [F.lit(x) for pair in SOURCE_CODES.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), json_text(raw, slot))


def position_source_is_bad(raw: Column, slot: int) -> Column:
    return position_source(raw, slot).isNull() & (json_text(raw, slot) != "null")
