"""Record envelopes: a base64 text that holds one JSON object."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.functions.json import json_value


def decoded_text(data: Column) -> Column:
    """UTF-8 text of base64, null where either decoding fails.

    Characters outside the alphabet are ignored, as mail decoders do; missing padding
    is an error. Clean input never reaches the regular expression.
    """
    letters = F.regexp_replace(data, "[^A-Za-z0-9+/=]", "")
    clean = F.when(F.length(data) % 4 == 0, F.try_to_binary(data, F.lit("base64")))
    noisy = F.when(F.length(letters) % 4 == 0, F.try_to_binary(letters, F.lit("base64")))
    return F.try_validate_utf8(F.coalesce(clean, noisy).cast("string"))


def decode_envelope(envelopes: DataFrame) -> DataFrame:
    """Adds ``record``, a VARIANT object; null where the record is unreadable."""
    text = decoded_text(F.col("data"))
    is_object = F.ltrim(text).startswith("{") & F.rtrim(text).endswith("}")
    return envelopes.withColumn("record", F.when(is_object, json_value(text)))


def field(record: Column, name: str, kind: str = "variant") -> Column:
    """A field of a record as ``kind``; null if it is absent or does not fit."""
    return F.try_variant_get(record, f"$.{name}", kind)
