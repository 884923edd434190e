"""JSON text to VARIANT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BARE_CONSTANT = r"([\[,:]\s*)(NaN|-?Infinity)(?=\s*[,\]}])"


def json_value(json: Column) -> Column:
    """VARIANT of JSON text, null for unreadable text.

    NaN and Infinity without quotes are not JSON, yet feeds write them. Only texts that
    fail are tried once more with these words quoted.
    """
    quoted = F.regexp_replace(json, _BARE_CONSTANT, '$1"$2"')
    return F.coalesce(F.try_parse_json(json), F.try_parse_json(quoted))
