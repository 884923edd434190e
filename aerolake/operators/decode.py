"""From positional arrays to typed state vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.functions import slots
from aerolake.schemas import STATE_FIELDS, STATE_SLOTS
from aerolake.sources.snapshots import state_arrays

_NUMBERS = ["longitude", "latitude", "altitude", "velocity", "heading", "vertical_rate", "geo_altitude"]
_EPOCHS = ["time_position", "last_contact"]

_CASTS = {
    "icao24": slots.text,
    "callsign": slots.clean_callsign,
    "origin_country": slots.text,
    "on_ground": slots.flag,
    "sensors": slots.sensor_ids,
    "squawk": slots.text,
    "spi": slots.flag,
    "position_source": slots.position_source,
    **{name: slots.number for name in _NUMBERS},
    **{name: slots.epoch_to_ts for name in _EPOCHS},
}

_CHECKS = {
    "sensors": slots.sensors_are_bad,
    "position_source": slots.position_source_is_bad,
    **{name: slots.number_is_bad for name in _NUMBERS},
    **{name: slots.epoch_is_bad for name in _EPOCHS},
}


def decoded_slot(raw: Column, name: str) -> Column:
    return _CASTS[name](raw, STATE_FIELDS.index(name))


def reject_reason(raw: Column) -> Column:
    """Why an array cannot be decoded; null for a good one. The first failing slot counts."""
    is_array = F.coalesce(F.to_json(raw).startswith("["), F.lit(False))
    shape = F.when(
        ~slots.present(raw, STATE_SLOTS - 1), F.when(is_array, "short_row").otherwise("not_an_array")
    )
    checks = [
        F.when(_CHECKS[name](raw, slot), f"bad_{name}")
        for slot, name in enumerate(STATE_FIELDS)
        if name in _CHECKS
    ]
    return F.coalesce(shape, *checks)


def decode_state_vector(exploded: DataFrame) -> DataFrame:
    """Replaces ``raw`` by the typed fields, ``reject_reason`` and the raw array itself.

    All casts are native expressions of one projection, so columns nobody asks for are
    pruned together with their casts.
    """
    raw = F.col("raw")
    others = [c for c in exploded.columns if c != "raw"]
    return exploded.select(
        *others,
        *[decoded_slot(raw, name).alias(name) for name in STATE_FIELDS],
        reject_reason(raw).alias("reject_reason"),
        raw,
    )


def good_states(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("reject_reason").isNull()).drop("reject_reason", "raw")


def quarantined(decoded: DataFrame) -> DataFrame:
    """Rejected rows with their reason and the array as JSON text, free of decoded fields."""
    bad = decoded.where(F.col("reject_reason").isNotNull())
    return bad.drop(*STATE_FIELDS).withColumn("raw", F.to_json("raw"))


def sequenced_states(snapshots: DataFrame, country: str | None = None) -> DataFrame:
    """Good states with ``seq``: 0, 1, 2, .. within each snapshot, without gaps.

    Bad elements go while the array still lies in its body's row, so numbering needs no shuffle.
    """

    def wanted(raw: Column) -> Column:
        good = reject_reason(raw).isNull()
        return good if country is None else good & F.coalesce(decoded_slot(raw, "origin_country") == F.lit(country), F.lit(False))

    arrays = F.filter(state_arrays(F.col("body")), wanted)
    rows = snapshots.select("snapshot_id", F.posexplode(arrays).alias("seq", "raw"))
    return rows.select("snapshot_id", "seq", *[decoded_slot(F.col("raw"), name).alias(name) for name in STATE_FIELDS])


def split_malformed(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, quarantine): every input row is in exactly one of them."""
    return good_states(decoded), quarantined(decoded)
