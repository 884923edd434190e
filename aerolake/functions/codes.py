"""Code lists and their names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Position source codes.
POSITION_SOURCES = {0: "ADSB", 1: "ASTERIX", 2: "MLAT", 3: "FLARM", 4: "UNKNOWN"}

# Aircraft category codes.
AIRCRAFT_CATEGORIES = {
    0: "NO_INFO", 1: "NO_CATEGORY", 2: "LIGHT", 3: "SMALL", 4: "LARGE",
    5: "HIGH_VORTEX_LARGE", 6: "HEAVY", 7: "HIGH_PERFORMANCE", 8: "ROTORCRAFT",
    9: "GLIDER", 10: "LIGHTER_THAN_AIR", 11: "PARACHUTIST", 12: "ULTRALIGHT",
    13: "RESERVED", 14: "UAV", 15: "SPACE", 16: "SURFACE_EMERGENCY",
    17: "SURFACE_SERVICE", 18: "POINT_OBSTACLE", 19: "CLUSTER_OBSTACLE",
    20: "LINE_OBSTACLE",
}


def _lookup(pairs: dict, key: Column) -> Column:
    literals = [F.lit(x) for pair in pairs.items() for x in pair]
    return F.try_element_at(F.create_map(*literals), key)


def position_source_name(code: Column) -> Column:
    return _lookup(POSITION_SOURCES, code.cast("int"))


def position_source_code(name: Column) -> Column:
    return _lookup({v: k for k, v in POSITION_SOURCES.items()}, name)


def aircraft_category_name(code: Column) -> Column:
    return _lookup(AIRCRAFT_CATEGORIES, code.cast("int"))
