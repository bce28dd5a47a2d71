"""Canonical flight record, column aliases and table schemas."""

from __future__ import annotations

import re

from pyspark.sql import types as T

# Canonical column order of a flight record.
CANONICAL = (
    "flight_id",
    "surrogate_id",
    "start_time_utc",
    "end_time_utc",
    "duration_minutes",
    "region_code",
    "region_name",
    "latitude",
    "longitude",
    "vehicle_category",
    "operator_type",
    "flight_purpose",
    "payload_type",
    "superseded",
)

# Accepted source headers per raw target column.
ALIASES = {
    "flight_id": ("flight_id", "flightno", "flight_no", "flightnumber", "номерполета", "flight"),
    "start_time": (
        "start_time", "start", "start_datetime", "departure_time", "времянчала", "временавылета",
    ),
    "end_time": (
        "end_time", "end", "end_datetime", "arrival_time", "времязавершения", "времепосадки",
    ),
    "duration_minutes": (
        "duration", "duration_minutes", "duration_min", "продолжительность", "длительностьмин",
    ),
    "region_code": ("region_code", "region", "regionid", "кодрегиона"),
    "region_name": ("region_name", "region_title", "названиерегиона"),
    "latitude": ("latitude", "lat", "широта"),
    "longitude": ("longitude", "lon", "lng", "долгота"),
    "vehicle_category": ("vehicle_category", "uav_type", "типбпла"),
    "operator_type": ("operator_type", "operator", "типоператора"),
    "flight_purpose": ("flight_purpose", "purpose", "цельвылета"),
    "payload_type": ("payload_type", "payload", "типнагрузки"),
}

# Correct spellings of aliases that the list above carries misspelt.
EXTRA_ALIASES = {
    "start_time": ("времяначала", "времявылета"),
    "end_time": ("времяпосадки",),
}

# Text that marks a cell of a leading service row.
SERVICE_ROW_PREFIXES = ("page ", "страница", "generated", "source:")

# Cell texts that stand for null.
NULL_TOKENS = ("", "null", "NULL")

RAW_COLUMNS = tuple(ALIASES)
RAW_NUMERIC = ("duration_minutes", "latitude", "longitude")
REQUIRED = ("flight_id", "start_time_utc", "end_time_utc", "duration_minutes")
KEY = ("flight_id", "start_time_utc", "region_code")
DIMENSIONS = ("operator_type", "payload_type", "flight_purpose")

_TYPES = {
    "start_time_utc": T.TimestampNTZType(),
    "end_time_utc": T.TimestampNTZType(),
    "duration_minutes": T.DoubleType(),
    "latitude": T.DoubleType(),
    "longitude": T.DoubleType(),
    "superseded": T.BooleanType(),
}

FLIGHT_SCHEMA = T.StructType(
    [T.StructField(c, _TYPES.get(c, T.StringType()), c != "superseded") for c in CANONICAL]
)

# Order of a row within the loaded batch: file, block of the file, running number.
ROW_ORD_TYPE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("block", T.LongType()),
        T.StructField("line", T.LongType()),
    ]
)

# Shape shared by every scan before cleaning: one row per table row, cells as text.
CELLS_SCHEMA = T.StructType(
    [
        T.StructField("_src_path", T.StringType()),
        T.StructField("_src_tz", T.StringType()),
        T.StructField("_src_degraded", T.BooleanType()),
        T.StructField("_row_ord", ROW_ORD_TYPE),
        T.StructField("header", T.ArrayType(T.StringType())),
        T.StructField("cells", T.ArrayType(T.StringType())),
        T.StructField("links", T.ArrayType(T.StringType())),
    ]
)


def header_name(text: str) -> str:
    """Header text as a snake_case name; letters of every alphabet are kept."""
    return re.sub(r"[\W_]+", "_", text.strip().lower()).strip("_")


def unique_names(names: list[str]) -> list[str]:
    """Give repeated names the suffixes _1, _2, ... while skipping names already taken."""
    taken: set[str] = set()
    out = []
    for name in names:
        candidate, n = name, 0
        while candidate in taken:
            n += 1
            candidate = f"{name}_{n}"
        taken.add(candidate)
        out.append(candidate)
    return out


def alias_key(text: str) -> str:
    return header_name(text).replace("_", "")


ALIAS_TO_TARGET = {
    alias_key(alias): target
    for source in (ALIASES, EXTRA_ALIASES)
    for target, aliases in source.items()
    for alias in aliases
}


def target_of(header: str) -> str | None:
    """Raw target column a source header stands for, or None."""
    return ALIAS_TO_TARGET.get(alias_key(header))
