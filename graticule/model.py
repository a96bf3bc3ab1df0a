"""Roles of coordinate columns, read from the schema alone."""

from __future__ import annotations

from pyspark.sql import DataFrame

from graticule.functions.columns import is_numeric, is_time, numeric_columns

# Column names that mark a coordinate role (compared in lower case).
LATITUDE_NAMES = {"lat", "latitude", "lats", "nav_lat", "y"}
LONGITUDE_NAMES = {"lon", "longitude", "lons", "long", "nav_lon", "x"}
TIME_NAMES = {"time", "date", "datetime", "timestamp", "valid_time"}
VERTICAL_NAMES = {"level", "lev", "depth", "height", "altitude", "plev", "pressure_level", "z"}

# Public CF attribute values for the same roles.
STANDARD_NAMES = {
    "latitude": "latitude",
    "longitude": "longitude",
    "time": "time",
    "air_pressure": "vertical",
    "altitude": "vertical",
    "depth": "vertical",
    "height": "vertical",
}
AXIS_LETTERS = {"Y": "latitude", "X": "longitude", "T": "time", "Z": "vertical"}
UNIT_ROLES = {"degrees_north": "latitude", "degrees_east": "longitude"}

# Numeric columns treated as coordinates when reducing dimensions.
COORDINATE_NAMES = {
    "lat", "lon", "latitude", "longitude", "x", "y", "level", "lev", "depth", "height", "z",
}

ROLES = ("latitude", "longitude", "time", "vertical")


def _role(name: str, dtype, attrs: dict) -> str | None:
    role = STANDARD_NAMES.get(attrs.get("standard_name", ""))
    role = role or AXIS_LETTERS.get(str(attrs.get("axis", "")).upper())
    role = role or UNIT_ROLES.get(attrs.get("units", ""))
    if role:
        return role
    low = name.lower()
    if low in LATITUDE_NAMES:
        return "latitude"
    if low in LONGITUDE_NAMES:
        return "longitude"
    if low in TIME_NAMES or is_time(dtype):
        return "time"
    if low in VERTICAL_NAMES:
        return "vertical"
    return None


def column_roles(df: DataFrame) -> dict[str, str]:
    """Role of every column that has one: attributes first, then name, then type."""
    roles = {}
    for field in df.schema.fields:
        role = _role(field.name, field.dataType, field.metadata or {})
        if role:
            roles[field.name] = role
    return roles


def detect_roles(df: DataFrame) -> dict[str, str | None]:
    """First column for each role; None where there is none."""
    found: dict[str, str | None] = {role: None for role in ROLES}
    for name, role in column_roles(df).items():
        if found[role] is None:
            found[role] = name
    return found


def coordinate_metadata(df: DataFrame) -> dict[str, dict]:
    """Attributes of every column that has a coordinate role."""
    return {c: dict(df.schema[c].metadata or {}) for c in column_roles(df)}


def numeric_variables(df: DataFrame) -> list[str]:
    """Numeric columns that are not dimensions."""
    dims = column_roles(df)
    return [c for c in numeric_columns(df) if c not in dims]


def coordinate_kind(dtype) -> str:
    if is_time(dtype):
        return "datetime"
    return "numeric" if is_numeric(dtype) else "categorical"
