"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skytally.constants import AIRLINE_BY_PREFIX, AIRLINE_OTHER, AIRLINE_UNKNOWN

# Every character that counts as white space, not only the ASCII ones.
_WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def _sql(value: object) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"array({', '.join(map(_sql, value))})" if isinstance(value, list) else str(value)


def lookup(entries: dict, key: Column, default: object = None) -> Column:
    """Left join against a small constant dimension, as an expression over one literal map."""
    cells = ", ".join(_sql(cell) for entry in entries.items() for cell in entry)
    found = F.try_element_at(F.expr(f"map({cells})"), key)
    return found if default is None else F.coalesce(found, F.expr(_sql(default)))


def strip(col: Column) -> Column:
    return F.btrim(col, F.lit(_WHITESPACE))


def blank_to_null(col: Column) -> Column:
    return F.nullif(strip(col), F.lit(""))


def callsign_prefix(callsign: Column) -> Column:
    """Leading two or three letters (three if there are three), '' when there are none."""
    return F.coalesce(F.regexp_extract(F.upper(strip(callsign)), "^[A-Z]{2,3}", 0), F.lit(""))


def airline_name(callsign: Column) -> Column:
    names = {"": AIRLINE_UNKNOWN, **AIRLINE_BY_PREFIX}
    return lookup(names, callsign_prefix(callsign), AIRLINE_OTHER)


def last_path_segment(url: Column) -> Column:
    return F.element_at(F.split(url, "/"), -1)


def hex_to_rgba(colour: Column) -> Column:
    """``#rrggbb`` as an array of four integers, fully opaque."""
    digits = F.ltrim(colour, F.lit("#"))
    parts = [F.conv(F.substring(digits, at, 2), 16, 10).cast("int") for at in (1, 3, 5)]
    return F.array(*parts, F.lit(255))
