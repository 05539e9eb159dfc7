"""Phone checks, client time, durations and name/value property lists."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ringlens.functions.numbers import col


def is_e164(c: str | Column) -> Column:
    """An E.164 number of country code 7: eleven digits."""
    return col(c).rlike("^7[0-9]{10}$")


def to_client_tz(ts: str | Column, tz: str | Column) -> Column:
    """Shift a UTC wall-clock time to the client's zone."""
    zone = F.lit(tz) if isinstance(tz, str) else tz
    return F.convert_timezone(F.lit("UTC"), zone, col(ts))


def from_client_tz(ts: str | Column, tz: str | Column) -> Column:
    """Shift an uploaded time from the client's zone to UTC."""
    zone = F.lit(tz) if isinstance(tz, str) else tz
    return F.convert_timezone(zone, F.lit("UTC"), col(ts))


def properties_of(pairs: str | Column) -> Column:
    """An array of (name, value) properties as a map; a repeated name keeps its last value."""
    pairs = col(pairs)
    names = F.array_distinct(F.transform(pairs, lambda p: p["name"]))
    last = F.transform(
        names,
        lambda n: F.struct(
            n, F.element_at(F.filter(pairs, lambda p: p["name"] == n), -1)["value"]
        ),
    )
    return F.map_from_entries(last)


def has_property(pairs: str | Column, name: str, value: str) -> Column:
    return F.exists(col(pairs), lambda p: (p["name"] == name) & (p["value"] == value))
