"""Affine unit conversion as a column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit -> (dimension, factor to base, offset to base); base = factor*x + offset.
_UNITS: dict[str, tuple[str, float, float]] = {
    "K": ("temperature", 1.0, 0.0),
    "degC": ("temperature", 1.0, 273.15),
    "degF": ("temperature", 5.0 / 9.0, 273.15 - 32.0 * 5.0 / 9.0),
    "%": ("fraction", 0.01, 0.0),
    "1": ("fraction", 1.0, 0.0),
    "mm d-1": ("water_flux", 1.0 / 86400.0, 0.0),
    "mm/day": ("water_flux", 1.0 / 86400.0, 0.0),
    "kg m-2 s-1": ("water_flux", 1.0, 0.0),
    "m s-1": ("speed", 1.0, 0.0),
    "km h-1": ("speed", 1.0 / 3.6, 0.0),
    "Pa": ("pressure", 1.0, 0.0),
    "hPa": ("pressure", 100.0, 0.0),
    "W m-2": ("power_flux", 1.0, 0.0),
}


def conversion(source: str, target: str) -> tuple[float, float]:
    """Coefficients (a, b) such that ``target = a * source + b``."""
    for unit in (source, target):
        if unit not in _UNITS:
            raise ValueError(f"unknown unit {unit!r}")
    dimension, factor, offset = _UNITS[source]
    other, target_factor, target_offset = _UNITS[target]
    if dimension != other:
        raise ValueError(f"cannot convert {source!r} to {target!r}")
    return factor / target_factor, (offset - target_offset) / target_factor


def convert(column: Column, source: str, target: str) -> Column:
    """Convert; the water-flux conversions divide or multiply by whole seconds per day."""
    if source == target:
        return column
    daily = {"mm d-1", "mm/day"}
    if source in daily and target == "kg m-2 s-1":
        return column / F.lit(86400.0)
    if source == "kg m-2 s-1" and target in daily:
        return column * F.lit(86400.0)
    a, b = conversion(source, target)
    result = column if a == 1.0 else column * F.lit(a)
    return result if b == 0.0 else result + F.lit(b)


def quantity(text: str, target: str) -> float:
    """Parse a quantity such as ``"0.1 mm d-1"`` into ``target`` units."""
    number, _, unit = text.strip().partition(" ")
    a, b = conversion(unit.strip() or "1", target)
    return a * float(number) + b
