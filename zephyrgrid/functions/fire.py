"""Canadian fire weather indices that need no memory, as column expressions.

Van Wagner (1987); the moisture codes with memory are in ``operators.fireweather``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def initial_spread(ffmc: Column, wind_kmh: Column) -> Column:
    moisture = F.lit(147.2) * (F.lit(101.0) - ffmc) / (F.lit(59.5) + ffmc)
    fuel = F.lit(19.1152) * F.exp(moisture * F.lit(-0.1386)) * (
        F.lit(1.0) + F.pow(moisture, F.lit(5.31)) / F.lit(49300000.0))
    return fuel * F.exp(F.lit(0.05039) * wind_kmh)


def buildup(dmc: Column, dc: Column) -> Column:
    denominator = F.nullif(dmc + F.lit(0.4) * dc, F.lit(0.0))
    low = F.lit(0.8) * dc * dmc / denominator
    high = dmc - (F.lit(1.0) - F.lit(0.8) * dc / denominator) * (
        F.lit(0.92) + F.pow(F.lit(0.0114) * dmc, F.lit(1.7)))
    value = F.when(dmc <= F.lit(0.4) * dc, low).otherwise(high)
    missing = dmc.isNull() | dc.isNull()
    return F.when(~missing, F.greatest(F.lit(0.0), F.coalesce(value, F.lit(0.0))))


def fire_weather(isi: Column, bui: Column) -> Column:
    """The final index; ``bui`` and ``isi`` should be plain columns, they are used repeatedly."""
    duff = F.when(bui <= 80, F.lit(0.626) * F.pow(bui, F.lit(0.809)) + F.lit(2.0)).otherwise(
        F.lit(1000.0) / (F.lit(25.0) + F.lit(108.64) / F.exp(F.lit(0.023) * bui)))
    b = F.lit(0.1) * isi * duff
    return F.when(b <= 1, b).otherwise(F.exp(F.lit(2.72) * F.pow(F.lit(0.434) * F.ln(b), F.lit(0.647))))
