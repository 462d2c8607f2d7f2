"""Derived quantities and value scaling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bolton (1980) saturation vapour pressure over water, and the ratio of the molecular weights of
# water vapour and dry air (fixed values).
BOLTON_ES0_PA = 611.2
BOLTON_A = 17.67
BOLTON_T0_K = 273.15
BOLTON_T1_K = 29.65
EPSILON = 0.622


def saturation_vapour_pressure(kelvin: Column) -> Column:
    return F.lit(BOLTON_ES0_PA) * F.exp(
        F.lit(BOLTON_A) * (kelvin - F.lit(BOLTON_T0_K)) / (kelvin - F.lit(BOLTON_T1_K))
    )


def specific_humidity(pressure_pa: Column, dewpoint_k: Column, epsilon: float = EPSILON) -> Column:
    """Specific humidity (kg/kg) from surface pressure and 2 m dewpoint.

    With vapour pressure e, the mixing ratio is w = eps*e/(p-e) and q = w/(1+w), which is
    eps*e / (p - (1-eps)*e).
    """
    e = saturation_vapour_pressure(dewpoint_k)
    return F.lit(epsilon) * e / (pressure_pa - F.lit(1.0 - epsilon) * e)


def log_scale(value: Column, epsilon: float) -> Column:
    """``log(v + eps) - log(eps)``: zero stays zero, large values are compressed."""
    return F.log(value + F.lit(epsilon)) - F.log(F.lit(float(epsilon)))


def difference(high: Column, low: Column) -> Column:
    return high - low
