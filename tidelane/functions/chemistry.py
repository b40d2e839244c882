"""Total-scale pH of an ISFET electrode at the sea surface, as plain column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Physical constants and the published seawater coefficients (Khoo et al. 1977,
# Dickson 1990, Martz et al. 2010, Johnson et al. 2016).
GAS_CONSTANT = 8.314462618
FARADAY = 96485.33212
ZERO_CELSIUS = 273.15


def dilution(salt: Column) -> Column:
    """Kilograms of water in a kilogram of seawater."""
    return F.lit(1.0) - F.lit(0.001005) * salt


def ionic_strength(salt: Column) -> Column:
    """Moles per kilogram of water."""
    return F.lit(19.924) * salt / (F.lit(1000.0) - F.lit(1.005) * salt)


def total_chloride(salt: Column) -> Column:
    """Moles per kilogram of seawater."""
    return F.lit(0.99889 / 35.453 / 1.80655) * salt


def total_sulfate(salt: Column) -> Column:
    """Moles per kilogram of seawater."""
    return F.lit(0.1400 / 96.062 / 1.80655) * salt


def ln_bisulfate_constant(temp: Column, salt: Column) -> Column:
    """Logarithm of the dissociation constant of bisulfate, in moles per kilogram of seawater."""
    kelvin, ionic = temp + F.lit(ZERO_CELSIUS), ionic_strength(salt)
    per_water = (
        F.lit(-4276.1) / kelvin + F.lit(141.328) - F.lit(23.093) * F.log(kelvin)
        + (F.lit(-13856.0) / kelvin + F.lit(324.57) - F.lit(47.986) * F.log(kelvin)) * F.sqrt(ionic)
        + (F.lit(35474.0) / kelvin - F.lit(771.54) + F.lit(114.723) * F.log(kelvin)) * ionic
        - F.lit(2698.0) / kelvin * ionic * F.sqrt(ionic)
        + F.lit(1776.0) / kelvin * ionic * ionic
    )
    return per_water + F.log(dilution(salt))


def isfet_ph(vrse: Column, temp: Column, salt: Column, k0: float, k2: float) -> Column:
    """pH (total scale) from electrode voltage, temperature (C) and salinity; pressure is zero.

    Null where an input is null or the salinity is zero, which leaves no chloride; NaN where it is negative.
    """
    kelvin, ionic = temp + F.lit(ZERO_CELSIUS), ionic_strength(salt)
    debye = F.lit(3.4286e-6) * temp * temp + F.lit(6.7503e-4) * temp + F.lit(0.49172143)
    activity = -debye * F.sqrt(ionic) / (F.lit(1.0) + F.lit(1.394) * F.sqrt(ionic)) + (
        F.lit(0.08885) - F.lit(0.000111) * temp
    ) * ionic
    nernst = F.lit(GAS_CONSTANT / FARADAY) * kelvin * F.log(F.lit(10.0))
    ph_free = (
        (vrse - (F.lit(k0) + F.lit(k2) * temp)) / nernst
        + F.log10(total_chloride(salt) / dilution(salt))
        + F.lit(2.0) * activity
        - F.log10(dilution(salt))
    )
    ph_total = ph_free - F.log10(F.lit(1.0) + total_sulfate(salt) / F.exp(ln_bisulfate_constant(temp, salt)))
    known = vrse.isNotNull() & temp.isNotNull() & salt.isNotNull()
    return F.when(known & (salt > 0), ph_total).when(known & (salt < 0), F.lit(float("nan")))


def add_corrected_ph(
    df: DataFrame,
    k0: float,
    k2: float,
    vrse: str = "vrse",
    temp: str = "temperature",
    salt: str = "salinity",
    out: str = "ph_corrected",
) -> DataFrame:
    """Calibrated pH per row; a table that lacks an input column gets an all-null column."""
    if not {vrse, temp, salt} <= set(df.columns):
        return df.withColumn(out, F.lit(None).cast("double"))
    return df.withColumn(out, isfet_ph(F.col(vrse), F.col(temp), F.col(salt), k0, k2))
