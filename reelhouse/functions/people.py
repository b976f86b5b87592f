"""Gender, age and age-band columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The day ages are measured on, and the age bands with their upper bounds.
REFERENCE_DAY = "2010-01-01"
AGE_BANDS = (("<25", 25), ("25-40", 40), ("40-60", 60))
TOP_BAND = ">60"


def gender_from_label(col: Column, default: str | None = None, ignore_case: bool = False) -> Column:
    """F or M from a text holding 'Female' or 'Male'; anything else gives ``default``."""
    label, female, male = (F.lower(col), "female", "male") if ignore_case else (col, "Female", "Male")
    return F.when(label.contains(female), "F").when(label.contains(male), "M").otherwise(F.lit(default))


def gender_from_flag(col: Column, default: str | None = None) -> Column:
    """1 gives M, 0 gives F, NULL gives ``default``."""
    return F.when(col == 1, "M").when(col == 0, "F").otherwise(F.lit(default))


def gender_whitelist(col: Column) -> Column:
    """Keep M or F, else NULL."""
    return F.when(col.isin("M", "F"), col)


def gender_label(col: Column) -> Column:
    """Display label: F is 'Femme', everything else (NULL too) is 'Homme'."""
    return F.when(col == "F", "Femme").otherwise("Homme")


def age_at_ref(dob: Column, ref: str = REFERENCE_DAY, clamp: bool = True) -> Column:
    """Completed years at ``ref``; NULL stays NULL although ``greatest`` skips NULLs."""
    day = F.to_date(F.lit(ref))
    years = F.timestamp_diff("YEAR", dob.cast("timestamp"), day.cast("timestamp")).cast("int")
    return F.when(dob.isNotNull(), F.greatest(F.lit(0), years)) if clamp else years


def age_band(age: Column, unknown: str = "Unknown") -> Column:
    """Band label by upper bound; a NULL age gives ``unknown`` instead of the top band."""
    band = F.when(age.isNull(), unknown)
    for label, upper in AGE_BANDS:
        band = band.when(age < upper, label)
    return band.otherwise(TOP_BAND)
