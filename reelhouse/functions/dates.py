"""Date columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from reelhouse.functions.text import strip_one_prefix

# Month names of the calendar, in both supported languages.
MONTHS_EN = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)
MONTHS_FR = (
    "Janvier", "Février", "Mars", "Avril", "Mai", "Juin",
    "Juillet", "Août", "Septembre", "Octobre", "Novembre", "Décembre",
)


def parse_us_date(col: Column, pivot: int = 25, lenient: bool = False) -> Column:
    """Date of 'M/D/YY' or 'M/D/YYYY' text, NULL for any other shape.

    Two-digit years from ``pivot`` on are 19xx, lower ones 20xx. ``lenient`` rolls an
    impossible day over (30 February is 1 or 2 March) where the strict form gives NULL.
    """
    text = F.trim(col)
    month = F.trim(F.substring_index(text, "/", 1))
    day = F.trim(F.substring_index(F.substring_index(text, "/", 2), "/", -1))
    short = F.trim(F.substring_index(text, "/", -1)).try_cast("int")
    year = F.when(short >= 100, short).when(short >= pivot, short + 1900).when(short >= 0, short + 2000)
    shaped = text.rlike("^[^/]*/[^/]*/[^/]*$") & (year <= 9999)
    if lenient:
        start = F.make_date(F.when(shaped, year), F.lit(1), F.lit(1))
        return F.date_add(F.add_months(start, month.try_cast("int") - 1), day.try_cast("int") - 1)
    return F.when(shaped, F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), month, day).try_cast("date"))


def parse_iso_date_guarded(col: Column, prefix: str = "T") -> Column:
    """Date of prefixed 'YYYY-MM-DD...' text, NULL when the shape or the day is wrong."""
    text = strip_one_prefix(col, prefix)
    return F.when(
        text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}"),
        F.substring(text, 1, 10).try_cast("date"),
    )


def parse_birth_date(col: Column, pivot: int = 25) -> Column:
    """US-style text first, ISO text as the fallback."""
    return F.coalesce(parse_us_date(col, pivot), parse_iso_date_guarded(col))


def calendar_parts(day: Column, months: tuple[str, ...] = MONTHS_EN) -> dict[str, Column]:
    """Calendar columns of a date, by their warehouse names."""
    number = F.month(day)
    return {
        "jour": F.dayofmonth(day),
        "mois": number,
        "nom_mois": F.elt(number, *[F.lit(name) for name in months]),
        "trimestre": F.quarter(day),
        "annee": F.year(day),
        "libelle_trimestre": F.concat(F.lit("Q"), F.quarter(day).cast("string")),
    }
