"""Column helpers on small literal frames: each known trap and each choice between readings."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from reelhouse.functions import dates, measures, people, text


@pytest.fixture
def values(spark):
    def apply(inputs, expr, schema="v string"):
        df = spark.createDataFrame([(v,) for v in inputs], schema)
        exprs = expr(F.col("v"))
        exprs = exprs if isinstance(exprs, tuple) else (exprs,)
        found = [tuple(r) for r in df.select(*[e.alias(f"c{i}") for i, e in enumerate(exprs)]).collect()]
        return found if len(exprs) > 1 else [r[0] for r in found]
    return apply


def test_prefix_once_or_all(values):
    titles = ["TTitanic", "TJaws", "titanic", "T", "", None]
    assert values(titles, text.strip_one_prefix) == ["Titanic", "Jaws", "titanic", "", "", None]
    assert values(titles, text.strip_all_prefix) == ["itanic", "Jaws", "titanic", "", "", None]
    assert values(["titanic", "TITANIC"], lambda c: text.strip_one_prefix(c, ignore_case=True)) == ["itanic", "ITANIC"]


def test_title_key_lowers_first(values):
    assert values(["The Matrix!", "THE-MATRIX", "8½ Women", "???", None], text.title_key) == [
        "thematrix", "thematrix", "8women", "", None
    ]


def test_collated_keys_ignore_case_and_accents(spark):
    names = spark.createDataFrame([("Émile",), ("emile",), ("EMILE",), ("Ann",)], "n string")
    assert names.select(text.collated(F.col("n")).alias("n")).distinct().count() == 2
    other = spark.createDataFrame([("émile",)], "n string").select(text.collated(F.col("n")).alias("n"))
    assert names.select(text.collated(F.col("n")).alias("n")).join(other, "n").count() == 3


def test_gender_readings(values):
    labels = ["TFemale", "TMale", "Tother", None]
    assert values(labels, people.gender_from_label) == ["F", "M", None, None]
    assert values(labels, lambda c: people.gender_from_label(c, "M")) == ["F", "M", "M", "M"]
    flags = [1, 0, None]
    assert values(flags, people.gender_from_flag, "v int") == ["M", "F", None]
    assert values(flags, lambda c: people.gender_from_flag(c, "F"), "v int") == ["M", "F", "F"]
    assert values(["M", "F", "X", "m", None], people.gender_whitelist) == ["M", "F", None, None, None]
    assert values(["F", "M", None], people.gender_label) == ["Femme", "Homme", "Homme"]


def test_us_dates(values):
    shapes = ["01/02/70", "1/2/1970", "12/31/24", "12/31/25", "02/30/1970", "13/01/70", "1/2", "1/2/3/70", "x/1/70", "", None]
    assert values(shapes, dates.parse_us_date) == [
        date(1970, 1, 2), date(1970, 1, 2), date(2024, 12, 31), date(1925, 12, 31), None, None, None, None, None, None, None
    ]
    assert values(["02/30/1970", "13/01/70"], lambda c: dates.parse_us_date(c, lenient=True)) == [date(1970, 3, 2), date(1971, 1, 1)]
    assert values(["01/01/30"], lambda c: dates.parse_us_date(c, pivot=40)) == [date(2030, 1, 1)]


def test_iso_dates_never_raise(values):
    shapes = ["T1980-02-29", "1980-02-29 10:00", "T1981-02-29", "T1980-13-01", "T1980-2-9", "Tunknown", None]
    assert values(shapes, dates.parse_iso_date_guarded) == [date(1980, 2, 29), date(1980, 2, 29), None, None, None, None, None]
    assert values(["T1980-02-29", "02/28/80"], dates.parse_birth_date) == [date(1980, 2, 29), date(1980, 2, 28)]


def test_names(values):
    assert values(["Ann Lee", "Ann", "Ann Q. Lee", None], lambda c: text.split_name_first_last(c)) == [
        ("Ann", "Lee"), ("Ann", "Ann"), ("Ann", "Lee"), (None, None)
    ]
    assert values([" Ann  Lee ", "Ann", "Ann Q. Lee", "Ann Q. van Lee", None], lambda c: text.parse_name_initial(c)) == [
        ("Ann", None, "Lee"), ("Ann", None, None), ("Ann", "Q.", "Lee"), ("Ann", "Q.", "Lee"), (None, None, None)
    ]
    assert values(["Lee", None], lambda c: text.client_caption(F.lit("Ann"), c)) == ["Ann Lee", None]


def test_age_counts_completed_years(values):
    born = [date(1980, 2, 29), date(1980, 3, 1), date(2010, 6, 1), date(2012, 6, 1), None]
    assert values(born, lambda c: people.age_at_ref(c, "2010-02-28"), "v date") == [29, 29, 0, 0, None]
    assert values(born, lambda c: people.age_at_ref(c, "2010-02-28", clamp=False), "v date") == [29, 29, 0, -2, None]


def test_age_bands_open_at_their_lower_bound(values):
    ages = [0, 24, 25, 39, 40, 59, 60, None]
    assert values(ages, people.age_band, "v int") == ["<25", "<25", "25-40", "25-40", "40-60", "40-60", ">60", "Unknown"]
    assert values([None], lambda c: people.age_band(c, "Inconnu"), "v int") == ["Inconnu"]


def test_calendar_parts_and_labels(values):
    parts = values([date(2008, 2, 29)], lambda c: tuple(dates.calendar_parts(c).values()), "v date")
    assert parts == [(29, 2, "February", 1, 2008, "Q1")]
    assert values([date(2008, 8, 1)], lambda c: dates.calendar_parts(c, dates.MONTHS_FR)["nom_mois"], "v date") == ["Août"]
    assert values([3, 12], lambda c: text.period_label(F.lit(2008), c), "v int") == ["2008-03", "2008-12"]


def test_ratios_and_margin(values):
    assert values([4, 0, None], lambda c: measures.ratio_measures(F.lit(2), c), "v int") == [0.5, None, None]
    assert values([80, 0, None], lambda c: measures.change(F.lit(100), c), "v int") == [0.25, None, None]
    assert values([3, None], lambda c: measures.margin(F.lit(10), c), "v int")[1] is None


def test_gender_labels_in_any_case(values):
    assert values(["TFEMALE", "tmale", "x", None], lambda c: people.gender_from_label(c, ignore_case=True)) == ["F", "M", None, None]
