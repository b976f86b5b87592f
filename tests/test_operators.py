"""Operators on small frames, with NULLs, namesakes, hot keys and ties."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from reelhouse.operators import dedup, joins, periods, quality, shape, skew


@pytest.fixture
def facts(spark):
    """3000 rows: one key holds a third, 100 rows have no key, the rest is spread."""
    n = F.col("id")
    key = F.when(n < 1000, 7).when(n < 1100, None).otherwise(n % 50 + 100)
    return spark.range(3000).select(n.alias("line"), key.cast("int").alias("k"), (n % 13).alias("v"))


@pytest.fixture
def dim(spark):
    keys = [(k, f"name{k}") for k in [7, *range(100, 140)]] + [(7, "namesake"), (None, "none")]
    return spark.createDataFrame(keys, "k int, name string")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_plain_join(facts, dim, rows, how):
    spread = skew.spread_join(facts, dim, ["k"], "line", skew.hot_keys(facts, ["k"], share=0.05), how)
    plain = facts.join(dim, ["k"], how)
    assert rows(spread, *plain.columns) == rows(plain)


def test_spread_join_deals_out_equal_rows_of_a_hot_key(spark):
    sales = spark.range(40_000).select(F.col("id").alias("row"), F.lit(7).alias("k"), F.lit(1.5).alias("price"))
    names = spark.createDataFrame([(7, "name")], "k int, name string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        hot = skew.hot_keys(sales, ["k"], share=0.02)
        tasks = skew.spread_join(sales, names, ["k"], "row", hot).groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(r["count"] for r in tasks) == 40_000
    assert len(tasks) >= 6 and max(r["count"] for r in tasks) < 12_000


def test_spread_join_refuses_to_preserve_the_right_side(facts, dim):
    with pytest.raises(ValueError):
        skew.spread_join(facts, dim, ["k"], "line", skew.hot_keys(facts, ["k"]), "full")


def test_hot_keys_are_few(facts, rows):
    assert rows(skew.hot_keys(facts.where("k IS NOT NULL"), ["k"], share=0.1)) == [(7, 4)]  # 1000 of 2900 keyed rows
    many = skew.hot_keys(facts, ["k"], share=0.01)
    assert many.count() < 100 and many.agg(F.sum("pieces")).collect()[0][0] < 200
    assert skew.hot_keys(facts.limit(0), ["k"]).count() == 0


def test_keep_first_takes_the_smallest_text_code(spark, rows):
    df = spark.createDataFrame(
        [("9", "ann", "Lee"), ("10", "ANN", "lee"), ("3", "Bob", None), (None, "Bob", None)], "code string, first string, last string"
    )
    kept = dedup.dedup_keep_first(df, [F.lower("first"), F.lower("last")], [F.col("code")])
    assert rows(kept) == [(None, "Bob", None), ("10", "ANN", "lee")]


def test_group_min_takes_each_column_on_its_own(spark, rows):
    df = spark.createDataFrame([("A", "x", 2), ("a", "y", 1), ("b", None, None)], "k string, t string, n int")
    assert rows(dedup.dedup_group_min(df, {"key": F.lower("k")}, ["t", "n"])) == [("a", "x", 1), ("b", None, None)]


def test_anti_join_by_another_key(spark, rows):
    from reelhouse.functions.text import collated

    new = spark.createDataFrame([("ÉMILE",), ("Zoe",)], "t string")
    old = spark.createDataFrame([("emile",)], "o string")
    assert joins.anti_join_lower(new, old, "t", "o").count() == 2
    assert rows(joins.anti_join_lower(new, old, "t", "o", collated)) == [("Zoe",)]


def test_known_surrogate_keys_stay_and_new_ones_are_unique(spark, rows):
    people = spark.range(50_000).select(F.col("id").cast("string").alias("code"))
    half = dedup.surrogate_keys(people.where("cast(code AS bigint) % 2 = 0"), ["code"], "id").cache()
    everybody = dedup.surrogate_keys(people, ["code"], "id", known=half).cache()
    assert everybody.count() == everybody.select("id").distinct().count() == 50_000
    assert everybody.join(half, ["code", "id"]).count() == half.count() == 25_000
    again = dedup.surrogate_keys(people, ["code"], "id", known=everybody)
    assert again.join(everybody, ["code", "id"]).count() == 50_000


def test_natural_keys_that_differ_stay_apart(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("x|y", "z"), ("x", "y|z"), (None, "a")], "a string, b string")
    assert df.select(dedup.natural_key_text(["a", "b"]).alias("k")).distinct().count() == 5


def test_titles_without_latin_letters_never_match(spark, rows):
    new = spark.createDataFrame([("千と千尋",), ("Амели",), ("Up!",)], "t string")
    old = spark.createDataFrame([("もののけ姫",), ("up",)], "o string")
    assert joins.join_on_title_key(new, old, "t", "o").count() == 1
    assert [r[0] for r in rows(joins.anti_join_title(new, old, "t", "o"))] == ["Амели", "千と千尋"]


def test_surrogate_keys_are_unique_and_repeatable(spark, rows):
    df = spark.range(5000).select(F.concat(F.lit("t"), "id").alias("name"), F.when(F.col("id") > 9, F.col("id")).alias("n"))
    first = rows(dedup.surrogate_keys(df, ["name", "n"], "id"))
    again = rows(dedup.surrogate_keys(df.repartition(3).orderBy(F.desc("name")), ["name", "n"], "id"))
    assert first == again and len({r[0] for r in first}) == 5000 and min(r[0] for r in first) >= 1


def test_upsert(spark, rows):
    stored = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (None, "z", 0)], "id int, name string, n int")
    fresh = spark.createDataFrame([(2, "B", None), (3, "C", 3)], "id int, name string, n int")
    once = dedup.upsert_by_key(stored, fresh, ["id"])
    assert rows(once) == [(None, "z", 0), (1, "a", 1), (2, "B", None), (3, "C", 3)]
    assert rows(dedup.upsert_by_key(once, fresh, ["id"])) == rows(once)
    kept = dedup.upsert_by_key(stored, fresh, ["id"], ["n"])
    assert rows(kept) == [(None, "z", 0), (1, "a", 1), (2, "b", None), (3, "C", 3)]


def test_limit_one(spark, rows):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "k string, n int")
    assert rows(dedup.limit_one(df, ["k"], [F.col("n")])) == [("a", 1), ("b", 3)]
    assert rows(dedup.limit_one(df, order_by=[F.col("n")])) == [("a", 1)]


def test_title_joins_keep_multiplicity(spark, rows):
    left = spark.createDataFrame([(1, "THE MATRIX"), (2, "Jaws"), (3, None)], "l int, a string")
    right = spark.createDataFrame([(10, "The-Matrix"), (11, "the matrix"), (12, None)], "r int, b string")
    assert rows(joins.join_on_title_key(left, right, "a", "b"), "l", "r") == [(1, 10), (1, 11)]
    assert rows(joins.anti_join_title(left, right, "a", "b"), "l") == [(2,), (3,)]
    assert rows(joins.anti_join_lower(left, right, "a", "b"), "l") == [(2,), (3,)]


def test_bb_titles_that_only_normalise_alike_all_survive(spark, rows):
    new = spark.createDataFrame([("Jaws",), ("JAWS!",)], "t string")
    known = spark.createDataFrame([("Alien",)], "t string")
    assert rows(joins.anti_join_title(new, known, "t", "t")) == [("JAWS!",), ("Jaws",)]


def test_person_joins(spark, rows):
    day = datetime(1980, 1, 1).date()
    src = spark.createDataFrame([(1, "ANN", "lee", day), (2, "Bob", "Ray", None)], "s int, prenom string, nom string, date_naissance date")
    clients = spark.createDataFrame(
        [(7, "Ann", "Lee", day, 1), (8, "ann", "LEE", None, 1), (9, "Bob", "Ray", None, 1), (6, "Ann", "Lee", day, 2)],
        "client_id int, prenom string, nom string, date_naissance date, magasin_id int",
    )
    assert rows(joins.join_on_person_key(src, clients, 1), "s", "client_id") == [(1, 7)]
    assert rows(joins.join_on_name_only(src, clients, 1), "s", "client_id") == [(1, 7), (1, 8), (2, 9)]


def test_lookups(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "n int, k string")
    ref = spark.createDataFrame([("a", 5, "y"), ("a", 4, "x"), ("c", 1, "z")], "k string, id int, v string")
    assert rows(joins.lookup_left(df, ref, "k", ["v"], [F.col("id")]), "n", "v") == [(1, "x"), (2, None), (3, None)]
    hit, miss = joins.lookup_first_match(df, ref, "k", "id")
    assert rows(hit, "n", "id") == [(1, 4)] and rows(miss, "n", "id") == [(2, None), (3, None)]


def test_quarantine_splits_the_input(facts, dim):
    matched, rejected = joins.quarantine_unmatched(facts, dim, "k", "no match")
    assert matched.count() + rejected.count() == facts.count()
    assert rejected.where("k IS NULL").count() == 100 and rejected.select("reason").distinct().count() == 1


def test_routing_sends_null_to_the_false_branch(spark, rows):
    df = spark.createDataFrame([(1,), (5,), (None,)], "n int")
    yes, no = shape.route_rows(df, F.col("n") > 3)
    assert rows(yes) == [(5,)] and rows(no) == [(None,), (1,)]


def test_rental_measures_and_interval(spark, rows):
    at = datetime
    df = spark.createDataFrame(
        [(1, at(2008, 1, 1, 9), at(2008, 1, 1, 18), 2.5), (2, at(2008, 1, 1), at(2008, 1, 4), 2.5), (3, at(2008, 1, 2), at(2008, 1, 1), 2.5), (4, at(2008, 1, 1), None, 2.5)],
        "n int, a timestamp, b timestamp, p double",
    )
    valid = shape.valid_interval_filter(df, "a", "b")
    assert rows(shape.rental_measures(valid, "a", "b", "p"), "n", "nb_jours_total", "ca_locations") == [
        (1, 1, Decimal("2.50")), (2, 3, Decimal("7.50"))
    ]
    assert rows(shape.rental_measures(valid, "a", "b", "p", min_days=0), "n", "nb_jours_total")[0] == (1, 0)
    assert rows(shape.rental_measures(df, "a", "b", "p").where("n = 4"), "nb_jours_total", "ca_locations") == [(None, None)]


def test_small_shapes(spark, rows):
    df = spark.createDataFrame([(1, Decimal("1.50"), " "), (None, None, "x")], "n int, d decimal(10,2), t string")
    assert dict(shape.coerce_decimals(df).dtypes) == {"n": "int", "d": "double", "t": "string"}
    assert rows(shape.required_fields_filter(df, ["n"])) != [] and rows(shape.required_fields_filter(df, ["n"], ["t"])) == []
    assert rows(shape.append_streams(df.select("n"), df.select("t"))) == [(None, None), (None, " "), (None, "x"), (1, None)]
    assert rows(shape.sort_ci(df, ["t"], ["n"]).select("n")) == [(None,), (1,)]
    assert rows(shape.stored_margin(df.withColumn("c", F.lit(1)), "d", "c"), "marge") == [(None,), (Decimal("0.50"),)]


@pytest.fixture
def months(spark):
    """March 2008 is missing."""
    return spark.createDataFrame(
        [(2007, 12, 100), (2008, 1, 80), (2008, 2, 90), (2008, 4, 45), (2008, 5, 0), (2008, 6, 10)], "annee int, mois int, n int"
    )


def test_previous_row_and_previous_month_differ_on_a_gap(months, rows):
    assert ("2008", "4", "90") in [tuple(map(str, (r[0], r[1], r[3]))) for r in rows(periods.lag_previous_row(months, "n"))]
    by_month = {(r[0], r[1]): r[3] for r in rows(periods.previous_calendar_month(months, "n"))}
    assert by_month[(2008, 4)] is None and by_month[(2008, 1)] == 100 and by_month[(2007, 12)] is None


def test_changes(months, rows):
    pct = {(r[0], r[1]): r[3] for r in rows(periods.mom_change_pct(months, "n"))}
    assert pct == {(2008, 1): -20.0, (2008, 2): 12.5, (2008, 4): -50.0, (2008, 5): -100.0, (2008, 6): None}
    flagged = {(r.annee, r.mois): r.flagged for r in periods.mom_drop_flag(months, "n").collect()}
    assert {k for k, v in flagged.items() if v is not None} == {(2008, 1), (2008, 5)}


def test_drop_filter_keeps_product_rows_of_falling_months(spark, rows):
    df = spark.createDataFrame([(2008, 1, "a", 60), (2008, 1, "b", 40), (2008, 2, "a", 70), (2008, 2, "b", 5)], "annee int, mois int, produit_id string, n int")
    assert [r[:3] for r in rows(periods.mom_drop_filter(df, "n"), "mois", "produit_id", "n")] == [(2, "a", 70), (2, "b", 5)]


def test_distinct_counts_cannot_be_rolled_up(months):
    with pytest.raises(ValueError):
        periods.reaggregate_monthly(months.withColumn("nb_clients", F.lit(1)), ["annee"], ["nb_clients"])


def test_topn_breaks_ties(spark, rows):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", 5), (1, "c", 4), (2, "a", 1)], "g int, k string, m int")
    top = periods.topn_per_group(df, ["g"], F.col("m"), ["k"], n=2)
    assert rows(top, "g", "k", "rank") == [(1, "a", 1), (1, "b", 2), (2, "a", 1)]


def test_quality(spark, rows):
    df = spark.createDataFrame([("Ta", 1), ("Tb", 1), ("c", None), (None, 2)], "t string, n int")
    parents = spark.createDataFrame([(1,), (1,)], "id int")
    assert rows(quality.null_rate_profile(df, "x", ["t", "n"])) == [("x", "n", 1, 4, 25.0), ("x", "t", 1, 4, 25.0)]
    assert rows(quality.duplicate_rate(df, ["n"])) == [(1, 4, 25.0)]
    assert rows(quality.orphan_count(df, parents, "n", "id")) == [(2, 4)]
    assert rows(quality.prefix_rate(df, "t")) == [(2, round(200 / 3, 6))]
    assert rows(quality.row_count_report({"a": df, "b": parents})) == [("a", 4), ("b", 2)]
    assert rows(quality.duplicate_rate(df.limit(0), ["n"])) == [(0, 0, None)]
