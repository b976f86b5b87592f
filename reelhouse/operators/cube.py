"""Cube queries over star frames: levels, slices, rollups, pivots and summary routing.

Measures are summed per needed foreign key first and the dimensions are joined to that small
result, so a product or client holding a large share of the fact is one row per task before
anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from reelhouse.functions.measures import ratio_measures
from reelhouse.functions.text import client_caption
from reelhouse.operators.periods import top_members
from reelhouse.sources.shared import written


@dataclass(frozen=True)
class Level:
    """A hierarchy level: its dimension, key columns with their ancestors, and its caption."""

    dim: str
    columns: tuple[str, ...]
    caption: Callable[[], Column] | None = None


@dataclass(frozen=True)
class Summary:
    """A pre-aggregated table: {dimension column: its expression there} and {measure: column} it can answer.

    ``rows`` is its size as measured when it was written; summaries of unknown size come after all others, in the order of ``grain``.
    """

    name: str
    frame: DataFrame
    columns: dict[str, str]
    measures: dict[str, str]
    grain: int
    rows: int | None = None

    @property
    def size(self) -> tuple[bool, int, int]:
        return self.rows is None, self.rows or 0, self.grain


@dataclass(frozen=True)
class CubeSpec:
    """A fact with its dimensions {name: (frame, key)}, measures {name: column} and summaries.

    A slice member is a value of the level, or a tuple with its ancestors' values where the level's own value
    isn't unique: ``2`` is the second quarter of every year, ``(1996, 2)`` that of one.
    """

    fact: DataFrame
    dims: dict[str, tuple[DataFrame, str]]
    measures: dict[str, str]
    summaries: tuple[Summary, ...] = ()
    slices: dict[str, tuple] = field(default_factory=dict)


# The hierarchy levels, each with the columns that make its members unique.
LEVELS = {
    "Year": Level("Time", ("annee",)),
    "Quarter": Level("Time", ("annee", "trimestre"), lambda: F.concat(F.lit("Q"), F.col("trimestre").cast("string"))),
    "Month": Level("Time", ("annee", "trimestre", "mois"), lambda: F.col("nom_mois")),
    "Day": Level("Time", ("annee", "trimestre", "mois", "jour")),
    "Type": Level("Product", ("type",)),
    "Subtype": Level("Product", ("type", "sous_type")),
    "Product": Level("Product", ("type", "sous_type", "produit_id"), lambda: F.col("titre")),
    "Store": Level("Store", ("magasin_id",), lambda: F.col("nom_magasin")),
    "Age Group": Level("Client", ("tranche_age",)),
    "Gender": Level("Client", ("genre",)),
    "Client": Level("Client", ("client_id",), lambda: client_caption(F.col("prenom"), F.col("nom"))),
}
# Drill paths. Clients have two independent ones.
TIME_PATH = ("annee", "trimestre", "mois", "jour")
PRODUCT_PATH = ("type", "sous_type", "produit_id")
CLIENT_PATHS = {"age": ("tranche_age", "client_id"), "gender": ("genre", "client_id")}

# Measures and summary columns of the two cubes.
SALES_MEASURES = {
    "Sales Revenue": "ca_ventes",
    "Inventory Cost": "prix_inventaire_total",
    "Gross Margin": "marge",
    "Number of Sales": "nb_ventes",
}
RENTAL_MEASURES = {
    "Rental Revenue": "ca_locations",
    "Number of Rentals": "nb_locations",
    "Total Rental Days": "nb_jours_total",
}
CALCULATED = {
    "Avg Revenue per Sale": ("Sales Revenue", "Number of Sales"),
    "Margin Rate": ("Gross Margin", "Sales Revenue"),
    "Avg Revenue per Rental": ("Rental Revenue", "Number of Rentals"),
    "Avg Duration (days)": ("Total Rental Days", "Number of Rentals"),
}
# Time columns of a summary by year and month.
_MONTHS = {"annee": "annee", "trimestre": "CAST((mois + 2) DIV 3 AS INT)", "mois": "mois"}


def sales_cube(
    fact: DataFrame, dims: dict, by_store: DataFrame | None = None, by_product: DataFrame | None = None, rows: dict[str, int] | None = None,
) -> CubeSpec:
    """The sales cube, with whichever of its two summaries exist and their measured rows by name."""
    summaries, rows = [], rows or {}
    if by_store is not None:
        summaries.append(Summary(
            "agg_ventes_mois_magasin", by_store,
            {**_MONTHS, "magasin_id": "magasin_id"},
            {"Sales Revenue": "ca_total", "Gross Margin": "marge_totale", "Number of Sales": "nb_ventes"}, 1,
            rows.get("agg_ventes_mois_magasin"),
        ))
    if by_product is not None:
        summaries.append(Summary(
            "agg_ventes_mois_produit", by_product,
            {**_MONTHS, "type": "type_produit", "produit_id": "produit_id"},
            {"Sales Revenue": "ca_total", "Number of Sales": "nb_ventes"}, 2,
            rows.get("agg_ventes_mois_produit"),
        ))
    return CubeSpec(fact, dims, SALES_MEASURES, tuple(summaries))


def rentals_cube(fact: DataFrame, dims: dict, summary: DataFrame | None = None) -> CubeSpec:
    """The rentals cube, with its summary if there is one."""
    summaries = () if summary is None else (Summary(
        "agg_locations_mois_produit_magasin", summary,
        {**_MONTHS, "produit_id": "produit_id", "magasin_id": "magasin_id"},
        {"Rental Revenue": "ca_total", "Number of Rentals": "nb_locations", "Total Rental Days": "nb_jours_total"}, 3,
    ),)
    return CubeSpec(fact, dims, RENTAL_MEASURES, summaries)


def slice_dice(cube: CubeSpec, members: dict[str, list]) -> CubeSpec:
    """Restrict every later query on the cube to the given members of each level."""
    slices = dict(cube.slices)
    for level, wanted in members.items():
        slices[level] = tuple(m for m in wanted if level not in slices or m in slices[level])
    return replace(cube, slices=slices)


def _in_slice(level: str, members: tuple, column: Callable[[str], Column] = F.col) -> Column:
    """True for the members of a level's slice."""
    names = LEVELS[level].columns
    test = F.lit(False)
    for m in members:
        values = m if isinstance(m, tuple) else (m,)
        own = F.lit(True)
        for name, value in zip(names[-len(values):], values, strict=True):
            own = own & (column(name) == F.lit(value))
        test = test | own
    return test


def _level_columns(levels: list[str]) -> list[str]:
    columns: list[str] = []
    for name in levels:
        columns += [c for c in LEVELS[name].columns if c not in columns]
    return columns


_BOUNDED = ("Time", "Store")  # one row per calendar day, one per store


def star(cube: CubeSpec, columns: list[str], measures: list[str]) -> DataFrame:
    """Measures summed per distinct combination of dimension ``columns``, slices applied."""
    owner = {c: LEVELS[name].dim for name in LEVELS for c in LEVELS[name].columns}
    used = {owner[c] for c in columns} | {LEVELS[name].dim for name in cube.slices}
    keys = {dim: cube.dims[dim][1] for dim in used}
    fact = cube.fact
    if "Year" in cube.slices and "annee" in fact.columns:
        fact = fact.where(_in_slice("Year", cube.slices["Year"]))  # prunes the fact's year folders
    sums = {m: cube.measures[m] for m in measures}
    rows = fact.groupBy(*keys.values()).agg(*[F.sum(c).alias(m) for m, c in sums.items()])
    for dim, key in sorted(keys.items(), key=lambda item: item[0] not in _BOUNDED):
        frame = cube.dims[dim][0]
        for name, members in cube.slices.items():
            if LEVELS[name].dim == dim:
                frame = frame.where(_in_slice(name, members))
        wanted = [c for c in columns if owner[c] == dim and c != key]
        frame = frame.select(key, *wanted)
        if dim in _BOUNDED:
            rows = rows.join(F.broadcast(frame), key)
        else:
            rows = rows.join(frame, key)
    return rows


def measure_at_level(cube: CubeSpec, measures: list[str], levels: list[str]) -> DataFrame:
    """Measures summed at the given levels, members identified with their ancestors."""
    columns = _level_columns(levels)
    rows = star(cube, columns, measures).groupBy(*columns)
    return rows.agg(*[F.sum(m).alias(m) for m in measures])


def calculated_members(df: DataFrame, names: list[str]) -> DataFrame:
    """Add ratios of measures already summed at the wanted level."""
    return df.withColumns({n: ratio_measures(F.col(CALCULATED[n][0]), F.col(CALCULATED[n][1])) for n in names})


def _finest(cube: CubeSpec, columns: list[str], measures: list[str]) -> DataFrame:
    sums = star(cube, columns, measures).groupBy(*columns).agg(*[F.sum(m).alias(m) for m in measures])
    return sums.withColumn("grouping_id", F.lit(0).cast("bigint"))


def without(level: DataFrame, columns: list[str], dropped: str, merges: dict[str, Column], also: tuple[str, ...] = ()) -> DataFrame:
    """Totals of ``level`` over the 'All' member of one of its ``columns``; ``also`` are further keys that stay."""
    bit = 1 << len(columns) - 1 - columns.index(dropped)
    kinds = dict(level.dtypes)
    keys = [c for c in (*columns, *also, "grouping_id") if c != dropped]
    totals = level.groupBy(*keys).agg(*[merge.cast(kinds[name]).alias(name) for name, merge in merges.items()])
    changed = {dropped: F.lit(None).cast(kinds[dropped]), "grouping_id": F.col("grouping_id") + F.lit(bit)}
    return totals.select([changed.get(c, F.col(f"`{c}`")).alias(c) for c in level.columns])


def path_totals(finest: DataFrame, path: list[str], merges: dict[str, Column], also: tuple[str, ...] = ()) -> DataFrame:
    """Every level of a drill path, each summed from the level below it; ``finest`` has a grouping_id of 0."""
    levels = [finest]
    for column in reversed(path):
        levels.append(without(levels[-1], path, column, merges, also))
    return reduce(DataFrame.unionByName, levels)


def every_total(finest: DataFrame, columns: list[str], order: list[str], merges: dict[str, Column], also: tuple[str, ...] = ()) -> DataFrame:
    """Every combination of columns and 'All' members; ``order`` lists the columns with the most members first.

    Columns are summed away one after the other, each time from everything found so far: a combination thus comes from the one that has, beside
    its columns, the missing column with the fewest members, the smallest it can come from. That is one shuffle per column rather
    than one row per combination for every finest row.
    """
    found = finest
    for column in order:
        found = found.unionByName(without(found, columns, column, merges, also))
    return found


def by_members(cube: CubeSpec, columns: list[str]) -> list[str]:
    """The columns, those with most members in their dimension first."""
    owner = {c: LEVELS[name].dim for name in LEVELS for c in LEVELS[name].columns}
    counts = [cube.dims[owner[c]][0].agg(F.approx_count_distinct(c).alias("n")).select(F.lit(c).alias("c"), "n") for c in columns]
    members = {row.c: row.n for row in reduce(DataFrame.unionAll, counts).collect()}  # one row per column
    return sorted(columns, key=lambda c: -members[c])


def _sums(measures: list[str]) -> dict[str, Column]:
    return {m: F.sum(f"`{m}`") for m in measures}


def coarser_totals(finest: DataFrame, columns: list[str], kept: list[list[str]], merges: dict[str, Column]) -> DataFrame:
    """``finest`` and the totals that keep only the listed columns, all from one pass over it; the finest rows themselves aren't grouped again."""
    kinds = dict(finest.dtypes)
    grouped = finest.groupingSets([[F.col(c) for c in own] for own in kept], *columns)
    totals = grouped.agg(F.grouping_id().alias("grouping_id"), *[merge.cast(kinds[name]).alias(name) for name, merge in merges.items()])
    return finest.unionByName(totals)


def _prefixes(path: list[str]) -> list[list[str]]:
    return [path[:i] for i in range(len(path))]


def rollup_time(cube: CubeSpec, measures: list[str]) -> DataFrame:
    """Totals for all periods, years, quarters, months and days."""
    path = list(TIME_PATH)
    return coarser_totals(_finest(cube, path, measures), path, _prefixes(path), _sums(measures))


def rollup_product(cube: CubeSpec, measures: list[str]) -> DataFrame:
    """Totals for all products, types, subtypes and products; each level from the one below, since products grow with the data."""
    path = list(PRODUCT_PATH)
    return path_totals(_finest(cube, path, measures), path, _sums(measures))


def rollup_client(cube: CubeSpec, measures: list[str], hierarchy: str) -> DataFrame:
    """Totals for all clients, bands (``age``) or genders (``gender``), and clients; each level from the one below."""
    path = list(CLIENT_PATHS[hierarchy])
    return path_totals(_finest(cube, path, measures), path, _sums(measures))


def cube_cross_dims(cube: CubeSpec, measures: list[str], columns: list[str], chained: bool = False) -> DataFrame:
    """Totals for every combination of the level columns and their 'All' members.

    By default all of them come from one pass over the finest totals, which repeats each of those once per combination before they are
    reduced in the task: right for few members. ``chained`` stores the finest totals and sums the columns away one after the other
    instead (``every_total``): right where products or clients are among the columns.
    """
    finest = _finest(cube, columns, measures)
    if chained:
        return every_total(written(finest, "cube"), columns, by_members(cube, columns), _sums(measures))
    kept = [[c for i, c in enumerate(columns) if not gone >> i & 1] for gone in range(1, 1 << len(columns))]
    return coarser_totals(finest, columns, kept, _sums(measures))


def pivot_matrix(df: DataFrame, row: list[str], col: str, values: list, measure: str) -> DataFrame:
    """Wide matrix of summed measures; the column members are stated, so no extra pass finds them."""
    return df.groupBy(*row).pivot(col, values).agg(F.sum(measure))


def distinct_buyers(fact: DataFrame, keys: list[str], approximate: bool = False) -> DataFrame:
    """Distinct clients per group, always from the fact."""
    count = F.approx_count_distinct("client_id") if approximate else F.count_distinct("client_id")
    return fact.groupBy(*keys).agg(count.alias("n"))


def year_filtered_total(fact: DataFrame, measure: str, year: int, store: int | None = None) -> DataFrame:
    """Total of one year, and store, read from that year's partition alone."""
    rows = fact.where(F.col("annee") == year)
    if store is not None:
        rows = rows.where(F.col("magasin_id") == store)
    return rows.agg(F.sum(measure).alias("total"))


def level_members(dim: DataFrame, level: str) -> DataFrame:
    """Members of a level from the dimension, with caption, whether or not they have facts."""
    spec = LEVELS[level]
    caption = F.col(spec.columns[-1]) if spec.caption is None else spec.caption()
    return dim.select(*spec.columns, caption.cast("string").alias("caption")).distinct()


def member_sort(df: DataFrame) -> DataFrame:
    """Months in calendar order, shown by name."""
    return df.orderBy("annee", "mois").drop("mois")


def top_count(cube: CubeSpec, level: str, n: int, measure: str) -> DataFrame:
    """(annee, member, value) of the n members that are largest over the whole slice."""
    member = LEVELS[level].columns[-1]
    per_year = star(cube, ["annee", member], [measure]).groupBy("annee", member).agg(F.sum(measure).alias("value"))
    best = top_members(per_year, member, "value", n)
    return per_year.join(F.broadcast(best), member, "left_semi").select("annee", member, "value")


def summary_router(cube: CubeSpec, levels: list[str], measures: list[str]) -> tuple[DataFrame, str]:
    """Answer from the smallest summary that covers the request, by measured rows, else from the fact.

    Both routes give the columns of ``measure_at_level``: each level with its ancestors, so that members
    that share a name stay apart, and the measures. A summary covers a request when it has every column
    of the levels and slices, and every measure is a plain sum.
    """
    columns = _level_columns(levels)
    asked = {*columns, *_level_columns(list(cube.slices))}
    for summary in sorted(cube.summaries, key=lambda s: s.size):
        if asked <= set(summary.columns) and set(measures) <= set(summary.measures):
            at = lambda c: F.expr(summary.columns[c])  # noqa: B023, E731
            rows = summary.frame
            for name, members in cube.slices.items():
                rows = rows.where(_in_slice(name, members, at))
            sums = [F.sum(summary.measures[m]).alias(m) for m in measures]
            return rows.groupBy(*[at(c).alias(c) for c in columns]).agg(*sums), summary.name
    return measure_at_level(cube, measures, levels), "fact"
