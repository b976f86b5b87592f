"""Sources and warehouses of one benchmark folder, shared by the registered queries."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from reelhouse.operators.cube import CubeSpec, rentals_cube, sales_cube
from reelhouse.operators.member_sets import monthly_client_sets
from reelhouse.plans.dimensions import dim_date, dim_store
from reelhouse.plans.direct import direct_warehouse
from reelhouse.plans.layered import layered_warehouse
from reelhouse.plans.stage import Stage
from reelhouse.registry.oracle import complete
from reelhouse.sources.binding import BENCHMARK_CALENDAR, RawSources
from reelhouse.sources.shared import written
from reelhouse.sources.tables import new_database


class Workspace:
    """Raw sources, lazy plans and, once something asks for them, stored warehouses."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.src = RawSources(spark, folder)

    @cached_property
    def calendar(self) -> DataFrame:
        return dim_date(self.spark, *BENCHMARK_CALENDAR)

    @cached_property
    def stores(self) -> DataFrame:
        return dim_store(self.spark)

    @cached_property
    def lazy(self) -> Stage:
        """Direct path as plans from the raw tables, nothing stored."""
        return direct_warehouse(self.spark, self.src, self.calendar, self.stores)

    @cached_property
    def direct(self) -> Stage:
        """Direct path stored table by table in the shared folder, loaded on first use."""
        return direct_warehouse(self.spark, self.src, self.calendar, self.stores, new_database(self.spark))

    @cached_property
    def layered(self) -> Stage:
        """Layered path stored table by table in the shared folder, loaded on first use."""
        return layered_warehouse(self.spark, self.src, self.calendar, self.stores, new_database(self.spark))

    @cached_property
    def dims(self) -> dict:
        stores = self.direct["dim_magasin"].select("magasin_id", F.col("nom").alias("nom_magasin"))
        return {
            "Time": (self.direct["dim_temps"], "temps_id"), "Product": (self.direct["dim_produit"], "produit_id"),
            "Store": (stores, "magasin_id"), "Client": (self.direct["dim_client"], "client_id"),
        }

    @cached_property
    def client_sets(self) -> DataFrame:
        """Monthly sets of clients, stored on first use."""
        return written(monthly_client_sets(self.direct["fait_ventes"], self.direct["dim_temps"], self.direct["dim_produit"]), "client-sets")

    @cached_property
    def sales(self) -> CubeSpec:
        summaries = [self.direct[name] for name in ("agg_ventes_mois_magasin", "agg_ventes_mois_produit")]
        return sales_cube(self.direct["fait_ventes"], self.dims, *summaries, {name: found["nb"] for name, found in self.direct.measured.items()})

    @cached_property
    def rentals(self) -> CubeSpec:
        return rentals_cube(self.direct["fait_locations"], self.dims, self.direct["agg_locations_mois_produit_magasin"])


_WORKSPACES: dict[tuple[str, str], Workspace] = {}


def workspace(spark: SparkSession, folder: str) -> Workspace:
    """The folder's workspace in this Spark application."""
    key = (spark.sparkContext.applicationId, str(folder).rstrip("/"))
    if key not in _WORKSPACES:
        _WORKSPACES[key] = Workspace(spark, key[1])
    return _WORKSPACES[key]


def settled(df: DataFrame) -> DataFrame:
    """Sums in their reported types: decimal(22,2) for money, bigint for counts."""
    return df.select([
        F.col(f"`{f.name}`").cast("decimal(22,2)").alias(f.name)
        if isinstance(f.dataType, T.DecimalType) and f.dataType.precision > 22 else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


QUERIES: dict[str, Callable[[Workspace], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None):
    """Register a query under ``name`` with the SQL that must give the same rows."""
    def register(build: Callable[[Workspace], DataFrame]):
        QUERIES[name] = build
        if check is not None:
            CHECKS[name] = complete(check)
        return build
    return register
