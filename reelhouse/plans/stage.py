"""Named table builders, evaluated lazily or stored table by table."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext
from threading import Lock

from pyspark.sql import DataFrame, Observation, SparkSession

from reelhouse.operators.quality import metrics_of, watched
from reelhouse.sources.shared import shuffles_removed
from reelhouse.sources.tables import fact_partition_by_year, truncate_reload


class Stage:
    """Builds tables by name from ``builders``, each of which may ask for other tables.

    Without a database every table is one lazy plan. With one, each table is written before
    the next reads it, so a lost executor costs at most one table's work; its shuffle files go with it. Tables named in
    ``by_year`` are stored one folder per year, those in ``large`` are written one at a time, so that the shuffle files of one
    of them are on disk at most. ``measured`` holds row count and missing values of each written table,
    taken while it was written.
    """

    def __init__(
        self, spark: SparkSession, src, builders: dict[str, Callable[["Stage"], DataFrame]],
        database: str | None = None, by_year: tuple[str, ...] = (), large: tuple[str, ...] = (),
    ) -> None:
        self.spark = spark
        self.src = src
        self._builders = builders
        self._database = database
        self._by_year = by_year
        self._large = large
        self._large_write = Lock()
        self._frames: dict[str, DataFrame] = {}
        self._locks = {name: Lock() for name in builders}
        self.names = tuple(builders)
        self.measured: dict[str, dict[str, int]] = {}

    @property
    def stored(self) -> bool:
        """True when tables are written, so that reading one doesn't compute it again."""
        return self._database is not None

    @property
    def database(self) -> str | None:
        return self._database

    def plan(self, name: str) -> DataFrame:
        """The table as a plan over its inputs; the inputs are stored when there is a database."""
        return self._builders[name](self)

    def __getitem__(self, name: str) -> DataFrame:
        with self._locks[name]:  # a table asked for by several is built once; builders form no circle
            if name not in self._frames:
                df = self.plan(name)
                if self._database:
                    table, seen, metrics = f"{self._database}.{name}", Observation(), watched(df)
                    df = df.observe(seen, *[metric.alias(key) for key, metric in metrics.items()])
                    # inputs are stored by now, so a write waits for no other table
                    with self._large_write if name in self._large else nullcontext(), shuffles_removed(self.spark):
                        if name in self._by_year:
                            fact_partition_by_year(df, table)
                        else:
                            truncate_reload(df, table)
                    self.measured[name] = metrics_of(seen, list(metrics))
                    df = self.spark.table(table)
                self._frames[name] = df
            return self._frames[name]

    def load(self, names: Iterable[str], at_once: int = 4) -> dict[str, DataFrame]:
        """The named tables; tables that don't need each other are written at the same time."""
        names = list(names)
        with ThreadPoolExecutor(at_once) as pool:
            return dict(zip(names, pool.map(self.__getitem__, names), strict=True))
