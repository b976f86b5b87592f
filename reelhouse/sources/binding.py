"""Raw source tables derived from the benchmark tables.

Every part, customer, supplier and order line belongs to some source; membership follows
descriptive attributes. Names and titles carry a running volume or block number, so the number
of namesakes per key stays bounded while the tables grow, but for one nation's customers of the second store, whose namesakes
grow with the square root of the customers. One product holds an eighth of all order lines.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

# Schemas are stated so that opening a table starts no job.
BENCHMARK_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
}
BENCHMARK_CALENDAR = ("1995-01-01", "2000-12-31")  # ends before the last orders: later ones are quarantined

_BIRTH = "date_add(DATE'1940-01-01', cast((c_custkey div 16) % 25 * 1000 as int))"
_BLOCK = "concat(n_name, '-', c_custkey div 16)"
_TITLE = "concat(CASE WHEN p_size > 40 THEN 'The ' ELSE '' END, p_name, ' ', p_partkey div 4)"
_BB_TITLE = "concat(CASE WHEN p_size > 40 THEN 'THE ' ELSE '' END, upper(p_name), '-', p_partkey div 4)"
_GADGET = "concat('T', p_name, ' ', p_partkey div 4)"
_MMM_GADGET = "concat('T', p_name, IF(p_size % 10 = 3, ' Deluxe ', ' '), p_partkey div 4)"  # some that BB lacks
_MMM_NAME = "concat('T', initcap(c_mktsegment), IF(c_acctbal > 7500, ' Q.', ''), ' ', n_name, '-', c_custkey div 16)"
_MMM_MALE = "CASE WHEN c_acctbal < 0 THEN NULL ELSE c_custkey % 2 END"
_UNSOLD = "l_linestatus = 'O'"
_HOT_PART = "IF(l_orderkey % 8 = 0, 7L, l_partkey)"
_MS_BLOCK = "IF(c_nationkey = 7, cast(floor(sqrt(c_custkey) / 4) as bigint), c_custkey div 8)"


class RawSources:
    """Lazily defined raw tables of the three sources over one benchmark folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            reader = self.spark.read.schema(BENCHMARK_SCHEMAS[name])
            self._tables[name] = reader.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def _customers(self) -> DataFrame:
        return self.table("customer").join(self.table("nation"), F.expr("c_nationkey = n_nationkey"))

    def _lines(self, flag: str) -> DataFrame:
        """Order lines of one store: returned (A, R) and not returned (N) lines are the stores."""
        lines = self.table("lineitem").where(F.col("l_returnflag") == flag).withColumn("l_partkey", F.expr(_HOT_PART))
        return lines.join(self.table("orders"), F.expr("l_orderkey = o_orderkey"))

    def _gadget_lines(self, flag: str) -> DataFrame:
        gadgets = self.table("part").where("p_type = 'PROMO'")
        return self._lines(flag).join(gadgets, F.expr("l_partkey = p_partkey"))

    def _with_buyer(self, lines: DataFrame) -> DataFrame:
        """Lines carrying the denormalised buyer, as the third source stores them."""
        return lines.join(self._customers, F.expr("o_custkey = c_custkey"))

    @cached_property
    def bb_customer(self) -> DataFrame:
        return self._customers.selectExpr(
            "concat('T', c_custkey) AS code",
            "concat('T', CASE WHEN c_acctbal > 4500 THEN upper(c_mktsegment) ELSE lower(c_mktsegment) END) AS firstname",
            f"concat('T', {_BLOCK}) AS lastname",
            f"IF(c_custkey % 2 = 0, date_format({_BIRTH}, 'MM/dd/yy'), date_format({_BIRTH}, 'MM/dd/yyyy')) AS dob",
            "CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'TFemale' ELSE 'TMale' END AS sex",
        )

    @cached_property
    def bb_movie(self) -> DataFrame:
        return self.table("part").where("p_type NOT IN ('PROMO', 'LARGE')").selectExpr(
            "concat('T', p_partkey) AS movie_id", f"concat('T', {_BB_TITLE}) AS movie_title",
            "concat('T', 1950 + p_size) AS movie_year",
        )

    @cached_property
    def bb_actor(self) -> DataFrame:
        return self.table("supplier").where("s_acctbal < 6000").selectExpr(
            "concat('T', s_suppkey) AS actor_id", "concat('T', upper(s_name)) AS actor_name",
            "CASE WHEN s_acctbal < 0 THEN 'TFemale' END AS sex",
        )

    @cached_property
    def bb_actsin(self) -> DataFrame:
        return self.table("lineitem").where("l_returnflag = 'A'").selectExpr(
            "concat('T', l_partkey) AS movieid", "concat('T', l_suppkey) AS actorid"
        )

    @cached_property
    def bb_sale_item(self) -> DataFrame:
        return self._lines("A").selectExpr(
            "l_orderkey * 8 + l_linenumber AS id", "concat('T', l_partkey) AS refers_to",
            f"IF({_UNSOLD}, NULL, concat('T', o_custkey)) AS cust_id", "'Tmovie' AS type",
            f"IF({_UNSOLD}, NULL, o_orderdate) AS sale_date",
            f"IF({_UNSOLD}, NULL, l_extendedprice) AS sale_price", "l_quantity * 10 AS inventory_price",
        )

    @cached_property
    def bb_gadget(self) -> DataFrame:
        return self._gadget_lines("A").selectExpr(
            "l_orderkey * 8 + l_linenumber AS id", f"{_GADGET} AS title", "concat('T', p_brand) AS type",
            f"IF({_UNSOLD}, NULL, o_orderdate) AS sale_date",
            f"IF({_UNSOLD}, NULL, l_extendedprice) AS sale_price", "p_retailprice AS price",
            f"IF({_UNSOLD}, NULL, concat('T', o_custkey)) AS cust_id",
        )

    @cached_property
    def ms_movie(self) -> DataFrame:
        return self.table("part").where("p_type NOT IN ('PROMO', 'ECONOMY')").selectExpr(
            "p_partkey AS movieid", f"concat('T', {_TITLE}) AS movie_title",
            "1950 + p_size AS production_year", "make_date(1950 + p_size, 1, 1 + p_size % 28) AS release_date",
            "p_retailprice AS release_price", "IF(p_size % 10 = 0, NULL, concat('T', p_brand)) AS director",
            "concat('T', p_type) AS writer",
        )

    @cached_property
    def ms_actor(self) -> DataFrame:
        return self.table("supplier").where("s_acctbal > 3000").selectExpr(
            "s_suppkey AS actor_id", "concat('T', s_name) AS actor_name"
        )

    @cached_property
    def ms_acts_in(self) -> DataFrame:
        return self.table("lineitem").where("l_returnflag = 'N'").selectExpr(
            "l_partkey AS movie_id", "l_suppkey AS actor_id"
        )

    @cached_property
    def ms_customer(self) -> DataFrame:
        return self._customers.selectExpr(
            "c_custkey AS code", "concat('T', initcap(c_mktsegment)) AS name",
            "IF(c_acctbal > 7500, concat('T', substring(c_mktsegment, 1, 1), '.'), NULL) AS middlename",
            f"concat('T', n_name, '-', {_MS_BLOCK}) AS surname",
            "CASE WHEN c_custkey % 13 = 0 THEN 'X' WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender",
            f"CASE WHEN c_custkey % 11 = 0 THEN 'Tunknown' ELSE concat('T', cast({_BIRTH} AS string)) END AS birthday",
            "concat('T', c_name) AS address",
        )

    @cached_property
    def ms_copy_for_rent(self) -> DataFrame:
        return self.table("part").selectExpr(
            "p_partkey * 10 + 1 AS id", "IF(p_size < 25, 'TVHS', 'TDVD') AS copy_type",
            "IF(p_size > 45, 1, 0) AS disposed", "p_partkey AS movie_id",
        )

    @cached_property
    def ms_copy_for_sale(self) -> DataFrame:
        return self._lines("N").selectExpr(
            "l_orderkey * 8 + l_linenumber AS id", "IF(l_quantity < 25, 'TVHS', 'TDVD') AS copy_type",
            "IF(l_tax > 0.04, 1, 0) AS is_new", f"IF({_UNSOLD}, NULL, l_extendedprice) AS sale_price",
            f"IF({_UNSOLD}, NULL, o_orderdate) AS sale_date", "l_partkey AS movie_id",
            f"IF({_UNSOLD}, NULL, o_custkey) AS soldto",
        )

    @cached_property
    def ms_copy_rented_to(self) -> DataFrame:
        return self._lines("N").selectExpr(
            "l_partkey * 10 + 1 AS copy_id", "o_custkey AS cust_id", "o_orderdate AS from_date",
            "l_shipdate AS to_date", "cast(l_linenumber AS double) AS price_day",
        )

    @cached_property
    def mmm_movierentals(self) -> DataFrame:
        return self._with_buyer(self._lines("R")).selectExpr(
            "l_orderkey * 8 + l_linenumber AS ref_no", "l_partkey AS movie_id", "o_orderdate AS date_from",
            "l_shipdate AS date_to", "cast(l_linenumber AS double) AS price_rent",
            f"{_MMM_NAME} AS cust_name", f"{_MMM_MALE} AS sex_male", f"{_BIRTH} AS birthdate",
            "concat('T', c_name) AS address",
        )

    @cached_property
    def mmm_moviesales(self) -> DataFrame:
        return self._with_buyer(self._lines("R")).selectExpr(
            "l_orderkey * 8 + l_linenumber AS ref_no", "l_partkey AS movie_id", "o_orderdate AS sale_date",
            "IF(l_discount = 0, NULL, l_extendedprice) AS price_sale",
            f"{_MMM_NAME} AS cust_name", f"{_MMM_MALE} AS sex_male", f"{_BIRTH} AS birthdate",
        )

    @cached_property
    def mmm_gadgetsales(self) -> DataFrame:
        return self._with_buyer(self._gadget_lines("R")).selectExpr(
            "l_orderkey * 8 + l_linenumber AS ref_no", f"{_MMM_GADGET} AS gadget_title", "concat('T', p_brand) AS gadget_type",
            "o_orderdate AS sale_date", "IF(l_discount = 0, NULL, l_extendedprice) AS price_sale",
            "p_retailprice AS inv_price", "to_date(l_shipdate) AS inv_date",
            f"{_MMM_NAME} AS cust_name", f"{_MMM_MALE} AS sex_male", f"{_BIRTH} AS birthdate",
        )
