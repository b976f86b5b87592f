"""Table lifecycle: ingest, reload, append, partitions and upsert of stored tables."""

import pytest
from pyspark.sql import functions as F

from reelhouse.plans import dimensions
from reelhouse.sources import tables


@pytest.fixture
def database(spark):
    return tables.new_database(spark, "test")


def test_shared_folder_is_the_session_setting(spark, database):
    location = spark.sql(f"DESCRIBE DATABASE {database}").where("info_name = 'Location'").collect()[0][1]
    assert spark.conf.get("spark.checkpoint.dir") in location


def test_ingest_is_idempotent(spark, database, rows):
    df = spark.createDataFrame([(1, "1.50"), (2, "2.50")], "id int, p string").withColumn("p", F.col("p").cast("decimal(8,2)"))
    bundle = {"bb": {"movie": df}, "ms": {"movie": df.limit(1)}}
    first = tables.raw_ingest(bundle, spark, database)
    assert rows(first) == [("bb_movie", 2), ("ms_movie", 1)]
    more = {"bb": {"movie": df.union(df)}}
    assert rows(tables.raw_ingest(more, spark, database)) == [("bb_movie", 2)]
    assert dict(spark.table(f"{database}.bb_movie").dtypes)["p"] == "double"


def test_missing_and_empty_tables_are_not_loaded(spark, database):
    assert not tables.is_loaded(spark, f"{database}.nothing")
    empty = spark.range(0)
    assert not tables.skip_if_loaded(empty, f"{database}.t")
    assert not tables.skip_if_loaded(spark.range(3), f"{database}.t")
    assert tables.skip_if_loaded(spark.range(9), f"{database}.t")
    assert spark.table(f"{database}.t").count() == 3


@pytest.mark.parametrize("file_format, options", [("parquet", {}), ("csv", {"header": "true"}), ("json", {}), ("orc", {})])
def test_bundles_read_exported_files(spark, tmp_path, rows, file_format, options):
    df = spark.createDataFrame([(1, "Ta"), (2, None)], "id int, t string")
    writer = df.write.format(file_format)
    for key, value in options.items():
        writer = writer.option(key, value)
    writer.save(f"{tmp_path}/movie.{file_format}")
    bundle = tables.read_bundle(spark, str(tmp_path), {"movie": "id int, t string"}, file_format, **options)
    assert rows(bundle["movie"]) == rows(df)


def test_reload_and_append(spark, database, rows):
    table = f"{database}.t"
    for _ in range(2):
        tables.truncate_reload(spark.createDataFrame([(1, "a")], "id int, name string"), table)
    tables.append_rows(spark.createDataFrame([(5,)], "n long"), table, {"id": "n"})
    assert rows(spark.table(table)) == [(1, "a"), (5, None)]


def test_year_partitions_prune_and_split(spark, database):
    df = spark.range(1000).withColumn("annee", F.when(F.col("id") < 900, 2008).otherwise(2009))
    table = f"{database}.fact"
    tables.fact_partition_by_year(df, table)
    one = spark.table(table).where("annee = 2009")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(annee" in plan and one.count() == 100


def test_upsert_rewrites_only_touched_years(spark, database, rows):
    table = f"{database}.fact"
    df = spark.createDataFrame([(1, 10, 2007), (2, 20, 2008), (3, 30, 2009)], "id int, v int, annee int")
    tables.fact_partition_by_year(df, table)
    files = lambda year: set(spark.table(table).where(f"annee = {year}").inputFiles())
    untouched = files(2007)
    change = spark.createDataFrame([(2, 21, 2009), (4, 40, 2009)], "id int, v int, annee int")
    for _ in range(2):
        tables.upsert_table(table, change, ["id"], partition="annee")
        spark.catalog.refreshTable(table)
        assert rows(spark.table(table)) == [(1, 10, 2007), (2, 21, 2009), (3, 30, 2009), (4, 40, 2009)]
    assert files(2007) == untouched and files(2008) == set()


def test_upsert_of_an_unpartitioned_table(spark, database, rows):
    table = f"{database}.t"
    tables.truncate_reload(spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string"), table)
    tables.upsert_table(table, spark.createDataFrame([(2, "B"), (3, "C")], "id int, name string"), ["id"])
    assert rows(spark.table(table)) == [(1, "a"), (2, "B"), (3, "C")]


def test_calendar_and_stores(spark, rows):
    calendar = dimensions.dim_date(spark)
    assert calendar.count() == 2922 and calendar.select("temps_id").distinct().count() == 2922
    assert rows(calendar.where("date_complete = '2008-02-29'"))[0][2:] == (29, 2, "February", 1, 2008)
    assert rows(dimensions.dim_store(spark)) == [(1, "BB", None), (2, "MS", None), (3, "MMM", None)]
    assert rows(dimensions.dim_store(spark, {1: "a", 2: "b", 3: "c"}, {2: "Main St"}))[1] == (2, "b", "Main St")
    dated = spark.createDataFrame([("2008-02-03",), ("2009-07-01",)], "d string")
    assert dimensions.dim_date_of(dated, "d").count() == 731


def test_views(spark, rows):
    tables.reporting_views({"v_test": spark.range(2)})
    assert rows(spark.sql("SELECT * FROM v_test")) == [(0,), (1,)]
