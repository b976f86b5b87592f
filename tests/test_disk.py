"""What a load leaves on disk while it runs: shuffle files, rows on their way, stored files."""

import hashlib
import re
import threading
import time

import pytest
from pyspark.sql import functions as F

from reelhouse.plans import layered, stage as stages
from reelhouse.plans.stage import Stage
from reelhouse.sources import shared, tables


@pytest.fixture
def database(spark):
    return tables.new_database(spark, "test")


def _shuffle_files(spark):
    blocks = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllBlocks()
    return {name for name in (blocks.apply(i).name() for i in range(blocks.size())) if name.startswith("shuffle_")}


def _left(spark, before, seconds=10):
    """Shuffle files that are new and stay; they are removed by another thread."""
    until = time.time() + seconds
    while (left := _shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return left


def test_stored_tables_leave_no_shuffle_files(spark, database):
    sums = lambda s: s.src.groupBy("k").agg(F.sum("id").alias("total")).withColumn("annee", F.col("k") % 3)
    builders = {"flat": sums, "by_year": lambda s: s["flat"].join(sums(s).drop("annee", "total"), "k")}
    before = _shuffle_files(spark)
    stage = Stage(spark, spark.range(1000).withColumn("k", F.col("id") % 10), builders, database, ("by_year",))
    stage.load(stage.names)
    assert {n: found["nb"] for n, found in stage.measured.items()} == {"flat": 10, "by_year": 10}
    assert not _left(spark, before)


def test_the_sessions_setting_holds_after_the_last_write(spark):
    held = lambda: spark.conf.get(shared._REMOVAL)
    own = held()
    with shared.shuffles_removed(spark):
        with pytest.raises(ValueError), shared.shuffles_removed(spark):
            raise ValueError
        assert held() == "true"
    assert held() == own


def test_large_tables_are_written_one_at_a_time(spark, database, monkeypatch):
    at_once, most, lock, write = [], {}, threading.Lock(), stages.truncate_reload

    def watched(df, table):
        name = table.split(".")[1]
        with lock:
            at_once.append(name)
            for n in at_once:
                most[n] = max(most.get(n, 0), sum(x.startswith(n[:5]) for x in at_once))
        time.sleep(0.5)
        write(df, table)
        with lock:
            at_once.remove(name)

    monkeypatch.setattr(stages, "truncate_reload", watched)
    builders = {f"{kind}_{i}": lambda s: s.src for i in range(2) for kind in ("small", "large")}
    builders["large_2"] = lambda s: s["large_0"].unionAll(s["large_1"])  # waits for tables that are written alone themselves
    stage = Stage(spark, spark.range(5), builders, database, large=tuple(n for n in builders if n.startswith("large")))
    frames = stage.load(["large_2", *builders])
    assert frames["large_2"].count() == 10
    assert all(most[n] == 1 for n in most if n.startswith("large")) and most["small_0"] == 2


def test_sales_and_rentals_are_shuffled_without_ids_and_titles(ws, spark):
    for name in ("int_vente", "int_location"):
        ws.layered[name]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [ws.layered.plan(name)._jdf.queryExecution().executedPlan().toString() for name in ("int_vente", "int_location")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for plan in plans:
        lines = plan.split("\n")
        shuffles = [i for i, line in enumerate(lines) if re.search(r"\bExchange hashpartitioning", line)]
        assert all(i < shuffles[0] for i, line in enumerate(lines) if "md5(" in line)
        numbered = next(i for i, line in enumerate(lines) if re.search(r"\bWindow\b", line))
        assert not any("titre#" in line for line in lines[:numbered])


def test_ids_are_those_of_the_source_rows(spark):
    """Ids name source, kind, source id and a number among rows that share these, in the order of date, price, title and client."""
    film = spark.createDataFrame([(1, "MS", "7", "Up"), (2, "MS", "8", "Alien"), (3, "BB", "b", None)], "film_id bigint, source string, source_id string, titre string")
    sale = "source_id bigint, date_vente date, prix_vente decimal(10,2), client_id bigint"
    day = lambda rows, schema: spark.createDataFrame(rows, schema.replace("date_vente date", "date_vente string")).withColumn("date_vente", F.to_date("date_vente"))
    s = {
        "int_film": film,
        "film_xref": spark.createDataFrame([("MS", 70, 1), ("MS", 80, 2), ("BB", 90, 3)], "source string, source_film_id bigint, film_id bigint"),
        "int_produit": spark.createDataFrame([(11, "Up", "film", 3), (12, "Alien", "film", 3), (13, "Up", "film", 2), (14, "Mug", "gadget", 1)],
                                             "produit_id bigint, titre string, type string, magasin_id int"),
        "int_client": spark.createDataFrame([(100, "MMM", 5), (101, "MS", 5)], "client_id bigint, source string, source_client_id bigint"),
        "bb_vente_film": day([(1, "1996-01-01", None, None, 90), (None, None, None, None, None)], f"{sale}, film_id bigint"),
        "bb_vente_gadget": day([(1, "1996-01-01", None, None, "Mug")], f"{sale}, titre string"),
        "ms_copie_vente": day([(1, "1996-01-01", None, 5, 70, 1)], f"{sale}, film_id bigint, est_neuf int"),
        "mmm_vente_film": day([(1, "1996-01-01", None, 5, 7), (1, "1996-01-01", None, 6, 8), (1, "1995-01-01", None, 6, 8), (2, None, None, 5, 99)],
                              f"{sale}, film_ref_id bigint"),
        "mmm_vente_gadget": day([], f"{sale}, titre_gadget string"),
    }
    md5 = lambda text: hashlib.md5(text.encode()).hexdigest()
    found = {r.vente_id: (r.client_id, r.produit_id, r.magasin_id) for r in layered.int_vente(s).collect()}
    assert found == {
        md5("BB|film|1|1"): (None, None, 1), md5("BB|film|-|1"): (None, None, 1), md5("BB|gadget|1|1"): (None, 14, 1), md5("MS|film|1|1"): (101, 13, 2),
        md5("MMM|film|1|1"): (None, 12, 3), md5("MMM|film|1|2"): (None, 12, 3), md5("MMM|film|1|3"): (100, 11, 3),
    }


def test_stored_tables_are_coded_for_their_ids(spark, database):
    place = spark.sql(f"DESCRIBE DATABASE {database}").where("info_name = 'Location'").collect()[0][1]
    ids = spark.range(20).select(F.md5(F.col("id").cast("string")).alias("vente_id"), (F.col("id") % 2).alias("annee"))
    tables.truncate_reload(ids, f"{database}.flat")
    tables.fact_partition_by_year(ids, f"{database}.fact")
    tables.upsert_table(f"{database}.fact", ids.limit(1), ["vente_id"], partition="annee")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(place).select("path").collect()
    assert len(files) >= 3 and all(r.path.endswith(".zstd.parquet") for r in files)
