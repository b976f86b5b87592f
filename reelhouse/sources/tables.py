"""Ingest, table writes and their lifecycle."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from reelhouse.operators.dedup import upsert_by_key
from reelhouse.operators.quality import metrics_of
from reelhouse.operators.shape import coerce_decimals
from reelhouse.sources.shared import shared_folder


def new_name() -> str:
    """A name no other run takes."""
    return uuid.uuid4().hex[:12]


def new_database(spark: SparkSession, name: str = "reelhouse") -> str:
    """Create an empty database under the shared folder and return its name."""
    database = f"{name}_{new_name()}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{shared_folder(spark)}/{database}'")
    return database


def is_loaded(spark: SparkSession, table: str) -> bool:
    """True when the table exists and holds a row; a missing table counts as empty."""
    return spark.catalog.tableExists(table) and not spark.table(table).isEmpty()


def skip_if_loaded(df: DataFrame, table: str) -> bool:
    """Write ``df`` unless the table already has rows; True when it was skipped."""
    if is_loaded(df.sparkSession, table):
        return True
    truncate_reload(df, table)
    return False


def raw_ingest(bundles: dict[str, dict[str, DataFrame]], spark: SparkSession, database: str) -> DataFrame:
    """Store every table of each source bundle as ``{prefix}_{table}`` and report its row count.

    Bundles map a prefix to {table: frame}; frames come from ``read_bundle`` or any reader.
    Tables already loaded are kept. Decimals become doubles on the way in.
    """
    counts = None
    for prefix, tables in bundles.items():
        for name, df in tables.items():
            target = f"{database}.{prefix}_{name}"
            skip_if_loaded(coerce_decimals(df), target)
            row = spark.table(target).agg(F.count(F.lit(1)).alias("n_rows"))
            row = row.select(F.lit(f"{prefix}_{name}").alias("table"), "n_rows")
            counts = row if counts is None else counts.unionAll(row)
    return counts


def read_bundle(spark: SparkSession, folder: str, schemas: dict[str, str], file_format: str = "parquet", **options) -> dict[str, DataFrame]:
    """Frames of the exported tables of one source, one file or folder per table, schemas stated."""
    suffix = f".{file_format}"
    return {
        name: spark.read.format(file_format).schema(schema).options(**options).load(f"{folder}/{name}{suffix}")
        for name, schema in schemas.items()
    }


def read_jdbc_bundle(spark: SparkSession, url: str, tables: dict[str, dict[str, str]], **options) -> dict[str, DataFrame]:
    """Frames of database tables; per table the partition options that split its read."""
    return {
        name: spark.read.format("jdbc").options(url=url, dbtable=name, **options, **split).load()
        for name, split in tables.items()
    }


# Ids of facts are texts of hexadecimal digits, which only an entropy coder shortens; later writes to a table keep its codec.
CODEC = "zstd"


def truncate_reload(df: DataFrame, table: str) -> None:
    """Replace the whole content of a table."""
    df.write.mode("overwrite").option("compression", CODEC).saveAsTable(table)


def append_rows(df: DataFrame, table: str, mapping: dict[str, str]) -> None:
    """Append rows given as {table column: field of df}; other table columns become NULL."""
    target = df.sparkSession.table(table).schema
    df.select([
        (F.col(mapping[f.name]) if f.name in mapping else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in target.fields
    ]).write.insertInto(table)


def fact_partition_by_year(df: DataFrame, table: str, year: str = "annee") -> None:
    """Store a fact in one folder per year.

    The rebalance hint gathers a year's rows into few files and splits a year that is much
    larger than the others over several tasks. The table is set up so that ``overwrite_partitions`` replaces only the years it is given.
    """
    balanced = df.hint("rebalance", year)
    writer = balanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", CODEC)
    writer.partitionBy(year).saveAsTable(table)


def overwrite_partitions(df: DataFrame, table: str, partition: str, touched: list) -> None:
    """Replace the ``touched`` partitions of a table by the rows of ``df``, which holds rows of those alone, in one committed job.

    ``df`` may read the table: new files are written beside the old ones and take their place when the job commits, so a
    failure before that leaves the table as it was. A touched partition without rows is dropped after the commit.
    """
    spark = df.sparkSession
    seen, columns = Observation(), spark.table(table).columns
    filled = [F.count_if(F.col(partition) == value).alias(f"p{i}") for i, value in enumerate(touched)]
    df.observe(seen, *filled).hint("rebalance", partition).select(*columns).write.mode("overwrite").insertInto(table)
    rows = metrics_of(seen, [f"p{i}" for i in range(len(filled))])
    for i, value in enumerate(touched):
        if not rows[f"p{i}"]:
            shown = f"'{value}'" if isinstance(value, str) else value
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({partition} = {shown})")
    spark.catalog.refreshTable(table)


def replace_table(df: DataFrame, table: str) -> None:
    """Replace an unpartitioned table by rows derived from it: they are written beside it, then the table is pointed there.

    That is one change of the catalogue, so the table is whole at any time; the old files stay for those who still read them.
    """
    spark = df.sparkSession
    place = f"{shared_folder(spark)}/{table.split('.')[-1]}-{new_name()}"
    df.write.parquet(place)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{place}'")
    spark.catalog.refreshTable(table)


def _partitions_of(rows: DataFrame, partition: str) -> list:
    """Partition values of some rows. Their number is that of the years, which is why they may pass through the driver."""
    return [row[0] for row in rows.select(partition).distinct().collect()]


def upsert_table(
    table: str, updates: DataFrame, keys: list[str], update_cols: list[str] | None = None, partition: str | None = None,
) -> None:
    """Insert or update rows of a stored table by key.

    With a ``partition`` column, as in facts stored by year, only the partitions that hold an updated row before or after the change
    are read for the merge and rewritten, all in one job. Should the driver be lost between that job and the dropping of
    a partition that lost all its rows, the same call sets it right.
    """
    spark = updates.sparkSession
    target = spark.table(table)
    if partition is None:
        replace_table(upsert_by_key(target, updates, keys, update_cols), table)
        return
    held = target.join(updates.select(*keys), keys, "left_semi").select(partition)
    touched = _partitions_of(held.unionByName(updates.select(partition)), partition)
    if touched:
        overwrite_partitions(upsert_by_key(target.where(F.col(partition).isin(touched)), updates, keys, update_cols), table, partition, touched)


def delete_rows(table: str, gone: DataFrame, keys: list[str], partition: str) -> None:
    """Remove the rows of a partitioned table whose key is in ``gone``; only partitions that hold one are rewritten."""
    target = gone.sparkSession.table(table)
    held = target.join(gone.select(*keys), keys, "left_semi")
    touched = _partitions_of(held, partition)
    if touched:
        rest = target.where(F.col(partition).isin(touched)).join(gone.select(*keys), keys, "left_anti")
        overwrite_partitions(rest, table, partition, touched)


_ENTRY = "path string, length bigint, modified timestamp, lot string, taken timestamp"


def ingested_files(spark: SparkSession, table: str) -> DataFrame:
    """The ledger of an ingested table: the last taken version of every file."""
    entries = spark.table(f"{table}_ledger")
    last = entries.groupBy("path").agg(F.max_by(F.struct(*[c for c in entries.columns if c != "path"]), "taken").alias("last"))
    return last.select("path", "last.*")


def _file_name(path: Column) -> Column:
    """One spelling of a file's address, however many slashes follow its scheme."""
    return F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/")


def ingest_new_files(spark: SparkSession, folder: str, table: str, schema: str, file_format: str = "parquet", **options) -> DataFrame:
    """Take the files below ``folder`` that the table's ledger doesn't list with their length and modification time; returns their entries.

    Each call's rows are one partition (``lot``) of the table, with the file they came from in ``source_file``. A file that changed is taken again
    and the rows of its earlier version are removed. The ledger is written last: a lot that no entry names, left by a run
    that failed, is dropped by the next call, which takes its files again. Decimals become doubles. Only the
    listing of new files passes through the driver, as it does in any read.
    """
    ledger = f"{table}_ledger"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {ledger} ({_ENTRY}) USING parquet")
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    here = listing.select(_file_name(F.col("path")).alias("path"), "length", F.col("modificationTime").alias("modified"), F.col("path").alias("address"))
    known = ingested_files(spark, table)
    new = here.join(known.select("path", "length", "modified"), ["path", "length", "modified"], "left_anti").collect()
    exists = spark.catalog.tableExists(table)
    if exists:
        named = {row[0] for row in known.select("lot").distinct().collect()}
        for (part,) in spark.sql(f"SHOW PARTITIONS {table}").collect():
            lot = part.removeprefix("lot=")
            if lot not in named:
                spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (lot = '{lot}')")
    lot = new_name()
    entries = spark.createDataFrame([(f.path, f.length, f.modified, lot) for f in new], ", ".join(_ENTRY.split(", ")[:4])).withColumn("taken", F.current_timestamp())
    if not new:
        return entries
    if exists:
        changed = known.join(entries.select("path"), "path", "left_semi").select("path", "lot")
        lots = _partitions_of(changed, "lot")
        if lots:
            held = spark.table(table).where(F.col("lot").isin(lots))
            overwrite_partitions(held.join(changed.select(F.col("path").alias("source_file"), "lot"), ["source_file", "lot"], "left_anti"), table, "lot", lots)
    read = spark.read.format(file_format).schema(schema).options(**options).load([f.address for f in new])
    rows = coerce_decimals(read.select("*", _file_name(F.col("_metadata.file_path")).alias("source_file"))).withColumn("lot", F.lit(lot))
    rows.write.mode("append").option("partitionOverwriteMode", "dynamic").partitionBy("lot").saveAsTable(table)
    entries.write.insertInto(ledger)
    return entries


def reporting_views(frames: dict[str, DataFrame]) -> None:
    """Expose the star model's frames to SQL under their names."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def mapped(columns: dict[str, Column], df: DataFrame) -> DataFrame:
    """Select named expressions."""
    return df.select([expr.alias(name) for name, expr in columns.items()])
