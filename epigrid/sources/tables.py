"""Namespaces, declared tables and table writers."""

import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F


def use_namespace(spark: SparkSession, name: str) -> None:
    """Create the namespace if it is absent and make it current."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
    spark.catalog.setCurrentDatabase(name)


def create_table(spark: SparkSession, name: str, schema: str) -> DataFrame:
    """Drop and recreate an empty table with a declared schema."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet")
    return spark.table(name)


def duplicate_keys(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: its name and row count."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    result = counts[0]
    for part in counts[1:]:
        result = result.unionByName(part)
    return result


def write_table(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Replace a table with the result of a query; running it again gives the same table.

    The result is written beside the table and takes its place only when it is whole: a write that fails leaves the table as it
    was. The query may read the table that it replaces.
    """
    spark = df.sparkSession
    staged, old = (f"{name}__{state}_{uuid.uuid4().hex[:8]}" for state in ("staged", "old"))
    writer = df.write.format("parquet")
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    try:
        writer.saveAsTable(staged)
        replaced = spark.catalog.tableExists(name)
        if replaced:
            _rename(spark, name, old)
        try:
            _rename(spark, staged, name)
        except BaseException:
            if replaced:
                _rename(spark, old, name)
            raise
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        raise
    if replaced:
        spark.sql(f"DROP TABLE {old}")
    return spark.table(name)


def _rename(spark: SparkSession, name: str, new: str) -> None:
    """Rename a table with its files. A catalog that moves the folder but not what it knows of the partitions is told where they are; a
    partition costs one entry in the catalog."""
    spark.sql(f"ALTER TABLE {name} RENAME TO {new}")
    columns = [c.name for c in spark.catalog.listColumns(new) if c.isPartition]
    if not columns:
        return
    location = spark.sql(f"DESCRIBE FORMATTED {new}").filter("col_name = 'Location'").first()["data_type"]
    for row in spark.sql(f"SHOW PARTITIONS {new}").collect():
        values = [part.split("=", 1)[1] for part in row["partition"].split("/")]
        spec = ", ".join(f"`{c}` = {_literal(unquote(v))}" for c, v in zip(columns, values))
        spark.sql(f"ALTER TABLE {new} PARTITION ({spec}) SET LOCATION {_literal(location + '/' + row['partition'])}")
    spark.catalog.refreshTable(new)


def _literal(text: str) -> str:
    if text == "__HIVE_DEFAULT_PARTITION__":
        return "NULL"
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def replace_partitions(df: DataFrame, name: str, partition_by: str) -> DataFrame:
    """Replace only those partitions of a table that the rows of `df` belong to; the files of all others stay as they are.

    Without such a table it is written whole. Partitions of which `df` has no row are not touched, so an emptied one has to be
    dropped by name.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        return write_table(df, name, partition_by)
    columns = spark.table(name).columns
    if sorted(columns) != sorted(df.columns):
        raise ValueError(f"{name} has the columns {columns}, the rows have {df.columns}")
    rows = df.select(*columns).repartition(partition_by)
    # the writer's own option does not reach an insert into a catalog table
    mode, before = "spark.sql.sources.partitionOverwriteMode", spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set(mode, "dynamic")
    try:
        rows.write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(mode, before)
    spark.catalog.refreshTable(name)
    return spark.table(name)
