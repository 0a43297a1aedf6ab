"""Batch readers for files, tables, indexes and databases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.names import file_name, parent_folder
from ..storage import child_folders


def read_source(
    spark: SparkSession,
    fmt: str,
    path: str | None = None,
    schema: T.StructType | None = None,
    **options: str,
) -> DataFrame:
    """Any registered format with its options; the connector is a matter of the deployment."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def read_nosql_table(
    spark: SparkSession,
    table: str,
    keyspace: str,
    fmt: str = "org.apache.spark.sql.cassandra",
    **options: str,
) -> DataFrame:
    """Wide-column table; consistency levels and endpoints come as connector options."""
    return read_source(spark, fmt, table=table, keyspace=keyspace, **options)


def read_search_index(
    spark: SparkSession, index: str, nodes: str, fmt: str = "es", **options: str
) -> DataFrame:
    """Search index, read shard by shard."""
    return read_source(spark, fmt, index, **{"es.nodes": nodes, **options})


def jdbc_options(
    url: str,
    table: str,
    driver: str,
    user: str | None = None,
    password: str | None = None,
    split: tuple[str, int, int, int] | None = None,
) -> dict[str, str]:
    """Options of a database read.

    ``split`` is ``(column, lowest, highest, parts)``: without it one task reads the table, with
    it each part is a range of the column. Bounds only place the ranges, no row is lost.
    """
    options = {"url": url, "dbtable": table, "driver": driver}
    if user is not None:
        options["user"] = user
    if password is not None:
        options["password"] = password
    if split is not None:
        column, low, high, parts = split
        options |= {
            "partitionColumn": column,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(parts),
        }
    return options


def read_jdbc(spark: SparkSession, **kwargs) -> DataFrame:
    return read_source(spark, "jdbc", **jdbc_options(**kwargs))


def read_json(
    spark: SparkSession, path: str | list[str], schema: T.StructType | None = None
) -> DataFrame:
    """JSON lines. Without a schema Spark infers one, which reads the data a second time."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_days(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    date_from: str | None = None,
    date_to: str | None = None,
) -> DataFrame:
    """JSON tree partitioned by ``$date``, days as ``yyyyMMdd``; only days in range are listed."""
    layout = T.StructType(schema.fields + [T.StructField("$date", T.StringType())])
    rows = spark.read.schema(layout).json(path)
    if date_from is not None:
        rows = rows.filter(F.col("$date") >= date_from)
    if date_to is not None:
        rows = rows.filter(F.col("$date") <= date_to)
    return rows.select(*schema.fieldNames())


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header line; without a schema all columns are text."""
    reader = spark.read.option("header", True)
    return (reader if schema is None else reader.schema(schema)).csv(path)


def file_manifest(
    spark: SparkSession, root: str, pattern: str = "*.jpg", keep: tuple[str, ...] = ()
) -> DataFrame:
    """``(path, file, label, length, *keep)`` of all matching files below ``root``.

    ``keep`` may name ``modificationTime``. The label is the name of the folder a file lies in. File contents are not read.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(root)
        .select(
            "path",
            file_name("path").alias("file"),
            parent_folder("path").alias("label"),
            "length",
            *keep,
        )
    )


def parse_json_column(
    rows: DataFrame, column: str, schema: T.StructType, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Fields of a JSON text (or binary) column as columns; broken text gives nulls."""
    parsed = F.from_json(F.col(column).cast("string"), schema).alias("_parsed")
    return rows.select(*keep, parsed).select(*keep, "_parsed.*")


def snapshot_before(spark: SparkSession, root: str, date: str) -> str | None:
    """Path of the newest ``yyyyMMdd`` snapshot below ``root`` older than ``date``, if any."""
    days = [d for d in child_folders(spark, root) if len(d) == 8 and d.isdigit() and d < date]
    return f"{root.rstrip('/')}/{days[-1]}" if days else None
