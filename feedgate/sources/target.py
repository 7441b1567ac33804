"""The target table: parquet folder, catalog table bucketed by key, or a database table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from feedgate.contract import TableContract


def ensure_target(spark: SparkSession, path: str, contract: TableContract) -> None:
    """Create an empty parquet target unless there is one."""
    try:
        spark.read.schema(contract.target_schema).parquet(path).schema
    except Exception as problem:
        if "PATH_NOT_FOUND" not in str(problem):
            raise
        empty = spark.createDataFrame([], contract.target_schema)
        empty.write.mode("ignore").parquet(path)


def read_target(spark: SparkSession, path: str, contract: TableContract) -> DataFrame:
    return spark.read.schema(contract.target_schema).parquet(path)


def read_files(spark: SparkSession, files: list[str], contract: TableContract) -> DataFrame:
    """Some files of a parquet target."""
    if not files:
        return spark.createDataFrame([], contract.target_schema)
    return spark.read.schema(contract.target_schema).parquet(*files)


def ensure_target_table(
    spark: SparkSession,
    table: str,
    contract: TableContract,
    buckets: int,
    location: str | None = None,
) -> None:
    """Create a catalog table bucketed by key, so loads never shuffle what is stored.

    Size ``buckets`` so that the key column of one bucket fits a task: rows / 10 million.
    """
    place = f" LOCATION '{location}'" if location else ""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in contract.target_schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
        f"CLUSTERED BY (`{contract.key}`) SORTED BY (`{contract.key}`) INTO {buckets} BUCKETS{place}"
    )


def read_database_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    partition_column: str | None = None,
    bounds: tuple | None = None,
    partitions: int = 1,
) -> DataFrame:
    """A database table over JDBC; a numeric, date or time column splits it into parallel reads."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **properties)
    if partition_column:
        low, high = bounds
        reader = reader.options(
            partitionColumn=partition_column,
            lowerBound=low,
            upperBound=high,
            numPartitions=partitions,
        )
    return reader.load()


def to_database_types(rows: DataFrame, contract: TableContract) -> DataFrame:
    """Target rows in the order and types of the insert list."""
    return rows.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in contract.target_schema]
    )


def append_to_database(
    rows: DataFrame, url: str, table: str, properties: dict[str, str], batch: int = 10_000
) -> None:
    """A plain append over JDBC: it fails on a repeated key, which is not insert-if-absent.

    Give it the rows of ``load.rows_to_insert``; the database's key guards against a second writer.
    """
    (
        rows.write.format("jdbc")
        .options(url=url, dbtable=table, batchsize=batch, **properties)
        .mode("append")
        .save()
    )
