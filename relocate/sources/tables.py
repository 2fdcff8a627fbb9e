"""Table source and sink: Parquet folders and JDBC relations."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def zoned(df: DataFrame) -> DataFrame:
    """Give zoneless timestamps the session zone (UTC); watermarks refuse zoneless ones."""
    for field in df.schema.fields:
        if isinstance(field.dataType, T.TimestampNTZType):
            df = df.withColumn(field.name, F.col(field.name).cast("timestamp"))
    return df


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def jdbc_options(
    url: str,
    table: str,
    *,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    split_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
    timeout_seconds: int = 0,
) -> dict[str, str]:
    """Options of a JDBC read; a split column makes it a parallel range read.

    Credentials are options of their own and never parsed out of a URL.
    """
    options = {
        "url": url,
        "dbtable": table,
        "fetchsize": str(fetch_size),
        "queryTimeout": str(timeout_seconds),
    }
    for name, value in (("user", user), ("password", password), ("driver", driver)):
        if value is not None:
            options[name] = value
    if split_column is not None:
        if lower is None or upper is None:
            raise ValueError("a split column needs lower and upper bounds")
        options.update(
            partitionColumn=split_column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(partitions),
        )
    return options


def read_jdbc(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def jdbc_bounds(
    spark: SparkSession, options: Mapping[str, str], split_column: str
) -> tuple[int, int] | None:
    """Smallest and largest value of a split column, asked of the database; none when empty."""
    rest = {k: v for k, v in options.items() if k != "dbtable"}
    ask = f"SELECT min({split_column}) AS lo, max({split_column}) AS hi FROM {options['dbtable']}"
    row = spark.read.format("jdbc").options(**rest).option("query", ask).load().first()
    return None if row[0] is None else (int(row[0]), int(row[1]))


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def write_jdbc(
    df: DataFrame, options: Mapping[str, str], mode: str = "append", batch_size: int = 10_000
) -> None:
    """Bulk load; the first failing row fails the job."""
    df.write.format("jdbc").options(**options).option("batchsize", batch_size).mode(mode).save()


def require_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Fail on drift: names and types must be the frozen ones, in any order."""

    def shape(schema: T.StructType) -> dict[str, str]:
        return {f.name: f.dataType.simpleString() for f in schema.fields}

    if shape(df.schema) != shape(expected):
        raise ValueError(
            f"schema drift: expected {expected.simpleString()}, found {df.schema.simpleString()}"
        )
    return df.select(*expected.fieldNames())
