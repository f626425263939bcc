"""Readers of the daily and hourly inputs; a path may be any URI that Hadoop knows, local or not."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from aeropanel.schema import CITY_DAY, HOURLY_PAYLOAD, column_name, display_name


def normalize_columns(df: DataFrame) -> DataFrame:
    """File names of columns -> engine names, without the dot."""
    return df.withColumnsRenamed({c: column_name(c) for c in df.columns if column_name(c) != c})


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN would fall into the open top band and win every maximum, so it counts as missing."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nanvl(c, F.lit(None)) for c in numeric}) if numeric else df


def read_city_day(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """Daily CSV with a header.

    The schema is fixed, which saves a pass over the file; the columns must come in that order. `infer`
    looks at the data instead and takes the columns as they are.
    """
    reader = spark.read.option("header", True)
    if infer:
        return nan_to_null(normalize_columns(reader.option("inferSchema", True).csv(path)))
    in_file = T.StructType([T.StructField(display_name(f.name), f.dataType) for f in CITY_DAY.fields])
    return nan_to_null(normalize_columns(reader.schema(in_file).option("enforceSchema", False).csv(path)))


def storage_of(path: str) -> str:
    """What kind of place a path names, by its scheme."""
    scheme, found, _ = path.partition("://")
    return {"hdfs": "HDFS", "file": "local file"}.get(scheme, scheme) if found else "local file"


def default_output(path: str) -> str:
    """Results go next to the input, on the same file system."""
    folder, found, _ = path.rstrip("/").rpartition("/")
    return f"{folder}/output" if found else "output"


def read_hourly_payloads(spark: SparkSession, path: str) -> DataFrame:
    """JSON objects of parallel hourly arrays, one object per line; see `flatten_hourly`."""
    return spark.read.schema(HOURLY_PAYLOAD).json(path)


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_city(spark: SparkSession, path: str, city: str) -> DataFrame:
    """One city of a panel written by `write_daily`; only the files of that city are read."""
    return read_daily(spark, path).filter(F.col("City") == city)


def read_city_days(spark: SparkSession, path: str, city: str, first: str, last: str | None = None) -> DataFrame:
    """Days of one city of a panel written by `write_daily`: its folder only, and there the row groups that can hold the days."""
    days = F.col("Date").between(F.lit(first).cast("date"), F.lit(last or first).cast("date"))
    return read_city(spark, path, city).filter(days)


def register(df: DataFrame, name: str) -> DataFrame:
    """Makes the frame a view for SQL, e.g. `aqi` for the cleaned and `daily` for the indexed panel."""
    df.createOrReplaceTempView(name)
    return df


@contextmanager
def persisted(df: DataFrame) -> Iterator[DataFrame]:
    """Keeps a reused frame in memory, on disk where it does not fit, and releases it at the end."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
