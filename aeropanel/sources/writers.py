"""Writers of panels, exports and result documents; every one writes folders, in parallel."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeropanel.functions.columns import round_rows
from aeropanel.operators.daily_index import daily_output
from aeropanel.schema import DAILY_OUTPUT, INDEX_POLLUTANTS, display_name


def write_clean(clean: DataFrame, path: str) -> None:
    clean.write.mode("overwrite").parquet(path)


def write_daily(daily: DataFrame, path: str, row_group_bytes: int | None = None) -> None:
    """Indexed panel, one folder per city, files sorted by date.

    Rebalancing brings a city's rows together, so tasks open few files, and splits a city that holds more than
    the advisory partition size over several tasks. As files are sorted, the row groups of a file hold dates that do not
    overlap, and `readers.read_city_days` reads only those that a date can be in; `row_group_bytes` makes them smaller.
    """
    out = daily.select(*DAILY_OUTPUT).hint("rebalance", "City")
    writer = out.sortWithinPartitions("City", "Date").write.mode("overwrite").partitionBy("City")
    if row_group_bytes:
        # a row group is closed once it is that large, which is looked at every so many rows
        writer = writer.option("parquet.block.size", row_group_bytes).option("parquet.page.size.row.check.min", 100)
    writer.parquet(path)


def daily_export(daily: DataFrame) -> DataFrame:
    """Columns and order of the daily CSV."""
    return daily_output(daily).withColumnsRenamed({"AQI": "AQI_recorded", "PM25": "PM2.5"})


def export_daily_csv(daily: DataFrame, path: str) -> None:
    """Daily CSV, sorted by city and date over all its part files."""
    daily_export(daily).write.mode("overwrite").option("header", True).csv(path)


def city_documents(daily: DataFrame) -> DataFrame:
    """City, days: one entry per day in date order - date, seven readings, recorded and calculated index.

    The panel holds one row per city and day, so an array is at most as long as the calendar.
    """
    entry = F.struct(
        F.date_format("Date", "yyyy-MM-dd").alias("date"),
        *(round_rows(p, 2).alias(display_name(p).replace(".", "")) for p in INDEX_POLLUTANTS),
        round_rows("AQI", 0).alias("recorded"), round_rows("AQI_calc", 0).alias("calculated"))
    return daily.groupBy("City").agg(F.sort_array(F.collect_list(entry)).alias("days"))


def document_days(documents: DataFrame) -> DataFrame:
    """City documents -> one row per day again."""
    return documents.select("City", F.inline("days"))


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object per line; missing values are written as null."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_results(results: Mapping[str, DataFrame], path: str, at_once: int = 4) -> None:
    """One JSON folder per named result below `path`.

    The results do not depend on each other, so `at_once` of them are written at the same time: one's last tasks
    leave cores that the next can use.
    """
    with ThreadPoolExecutor(at_once) as pool:
        for done in [pool.submit(write_json, df, f"{path}/{name}") for name, df in results.items()]:
            done.result()
