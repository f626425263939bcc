"""Adapters that shape the given tables like the engine's inputs.

The texts use only SQL that Spark and DuckDB read alike. All fractions are dyadic, so sums are exact
and do not depend on row order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CITY_DAY_SQL = """
SELECT *, CASE WHEN AQI IS NULL THEN NULL WHEN AQI <= 50 THEN 'Good' WHEN AQI <= 100 THEN 'Satisfactory'
  WHEN AQI <= 200 THEN 'Moderate' WHEN AQI <= 300 THEN 'Poor' WHEN AQI <= 400 THEN 'Very Poor'
  ELSE 'Severe' END AS AQI_Bucket
FROM (
  SELECT City, Region, Date, k,
    CASE WHEN k%6=0 THEN NULL WHEN k%97=0 THEN CAST(-1 AS DOUBLE) ELSE CAST(q AS DOUBLE)/16 END AS PM25,
    CASE WHEN k%8<3 THEN NULL ELSE CAST(q AS DOUBLE)/8 END AS PM10,
    CASE WHEN k%8=3 THEN NULL ELSE CAST(t%500 AS DOUBLE)/8 END AS NO,
    CASE WHEN k%8=4 THEN NULL ELSE CAST(t%900 AS DOUBLE)/8 END AS NO2,
    CASE WHEN k%7=0 THEN NULL ELSE CAST(t%1100 AS DOUBLE)/8 END AS NOx,
    CASE WHEN k%3=0 THEN NULL ELSE CAST(t%2500 AS DOUBLE)/8 END AS NH3,
    CASE WHEN k%14=0 THEN NULL WHEN k%50=1 THEN CAST(t%3000 AS DOUBLE)/128 ELSE CAST(t%400 AS DOUBLE)/128 END AS CO,
    CASE WHEN k%8=5 THEN NULL ELSE CAST(t%700 AS DOUBLE)/8 END AS SO2,
    CASE WHEN k%8=6 THEN NULL ELSE CAST(t%1300 AS DOUBLE)/8 END AS O3,
    CASE WHEN k%5=0 THEN NULL ELSE CAST(t%160 AS DOUBLE)/16 END AS Benzene,
    CASE WHEN k%11<3 THEN NULL ELSE CAST(t%640 AS DOUBLE)/16 END AS Toluene,
    CASE WHEN k%18<11 THEN NULL ELSE CAST(t%96 AS DOUBLE)/16 END AS Xylene,
    CASE WHEN k%19<3 THEN NULL WHEN k%211=0 THEN CAST(0 AS DOUBLE) WHEN k%223=0 THEN CAST(1500 AS DOUBLE)
         ELSE CAST(floor(CAST(q AS DOUBLE)/11) AS DOUBLE)+(k%23)+5 END AS AQI
  FROM (
    SELECT n_name AS City, r_name AS Region, CAST(o_orderdate AS DATE) AS Date, o_orderkey AS k,
           CAST(round(o_totalprice*100) AS BIGINT) AS t,
           (CAST(round(o_totalprice*100) AS BIGINT) % 61) * (o_orderkey % 71) AS q
    FROM {orders} JOIN {customer} ON o_custkey = c_custkey
    JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey))
"""

HOURLY_SQL = """
SELECT concat('S', CAST(user_id % 8 AS VARCHAR(4))) AS station, date_trunc('hour', ts) AS time,
  max(CASE WHEN event_id%10=0 THEN NULL ELSE CAST(floor(value*8) AS DOUBLE)/8 END)  AS pm2_5,
  max(CASE WHEN event_id%9=1  THEN NULL ELSE CAST(floor(value*16) AS DOUBLE)/8 END) AS pm10,
  max(CASE WHEN event_id%8=2  THEN NULL ELSE CAST(floor(value*4) AS DOUBLE)/8 END)  AS nitrogen_dioxide,
  max(CASE WHEN event_id%7=3  THEN NULL ELSE CAST(floor(value*2) AS DOUBLE)/8 END)  AS sulphur_dioxide,
  max(CASE WHEN event_id%6=4  THEN NULL ELSE CAST(floor(value*25) AS DOUBLE) END)   AS carbon_monoxide,
  max(CASE WHEN event_id%5=0  THEN NULL ELSE CAST(floor(value*8) AS DOUBLE)/8 END)  AS ozone
FROM {events} GROUP BY 1, 2
"""

# One reading per event, before any grouping; the stream groups these itself.
READINGS_SQL = """
SELECT concat('S', CAST(user_id % 8 AS VARCHAR(4))) AS station, CAST(ts AS TIMESTAMP) AS ts,
  CASE WHEN event_id%10=0 THEN NULL ELSE CAST(floor(value*8) AS DOUBLE)/8 END  AS pm2_5,
  CASE WHEN event_id%9=1  THEN NULL ELSE CAST(floor(value*16) AS DOUBLE)/8 END AS pm10,
  CASE WHEN event_id%8=2  THEN NULL ELSE CAST(floor(value*4) AS DOUBLE)/8 END  AS nitrogen_dioxide,
  CASE WHEN event_id%7=3  THEN NULL ELSE CAST(floor(value*2) AS DOUBLE)/8 END  AS sulphur_dioxide,
  CASE WHEN event_id%6=4  THEN NULL ELSE CAST(floor(value*25) AS DOUBLE) END   AS carbon_monoxide,
  CASE WHEN event_id%5=0  THEN NULL ELSE CAST(floor(value*8) AS DOUBLE)/8 END  AS ozone
FROM {events}
"""

# Stand-ins for the parameters of the published study; the tables span 1995-01-01 to 2001-08-01.
TIE_BREAK = ["k"]
N_YEARS = 7
METROS = [f"NATION_{i}" for i in range(8)]
DIAGNOSED = [f"NATION_{i}" for i in range(3)]
BASE_PERIOD = ("1999-03-25", "1999-05-31")
EVENT_PERIOD = ("2000-03-25", "2000-05-31")
DAY = "1999-04-10"
MONTH = (1999, 4)
CITY, YEAR = "NATION_3", 1998
AS_OF = "2024-01-20 12:00:00"
LATE_TYPE = "error"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _query(spark: SparkSession, sf_dir: str, text: str, *names: str) -> DataFrame:
    return spark.sql(text, **{n: table(spark, sf_dir, n) for n in names})


def city_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw daily panel, with copies, and with the order key `k` that tells them apart."""
    return _query(spark, sf_dir, CITY_DAY_SQL, "orders", "customer", "nation", "region").drop("Region")


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per station and hour that has a reading."""
    return _query(spark, sf_dir, HOURLY_SQL, "events")


def readings(events: DataFrame) -> DataFrame:
    """One row per reading, from the events table or a stream of it."""
    return events.sparkSession.sql(READINGS_SQL, events=events)


def city_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _query(spark, sf_dir, "SELECT r_name AS Region, n_name AS City "
                                 "FROM {nation} JOIN {region} ON n_regionkey = r_regionkey", "nation", "region")


def city_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of the cities; one region is left out, so some cities are unknown."""
    return _query(spark, sf_dir, "SELECT n_name AS City, concat('STATE_', CAST(n_regionkey AS VARCHAR(4))) AS State "
                                 "FROM {nation} WHERE n_regionkey <> 4", "nation")
