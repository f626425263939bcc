"""Schemas, column lists and fixed values shared by all operators."""

from __future__ import annotations

from pyspark.sql import types as T

# Names, units, breakpoints, bands, limits and advice texts of the
# public index method and of the input files.
POLLUTANTS = ["PM25", "PM10", "NO", "NO2", "NOx", "NH3", "CO", "SO2", "O3", "Benzene", "Toluene", "Xylene"]
INDEX_POLLUTANTS = ["PM25", "PM10", "NO2", "SO2", "CO", "O3", "NH3"]
PROFILE_POLLUTANTS = ["PM25", "PM10", "NO2", "SO2", "CO", "O3"]

INDEX_EDGES = [0, 50, 100, 200, 300, 400, 500]
CONCENTRATION_EDGES = {
    "PM25": [0, 30, 60, 90, 120, 250, 380],
    "PM10": [0, 50, 100, 250, 350, 430, 510],
    "NO2": [0, 40, 80, 180, 280, 400, 520],
    "SO2": [0, 40, 80, 380, 800, 1600, 2400],
    "CO": [0, 1, 2, 10, 17, 34, 51],
    "O3": [0, 50, 100, 168, 208, 748, 1288],
    "NH3": [0, 200, 400, 800, 1200, 1800, 2400],
}

# (order, name, highest index value or None for the open band, advice)
CATEGORIES = [
    (1, "Good", 50.0, "Minimal health impact. A good day for outdoor activity."),
    (2, "Satisfactory", 100.0, "Minor breathing discomfort for sensitive people, such as those with asthma."),
    (3, "Moderate", 200.0, "Breathing discomfort for people with lung disease such as asthma, and discomfort for "
                           "people with heart disease, children and older adults."),
    (4, "Poor", 300.0, "Breathing discomfort for most people on prolonged exposure. Limit long outdoor exertion."),
    (5, "Very Poor", 400.0, "Respiratory illness on prolonged exposure. Avoid outdoor exercise; consider masks and "
                            "air purifiers."),
    (6, "Severe", None, "Affects healthy people and seriously impacts those with existing diseases. Stay indoors "
                        "where possible."),
]
CATEGORY_NAMES = [name for _, name, _, _ in CATEGORIES]
POOR_OR_WORSE = ["Poor", "Very Poor", "Severe"]
NO_INDEX = "No AQI"

# (pollutant, limit, unit)
LIMITS = [
    ("PM2.5", 60.0, "µg/m³"),
    ("PM10", 100.0, "µg/m³"),
    ("NO2", 80.0, "µg/m³"),
    ("SO2", 80.0, "µg/m³"),
    ("CO", 2.0, "mg/m³"),
    ("O3", 100.0, "µg/m³"),
]

SEASONS = ["Winter", "Summer", "Monsoon", "Post-Monsoon"]
SEASON_MONTHS = {"Winter": [12, 1, 2], "Summer": [3, 4, 5], "Monsoon": [6, 7, 8, 9]}
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]

# Validity of an index value, and coverage of the rolling means.
MIN_POLLUTANTS = 3
DAY_HOURS, DAY_MIN_READINGS = 24, 16
SHORT_HOURS, SHORT_MIN_READINGS = 8, 6
MAX_TARGET = 1000
# End of fixed values.

CITY_DAY = T.StructType(
    [T.StructField("City", T.StringType()), T.StructField("Date", T.DateType())]
    + [T.StructField(p, T.DoubleType()) for p in POLLUTANTS + ["AQI"]]
    + [T.StructField("AQI_Bucket", T.StringType())]
)

# field of the hourly feed -> column of the daily panel
HOURLY_FIELDS = {
    "pm2_5": "PM25",
    "pm10": "PM10",
    "nitrogen_dioxide": "NO2",
    "sulphur_dioxide": "SO2",
    "carbon_monoxide": "CO",
    "ozone": "O3",
}

HOURLY = T.StructType(
    [T.StructField("station", T.StringType()), T.StructField("time", T.TimestampType())]
    + [T.StructField(f, T.DoubleType()) for f in HOURLY_FIELDS]
)

HOURLY_PAYLOAD = T.StructType([
    T.StructField("city", T.StringType()),
    T.StructField("hourly", T.StructType(
        [T.StructField("time", T.ArrayType(T.StringType()))]
        + [T.StructField(f, T.ArrayType(T.DoubleType())) for f in HOURLY_FIELDS])),
])

DAILY_OUTPUT = ["City", "Date", *INDEX_POLLUTANTS, "AQI", "AQI_calc", "Bucket_calc", "Dominant"]


def display_name(pollutant: str) -> str:
    """Column name -> printed name; the dot is avoided in column names only."""
    return "PM2.5" if pollutant == "PM25" else pollutant


def column_name(pollutant: str) -> str:
    return "PM25" if pollutant == "PM2.5" else pollutant
