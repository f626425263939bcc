"""Small fixed tables: bands, breakpoints, limits, states and regions.

They are built as local relations, so Spark knows their size and broadcasts them by its own rule.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from aeropanel.schema import CATEGORIES, CONCENTRATION_EDGES, INDEX_EDGES, LIMITS, POLLUTANTS

# State and region of each monitored city.
CITY_STATE = {
    "Ahmedabad": "Gujarat", "Aizawl": "Mizoram", "Amaravati": "Andhra Pradesh", "Amritsar": "Punjab",
    "Bengaluru": "Karnataka", "Bhopal": "Madhya Pradesh", "Brajrajnagar": "Odisha",
    "Chandigarh": "Chandigarh (UT)", "Chennai": "Tamil Nadu", "Coimbatore": "Tamil Nadu",
    "Delhi": "Delhi (NCT)", "Ernakulam": "Kerala", "Gurugram": "Haryana", "Guwahati": "Assam",
    "Hyderabad": "Telangana", "Jaipur": "Rajasthan", "Jorapokhar": "Jharkhand", "Kochi": "Kerala",
    "Kolkata": "West Bengal", "Lucknow": "Uttar Pradesh", "Mumbai": "Maharashtra", "Patna": "Bihar",
    "Shillong": "Meghalaya", "Talcher": "Odisha", "Thiruvananthapuram": "Kerala",
    "Visakhapatnam": "Andhra Pradesh",
}
REGION_CITIES = {
    "North": ["Delhi", "Gurugram", "Lucknow", "Amritsar", "Chandigarh", "Jaipur"],
    "East": ["Kolkata", "Patna", "Brajrajnagar", "Talcher", "Jorapokhar"],
    "North-east": ["Guwahati", "Shillong", "Aizawl"],
    "West": ["Mumbai", "Ahmedabad", "Bhopal"],
    "South": ["Chennai", "Bengaluru", "Hyderabad", "Coimbatore", "Kochi", "Ernakulam",
              "Thiruvananthapuram", "Visakhapatnam", "Amaravati"],
}
METROS = ["Delhi", "Mumbai", "Kolkata", "Chennai", "Bengaluru", "Hyderabad", "Ahmedabad", "Lucknow"]
DIAGNOSED = ["Ahmedabad", "Delhi", "Mumbai"]
BASE_PERIOD = ("2019-03-25", "2019-05-31")
EVENT_PERIOD = ("2020-03-25", "2020-05-31")
# The day the study predicts as an example, in the order of POLLUTANTS.
EXAMPLE_ROW = (180.0, 300.0, 20.0, 60.0, 50.0, 40.0, 1.5, 15.0, 40.0, 4.0, 15.0, 3.0)
# End of fixed values.


def literal_rows(spark: SparkSession, rows: Iterable[Sequence], schema: str | T.StructType) -> DataFrame:
    """DataFrame from literal rows, for dimensions and ad-hoc inputs."""
    struct = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    names = struct.fieldNames()
    records = [dict(zip(names, row, strict=True)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(records, schema=to_arrow_schema(struct)), schema=struct)


def ad_hoc_rows(spark: SparkSession, rows: Iterable[Sequence], cols: Sequence[str] = POLLUTANTS) -> DataFrame:
    """Concentration rows typed in by hand, e.g. to score or to compute an index for."""
    schema = T.StructType([T.StructField(c, T.DoubleType()) for c in cols])
    return literal_rows(spark, rows, schema)


def categories(spark: SparkSession) -> DataFrame:
    """Bands of the index -> ord, name, lo, hi, advice; lo is exclusive, hi inclusive or null."""
    below = [None] + [hi for _, _, hi, _ in CATEGORIES[:-1]]
    rows = [(ord_, name, lo, hi, advice) for lo, (ord_, name, hi, advice) in zip(below, CATEGORIES, strict=True)]
    return literal_rows(spark, rows, "ord int, name string, lo double, hi double, advice string")


def breakpoints(spark: SparkSession) -> DataFrame:
    """One row per pollutant and band -> pollutant, band, c_lo, c_hi, i_lo, i_hi."""
    rows = [
        (pollutant, band, *map(float, (edges[band - 1], edges[band], INDEX_EDGES[band - 1], INDEX_EDGES[band])))
        for pollutant, edges in CONCENTRATION_EDGES.items()
        for band in range(1, len(edges))
    ]
    return literal_rows(
        spark, rows, "pollutant string, band int, c_lo double, c_hi double, i_lo double, i_hi double")


def limits(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, LIMITS, "pollutant string, limit double, unit string")


def city_states(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, CITY_STATE.items(), "City string, State string")


def city_regions(spark: SparkSession) -> DataFrame:
    rows = [(region, city) for region, members in REGION_CITIES.items() for city in members]
    return literal_rows(spark, rows, "Region string, City string")
