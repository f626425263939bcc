import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from aeropanel.session import local_session  # noqa: E402
from compare import connect  # noqa: E402

SMOKE = "/root/testdata/sf0.001"
CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    return local_session(8)


@pytest.fixture(scope="session")
def duck():
    return connect(CHECK)


@pytest.fixture(scope="session")
def raw(spark):
    from aeropanel.sources import driver_tables as given
    return given.city_day(spark, CHECK).persist()


@pytest.fixture(scope="session")
def clean(raw):
    from aeropanel.operators import clean as cleaning
    return cleaning.clean(raw, ["k"]).persist()


@pytest.fixture(scope="session")
def daily(raw):
    from aeropanel.operators import daily_index
    return daily_index.daily_index(raw, ["k"]).persist()


@pytest.fixture(scope="session")
def hourly_rows(spark):
    from aeropanel.sources import driver_tables as given
    return given.hourly(spark, CHECK).persist()
