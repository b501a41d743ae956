import datetime as dt

import pytest

from tidewalk.session import local_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, work_dir=str(tmp_path_factory.mktemp("work")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL


def business_days(n, start=dt.date(2016, 1, 1)):
    days, day = [], start
    while len(days) < n:
        if day.weekday() < 5:
            days.append(day)
        day += dt.timedelta(days=1)
    return days


def month_ends(n, start=dt.date(2016, 1, 1)):
    ends, first = [], start
    for _ in range(n):
        following = (first.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
        ends.append(following - dt.timedelta(days=1))
        first = following
    return ends


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
