"""Every registered query against its SQL on the smallest tables."""

import oracle
import pytest

import __spark_entry__ as entry_point

SMALL = entry_point.SMALL


@pytest.fixture(scope="module")
def db():
    return oracle.connect(SMALL)


@pytest.mark.parametrize("name", sorted(entry_point.queries()))
def test_query(spark, db, name):
    rows = entry_point.queries()[name](spark, SMALL)
    sql = entry_point.oracle_sql().get(name)
    if sql is None:
        assert rows.count() > 0
    else:
        assert oracle.compare(rows, db, sql) == ""


def test_entry(spark):
    assert entry_point.entry(spark).columns == [
        "factoryNum",
        "startDateTime",
        "injectMode",
        "alarmType",
        "alarmValue",
        "alarmTs",
    ]
