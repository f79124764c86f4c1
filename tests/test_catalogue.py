"""Every registered query against its SQL, and the coverage of the catalogue."""

import re

import pytest

import __spark_entry__ as entry
from catalog.check import connect, differences
from catalog.registry import ORACLES, QUERIES
from opsgauge.plans.report import CATALOGUE


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_equals_sql(spark, duck, sf_dir, key):
    got = QUERIES[key](spark, sf_dir)
    assert got.isStreaming is False
    want = duck.execute(ORACLES[key]).fetchdf()
    assert differences(got.toPandas(), want) is None


def test_all_operators_are_registered():
    have = {re.match(r"[A-Z]\d\d", k).group() for k in QUERIES}
    last = {"S": 6, "P": 19, "J": 9, "A": 15, "W": 6, "O": 2, "U": 3, "F": 15, "K": 42}
    want = {f"{letter}{n:02d}" for letter, top in last.items() for n in range(1, top + 1)}
    assert want == have


def test_report_has_every_measure_once():
    assert len(CATALOGUE) == 83
    assert len({row[0] for row in CATALOGUE}) == 83
    assert len({row[1] for row in CATALOGUE}) == 83


def test_entry_holds_the_catalogue():
    assert QUERIES.keys() <= entry.queries().keys()
    assert ORACLES.keys() <= entry.oracle_sql().keys() <= entry.queries().keys()


def test_entry_gives_the_whole_report(spark):
    assert entry.entry(spark).count() == 83 * 3
