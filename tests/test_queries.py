"""Every named query against the same query in DuckDB."""

from threading import Barrier

import pytest
from compare import connect, differences

import __spark_entry__ as entry
from citystream.operators import detect, proximity
from citystream.plans.oracles import ORACLES
from citystream.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.items() <= entry.queries().items() and ORACLES.items() <= entry.oracle_sql().items()


def test_entry(spark):
    assert entry.entry(spark).count() == 20


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    want = duck.execute(ORACLES[name]).df()
    assert differences(got, want) is None


def test_rules_of_incidents_run_side_by_side(spark, monkeypatch):
    """Each rule waits until the others have begun; what one of them raises reaches the caller."""
    begun, fails = Barrier(3, timeout=30), []

    def waiting(rule):
        def begin(rows):
            begun.wait()
            if rule in fails:
                raise ValueError(rule)
            return rule(rows)
        return begin

    rules = ((detect, "aqi_emergencies"), (detect, "gridlocks"), (proximity, "bus_bunching"))
    real = [getattr(module, name) for module, name in rules]
    for (module, name), rule in zip(rules, real):
        monkeypatch.setattr(module, name, waiting(rule))
    kinds = {r.alert_type for r in QUERIES["incidents"](spark, SF).select("alert_type").distinct().collect()}
    assert {"AQI_EMERGENCY", "TRAFFIC_GRIDLOCK"} <= kinds
    fails.append(real[1])
    with pytest.raises(ValueError):
        QUERIES["incidents"](spark, SF)
