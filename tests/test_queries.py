"""Every registered query against its SQL statement on a second engine."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from catalog.oracles import ORACLES
from catalog.queries import QUERIES
from compare import difference, oracle_connection

FOLDER = os.environ.get("VIGIA_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, oracle, name):
    frame = entry.queries()[name](spark, FOLDER)
    statements = entry.oracle_sql()
    if name in statements:
        assert difference(frame, oracle.execute(statements[name])) is None
    else:
        assert frame.count() > 0


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry.entry(spark).count() == 15


def _rows(spark, name):
    return [r.asDict() for r in entry.queries()[name](spark, FOLDER).collect()]


def test_order_of_the_risk_ranking(spark):
    rows = _rows(spark, "p01_client_risk_cost")
    place = [(-r["clase_riesgo"], r["ranking_clase"], r["id_cliente"]) for r in rows]
    assert len(place) > 10 and place == sorted(place)


def test_order_of_the_worklist(spark):
    rows = _rows(spark, "p41_worklist")
    states = list(dict.fromkeys(r["estado"] for r in rows))
    assert states == [s for s in ("rojo", "amarillo", "verde", "sin dato") if s in states]
    for state in states:
        place = [(-r["casos"], r["id_cliente"]) for r in rows if r["estado"] == state]
        assert place == sorted(place)


def test_order_of_the_sectors(spark):
    rows = _rows(spark, "p30_sector_rate")
    place = [(r["cumplimiento"] is None, -(r["cumplimiento"] or 0), r["sector"] or "") for r in rows]
    assert len(place) > 1 and place == sorted(place)
