from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from vigia.calendar import DailyCutoff
from vigia.plans import controls, publish, snapshot
from vigia.sources.snapshots import SnapshotStore
from vigia.sources.star import Star

DAY = DailyCutoff(date(2026, 9, 10))
CLIENTS = [(f"CLI-{n:04d}", f"c{n}", "s", n % 5 + 1, "k", "inactivo" if n == 9 else "activo") for n in range(1, 10)]


def star(spark, cases=(), billing=(), visits=()):
    return Star(
        spark.createDataFrame(
            CLIENTS, "id_cliente STRING, nombre STRING, sector STRING, clase_riesgo INT, coordinador STRING, estado STRING"),
        spark.createDataFrame(
            [(n, *case) for n, case in enumerate(cases)],
            "id_caso BIGINT, id_cliente STRING, fecha_ocurrencia DATE, tipo STRING, costo DECIMAL(18,2), dias_ausencia INT"),
        spark.createDataFrame(list(billing), "id_cliente STRING, periodo DATE, trabajadores_activos INT"),
        spark.createDataFrame(list(visits), "id_cliente STRING, fecha DATE, participantes INT"))


def case(n, day, kind="leve", cost=None, days=1):
    return (f"CLI-{n:04d}" if n else None, day, kind, cost, days)


def billed(workers, months=(date(2026, 9, 1),)):
    return [(f"CLI-{n:04d}", m, workers) for n in range(1, 9) for m in months]


def snap(s, cutoff=DAY):
    return {r.id_cliente: r for r in snapshot.daily_snapshot(s.clientes, s.casos, s.facturacion, s.prevencion, cutoff).collect()}


def test_classes_use_the_unrounded_rate(spark):
    cases = [case(1, date(2026, 9, 3))] + [case(2, date(2026, 9, 3))] * 5 + [case(3, date(2026, 9, 3))] * 2
    billing = [("CLI-0001", date(2026, 9, 1), 19), ("CLI-0002", date(2026, 9, 1), 100), ("CLI-0003", date(2026, 9, 1), 100),
               ("CLI-0004", date(2026, 9, 1), 0), ("CLI-0005", date(2026, 10, 1), 5), ("CLI-0006", date(2026, 7, 1), 5)]
    rows = snap(star(spark, cases, billing))
    assert {k[-1]: r.clasificacion for k, r in rows.items()} == {
        "1": "crítico", "2": "moderado", "3": "moderado", "4": "sin dato", "5": "sin dato",
        "6": "bajo", "7": "sin dato", "8": "sin dato"}
    assert rows["CLI-0006"].periodo_trabajadores == date(2026, 7, 1)
    assert rows["CLI-0001"].tasa_incidencia == 5.26


def test_month_to_date_against_the_same_stretch(spark):
    cases = [case(1, date(2026, 8, 1)), case(1, date(2026, 8, 10)), case(1, date(2026, 8, 11)),
             case(1, date(2026, 9, 10), "grave"), case(1, date(2026, 9, 11)), case(2, date(2026, 9, 1))]
    visits = [("CLI-0001", date(2026, 8, 11), 5), ("CLI-0001", date(2026, 8, 12), 6), ("CLI-0001", date(2026, 9, 10), 7)]
    rows = snap(star(spark, cases, billed(10), visits))
    one = rows["CLI-0001"]
    assert (one.casos_mes, one.graves_mes, one.casos_mes_ant_mismo_corte, one.casos_mes_ant_completo) == (1, 1, 2, 3)
    assert (one.variacion_casos, one.variacion_casos_pct) == (-1, -50.0)
    assert (one.actividades_prevencion_30d, one.participantes_prevencion_30d) == (2, 13)
    assert rows["CLI-0002"].variacion_casos_pct is None
    assert len(rows) == 8


def results(frame):
    return {r.control: (r.valor, r.esperado, r.resultado) for r in frame.collect()}


def run(spark, s, staged=None, published=None, cutoff=DAY):
    today = staged if staged is not None else snapshot.daily_snapshot(
        s.clientes, s.casos, s.facturacion, s.prevencion, cutoff)
    yesterday = published if published is not None else snapshot.daily_snapshot(
        s.clientes, s.casos, s.facturacion, s.prevencion, DailyCutoff(cutoff.previous_day))
    return results(controls.quality_controls(today, yesterday, s.casos, s.clientes, cutoff))


GOOD = [case(n, date(2026, 9, 2 + n)) for n in range(1, 9)]


def test_clean_day_passes(spark):
    got = run(spark, star(spark, GOOD, billed(50)))
    assert list(got) == ["C01", "C02", "C03", "C04", "C05", "C06", "C09", "C07", "C08", "C10", "C11", "C12"]
    assert {r[2] for r in got.values()} == {"OK"}
    assert got["C01"][:2] == (8.0, 8.0) and got["C03"][0] == 0.0


def test_each_defect_fails_its_control(spark):
    bad = GOOD + [case(0, date(2026, 9, 4)), ("CLI-9999", date(2026, 9, 4), "leve", None, 1),
                  case(1, date(2026, 9, 4), None), case(1, date(2026, 9, 4), "otro"),
                  case(1, date(2026, 9, 12)), case(2, date(2026, 9, 4), "leve", Decimal(-1)), case(2, date(2026, 9, 4), "leve", None, -1),
                  case(3, None, None)]
    s = star(spark, bad, billed(1))
    s = Star(s.clientes, s.casos.unionByName(s.casos.filter("id_caso = 0")), s.facturacion, s.prevencion)
    got = run(spark, s)
    assert got["C05"] == (2.0, 0.0, "FALLA")      # a missing client is an unknown one too
    assert got["C06"] == (3.0, 0.0, "FALLA")      # the row without a date is not seen
    assert got["C07"] == (1.0, 0.0, "FALLA") and got["C03"] == (-2.0, 3.0, "OK")
    assert got["C08"] == (2.0, 0.0, "FALLA") and got["C09"] == (1.0, 0.0, "FALLA")
    assert got["C11"][2] == "FALLA"


def test_missing_figures_fail(spark):
    s = star(spark)
    empty = snapshot.daily_snapshot(s.clientes, s.casos, s.facturacion, s.prevencion, DAY).limit(0)
    got = run(spark, s, empty, empty)
    assert {c for c, r in got.items() if r[2] == "FALLA"} == {"C01", "C03", "C04", "C10"}
    assert got["C03"][0] is None and got["C04"][:2] == (None, None)
    first = run(spark, s, empty, empty, DailyCutoff(date(2026, 9, 1)))
    assert first["C04"][2] == "OK"


def test_repeated_clients_and_fewer_cases_than_yesterday(spark):
    s = star(spark, GOOD, billed(50))
    today = snapshot.daily_snapshot(s.clientes, s.casos.filter("id_caso > 3"), s.facturacion, s.prevencion, DAY)
    got = run(spark, s, today.unionByName(today.limit(2)))
    assert got["C02"] == (2.0, 0.0, "FALLA") and got["C01"][2] == "FALLA" and got["C04"][2] == "FALLA"


def test_publication_gate(spark, tmp_path):
    store = SnapshotStore.open(spark, str(tmp_path))
    first, second = DailyCutoff(date(2026, 9, 1)), DailyCutoff(date(2026, 9, 2))
    good = star(spark, [case(1, date(2026, 8, 31)), case(2, date(2026, 9, 1)), case(3, date(2026, 9, 2))], billed(50))
    assert publish.write_audit_publish(good, first, store).published
    assert publish.write_audit_publish(good, first, store).published          # a day can be run again
    broken = star(spark, [case(1, date(2026, 9, 1)), ("CLI-9999", date(2026, 9, 2), "leve", None, 1)], billed(50))
    refused = publish.write_audit_publish(broken, second, store)
    assert not refused.published and refused.failed == ["C05"]
    days = {r.fecha_corte: r.n for r in store.published().groupBy("fecha_corte").count().withColumnRenamed("count", "n").collect()}
    assert days == {date(2026, 9, 1): 8}                                      # the last good day stays
    assert store.staged().count() == 16
    assert publish.write_audit_publish(good, second, store).published
    assert store.published().count() == 16
    trend = {r.control: r for r in controls.control_history(store.history()).collect()}
    assert trend["C05"].ejecuciones == 4 and trend["C05"].dias == 2
    assert trend["C05"].dias_con_falla == 0 and trend["C01"].ultimo_valor == 8.0


@pytest.mark.parametrize("name", [c[0] for c in controls.CONTROLS])
def test_catalogue_is_complete(name):
    assert name == f"C{int(name[1:]):02d}"


def test_readers_see_a_day_whole_while_it_is_replaced(spark, tmp_path, monkeypatch):
    """The job that replaces a day fails after writing it: readers still get the old day, and all of it."""
    store = SnapshotStore.open(spark, str(tmp_path))
    assert store.published().count() == 0 and store.served_day() is None
    rows = spark.createDataFrame([(f"CLI-{n}", n, DAY.day) for n in range(40)], "id_cliente STRING, casos_mes BIGINT, fecha_corte DATE")
    full = spark.createDataFrame([], store.published().schema).unionByName(rows, allowMissingColumns=True)
    store.publish(full, DAY.day)
    store.publish(full.withColumn("fecha_corte", F.lit(date(2026, 9, 9))), date(2026, 9, 9))
    reading = store.published()   # a reader that has begun
    with monkeypatch.context() as patch:
        def fail(*_):
            raise RuntimeError("ended half-way")

        patch.setattr(SnapshotStore, "_point", fail)
        with pytest.raises(RuntimeError):
            store.publish(full.filter("casos_mes < 3"), DAY.day)
    assert store.published().filter(F.col("fecha_corte") == DAY.day).count() == 40
    store.publish(full.filter("casos_mes < 5"), DAY.day)
    assert store.published().groupBy("fecha_corte").count().orderBy("fecha_corte").collect() == [(date(2026, 9, 9), 40), (DAY.day, 5)]
    assert reading.count() == 80 and store.served_day() == DAY.day
    store.publish(full.filter("casos_mes < 0"), DAY.day)   # an empty day
    assert store.published().filter(F.col("fecha_corte") == DAY.day).count() == 0
    assert len(list((tmp_path / "publicado" / f"fecha_corte={DAY.day}").glob("version=*"))) == 2
    plan = store.published().filter(F.col("fecha_corte") == date(2026, 9, 9))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(fecha_corte" in plan
