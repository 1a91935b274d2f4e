from __future__ import annotations

from datetime import date

from vigia.business import PriorityWeights
from vigia.calendar import DailyCutoff
from vigia.plans import priority

CUT = DailyCutoff(date(2026, 9, 30))


def tables(spark, clients, billing=(), cases=(), visits=()):
    return (
        spark.createDataFrame(clients, "id_cliente STRING, nombre STRING, sector STRING, clase_riesgo INT, estado STRING"),
        spark.createDataFrame(list(billing), "id_cliente STRING, periodo DATE, trabajadores_activos INT"),
        spark.createDataFrame(list(cases), "id_cliente STRING, fecha_ocurrencia DATE, tipo STRING, estado STRING"),
        spark.createDataFrame(list(visits), "id_cliente STRING, fecha DATE"),
    )


def client(n, risk=3, state="activo"):
    return (f"CLI-{n:04d}", f"c{n}", "s", risk, state)


def test_metrics(spark):
    day = date(2026, 9, 30)
    rows = priority.priority_metrics(*tables(
        spark,
        [client(1), client(2), client(3, state="inactivo")],
        [("CLI-0001", date(2026, 8, 1), 50), ("CLI-0001", date(2026, 9, 1), 0), ("CLI-0001", date(2026, 10, 1), 9)],
        [
            ("CLI-0001", day, "grave", "abierto"),                      # recent and open: counts twice
            ("CLI-0001", date(2026, 7, 2), "leve", "cerrado"),          # 90 days back: older window
            ("CLI-0001", date(2026, 7, 3), "leve", "cerrado"),          # 89 days back: recent
            ("CLI-0001", date(2026, 4, 3), "leve", "cerrado"),          # 180 days back: outside
            ("CLI-0001", date(2020, 1, 1), "grave", "abierto"),         # old but open
            ("CLI-0001", date(2026, 10, 1), "grave", "abierto"),        # after the cut-off
        ],
        [("CLI-0001", date(2025, 5, 18)), ("CLI-0001", date(2026, 10, 2))]), CUT).orderBy("id_cliente").collect()
    one, two = rows
    assert one.trabajadores_activos == 50
    assert (one.casos_90d, one.casos_90d_previos, one.graves_90d, one.graves_abiertos) == (2, 1, 1, 2)
    assert (one.severidad, one.incidencia_90d, one.tendencia) == (3, 4.0, 1.5)
    assert one.dias_sin_prevencion == 500 and two.dias_sin_prevencion == 365
    assert two.trabajadores_activos is None and two.incidencia_90d == 0.0 and two.tendencia == 1.0


def test_small_clients_have_a_floor_in_the_denominator(spark):
    rows = priority.priority_metrics(*tables(
        spark, [client(1)], [("CLI-0001", date(2026, 9, 1), 3)],
        [("CLI-0001", date(2026, 9, 2), "leve", "cerrado")]), CUT)
    assert rows.head().incidencia_90d == 5.0


def test_reason_ties_go_to_weight_then_to_order(spark):
    scored = spark.createDataFrame(
        [("a", 0.5, 0.5, 0.5, 0.5), ("b", 0.1, 0.2, 0.2, 0.2), ("c", 0.1, 0.2, 0.4, 0.4), ("d", 0.1, 0.2, 0.3, 0.4)],
        "id STRING, p_incidencia DOUBLE, p_severidad DOUBLE, p_tendencia DOUBLE, p_prevencion DOUBLE")
    reasons = {r.id: r.m for r in scored.select("id", priority.main_reason().alias("m")).collect()}
    assert reasons == {
        "a": priority.REASON_INCIDENCE, "b": priority.REASON_SEVERITY,
        "c": priority.REASON_TREND, "d": priority.REASON_PREVENTION}


def test_top_in_order(spark):
    clients = [client(n, n % 5 + 1) for n in range(1, 61)]
    cases = [(f"CLI-{n:04d}", date(2026, 9, 1 + n % 28), "grave" if n % 4 == 0 else "leve", "abierto")
             for n in range(1, 61) for _ in range(n % 7)]
    args = tables(spark, clients, [], cases, [(f"CLI-{n:04d}", date(2026, 1 + n % 9, 3)) for n in range(1, 50)])
    small = priority.visit_priorities(*args, CUT).collect()
    assert [r.prioridad for r in small] == list(range(1, 16))
    assert [r.score_prioridad for r in small] == sorted((r.score_prioridad for r in small), reverse=True)
    heavier = priority.visit_priorities(*args, CUT, n=3, weights=PriorityWeights(incidence=0, severity=0, trend=0, risk=1, prevention=0))
    assert {r.clase_riesgo for r in heavier.collect()} == {5}
