from __future__ import annotations

from dataclasses import replace
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from vigia import schemas
from vigia.business import Targets
from vigia.calendar import MonthWindow, shift_months
from vigia.functions.status import suggested_action, traffic_light, whole_percent
from vigia.functions import status as st
from vigia.operators.cardinality import key_summary, repeated_keys
from vigia.operators.fanout import join_fanout
from vigia.operators.streaks import streaks
from vigia.operators.spine import entity_months
from vigia.plans import portfolio, segments, worklists
from vigia.sources.star import Star, read_star, target_table, targets_from_table, write_star

MONTH = date(2026, 9, 1)


def m(back):
    return shift_months(MONTH, -back)


CLIENTS = [
    ("CLI-0001", "uno", "Minería", 5, "Ana", "activo"), ("CLI-0002", "dos", "Minería", 4, "Ana", "activo"),
    ("CLI-0003", "tres", "Comercio", 1, "Luz", "inactivo"), ("CLI-0004", "cuatro", "Salud", 2, "Luz", "activo"),
]
CASES = [
    ("CLI-0001", m(0), "grave", 20, "100.50"), ("CLI-0001", m(0), "leve", 2, "10.00"), ("CLI-0002", m(1), "leve", 1, None),
    ("CLI-0003", m(0), "otro", 3, "5.00"), ("CLI-0004", m(0), "leve", 3, "5.00"), ("CLI-0009", m(0), "grave", 9, "7.00"),
    ("CLI-0001", m(23), "leve", 1, "1.00"), ("CLI-0001", m(24), "leve", 1, "1.00"),
]
BILLING = [("CLI-0001", m(0), 100), ("CLI-0002", m(0), 100), ("CLI-0003", m(0), 50), ("CLI-0001", m(1), 80),
           ("CLI-0009", m(0), 1000), ("CLI-0004", m(0), 0)]
VISITS = [("CLI-0001", m(0), date(2026, 9, 5), "Inspección", 4), ("CLI-0001", m(0), date(2026, 9, 6), "Asesoría", 3),
          ("CLI-0002", m(2), date(2026, 7, 31), "Inspección", 2), ("CLI-0003", m(0), date(2026, 9, 1), "Inspección", 1)]


def build(spark, clients=CLIENTS, cases=CASES, billing=BILLING, visits=VISITS):
    return Star(
        spark.createDataFrame(
            clients, "id_cliente STRING, nombre STRING, sector STRING, clase_riesgo INT, coordinador STRING, estado STRING"),
        spark.createDataFrame(
            [(n, c, p, t, d, Decimal(v) if v else None, p, "cerrado") for n, (c, p, t, d, v) in enumerate(cases)],
            "id_caso BIGINT, id_cliente STRING, periodo DATE, tipo STRING, dias_ausencia INT, costo DECIMAL(18,2), "
            "fecha_ocurrencia DATE, estado STRING"),
        spark.createDataFrame([(*b, None) for b in billing],
                              "id_cliente STRING, periodo DATE, trabajadores_activos INT, valor_contrato DECIMAL(18,2)"),
        spark.createDataFrame([(n, *v) for n, v in enumerate(visits)],
                              "id_actividad BIGINT, id_cliente STRING, periodo DATE, fecha DATE, tipo STRING, participantes INT"))


@pytest.fixture(scope="module")
def star(spark):
    return build(spark)


def by_month(frame, *keys):
    return {tuple(r[k] for k in (*keys, "periodo")): r for r in frame.collect()}


def test_portfolio_series(star):
    rows = by_month(portfolio.monthly_series(star, MONTH))
    assert len(rows) == 24 and min(rows) == (m(23),)
    now = rows[(MONTH,)]
    # Cases of an unknown client count in the portfolio; its workers do not.
    assert (now.casos, now.graves, now.dias_ausencia, float(now.costo)) == (5, 2, 37, 127.5)
    assert now.trabajadores == 250
    assert now.casos_meta == pytest.approx(100 * 1.25 / 100 + 100 * 0.95 / 100 + 50 * 0.25 / 100)
    assert now.tasa == 2.0 and float(now.presupuesto) == 250 * 22000
    assert (now.clientes_riesgo_alto, now.riesgo_alto_con_prevencion, now.cobertura) == (2, 1, 0.5)
    empty = rows[(m(5),)]
    assert (empty.casos, float(empty.costo), empty.trabajadores, empty.tasa, empty.presupuesto) == (0, 0.0, None, None, None)
    assert empty.cobertura == 0.0


def test_client_series_agrees_with_the_grouped_one(star):
    single = portfolio.monthly_series(star, MONTH, ["id_cliente"])
    # The same result from the join form, grouping by a column that is unique per client.
    joined = portfolio.monthly_series(star, MONTH, ["nombre"])
    names = {c[0]: c[1] for c in CLIENTS}
    a = {(names[k[0]], k[1]): tuple(r)[1:] for k, r in by_month(single, "id_cliente").items()}
    b = {k: tuple(r)[1:] for k, r in by_month(joined, "nombre").items()}
    assert len(a) == 4 * 24 and a == b
    both = portfolio.monthly_series(star, MONTH, ["id_cliente", "sector"])
    assert both.drop("sector").exceptAll(single).isEmpty() and both.count() == single.count()


def test_groups_add_up_to_known_clients(star):
    known = star.with_clients(star.clientes)
    total = by_month(portfolio.monthly_series(known, MONTH))
    parts = portfolio.monthly_series(known, MONTH, ["sector"]).groupBy("periodo").agg(
        F.sum("casos").alias("casos"), F.sum("trabajadores").alias("trabajadores"), F.sum("costo").alias("costo"))
    for row in parts.collect():
        whole = total[(row.periodo,)]
        assert (row.casos, row.trabajadores, row.costo) == (whole.casos, whole.trabajadores, whole.costo)


def test_repeated_client_fails_the_job(spark):
    twice = build(spark, clients=CLIENTS + CLIENTS[:1])
    for job in (
        lambda: portfolio.monthly_series(twice, MONTH),
        lambda: portfolio.monthly_series(twice, MONTH, ["id_cliente"]),
        lambda: segments.sector_rate(twice, MONTH),
        lambda: worklists.client_month_summary(twice, MONTH),
    ):
        with pytest.raises(Exception, match="id_cliente repetido: CLI-0001"):
            job().collect()


def test_repeated_keys_are_reported(spark):
    billing = build(spark, billing=BILLING + BILLING[:1] * 2 + [(None, MONTH, 1)]).facturacion
    keys = ["id_cliente", "periodo"]
    assert [(r.id_cliente, r.filas) for r in repeated_keys(billing, keys).collect()] == [("CLI-0001", 3)]
    row = key_summary(billing, "facturacion", keys).head()
    assert (row.filas, row.llaves, row.llaves_repetidas, row.filas_sin_llave) == (9, 7, 1, 1)


def test_filters_cascade(star):
    mine = portfolio.filter_portfolio(star, "Ana", ["Minería", "Salud"], [1, 2, 5])
    assert [r.id_cliente for r in mine.clientes.collect()] == ["CLI-0001"]
    assert {r.id_cliente for f in (mine.casos, mine.facturacion, mine.prevencion) for r in f.collect()} == {"CLI-0001"}
    assert portfolio.filter_portfolio(star).clientes.count() == 4
    assert portfolio.filter_portfolio(star, active_only=True).clientes.count() == 3
    nobody = portfolio.filter_portfolio(star, "nadie")
    assert {r.clientes_riesgo_alto for r in portfolio.monthly_series(nobody, MONTH).collect()} == {0}


def test_assignments(spark, star):
    table = spark.createDataFrame([("ana", "CLI-0002"), ("ana", "CLI-0002"), ("luz", "CLI-0001")], "usuario STRING, id_cliente STRING")
    own = portfolio.assigned_portfolio(star, table, "ana")
    assert [r.id_cliente for r in own.clientes.collect()] == ["CLI-0002"]


def test_changes(spark):
    values = [None, 0.0, 10.0, 5.0] + [1.0] * 12
    series = spark.createDataFrame(
        [(shift_months(date(2025, 1, 1), n), v) for n, v in enumerate(values)], "periodo DATE, tasa DOUBLE")
    rows = {r.periodo: r for r in portfolio.compare_periods(series, ("tasa",)).collect()}
    assert rows[date(2025, 1, 1)].promedio_12m is None and rows[date(2025, 1, 1)].anterior is None
    assert rows[date(2025, 3, 1)].variacion is None                       # from 0
    assert rows[date(2025, 4, 1)].variacion == -0.5 and rows[date(2025, 4, 1)].promedio_12m == 5.0
    assert rows[date(2026, 4, 1)].promedio_12m == pytest.approx((5.0 + 11) / 12)


def test_streaks(spark):
    rates = [2.0, 2.0, None, 0.5, 2.0, 2.0]
    series = spark.createDataFrame(
        [(g, shift_months(date(2026, 1, 1), n), v, 1.0) for g in "ab" for n, v in enumerate(rates)],
        "g STRING, periodo DATE, tasa DOUBLE, meta_tasa DOUBLE")
    rows = portfolio.target_streaks(series, ["g"]).orderBy("g", "periodo").collect()
    assert [(r.n_meses, r.sobre_meta) for r in rows] == [
        (1, True), (2, True), (1, False), (2, False), (1, True), (2, True)] * 2


def test_lights(spark):
    cases = [
        (1.0, 1.0, True, "verde", 1.0), (1.0, 0.8, True, "amarillo", 0.8), (1.0, 0.79, True, "rojo", 0.79),
        (0.0, 1.0, True, "verde", 1.0), (None, 1.0, True, "sin dato", None), (1.0, None, False, "sin dato", None),
        (0.95, 0.9, False, "verde", 1.0), (0.4, 0.5, False, "amarillo", 0.8), (0.0, 0.9, False, "rojo", 0.0),
        (1.0003, 1.0, True, "amarillo", 1 / 1.0003),
    ]
    for lower in (True, False):
        frame = spark.createDataFrame([c for c in cases if c[2] == lower], "r DOUBLE, m DOUBLE, l BOOLEAN, e STRING, c DOUBLE")
        state, reached = traffic_light(F.col("r"), F.col("m"), lower)
        for row in frame.select("e", "c", state.alias("s"), reached.alias("x"), whole_percent(reached).alias("p")).collect():
            assert (row.s, row.x) == (row.e, row.c)
            assert row.p is None or row.p <= row.x * 100
    assert spark.range(1).select(whole_percent(F.lit(0.9997)).alias("p")).head().p == 99


def test_first_action_wins(spark):
    frame = spark.createDataFrame([
        ("rojo", 1, 1, 0, st.VISIT), ("rojo", 1, 1, 1, st.REVIEW_SERIOUS), ("verde", 4, 1, 0, st.REVIEW_SERIOUS),
        ("verde", 4, 0, 0, st.PLAN_PREVENTION), ("rojo", 4, 0, 2, st.FOLLOW_UP), ("sin dato", 3, 0, 0, st.NO_ACTION)],
        "e STRING, c INT, g INT, v INT, a STRING")
    got = frame.select("a", suggested_action(F.col("e"), F.col("c"), F.col("g"), F.col("v")).alias("x")).collect()
    assert all(r.a == r.x for r in got)


def test_client_summary(star):
    rows = {r.id_cliente: r for r in worklists.client_month_summary(star, MONTH).collect()}
    one, two, four = rows["CLI-0001"], rows["CLI-0002"], rows["CLI-0004"]
    assert (one.casos, one.graves, float(one.costo), one.tasa, one.meta_tasa) == (2, 1, 110.5, 2.0, 1.25)
    assert (one.prevencion_mes, one.dias_sin_prevencion, one.estado, one.accion) == (2, 24, "rojo", st.REVIEW_SERIOUS)
    assert (two.casos, two.prevencion_mes, two.dias_sin_prevencion, two.accion) == (0, 0, 61, st.PLAN_PREVENTION)
    assert (four.trabajadores, four.tasa, four.estado, four.dias_sin_prevencion) == (0, None, "sin dato", None)
    assert len(rows) == 4
    summary = worklists.client_month_summary(star, MONTH)
    assert [r.id_cliente for r in worklists.worklist(summary).collect()] == ["CLI-0001", "CLI-0003", "CLI-0002", "CLI-0004"]
    assert [r.id_cliente for r in worklists.worklist(summary, True).collect()] == ["CLI-0002"]
    assert [r.id_cliente for r in worklists.top_clients(summary, 2).collect()] == ["CLI-0001", "CLI-0003"]


def test_segments(star):
    rows = {r.sector: r for r in segments.sector_rate(star, MONTH).collect()}
    assert rows["Minería"].casos == 2 and rows["Minería"].tasa == 1.0 and rows["Minería"].estado == "verde"
    assert rows["Comercio"].estado == "rojo" and rows["Salud"].estado == "sin dato"
    assert [r.sector for r in segments.sector_rate(star, MONTH).collect()] == ["Minería", "Comercio", "Salud"]
    months = segments.sector_month(star, MONTH)
    assert {(r.sector, r.periodo) for r in months.collect()} == {
        ("Minería", MONTH), ("Minería", m(1)), ("Comercio", MONTH), ("Salud", MONTH)}
    assert [(r.sector, r.meses) for r in segments.persistent_red(months, MONTH).collect()] == [("Comercio", 1)]
    matrix = {r.sector: r for r in segments.sector_month_matrix(months, MONTH).collect()}
    assert len(matrix["Salud"]) == 25 and matrix["Salud"]["2026_09_estado"] == "sin dato"
    assert matrix["Minería"]["2026_08_tasa"] == 1.25 and matrix["Minería"]["2025_10_tasa"] is None


def test_distribution_has_fixed_classes_and_types(star):
    dist = segments.case_distribution(star, MONTH)
    assert [tuple(r) for r in dist.collect()] == [(1, 0, 0), (2, 1, 0), (3, 0, 0), (4, 0, 0), (5, 1, 1)]
    mix = segments.case_mix(dist).head()
    assert (mix.leve, mix.grave, mix.parte_grave_riesgo_alto) == (2, 1, 1.0)
    nothing = segments.case_mix(segments.case_distribution(star, m(7))).head()
    assert (nothing.parte_grave, nothing.parte_grave_riesgo_alto) == (0.0, 0.0)


def test_client_lists(star):
    assert [(r.id_cliente, r.tipo) for r in worklists.client_month_cases(star, MONTH).collect()][:2] == [
        ("CLI-0001", "Grave"), ("CLI-0001", "Leve")]
    last = worklists.last_preventions(star, MONTH, 1).collect()
    assert {(r.id_cliente, r.fecha.day) for r in last} == {("CLI-0001", 6), ("CLI-0002", 31), ("CLI-0003", 1)}
    gaps = worklists.months_without_prevention(star, MONTH).groupBy("id_cliente").count().collect()
    assert {r.id_cliente: r["count"] for r in gaps} == {"CLI-0001": 11, "CLI-0002": 11, "CLI-0003": 11, "CLI-0004": 12}


def test_cards_and_messages(star):
    series = portfolio.monthly_series(star, MONTH)
    cards = {r.kpi: r for r in portfolio.kpi_cards(series, MONTH).collect()}
    assert cards["tasa"].estado == "rojo" and cards["costo"].estado == "verde" and cards["cobertura"].meta == 0.9
    assert cards["cobertura"].cumplimiento_pct == 55 and cards["cobertura"].estado == "rojo"
    facts = portfolio.key_message_facts(series, segments.sector_rate(star, MONTH), MONTH).head()
    assert (facts.sectores_rojos, facts.sector_rojo_1, facts.sector_rojo_2) == (1, "Comercio", None)
    # August is exactly on its target (1.25), which is within it.
    assert (facts.n_meses, facts.sobre_meta, facts.riesgo_alto_sin_prevencion) == (1, True, 1)
    quiet = portfolio.key_message_facts(series, segments.sector_rate(star, MONTH).filter("sector = 'Salud'"), MONTH).head()
    assert (quiet.sectores_rojos, quiet.sector_rojo_1) == (0, None)
    support = {r.metrica: r for r in portfolio.support_metrics(
        series, worklists.client_month_summary(star, MONTH), MONTH).collect()}
    assert (support["clientes_fuera_de_meta"].actual, support["clientes_fuera_de_meta"].total_clientes) == (2.0, 4)
    assert support["casos"].actual == 5.0 and support["casos"].variacion == 4.0
    trend = portfolio.trend_12m(series, MONTH).collect()
    assert len(trend) == 12 and trend[-1].promedio_historico == pytest.approx((2.0 + 1.25) / 2)


def test_tables_and_targets_from_storage(spark, star, tmp_path):
    write_star(star, str(tmp_path / "star"))
    stored = read_star(spark, str(tmp_path / "star"))
    assert sorted(map(str, stored.casos.collect())) == sorted(map(str, star.casos.select(*stored.casos.columns).collect()))
    table = target_table(spark, replace(Targets(), rate_by_class={5: Decimal("2.5")}))
    targets = targets_from_table(table)
    assert targets.rate_by_class == {5: Decimal("2.5000")}
    row = {r.id_cliente: r for r in worklists.client_month_summary(stored, MONTH, targets).collect()}
    assert row["CLI-0001"].estado == "verde" and row["CLI-0002"].estado == "sin dato"
    gold = str(tmp_path / "oro")
    series = portfolio.monthly_series(stored, MONTH, ["id_cliente"])
    portfolio.write_monthly_gold(series, gold, ["id_cliente"])
    read = portfolio.read_monthly_gold(spark, gold, series.schema)
    assert sorted(map(str, read.select(*series.columns).collect())) == sorted(map(str, series.collect()))


def test_fanout_counts_without_building_the_join(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",), ("z",), (None,)], "k STRING")
    b = spark.createDataFrame([("x",)] * 3 + [("y",)], "k STRING")
    row = join_fanout(a, b, "k").head()
    assert (row.conteo_directo, row.conteo_unido, row.llaves_multiplicadas) == (5, a.join(b, "k", "left").count(), 1)


def test_streaks_with_one_row(spark):
    frame = spark.createDataFrame([(date(2026, 1, 1), 1.0)], "p DATE, v DOUBLE")
    row = streaks(frame, F.col("v") > 2, [], "p", "n", "s").head()
    assert (row.n, row.s) == (1, False)


def test_facets(star):
    facets = portfolio.filter_facets(star)
    values = {}
    for r in facets.collect():
        values.setdefault(r.faceta, set()).add(r.valor)
    assert values == {"periodo": {"2026-09-01", "2026-08-01"}, "sector": {"Minería", "Comercio", "Salud"},
                      "coordinador": {"Ana", "Luz"}}


def test_missing_attributes_are_groups(spark):
    """A client without coordinator keeps its workers, cases and rate together."""
    clients = spark.createDataFrame(
        [("CLI-0001", "a", None, 4, None, "activo"), ("CLI-0002", "b", "X", 1, "c", "activo")], schemas.CLIENTES)
    cases = spark.createDataFrame(
        [(n, "CLI-0001", MONTH, "leve", 1, Decimal(5), MONTH, "abierto") for n in range(9)], schemas.CASOS)
    billed = spark.createDataFrame([("CLI-0001", MONTH, 10, Decimal(1)), ("CLI-0002", MONTH, 5, Decimal(1))], schemas.FACTURACION)
    own = Star(clients, cases, billed, spark.createDataFrame([], schemas.PREVENCION))
    rates = {r.coordinador: (r.trabajadores, r.casos, r.tasa, r.estado) for r in segments.rate_vs_target(own, MONTH, MONTH, ["coordinador"]).collect()}
    assert rates == {None: (10, 9, 90.0, "rojo"), "c": (5, 0, 0.0, "verde")}
    series = {r.sector: (r.casos, r.trabajadores, r.clientes_riesgo_alto) for r in portfolio.monthly_series(own, MONTH, ["sector"]).filter(F.col("periodo") == MONTH).collect()}
    assert series == {None: (9, 10, 1), "X": (0, 5, 0)}


def test_target_table_takes_any_class_and_no_class_twice(spark):
    schema = "clase_riesgo INT, meta_tasa DECIMAL(9,4)"
    table = spark.createDataFrame([(1, Decimal("0.2")), (6, Decimal("3"))], schema)
    assert targets_from_table(table).rate_by_class == {1: Decimal("0.2000"), 6: Decimal("3.0000")}
    for row, problem in (((6, Decimal("4")), "repetida.*6"), ((7, None), "sin meta.*7")):
        with pytest.raises(ValueError, match=problem):
            targets_from_table(table.union(spark.createDataFrame([row], schema)))


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("listed", "pushed"), [("10", 100_000), ("0", 100_000), ("10", 1)], ids=["list", "broadcast", "late"])
def test_a_portfolio_is_applied_at_the_scan(spark, star, tmp_path, monkeypatch, listed, pushed):
    write_star(star, str(tmp_path))
    stored_star = read_star(spark, str(tmp_path))
    everything = {r.tabla: (r.filas, r.clientes) for r in portfolio.portfolio_sizes(stored_star).collect()}
    before = spark.conf.get("spark.sql.parquet.pushdown.inFilterThreshold")
    spark.conf.set("spark.sql.parquet.pushdown.inFilterThreshold", listed)
    monkeypatch.setattr("vigia.sources.star.RestrictedStar.MAX_PUSHED", pushed)
    try:
        own = portfolio.filter_portfolio(stored_star, "Ana")
        rows = {r.tabla: (r.filas, r.clientes) for r in portfolio.portfolio_sizes(own).collect()}
        plan = _plan(portfolio.portfolio_sizes(own))
        ids = {r.id_cliente for r in own.fact("casos").collect()}
        series = by_month(portfolio.monthly_series(own, MONTH, ["sector"]), "sector")
        none = portfolio.portfolio_sizes(portfolio.filter_portfolio(stored_star, "nadie")).collect()
    finally:
        spark.conf.set("spark.sql.parquet.pushdown.inFilterThreshold", before)
    assert rows == {"clientes": (2, 2), "casos": (5, 2), "facturacion": (3, 2), "prevencion": (3, 2)} != everything
    assert series[("Minería", MONTH)].casos == 2 and {k[0] for k in series} == {"Minería"}
    assert {(r.filas, r.clientes) for r in none} == {(0, 0)}
    if pushed == 1:
        assert ids == {"CLI-0001", "CLI-0002", "CLI-0003", "CLI-0004", "CLI-0009"}
        return
    assert ids == {"CLI-0001", "CLI-0002"}  # other clients' rows reach no aggregation
    if listed == "10":
        # The readers of the three facts, and of the clients each is joined to, skip row groups.
        assert plan.count("In(id_cliente, [CLI-0001,CLI-0002])") == 6
    else:
        below = plan[plan.index("HashAggregate(keys=[id_cliente"):]
        assert plan.count("LeftSemi, BuildRight") >= 3 and "BroadcastHashJoin [id_cliente" in below


def test_months_of_clients_are_spread_over_tasks(spark, star):
    """Clients of one file do not get their months, and the sums of them, in one task."""
    clients = spark.range(0, 5000, 1, 1).select(F.format_string("CLI-%04d", "id").alias("id_cliente"))
    axis = entity_months(clients, MonthWindow(MONTH, 24), "id_cliente")
    sizes = [r.n for r in axis.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 5000 * 24 and max(sizes) < 5000 * 24 / 50
    plan = portfolio.monthly_series(star, MONTH, ["id_cliente"])._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan
