"""One entry per job: (spark, folder of Parquet tables) → DataFrame.

Every query reads whole tables. Money leaves as double and run times are left
out, so that results can be compared value by value with another engine.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from catalog import settings as S
from vigia import business as B
from vigia.calendar import DailyCutoff, MonthWindow, month_start, shift_months
from vigia.durable import scratch_path, stored
from vigia.functions.status import traffic_light
from vigia.operators.cardinality import key_summary
from vigia.plans import (
    billing_quality as bq, client_risk, controls, portfolio, priority, publish, segments, snapshot,
    worklists)
from vigia.operators.ranking import dense_rank_desc, percent_ranks
from vigia.sources.billing_file import AS_RECEIVED, read_billing_file, read_billing_files
from vigia.sources.mapped import MappedTables
from vigia.sources.snapshots import SnapshotStore
from vigia.sources.star import Star, read_star, targets_from_table, write_star
from vigia.streaming.billing_arrivals import validate_arrivals

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

NEXT_MONTH = shift_months(S.MONTH, 1)
HISTORY = MonthWindow(S.MONTH, B.HISTORY_MONTHS)
YEAR = MonthWindow(S.MONTH, 12)


def _plain(frame: DataFrame) -> DataFrame:
    columns = []
    for field in frame.schema.fields:
        if isinstance(field.dataType, T.TimestampType):
            continue
        column = F.col(field.name)
        columns.append(
            column.cast("double").alias(field.name) if isinstance(field.dataType, T.DecimalType) else column)
    return frame.select(*columns)


def _rounded(frame: DataFrame, digits: int, *names: str) -> DataFrame:
    """Means of doubles depend on the order of summation in the last bits."""
    return frame.withColumns({n: F.round(n, digits) for n in names})


def query(name: str) -> Callable[[Query], Query]:
    def register(job: Query) -> Query:
        QUERIES[name] = lambda spark, folder: _plain(job(spark, folder))
        return job

    return register


# -- client risk and cost ------------------------------------------------------


@query("p01_client_risk_cost")
def p01(spark, folder):
    t = MappedTables(spark, folder)
    months = S.CLOSED
    return client_risk.client_risk_cost(
        t.clientes(), t.casos(months.start, months.end), t.facturacion(months.start, months.end), months)


def _legacy_inputs(spark, folder):
    t = MappedTables(spark, folder)
    since = month_start(shift_months(S.LEGACY_TODAY, -12))
    return t.clientes(), t.casos(since), t.facturacion(month_start(shift_months(S.LEGACY_TODAY, -6)))


@query("p02_client_risk_cost_legacy")
def p02(spark, folder):
    return client_risk.client_risk_cost_legacy(*_legacy_inputs(spark, folder), S.LEGACY_TODAY)


@query("p03_join_fanout_audit")
def p03(spark, folder):
    return client_risk.legacy_fanout(*_legacy_inputs(spark, folder), S.LEGACY_TODAY)


# -- visit priority ------------------------------------------------------------


def _priority_tables(spark, folder, cutoff=S.CUTOFF):
    t = MappedTables(spark, folder)
    after = cutoff.day + timedelta(days=1)
    return (
        t.clientes(), t.facturacion(until=shift_months(cutoff.month_start, 1)), t.casos(until=after),
        t.prevencion(until=after), cutoff)


@query("p04_priority_metrics")
def p04(spark, folder):
    return priority.priority_metrics(*_priority_tables(spark, folder))


@query("p05_priority_score")
def p05(spark, folder):
    return priority.priority_score(priority.priority_metrics(*_priority_tables(spark, folder)))


@query("p06_main_reason")
def p06(spark, folder):
    scored = priority.priority_score(priority.priority_metrics(*_priority_tables(spark, folder)))
    return scored.select("id_cliente", priority.main_reason().alias("motivo_principal"))


@query("p07_priority_top")
def p07(spark, folder):
    return priority.visit_priorities(*_priority_tables(spark, folder))


@query("w04_percent_rank")
def w04(spark, folder):
    cases = MappedTables(spark, folder).casos().select("id_caso", "costo", "dias_ausencia", "tipo")
    return percent_ranks(cases, {"costo": "p_costo", "dias_ausencia": "p_dias"}).drop("costo")


@query("w01_rank_missing_groups")
def w01(spark, folder):
    """Ranks within a group that may be missing, over integers that doubles cannot tell apart."""
    key = F.col("o_orderkey")
    orders = MappedTables(spark, folder).raw("orders").select(
        "o_orderkey", F.when(key % 5 != 0, key % 5).alias("grupo"),
        F.when(key % 11 != 0, F.lit(9007199254740992) + key % 1000).alias("valor"))
    ranked = percent_ranks(dense_rank_desc(orders, "grupo", "valor", "rango"), {"valor": "p_valor", "grupo": "p_grupo"})
    return ranked.select("o_orderkey", "rango", "p_valor", "p_grupo")


# -- daily snapshot ------------------------------------------------------------


def _snapshot_tables(spark, folder, cutoff: DailyCutoff):
    t = MappedTables(spark, folder)
    after = cutoff.day + timedelta(days=1)
    return (
        t.clientes(), t.casos(cutoff.previous_month_start, after),
        t.facturacion(until=shift_months(cutoff.month_start, 1)),
        t.prevencion(cutoff.days_before(30), after), cutoff)


SNAPSHOT_DAYS = {
    "p08_daily_snapshot": S.CUTOFF.day,
    "p08_daily_snapshot_feb_end": date(2001, 2, 28),
    "p08_daily_snapshot_mar_30": date(2001, 3, 30),
    "p08_daily_snapshot_mar_31": date(2001, 3, 31),
    "p08_daily_snapshot_apr_30": date(2001, 4, 30),
    "p08_daily_snapshot_first_day": date(2001, 6, 1),
}


def _snapshot(day: date) -> Query:
    return lambda spark, folder: snapshot.daily_snapshot(*_snapshot_tables(spark, folder, DailyCutoff(day)))


for _name, _day in SNAPSHOT_DAYS.items():
    query(_name)(_snapshot(_day))


def _controls(spark, folder, casos):
    t = MappedTables(spark, folder)
    day = S.CUTOFF
    staged = _snapshot(day.day)(spark, folder)
    before = _snapshot(day.previous_day)(spark, folder)
    # A stored snapshot is read by several aggregates; here it is computed once for them.
    return controls.quality_controls(stored(staged, "hoy"), stored(before, "ayer"), casos, t.clientes(), day)


@query("p09_quality_controls")
def p09(spark, folder):
    return _controls(spark, folder, MappedTables(spark, folder).casos())


@query("p09_quality_controls_defects")
def p09_defects(spark, folder):
    return _controls(spark, folder, MappedTables(spark, folder).defective_casos(S.CUTOFF.day))


PUBLISHED_DAYS = (date(2001, 6, 1), date(2001, 6, 2), date(2001, 6, 3))


def _publish_days(spark, folder) -> tuple[SnapshotStore, list[publish.PublishResult]]:
    """Three days in a row through stage, audit and gate, in a fresh store; the last one audits damaged cases."""
    t = MappedTables(spark, folder)
    store, results = SnapshotStore.open(spark, scratch_path(spark, "tablero")), []
    for day in PUBLISHED_DAYS:
        cutoff = DailyCutoff(day)
        casos = t.defective_casos(day) if day == PUBLISHED_DAYS[-1] else t.casos()
        star = Star(t.clientes(), casos, *_snapshot_tables(spark, folder, cutoff)[2:4])
        results.append(publish.write_audit_publish(star, cutoff, store))
    return store, results


@query("p10_write_audit_publish")
def p10(spark, folder):
    return _publish_days(spark, folder)[0].published()


@query("p10_publication_notice")
def p10_notice(spark, folder):
    """Per day whether it was published, what failed, what is warned of and which day is served."""
    _, results = _publish_days(spark, folder)
    return spark.createDataFrame(
        [(day, r.published, ",".join(r.failed), ",".join(r.warnings), r.served)
         for day, r in zip(PUBLISHED_DAYS, results, strict=True)],
        "fecha_corte DATE, publicado BOOLEAN, fallas STRING, avisos STRING, dia_servido DATE")


@query("p11_control_history")
def p11(spark, folder):
    return controls.control_history(_publish_days(spark, folder)[0].history())


# -- billing file --------------------------------------------------------------


def _raw(spark, folder) -> DataFrame:
    return MappedTables(spark, folder).raw_billing()


def _judged(spark, folder, load_date=S.LOAD_DATE) -> DataFrame:
    return bq.apply_rules(bq.normalize_billing(_raw(spark, folder)), load_date)


@query("p12_normalize_billing")
def p12(spark, folder):
    normal = bq.normalize_billing(_raw(spark, folder))
    return normal.select("fila_origen", *bq.BILLING_COLUMNS, *bq.CLEAN.values())


@query("p13_apply_rules")
def p13(spark, folder):
    return _judged(spark, folder).select("fila_origen", *bq.CODES)


@query("p13_apply_rules_late_load")
def p13_late(spark, folder):
    return _judged(spark, folder, S.LATE_LOAD_DATE).select("fila_origen", *bq.CODES)


@query("p14_split_valid")
def p14(spark, folder):
    return bq.split_valid(_judged(spark, folder), S.LOAD_DATE)


@query("p15_split_rejected")
def p15(spark, folder):
    return bq.split_rejected(_judged(spark, folder))


@query("p16_dimension_scores")
def p16(spark, folder):
    return bq.dimension_scores(_judged(spark, folder))


@query("p17_rejections_by_rule")
def p17(spark, folder):
    return bq.rejections_by_rule(_judged(spark, folder))


@query("p18_format_corrections")
def p18(spark, folder):
    return bq.format_corrections(_judged(spark, folder))


def _flat_report(report: DataFrame) -> DataFrame:
    return report.select(
        "fecha_carga", "total_registros", "validos", "rechazados", "pct_rechazo", "estado_carga",
        *[F.col(f"score_por_dimension.{d}").alias(f"score_{d}") for d in bq.DIMENSIONS],
        F.aggregate("rechazos_por_regla", F.lit(0).cast("bigint"), lambda a, r: a + r["filas"])
        .alias("fallas"),
        F.col("correcciones_de_formato.id_cliente").alias("corregidos_id_cliente"),
        F.col("correcciones_de_formato.periodo").alias("corregidos_periodo"),
    )


@query("p19_load_report")
def p19(spark, folder):
    return _flat_report(bq.load_report(_judged(spark, folder), S.LOAD_DATE, "facturacion"))


def _billing_csv(spark, folder) -> str:
    """The untidy billing text as a CSV load in client, month and copy order."""
    path = scratch_path(spark, "facturacion-csv")
    raw = MappedTables(spark, folder).raw_billing(lambda rows, line: rows.orderBy(line))
    raw.drop("fila_origen").write.options(**AS_RECEIVED).csv(path)
    return path


@query("p20_validate_billing")
def p20(spark, folder):
    result = bq.validate_billing(
        spark, _billing_csv(spark, folder), S.LOAD_DATE, scratch_path(spark, "validacion"))
    return _flat_report(result.report)


@query("t01_billing_arrivals")
def t01(spark, folder):
    """The billing text arriving as files, each validated by the stream; failures per rule over all."""
    incoming, output = scratch_path(spark, "entrada"), scratch_path(spark, "llegadas")
    # All lines of a client stay in one file and in order, so uniqueness per file is uniqueness overall.
    raw = MappedTables(spark, folder).raw_billing(
        lambda rows, line: rows.repartition(F.floor(line / 100_000)).sortWithinPartitions(line))
    raw.drop("fila_origen").write.options(**AS_RECEIVED).csv(incoming)
    stream = validate_arrivals(spark, incoming, output, scratch_path(spark, "estado"), S.LOAD_DATE)
    stream.awaitTermination()
    summaries = spark.read.schema(
        "fecha_carga DATE, archivo STRING, regla STRING, dimension STRING, descripcion STRING, filas BIGINT"
    ).option("header", True).csv(f"{output}/resumen_reglas/*/*")
    return summaries.groupBy("regla", "dimension", "descripcion").agg(F.sum("filas").alias("filas"))


@query("s04_source_row")
def s04(spark, folder):
    return read_billing_file(spark, _billing_csv(spark, folder))


@query("s01_quoted_records")
def s01(spark, folder):
    """Files with line breaks, doubled quotes and commas inside quoted fields, and stray quotes elsewhere, read back."""
    path = scratch_path(spark, "facturacion-comillas")
    n = F.floor(F.col("fila_origen") / 10) % 5
    workers = F.when(n == 1, '7"').when(n == 2, '"a"" ""b"').otherwise("8")
    value = F.when(n == 2, '"1\n\n2"').when(n == 3, '"x,"y"z').when(n == 4, 'm"n"').otherwise("9")
    record = F.concat_ws(",", F.concat(F.lit("F"), F.col("fila_origen")), F.lit("2001-06"), workers, value)
    group = F.floor(F.col("fila_origen") / 100_000) % 32
    header = spark.range(32).select(F.col("id").alias("grupo"), F.lit(-1).cast("bigint").alias("fila_origen"))
    lines = _raw(spark, folder).select(group.alias("grupo"), "fila_origen")
    lines = lines.unionByName(header.join(lines.select("grupo").distinct(), "grupo"))
    # Numbers move and are sorted; the text is made where it is written.
    lines = lines.repartition("grupo").sortWithinPartitions("grupo", "fila_origen")
    lines.select("grupo", F.when(F.col("fila_origen") == -1, ",".join(bq.BILLING_COLUMNS)).otherwise(record).alias("value")).write.partitionBy("grupo").text(path)
    read = read_billing_files(spark, [path], path).records
    fila = F.col("id_cliente").substr(F.lit(2), F.length("id_cliente")).cast("bigint")
    return read.groupBy("periodo", "trabajadores_activos", "valor_contrato", (F.floor(fila / 10) % 5).alias("clase")).agg(
        F.count(F.lit(1)).alias("filas"), F.sum("fila_origen").alias("suma_filas"), F.max("fila_origen").alias("ultima"))


# -- portfolio indicators ------------------------------------------------------


def _history(spark, folder):
    return MappedTables(spark, folder).star(HISTORY.start, HISTORY.end)


@query("p21_filter_portfolio")
def p21(spark, folder):
    star = MappedTables(spark, folder).star()
    return portfolio.portfolio_sizes(portfolio.filter_portfolio(star, S.COORDINATOR, S.SECTORS, S.CLASSES))


@query("p47_assigned_portfolio")
def p47(spark, folder):
    star = MappedTables(spark, folder).star()
    assignments = star.clientes.select(
        F.concat(F.lit("usuario "), F.col("clase_riesgo").cast("string")).alias("usuario"), "id_cliente")
    return portfolio.portfolio_sizes(portfolio.assigned_portfolio(star, assignments, S.USER))


@query("p22_traffic_light")
def p22(spark, folder):
    """Status and compliance of the three indicators, in both directions, per sector and month."""
    series = portfolio.monthly_series(_history(spark, folder), S.MONTH, ["sector"], targets=S.NEAR_TARGETS)
    rate, cost = (
        traffic_light(F.col(a).cast("double"), F.col(b).cast("double"))
        for a, b in (("tasa", "meta_tasa"), ("costo", "presupuesto")))
    coverage = traffic_light(F.col("cobertura"), F.lit(S.NEAR_TARGETS.coverage), lower_is_better=False)
    return series.select(
        "sector", "periodo",
        rate[0].alias("estado_tasa"), rate[1].alias("cumplimiento_tasa"),
        cost[0].alias("estado_costo"), cost[1].alias("cumplimiento_costo"),
        coverage[0].alias("estado_cobertura"), coverage[1].alias("cumplimiento_cobertura"))


@query("p23_monthly_series")
def p23(spark, folder):
    return portfolio.monthly_series(_history(spark, folder), S.MONTH)


@query("p23_monthly_series_by_sector")
def p23_sector(spark, folder):
    return portfolio.monthly_series(_history(spark, folder), S.MONTH, ["sector"])


@query("p23_monthly_series_filtered")
def p23_filtered(spark, folder):
    star = portfolio.filter_portfolio(_history(spark, folder), None, S.SECTORS, S.CLASSES)
    return portfolio.monthly_series(star, S.MONTH)


@query("p24_client_series")
def p24(spark, folder):
    return portfolio.monthly_series(_history(spark, folder), S.MONTH, ["id_cliente"])


@query("p25_compare_periods")
def p25(spark, folder):
    return _rounded(
        portfolio.compare_periods(portfolio.monthly_series(_history(spark, folder), S.MONTH)), 6,
        "promedio_12m")


@query("p25_compare_periods_by_sector")
def p25_sector(spark, folder):
    series = portfolio.monthly_series(_history(spark, folder), S.MONTH, ["sector"])
    return _rounded(portfolio.compare_periods(series, ("casos", "costo", "tasa"), ["sector"]), 6, "promedio_12m")


@query("p26_streaks")
def p26(spark, folder):
    series = portfolio.monthly_series(_history(spark, folder), S.MONTH, targets=S.NEAR_TARGETS)
    return portfolio.target_streaks(series)


@query("p26_streaks_by_sector")
def p26_sector(spark, folder):
    series = portfolio.monthly_series(_history(spark, folder), S.MONTH, ["sector"], targets=S.NEAR_TARGETS)
    return portfolio.target_streaks(series, ["sector"])


def _month_star(spark, folder):
    """One month of cases and billing, and all prevention up to its end."""
    t = MappedTables(spark, folder)
    return t.star(S.MONTH, NEXT_MONTH, all_prevention=True)


def _summary(spark, folder, targets=B.Targets()):
    return worklists.client_month_summary(_month_star(spark, folder), S.MONTH, targets)


@query("p27_client_month_summary")
def p27(spark, folder):
    return _summary(spark, folder)


@query("p28_suggested_action")
def p28(spark, folder):
    return (
        _summary(spark, folder, S.NEAR_TARGETS)
        .groupBy("estado", "accion").agg(F.count(F.lit(1)).alias("clientes")))


def _year_star(spark, folder):
    return MappedTables(spark, folder).star(YEAR.start, YEAR.end)


@query("p29_rate_vs_target")
def p29(spark, folder):
    return segments.rate_vs_target(
        _year_star(spark, folder), YEAR.start, S.MONTH, ["coordinador", "clase_riesgo"])


@query("p30_sector_rate")
def p30(spark, folder):
    return segments.sector_rate(_month_star(spark, folder), S.MONTH)


@query("p30_sector_rate_near_targets")
def p30_near(spark, folder):
    return segments.sector_rate(_month_star(spark, folder), S.MONTH, S.NEAR_TARGETS)


@query("p31_sector_month")
def p31(spark, folder):
    return segments.sector_month(_year_star(spark, folder), S.MONTH)


@query("p32_sector_month_matrix")
def p32(spark, folder):
    by_month = segments.sector_month(_year_star(spark, folder), S.MONTH, targets=S.NEAR_TARGETS)
    return segments.sector_month_matrix(by_month, S.MONTH)


@query("p33_persistent_red")
def p33(spark, folder):
    return segments.persistent_red(segments.sector_month(_year_star(spark, folder), S.MONTH), S.MONTH)


@query("p34_case_distribution")
def p34(spark, folder):
    return segments.case_distribution(_month_star(spark, folder), S.MONTH)


@query("p35_case_mix")
def p35(spark, folder):
    return segments.case_mix(segments.case_distribution(_month_star(spark, folder), S.MONTH))


@query("p36_kpi_cards")
def p36(spark, folder):
    series = portfolio.monthly_series(_history(spark, folder), S.MONTH)
    return _rounded(portfolio.kpi_cards(series, S.MONTH), 6, "promedio_12m")


@query("p36_kpi_cards_near_targets")
def p36_near(spark, folder):
    series = portfolio.monthly_series(_history(spark, folder), S.MONTH, targets=S.NEAR_TARGETS)
    return _rounded(portfolio.kpi_cards(series, S.MONTH, targets=S.NEAR_TARGETS), 6, "promedio_12m")


@query("p37_support_metrics")
def p37(spark, folder):
    series = portfolio.monthly_series(_history(spark, folder), S.MONTH)
    return portfolio.support_metrics(series, _summary(spark, folder), S.MONTH)


@query("p38_key_message_facts")
def p38(spark, folder):
    series = portfolio.monthly_series(_history(spark, folder), S.MONTH)
    sectors = segments.sector_rate(_month_star(spark, folder), S.MONTH)
    return portfolio.key_message_facts(series, sectors, S.MONTH)


@query("p39_trend_12m")
def p39(spark, folder):
    series = portfolio.monthly_series(_history(spark, folder), S.MONTH, targets=S.NEAR_TARGETS)
    return _rounded(portfolio.trend_12m(series, S.MONTH), 6, "promedio_historico")


@query("p40_top_clients")
def p40(spark, folder):
    return worklists.top_clients(_summary(spark, folder))


@query("p41_worklist")
def p41(spark, folder):
    return worklists.worklist(_summary(spark, folder, S.NEAR_TARGETS))


@query("p41_worklist_high_risk_unvisited")
def p41_unvisited(spark, folder):
    return worklists.worklist(_summary(spark, folder), only_high_risk_unvisited=True)


@query("p42_client_month_cases")
def p42(spark, folder):
    return worklists.client_month_cases(_month_star(spark, folder), S.MONTH)


@query("p43_last_preventions")
def p43(spark, folder):
    return worklists.last_preventions(_month_star(spark, folder), S.MONTH)


@query("p44_months_without_prevention")
def p44(spark, folder):
    return worklists.months_without_prevention(_year_star(spark, folder), S.MONTH)


@query("p45_filter_facets")
def p45(spark, folder):
    return portfolio.filter_facets(MappedTables(spark, folder).star())


@query("p46_monthly_gold")
def p46(spark, folder):
    series = portfolio.monthly_series(_history(spark, folder), S.MONTH, ["id_cliente"])
    path = scratch_path(spark, "oro-mensual")
    portfolio.write_monthly_gold(series, path, ["id_cliente"])
    return portfolio.read_monthly_gold(spark, path, series.schema).select(*series.columns)


@query("j07_cardinality")
def j07(spark, folder):
    star = MappedTables(spark, folder).star()
    parts = [
        key_summary(star.clientes, "clientes", ["id_cliente"]),
        key_summary(star.casos, "casos", ["id_caso"]),
        key_summary(star.facturacion, "facturacion", ["id_cliente", "periodo"]),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# -- missing attributes, target table, warehouse ----------------------------------


def _with_gaps(star) -> Star:
    """Clients of two segments have no sector, and some no coordinator."""
    clients = star.clientes.withColumns({
        "sector": F.when(~F.col("sector").isin("FURNITURE", "AUTOMOBILE"), F.col("sector")),
        "coordinador": F.when(F.col("coordinador") != "NATION_3", F.col("coordinador")),
    })
    return Star(clients, star.casos, star.facturacion, star.prevencion)


@query("p23_monthly_series_missing_sector")
def p23_gaps(spark, folder):
    return portfolio.monthly_series(_with_gaps(_history(spark, folder)), S.MONTH, ["sector"])


@query("p29_rate_vs_target_missing_groups")
def p29_gaps(spark, folder):
    return segments.rate_vs_target(
        _with_gaps(_year_star(spark, folder)), YEAR.start, S.MONTH, ["sector", "coordinador"])


@query("s14_targets_table")
def s14(spark, folder):
    """Targets from a stored table that leaves a class out and names one without clients."""
    path = scratch_path(spark, "metas")
    spark.createDataFrame(S.STORED_TARGETS, "clase_riesgo INT, meta_tasa DECIMAL(9,4)").write.parquet(path)
    targets = targets_from_table(spark.read.parquet(path))
    return segments.rate_vs_target(_year_star(spark, folder), YEAR.start, S.MONTH, ["clase_riesgo"], targets)


@query("s09_star_round_trip")
def s09(spark, folder):
    """The star written to the warehouse and read back."""
    path = scratch_path(spark, "estrella")
    write_star(_year_star(spark, folder), path)
    return segments.rate_vs_target(
        read_star(spark, path), YEAR.start, S.MONTH, ["coordinador", "clase_riesgo"])
