"""Monthly indicators of the portfolio or of any grouping of its clients.

``by`` names client columns (``sector``, ``clase_riesgo``, ``coordinador``,
``id_cliente`` …). One run covers every group and every month of the window; an
empty ``by`` is the whole portfolio.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from vigia import business as B
from vigia.calendar import MonthWindow, shift_months
from vigia.functions.dates import day, from_until
from vigia.functions.numbers import ratio, relative_change
from vigia.functions.status import high_risk, traffic_light, whole_percent
from vigia.functions.targets import class_target, expected_cases
from vigia.operators.cardinality import one_per_key
from vigia.operators.spine import entity_months
from vigia.operators.streaks import streaks
from vigia.sources.star import StarTables

SERIES = (
    "periodo", "casos", "graves", "dias_ausencia", "costo", "trabajadores", "casos_meta", "tasa",
    "meta_tasa", "presupuesto", "clientes_riesgo_alto", "riesgo_alto_con_prevencion", "cobertura",
)
METRICS = ("casos", "graves", "dias_ausencia", "costo", "trabajadores", "tasa", "cobertura")


def filter_portfolio(
    star: StarTables,
    coordinator: str | None = None,
    sectors: Sequence[str] | None = None,
    classes: Sequence[int] | None = None,
    active_only: bool = False,
) -> StarTables:
    """The star of the chosen clients; ``None`` leaves a filter out."""
    clients = star.clientes
    if sectors is not None:
        clients = clients.filter(F.col("sector").isin(*sectors))
    if classes is not None:
        clients = clients.filter(F.col("clase_riesgo").isin(*classes))
    if coordinator is not None:
        clients = clients.filter(F.col("coordinador") == coordinator)
    if active_only:
        clients = clients.filter(F.col("estado") == B.ACTIVE)
    return star.with_clients(clients)


def assigned_portfolio(star: StarTables, assignments: DataFrame, user: str) -> StarTables:
    """The star of the clients assigned to a user (``usuario``, ``id_cliente``)."""
    own = assignments.filter(F.col("usuario") == user).select("id_cliente")
    return star.with_clients(star.clientes.join(own, "id_cliente", "left_semi"))


def portfolio_sizes(star: StarTables) -> DataFrame:
    """Rows and clients of the four tables; facts are counted per client before they meet the choice of clients."""
    ids = star.clientes.select("id_cliente")
    parts = [ids.groupBy("id_cliente").agg(F.count(F.lit(1)).alias("_n")).select(F.lit("clientes").alias("tabla"), "_n")]
    for name in ("facturacion", "casos", "prevencion"):
        per_client = star.fact(name).groupBy("id_cliente").agg(F.count(F.lit(1)).alias("_n"))
        if star.restricted:
            per_client = per_client.join(ids, "id_cliente", "left_semi")
        parts.append(per_client.select(F.lit(name).alias("tabla"), "_n"))
    names = F.array(*[F.lit(n) for n in ("clientes", "facturacion", "casos", "prevencion")])
    parts.append(ids.sparkSession.range(1).select(F.explode(names).alias("tabla"), F.lit(0).cast("bigint").alias("_n")))
    return reduce(DataFrame.unionByName, parts).groupBy("tabla").agg(
        F.sum("_n").alias("filas"), F.count_if(F.col("_n") > 0).alias("clientes"))


CASE_MEASURES = ("casos", "graves", "dias_ausencia", "costo")


def _in_window(frame: DataFrame, window: MonthWindow) -> DataFrame:
    return frame.filter(from_until(F.col("periodo"), window.start, window.month))


def _cases_by_month(star: StarTables, clients: DataFrame, by: list[str], window: MonthWindow) -> DataFrame:
    """Case measures per group and month; cases go to one row per client and month before any join."""
    facts = _in_window(star.fact("casos"), window)
    measures = [
        F.count("id_caso").alias("casos"),
        F.count_if(F.col("tipo") == B.SERIOUS).alias("graves"),
        F.sum("dias_ausencia").alias("dias_ausencia"),
        F.sum("costo").alias("costo"),
    ]
    if not by and not star.restricted:
        return facts.groupBy("periodo").agg(*measures)
    per_client = facts.groupBy("id_cliente", "periodo").agg(*measures)
    return (
        per_client.join(clients.select("id_cliente", *by), "id_cliente", "inner" if by else "left_semi")
        .groupBy(*by, "periodo").agg(*[F.sum(c).alias(c) for c in CASE_MEASURES])
    )


def _workers_by_month(
    star: StarTables, clients: DataFrame, by: list[str], window: MonthWindow, targets: B.Targets
) -> DataFrame:
    # One row per client and month whatever the table holds: no client can crowd the join.
    billed = _in_window(star.fact("facturacion"), window).groupBy("id_cliente", "periodo").agg(
        F.sum("trabajadores_activos").alias("_n"))
    return (
        billed.join(one_per_key(clients, "id_cliente"), "id_cliente")
        .groupBy(*by, "periodo")
        .agg(
            F.sum("_n").alias("trabajadores"),
            expected_cases(F.col("_n"), F.col("clase_riesgo"), targets).alias("casos_meta"),
        )
    )


def _group_months(
    star: StarTables, clients: DataFrame, by: list[str], window: MonthWindow, targets: B.Targets
) -> DataFrame:
    """Months of groups larger than a client: one aggregate per fact, stacked and summed.

    Nothing is joined at the group, so a missing sector is a group like any other.
    """
    # Today's high-risk list is the denominator of every month.
    exposed = clients.filter(high_risk(F.col("clase_riesgo")))
    visited = (
        _in_window(star.fact("prevencion"), window).select("id_cliente", "periodo").distinct()
        .join(exposed.select("id_cliente", *by), "id_cliente", "inner" if by else "left_semi")
        .groupBy(*by, "periodo").agg(F.count(F.lit(1)).alias("riesgo_alto_con_prevencion"))
    )
    # A count without groups is one row even when there is nothing to count.
    counted = clients.groupBy(*by).agg(
        F.count_if(high_risk(F.col("clase_riesgo"))).alias("clientes_riesgo_alto"), F.lit(True).alias("_eje"))
    stacked = entity_months(counted, window)
    for part in (
        _cases_by_month(star, clients, by, window), _workers_by_month(star, clients, by, window, targets), visited
    ):
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    sums = (*CASE_MEASURES, "trabajadores", "casos_meta", "clientes_riesgo_alto", "riesgo_alto_con_prevencion")
    return stacked.groupBy(*by, "periodo").agg(
        F.max("_eje").alias("_eje"), *[F.sum(c).alias(c) for c in sums]).filter("_eje")


def _client_months(
    star: StarTables, clients: DataFrame, window: MonthWindow, targets: B.Targets
) -> DataFrame:
    """Months of every client with a single shuffle of months and no join.

    The month axis and the three facts are stacked and summed by client and month. The axis has a row for each
    sum, so its share of the partial sums is as large as the task: clients are spread before they have months.
    Rows of clients outside the dimension have no axis row and drop out.
    """
    axis = entity_months(clients, window, "id_cliente").withColumn("_eje", F.lit(1))
    cases = _in_window(star.fact("casos"), window).select(
        "id_cliente", "periodo", F.when(F.col("id_caso").isNotNull(), 1).alias("casos"),
        F.when(F.col("tipo") == B.SERIOUS, 1).alias("graves"), "dias_ausencia", "costo")
    billed = _in_window(star.fact("facturacion"), window).select(
        "id_cliente", "periodo", F.col("trabajadores_activos").alias("trabajadores"))
    visits = _in_window(star.fact("prevencion"), window).select("id_cliente", "periodo", F.lit(1).alias("_visitas"))
    stacked = axis
    for fact in (cases, billed, visits):
        stacked = stacked.unionByName(fact, allowMissingColumns=True)
    months_of_clients = stacked.groupBy("id_cliente", "periodo").agg(
        F.sum("_eje").alias("_eje"), F.max("clase_riesgo").alias("clase_riesgo"),
        *[F.sum(c).alias(c) for c in (*CASE_MEASURES, "trabajadores", "_visitas")])
    repeated = F.raise_error(F.concat(F.lit("id_cliente repetido: "), "id_cliente")).cast("boolean")
    known = F.when(F.col("_eje") > 1, repeated).otherwise(F.col("_eje") == 1)
    exposed = high_risk(F.col("clase_riesgo"))
    target = class_target(F.col("clase_riesgo"), targets)
    return months_of_clients.filter(known).withColumns(
        {
            "casos_meta": (F.col("trabajadores").cast("decimal(20,0)") * target).cast("double") / F.lit(100.0),
            "clientes_riesgo_alto": exposed.cast("bigint"),
            "riesgo_alto_con_prevencion": (exposed & (F.col("_visitas") > 0)).cast("bigint"),
        }
    )


def monthly_series(
    star: StarTables,
    month: date,
    by: Sequence[str] = (),
    months_back: int = B.HISTORY_MONTHS,
    targets: B.Targets = B.Targets(),
) -> DataFrame:
    """One row per group and month: cases, cost, workers, rate, target, budget and prevention coverage.

    Months without data are rows too: counts and cost are 0, workers and ratios NULL.
    Rates are sums over sums, never means of rates. A repeated client fails the job.
    """
    by = list(by)
    window = MonthWindow(month, months_back)
    clients = star.clientes.select(*dict.fromkeys(["id_cliente", "clase_riesgo", *by]))
    if by == ["id_cliente"]:
        series = _client_months(star, clients, window, targets)
    elif "id_cliente" in by:  # the client determines its other columns
        others = [c for c in by if c not in ("id_cliente", "clase_riesgo")]
        series = _client_months(star, clients.select("id_cliente", "clase_riesgo"), window, targets).join(
            clients.select("id_cliente", *others), "id_cliente")
    else:
        series = _group_months(star, clients, by, window, targets)
    people = F.col("trabajadores").cast("double")
    return series.withColumns(
        {
            name: F.coalesce(name, F.lit(0))
            for name in (*CASE_MEASURES, "clientes_riesgo_alto", "riesgo_alto_con_prevencion")
        }
    ).withColumns(
        {
            "tasa": ratio(F.col("casos"), people) * 100,
            "meta_tasa": ratio(F.col("casos_meta"), people) * 100,
            "presupuesto": F.col("trabajadores") * F.lit(str(targets.cost_per_worker)).cast("decimal(18,2)"),
            "cobertura": ratio(F.col("riesgo_alto_con_prevencion"), F.col("clientes_riesgo_alto")),
        }
    ).select(*by, *SERIES)


def with_history(series: DataFrame, metrics: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Adds to each month, per metric, the previous month, the change and the mean of the twelve before.

    The series is dense, so the previous row is the previous month. The mean leaves
    the month itself out and skips missing values. All metrics share one window.
    """
    in_order = Window.partitionBy(*by).orderBy("periodo")
    added = {}
    for name in metrics:
        value = F.col(name).cast("double")
        added[f"{name}_anterior"] = F.lag(value).over(in_order)
        added[f"{name}_promedio_12m"] = F.avg(value).over(in_order.rowsBetween(-12, -1))
    extended = series.withColumns(added)
    return extended.withColumns(
        {
            f"{name}_variacion": relative_change(F.col(name).cast("double"), F.col(f"{name}_anterior"))
            for name in metrics
        }
    )


def compare_periods(
    series: DataFrame, metrics: Sequence[str] = METRICS, by: Sequence[str] = ()
) -> DataFrame:
    """Per group, month and metric: value, previous month, change and mean of the twelve months before."""
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("metrica"),
                F.col(name).cast("double").alias("actual"),
                F.col(f"{name}_anterior").alias("anterior"),
                F.col(f"{name}_variacion").alias("variacion"),
                F.col(f"{name}_promedio_12m").alias("promedio_12m"),
            )
            for name in metrics
        ]
    )
    return with_history(series, metrics, by).select(*by, "periodo", F.inline(rows))


def _with_streaks(series: DataFrame, by: Sequence[str]) -> DataFrame:
    return streaks(
        series, F.col("tasa") > F.col("meta_tasa"), list(by), "periodo", "n_meses", "sobre_meta")


def target_streaks(series: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Months in a row that the rate has been on the same side of its target, up to each month.

    A missing rate counts as within the target.
    """
    return _with_streaks(series, by).select(*by, "periodo", "n_meses", "sobre_meta")


def kpi_cards(
    series: DataFrame, month: date, by: Sequence[str] = (), targets: B.Targets = B.Targets()
) -> DataFrame:
    """Three indicators with a target for one month: rate, cost and prevention coverage."""
    goals = {
        "tasa": (F.col("meta_tasa"), True),
        "costo": (F.col("presupuesto").cast("double"), True),
        "cobertura": (F.lit(float(targets.coverage)), False),
    }
    cards = []
    for name, (goal, lower) in goals.items():
        status, reached = traffic_light(F.col(name).cast("double"), goal, lower)
        cards.append(
            F.struct(
                F.lit(name).alias("kpi"), F.col(name).cast("double").alias("valor"), goal.alias("meta"),
                status.alias("estado"), reached.alias("cumplimiento"),
                whole_percent(reached).alias("cumplimiento_pct"),
                F.col(f"{name}_variacion").alias("variacion"),
                F.col(f"{name}_promedio_12m").alias("promedio_12m"),
            )
        )
    return (
        with_history(series, list(goals), by).filter(F.col("periodo") == day(month))
        .select(*by, F.inline(F.array(*cards)))
    )


def support_metrics(series: DataFrame, summary: DataFrame, month: date) -> DataFrame:
    """Context without a target of its own: cases, serious cases, absence days and clients out of target."""
    moved = (
        compare_periods(series, ("casos", "graves", "dias_ausencia"))
        .filter(F.col("periodo") == day(month))
        .select("metrica", "actual", "variacion", F.lit(None).cast("bigint").alias("total_clientes"))
    )
    out = summary.agg(
        F.lit("clientes_fuera_de_meta").alias("metrica"),
        F.count_if(F.col("estado") == B.RED).cast("double").alias("actual"),
        F.lit(None).cast("double").alias("variacion"),
        F.count(F.lit(1)).alias("total_clientes"),
    )
    return moved.unionByName(out)


def trend_12m(
    series: DataFrame, month: date, by: Sequence[str] = (), months_shown: int = 12
) -> DataFrame:
    """Rate, target and status of the last months, with the mean rate of all history up to the month."""
    by = list(by)
    known = series.filter(F.col("periodo") <= day(month))
    so_far = Window.partitionBy(*by)
    status, reached = traffic_light(F.col("tasa"), F.col("meta_tasa"))
    return (
        known.withColumn("promedio_historico", F.avg("tasa").over(so_far))
        .filter(F.col("periodo") > day(shift_months(month, -months_shown)))
        .select(*by, "periodo", "casos", "tasa", "meta_tasa", status.alias("estado"),
                reached.alias("cumplimiento"), "promedio_historico")
        .orderBy(*by, "periodo")
    )


def key_message_facts(
    series: DataFrame, sectors: DataFrame, month: date
) -> DataFrame:
    """The facts of the month in one row: rate and target, streak, change, worst sectors, unvisited clients."""
    status, reached = traffic_light(F.col("tasa"), F.col("meta_tasa"))
    missing = F.col("clientes_riesgo_alto") - F.col("riesgo_alto_con_prevencion")
    facts = _with_streaks(with_history(series, ("tasa",)), ()).filter(F.col("periodo") == day(month)).select(
        "periodo", "tasa", "meta_tasa", status.alias("estado"), reached.alias("cumplimiento"),
        whole_percent(reached).alias("cumplimiento_pct"),
        "clientes_riesgo_alto", missing.alias("riesgo_alto_sin_prevencion"),
        "n_meses", "sobre_meta", F.col("tasa_variacion").alias("variacion"),
    )
    red = sectors.filter(F.col("estado") == B.RED)
    # One row per sector, worst first; ties by name, so the choice does not depend on the run.
    worst = Window.orderBy("cumplimiento", "sector")
    named = red.withColumn("_n", F.row_number().over(worst)).agg(
        day(month).alias("periodo"),
        F.count(F.lit(1)).alias("sectores_rojos"),
        F.max(F.when(F.col("_n") == 1, F.col("sector"))).alias("sector_rojo_1"),
        F.max(F.when(F.col("_n") == 2, F.col("sector"))).alias("sector_rojo_2"),
    )
    # Two one-row results side by side: stacked and collapsed, which needs no join.
    stacked = facts.unionByName(named, allowMissingColumns=True)
    others = [c for c in stacked.columns if c != "periodo"]
    return stacked.groupBy("periodo").agg(*[F.max(c).alias(c) for c in others])


def write_monthly_gold(series: DataFrame, folder: str, by: Sequence[str]) -> None:
    """Store a series for readers, one folder per month, rows of a group close together.

    A range over month and group lets a month span as many tasks as its size needs,
    and sorted files let a reader of one client skip most of them.
    """
    order = ["periodo", *by]
    (series.repartitionByRange(*order).sortWithinPartitions(*order)
     .write.mode("overwrite").partitionBy("periodo").parquet(folder))


def read_monthly_gold(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(folder)


def filter_facets(star: StarTables, months_shown: int = 12) -> DataFrame:
    """Choices offered to a reader: latest billed months, sectors and coordinators."""
    billed = (
        star.facturacion.select("periodo").distinct().orderBy(F.desc_nulls_last("periodo")).limit(months_shown)
    )
    lists = [
        billed.select(F.lit("periodo").alias("faceta"), F.date_format("periodo", "yyyy-MM-dd").alias("valor"))
    ]
    for name in ("sector", "coordinador"):
        lists.append(
            star.clientes.select(F.lit(name).alias("faceta"), F.col(name).alias("valor")).distinct())
    return lists[0].unionByName(lists[1]).unionByName(lists[2])
