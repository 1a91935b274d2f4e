"""Twelve quality controls over a staged snapshot, and the gate they feed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from vigia import business as B
from vigia.calendar import DailyCutoff
from vigia.functions.dates import day
from vigia.functions.numbers import ratio
from vigia.plans.snapshot import CRITICAL, NO_DATA

BLOCKING, WARNING = "BLOQUEANTE", "ADVERTENCIA"
PASS, FAIL = "OK", "FALLA"

# Code, description and severity of each control.
CONTROLS = (
    ("C01", "Filas del snapshot = clientes activos", BLOCKING),
    ("C02", "Sin clientes duplicados en el snapshot", BLOCKING),
    ("C03", "Días desde el último caso registrado (máx. 3)", BLOCKING),
    ("C04", "Casos acumulados del mes no disminuyen >2% vs ayer", BLOCKING),
    ("C05", "Casos del mes con cliente inexistente", BLOCKING),
    ("C06", "Casos del mes con tipo, fecha o cliente inválidos", BLOCKING),
    ("C07", "Casos con fecha de ocurrencia futura", WARNING),
    ("C08", "Casos del mes con costo o días de ausencia negativos", WARNING),
    ("C09", "id_caso duplicados", BLOCKING),
    ("C10", "% clientes sin trabajadores (tasa sin dato) <= 5%", WARNING),
    ("C11", "Clientes con tasa de incidencia > 50", WARNING),
    ("C12", "Clientes críticos no crecen más de 2x vs ayer", WARNING),
)
MAX_STALE_DAYS = 3
MIN_SHARE_OF_YESTERDAY = 0.98
MAX_NO_DATA_PERCENT = 5.0
MAX_PLAUSIBLE_RATE = 50


def _measures(
    staged: DataFrame, published: DataFrame, casos: DataFrame, clientes: DataFrame, cutoff: DailyCutoff
) -> DataFrame:
    """All figures the controls need, in one row: one aggregate per source, no scalar subqueries."""
    today = staged.filter(F.col("fecha_corte") == day(cutoff.day))
    before = published.filter(F.col("fecha_corte") == day(cutoff.previous_day))
    class_is = F.col("clasificacion")
    in_month = F.col("fecha_ocurrencia") >= day(cutoff.month_start)
    client, kind = F.col("id_cliente"), F.col("tipo")

    # Grouping by client first keeps the anti join at one row per client, whatever the busiest one holds.
    orphans = (
        casos.filter(in_month).groupBy("id_cliente").agg(F.count(F.lit(1)).alias("_n"))
        .join(clientes.select("id_cliente"), "id_cliente", "left_anti")
    )
    sources = [
        today.agg(
            F.count(F.lit(1)).alias("hoy_filas"),
            F.sum("casos_mes").alias("hoy_casos"),
            F.count_if(class_is == NO_DATA).alias("hoy_sin_dato"),
            F.count_if(F.col("tasa_incidencia") > MAX_PLAUSIBLE_RATE).alias("hoy_tasa_alta"),
            F.count_if(class_is == CRITICAL).alias("hoy_criticos"),
        ),
        today.agg(F.count_distinct("id_cliente").alias("hoy_clientes")),
        before.agg(
            F.sum("casos_mes").alias("ayer_casos"),
            F.count_if(class_is == CRITICAL).alias("ayer_criticos"),
        ),
        clientes.agg(F.count_if(F.col("estado") == B.ACTIVE).alias("activos")),
        casos.agg(
            F.count(F.lit(1)).alias("casos_filas"),
            F.max("fecha_ocurrencia").alias("ultimo_caso"),
            F.count_if(in_month & (client.isNull() | kind.isNull() | ~kind.isin(B.MILD, B.SERIOUS)))
            .alias("casos_invalidos"),
            F.count_if(F.col("fecha_ocurrencia") > day(cutoff.day)).alias("casos_futuros"),
            F.count_if(in_month & ((F.col("costo") < 0) | (F.col("dias_ausencia") < 0)))
            .alias("casos_negativos"),
        ),
        casos.agg(F.count_distinct("id_caso").alias("casos_distintos")),
        orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("casos_sin_cliente")),
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def quality_controls(
    staged: DataFrame, published: DataFrame, casos: DataFrame, clientes: DataFrame, cutoff: DailyCutoff
) -> DataFrame:
    """One row per control. A control whose figures are missing fails.

    ``staged`` and ``published`` may hold any number of days: only the cut-off and
    the day before it are read.
    """
    c = F.col
    zero = F.lit(0)
    stale = F.datediff(day(cutoff.day), c("ultimo_caso"))
    repeated_clients = c("hoy_filas") - c("hoy_clientes")
    repeated_cases = c("casos_filas") - c("casos_distintos")
    no_data = ratio(c("hoy_sin_dato") * 100, c("hoy_filas"))
    first_day = F.lit(cutoff.day == cutoff.month_start)
    checks: dict[str, tuple[Column, Column, Column]] = {
        "C01": (c("hoy_filas"), c("activos"), c("hoy_filas") == c("activos")),
        "C02": (repeated_clients, zero, repeated_clients == 0),
        "C03": (stale, F.lit(MAX_STALE_DAYS), stale <= MAX_STALE_DAYS),
        "C04": (
            c("hoy_casos"), c("ayer_casos"),
            first_day | (c("hoy_casos") >= F.lit(MIN_SHARE_OF_YESTERDAY) * c("ayer_casos"))),
        "C05": (c("casos_sin_cliente"), zero, c("casos_sin_cliente") == 0),
        "C06": (c("casos_invalidos"), zero, c("casos_invalidos") == 0),
        "C07": (c("casos_futuros"), zero, c("casos_futuros") == 0),
        "C08": (c("casos_negativos"), zero, c("casos_negativos") == 0),
        "C09": (repeated_cases, zero, repeated_cases == 0),
        "C10": (no_data, F.lit(MAX_NO_DATA_PERCENT), no_data <= MAX_NO_DATA_PERCENT),
        "C11": (c("hoy_tasa_alta"), zero, c("hoy_tasa_alta") == 0),
        "C12": (
            c("hoy_criticos"), c("ayer_criticos"),
            c("hoy_criticos") <= c("ayer_criticos") * 2 + 3),
    }
    rows = [
        F.struct(
            day(cutoff.day).alias("fecha_corte"),
            F.lit(code).alias("control"),
            F.lit(text).alias("descripcion"),
            F.lit(severity).alias("severidad"),
            checks[code][0].cast("double").alias("valor"),
            checks[code][1].cast("double").alias("esperado"),
            F.when(checks[code][2], PASS).otherwise(FAIL).alias("resultado"),
            F.current_timestamp().alias("fecha_ejecucion"),
        )
        for code, text, severity in CONTROLS
    ]
    measures = _measures(staged, published, casos, clientes, cutoff)
    return (
        measures.select(F.inline(F.array(*rows)))
        .orderBy(F.when(F.col("severidad") == BLOCKING, 0).otherwise(1), "control")
    )


def failures(controls: DataFrame) -> tuple[list[str], list[str]]:
    """Codes that forbid publication and codes to warn of; at most one row per control comes to the driver."""
    rows = controls.filter(F.col("resultado") == FAIL).select("control", "severidad").orderBy("control").collect()
    return [r.control for r in rows if r.severidad == BLOCKING], [r.control for r in rows if r.severidad != BLOCKING]


def control_history(history: DataFrame) -> DataFrame:
    """Trend of each control over its stored runs, the last run of a day counting for that day."""
    per_day = history.groupBy("control", "severidad", "fecha_corte").agg(
        F.max_by("resultado", "fecha_ejecucion").alias("resultado"),
        F.max_by("valor", "fecha_ejecucion").alias("valor"),
        F.count(F.lit(1)).alias("ejecuciones"),
    )
    failed = F.col("resultado") == FAIL
    return (
        per_day.groupBy("control", "severidad")
        .agg(
            F.count(F.lit(1)).alias("dias"),
            F.sum("ejecuciones").alias("ejecuciones"),
            F.count_if(failed).alias("dias_con_falla"),
            F.max(F.when(failed, F.col("fecha_corte"))).alias("ultima_falla"),
            F.max_by("valor", "fecha_corte").alias("ultimo_valor"),
        )
        .orderBy("control")
    )
