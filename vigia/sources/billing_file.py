"""The incoming billing files: everything is text until the rules have seen it.

A field may be quoted and then hold commas, doubled quotes and line breaks; a quote anywhere else is text.
Each file has its own header, so files with other column
orders can arrive together; fields are matched by name. A record with more fields
than its header, or a quote that never closes, makes the file unreadable and is named. Missing fields at the end are blank.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, Window, functions as F

from vigia.durable import COMPACT, Workspace, remove
from vigia.operators.lookup import lookup
from vigia.operators.ordinal import numbered_records
from vigia.schemas import BILLING_COLUMNS

# A quote inside a quoted field is doubled; a backslash is an ordinary character.
DIALECT = {"quote": '"', "escape": '"', "encoding": "UTF-8"}
# Written text keeps its outer blanks: people compare it with the file they sent.
AS_RECEIVED = {
    "header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "emptyValue": "",
    **DIALECT,
}
NO_RECORDS = "El archivo no tiene registros"


class BillingFileError(ValueError):
    """The file cannot be validated at all."""


@dataclass(frozen=True)
class BillingLines:
    """Records of the readable files, and a problem for each of the others.

    ``records``: archivo, fila_origen (the line; the header is line 1) and the four
    columns as text, blanks kept as ``""``. ``problems``: archivo, problema.
    """

    records: DataFrame
    problems: DataFrame


def _names(header: list[str]) -> tuple[str, ...]:
    return tuple(name.strip().lower() for name in header)


def load_name(path: str, root: str) -> str:
    """The name of a load: the path of its file below ``root``."""
    return unquote(path).rsplit(f"{root.rstrip('/').split(':')[-1].lstrip('/')}/", 1)[-1]


def read_billing_files(spark: SparkSession, paths: list[str], root: str | None = None) -> BillingLines:
    """Read files of any number; ``archivo`` is the path below ``root`` or the last part of the path.

    The text is scanned once; records, headers and problems come from the stored records.
    """
    with Workspace(spark) as work:
        found = numbered_records(spark, paths, work)
        full = F.url_decode(F.replace("archivo", F.lit("+"), F.lit("%2B")))
        if root is None:
            name = F.element_at(F.split(full, "/"), -1)
        else:
            name = F.substring_index(full, f"{root.rstrip('/').split(':')[-1].lstrip('/')}/", -1)
        # One row per file; one spelling of the header for many files.
        headers = found.records.filter("fila = 1").select("archivo", F.col("campos").alias("_encabezado"))
        sizes = found.records.filter("fila > 1").groupBy("archivo").agg(F.count(F.lit(1)).alias("_n"))
        files = work.stored(headers.join(sizes, "archivo", "full").fillna(0, ["_n"]), "archivos")
        spellings = {tuple(r._encabezado): _names(r._encabezado) for r in files.filter("_encabezado IS NOT NULL").select("_encabezado").distinct().collect()}

        def by_header(value):
            """A literal for each spelling of the header."""
            return reduce(
                lambda made, item: made.when(F.col("_encabezado") == F.array(*[F.lit(n) for n in item[0]]), value(item[1])),
                spellings.items(), F.when(F.lit(False), value(())))

        body = lookup(found.records.filter("fila > 1"), files, ["archivo"], "_n")
        expected = by_header(lambda names: F.lit(len(names)))
        cells = by_header(lambda names: F.array(*[
            F.coalesce(F.get("campos", F.lit(names.index(c))), F.lit("")) if c in names else F.lit("") for c in BILLING_COLUMNS]))
        damaged = F.size("campos") > F.coalesce(expected, F.lit(0))
        read = work.kept(
            body.select("archivo", F.col("fila").alias("fila_origen"), damaged.alias("_danado"), cells.alias("_celdas")).select(
                name.alias("archivo"), "fila_origen", "_danado", *[F.get("_celdas", F.lit(i)).alias(c) for i, c in enumerate(BILLING_COLUMNS)]),
            "facturacion-texto", COMPACT)

        damage = read.filter("_danado").groupBy("archivo").agg(F.min("fila_origen").alias("_larga"))
        missing = by_header(lambda names: F.lit(
            None if set(BILLING_COLUMNS) <= set(names) else f"Faltan columnas obligatorias: {[c for c in BILLING_COLUMNS if c not in names]}").cast("string"))
        state = files.join(found.unclosed.withColumnRenamed("fila", "_abierta"), "archivo", "full").select(
            name.alias("archivo"), "_encabezado", F.coalesce("_n", F.lit(0)).alias("_n"), "_abierta").join(damage, "archivo", "left")
        line = F.least("_larga", "_abierta")
        why = F.when(line == F.col("_abierta"), "comillas sin cerrar").otherwise("más campos que el encabezado")
        problem = F.coalesce(missing, F.when(line.isNotNull(), F.format_string("Fila %d: %s", line, why)), F.when(F.col("_n") == 0, NO_RECORDS))
        problems = work.kept(state.select("archivo", problem.alias("problema")).filter("problema IS NOT NULL"), "cargas-ilegibles")
        return BillingLines(read.drop("_danado"), problems)


def read_billing_file(spark: SparkSession, path: str) -> DataFrame:
    """One load: a file or a folder of part files, which count as one file in name order.

    Fails with the first problem of any part. Names are trimmed and lower-cased.
    """
    try:
        read = read_billing_files(spark, [path])
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"No existe el archivo {path}") from problem
        raise
    first = read.problems.filter(F.col("problema") != NO_RECORDS).orderBy("archivo").first()
    if first is not None:
        raise BillingFileError(f"{first.archivo}: {first.problema}")
    # Part files are one file: what they hold before, without their headers, is added. A row per part file.
    sizes = read.records.groupBy("archivo").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.withColumn("_antes", F.sum("_n").over(Window.orderBy("archivo")) - F.col("_n"))
    counted = before.agg(F.count(F.lit(1)).alias("archivos")).head().archivos
    if counted == 0:
        raise BillingFileError(NO_RECORDS)
    if counted == 1:
        return read.records.drop("archivo")
    return lookup(read.records, before, ["archivo"], "_n").select(
        (F.col("fila_origen") + F.col("_antes")).alias("fila_origen"), *BILLING_COLUMNS)


# -- results of a load -----------------------------------------------------------

VALID, REJECTED, SUMMARY, REPORT, UNREADABLE = (
    "facturacion_validos", "facturacion_rechazados", "resumen_reglas", "reporte_calidad", "cargas_con_error")


def clear_load(spark: SparkSession, folder: str, load_date: date, name: str) -> None:
    """Remove what an earlier run of the same load left, also where the new run leaves nothing."""
    escaped = "".join(f"%{ord(c):02X}" if ord(c) < 32 or c in "\"#%'*/:=?\\\x7f{}[]^" else c for c in name)
    for table in (VALID, REJECTED, SUMMARY, REPORT, UNREADABLE):
        remove(spark, f"{folder}/{table}/carga={load_date}/origen={escaped}")


#: Loads a task writes side by side. Only rows of further loads are sorted by load.
OPEN_LOADS = 16
_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def _per_load(frame: DataFrame) -> Iterator[DataFrameWriter]:
    """Results stand side by side by load date and file, in folders named ``carga`` and ``origen``.

    Without files held open Spark sorts all rows of a task by folder, texts and reasons included, also when
    there is one load only.
    """
    conf = frame.sparkSession.conf
    before = conf.get(_OPEN_FILES)
    conf.set(_OPEN_FILES, OPEN_LOADS)
    try:
        yield (
            frame.withColumns({"carga": F.col("fecha_carga"), "origen": F.col("archivo")})
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("carga", "origen"))
    finally:
        conf.set(_OPEN_FILES, before)


def write_valid(valid: DataFrame, folder: str) -> None:
    with _per_load(valid) as write:
        write.parquet(f"{folder}/{VALID}")


def write_rejected(rejected: DataFrame, folder: str) -> None:
    """CSV with a header, for people to review and correct at the source."""
    with _per_load(rejected) as write:
        write.options(**AS_RECEIVED).csv(f"{folder}/{REJECTED}")


def write_rule_summary(summary: DataFrame, folder: str) -> None:
    with _per_load(summary) as write:
        write.option("header", True).csv(f"{folder}/{SUMMARY}")


def write_report(report: DataFrame, folder: str) -> None:
    """One nested JSON document per load, with its date and file."""
    with _per_load(report) as write:
        write.json(f"{folder}/{REPORT}")


def write_unreadable(problems: DataFrame, load_date: date, folder: str) -> None:
    """Record the files that could not be validated at all."""
    rows = problems.select(F.lit(load_date).alias("fecha_carga"), "archivo", F.col("problema").alias("error"))
    with _per_load(rows) as write:
        write.json(f"{folder}/{UNREADABLE}")
