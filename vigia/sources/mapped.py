"""The star schema as views over order tables (customer, nation, orders, lineitem).

Used by the registered queries and tests. ``since`` and ``until`` are month
starts; they bound the raw date column, where the file scan can use them.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vigia.functions.dates import day, month_of
from vigia.functions.text import MONTH_NAMES
from vigia.schemas import MONEY
from vigia.sources.star import StarTables

UNKNOWN_CLIENT = "CLI-999999"

# Declared, so that opening a table reads no file.
SCHEMAS = {
    "nation": "n_nationkey INT, n_name STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"),
    "lineitem": (
        "l_orderkey BIGINT, l_quantity DOUBLE, l_extendedprice DOUBLE, l_returnflag STRING, "
        "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"),
}


def _client_id(customer_key: Column) -> Column:
    return F.format_string("CLI-%04d", customer_key + 1)


def _between(frame: DataFrame, column: str, since: date | None, until: date | None) -> DataFrame:
    value = F.to_date(column)
    if since is not None:
        frame = frame.filter(value >= day(since))
    if until is not None:
        frame = frame.filter(value < day(until))
    return frame


class MappedTables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    def clientes(self) -> DataFrame:
        nations = self.raw("nation").select("n_nationkey", "n_name")
        return (
            self.raw("customer")
            .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                _client_id(F.col("c_custkey")).alias("id_cliente"),
                F.col("c_name").alias("nombre"),
                F.col("c_mktsegment").alias("sector"),
                (F.col("c_custkey") % 5 + 1).cast("int").alias("clase_riesgo"),
                F.col("n_name").alias("coordinador"),
                F.when(F.col("c_acctbal") >= 0, "activo").otherwise("inactivo").alias("estado"),
            )
        )

    def casos(self, since: date | None = None, until: date | None = None) -> DataFrame:
        orders = _between(self.raw("orders"), "o_orderdate", since, until)
        occurred = F.to_date("o_orderdate")
        return orders.select(
            F.col("o_orderkey").alias("id_caso"),
            _client_id(F.col("o_custkey")).alias("id_cliente"),
            month_of(occurred).alias("periodo"),
            F.when(F.col("o_orderpriority") == "1-URGENT", "grave").otherwise("leve").alias("tipo"),
            (F.col("o_orderkey") % 30).cast("int").alias("dias_ausencia"),
            F.col("o_totalprice").cast(MONEY).alias("costo"),
            occurred.alias("fecha_ocurrencia"),
            F.when(F.col("o_orderstatus") == "O", "abierto").otherwise("cerrado").alias("estado"),
        )

    def _shipped(self, since: date | None, until: date | None, *columns: Column) -> DataFrame:
        """The columns of the lines with their customer; lines move as narrow as the columns are."""
        lines = _between(self.raw("lineitem"), "l_shipdate", since, until).select("l_orderkey", *columns)
        owners = self.raw("orders").select("o_orderkey", "o_custkey")
        return lines.join(owners, F.col("l_orderkey") == F.col("o_orderkey"))

    def facturacion(self, since: date | None = None, until: date | None = None) -> DataFrame:
        # Whole cents: a sum of long decimals takes three times the room in a shuffle.
        cents = (F.col("l_extendedprice").cast(MONEY) * 100).cast("bigint").alias("centavos")
        return (
            self._shipped(since, until, month_of(F.to_date("l_shipdate")).alias("periodo"), F.col("l_quantity"), cents)
            .groupBy("o_custkey", "periodo")
            .agg(
                F.sum("l_quantity").cast("int").alias("trabajadores_activos"),
                (F.sum("centavos").cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast(MONEY).alias("valor_contrato"),
            )
            .select(
                _client_id(F.col("o_custkey")).alias("id_cliente"), "periodo",
                "trabajadores_activos", "valor_contrato",
            )
        )

    def prevencion(self, since: date | None = None, until: date | None = None) -> DataFrame:
        fecha = F.to_date("l_shipdate").alias("fecha")
        return (
            self._shipped(since, until, fecha, F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_quantity"))
            .filter(F.col("l_returnflag") == "R")
            .select(
                _client_id(F.col("o_custkey")).alias("id_cliente"),
                month_of(F.col("fecha")).alias("periodo"),
                "fecha",
                F.col("l_linestatus").alias("tipo"),
                F.col("l_quantity").cast("int").alias("participantes"),
            )
        )

    def star(
        self, since: date | None = None, until: date | None = None, all_prevention: bool = False
    ) -> MappedStar:
        """Facts of a date range; ``all_prevention`` takes prevention from its beginning."""
        return MappedStar(self, since, until, None if all_prevention else since)

    def defective_casos(self, cutoff: date) -> DataFrame:
        """Cases with seeded defects, by the case number modulo small primes."""
        key = F.col("id_caso")
        broken = self.casos().select(
            "id_caso",
            F.when(key % 89 == 0, UNKNOWN_CLIENT).otherwise(F.col("id_cliente")).alias("id_cliente"),
            "periodo",
            F.when(key % 97 != 0, F.col("tipo")).alias("tipo"),
            "dias_ausencia",
            F.when(key % 83 == 0, -F.col("costo")).otherwise(F.col("costo")).cast(MONEY).alias("costo"),
            F.when(key % 107 == 0, F.lit(None))
            .when(key % 103 == 0, F.date_add(day(cutoff), 5))
            .otherwise(F.col("fecha_ocurrencia")).alias("fecha_ocurrencia"),
            "estado",
        )
        return broken.unionByName(broken.filter(key % 101 == 0))

    def raw_billing(self, arranged: Callable[[DataFrame, Column], DataFrame] = lambda rows, line: rows) -> DataFrame:
        """All billing as untidy text: every spelling the readers accept and a breach of every rule.

        ``fila_origen`` is client · 100000 + month · 10 + copy: it keeps the order of a
        file sorted by client, month and copy without sorting. The months count from 1990.
        ``arranged`` sorts or moves the billed months by the ``fila_origen`` of their first line, before they
        are spelled out as text, which is wider.
        """
        p = F.col("periodo")
        month = (F.year(p) - 1990) * 12 + F.month(p)
        client = F.substr("id_cliente", F.lit(5)).cast("bigint")
        billed = arranged(self.facturacion(), client * 100_000 + month * 10)
        rows = billed.select(
            "id_cliente", p, client.alias("n"), month.alias("m"),
            F.col("trabajadores_activos").cast("string").alias("t"), F.col("valor_contrato").alias("v"))
        n, m, t = F.col("n"), F.col("m"), F.col("t")
        draw = (23 * n + m) % 50
        # A second line that repeats the first, or contradicts it.
        second = F.when(draw == 7, F.array(F.lit(0), F.lit(1))).when(draw == 31, F.array(F.lit(0), F.lit(2)))
        copies = rows.withColumn("copia", F.explode(F.coalesce(second, F.array(F.lit(0)))))
        amount = F.when(F.col("copia") == 2, F.col("v") + 1).otherwise(F.col("v")).cast(MONEY).cast("string")
        code = F.col("id_cliente")
        spelled = {
            "id_cliente": _drawn((7 * n + m) % 40, code, [
                F.lit(""), F.concat(F.lit("CLX-"), n.cast("string")), F.lower(code), F.replace(code, F.lit("-"), F.lit("_")),
                F.concat(F.lit("\t"), code, F.lit(" ")), n.cast("string"), F.concat(F.lit("cli "), F.lpad(n.cast("string"), 6, "0"))]),
            "periodo": _drawn((13 * n + m) % 40, F.date_format(p, "yyyy-MM-dd"), [
                F.lit(""), F.concat(F.lit("30/02/"), F.year(p).cast("string")), F.date_format(F.add_months(p, 1), "yyyy-MM-dd"),
                F.date_format(F.add_months(p, -4), "yyyy/MM"), *[F.date_format(p, f) for f in PERIOD_FORMATS],
                _named_month(p, n, " "), _named_month(p, n, "-"), F.upper(_named_month(p, n + 1, "/"))]),
            "trabajadores_activos": _drawn((17 * n + m) % 60, t, [
                F.lit(""), F.lit("muchos"), F.concat(t, F.lit(".5")), F.concat(F.lit("-"), t), F.lit("0"), F.lit("50001"),
                F.concat(t, F.lit(".0"))]),
            "valor_contrato": _drawn((19 * n + m) % 60, amount, [
                F.lit(""), F.concat(F.lit("COP "), amount), F.concat(F.lit("-"), amount), F.lit("5000000000.5"), F.lit("2.5e3")]),
        }
        return copies.select(
            (n * 100_000 + m * 10 + F.col("copia")).alias("fila_origen"),
            *[column.alias(name) for name, column in spelled.items()])


#: Spellings of a month besides the names, one for each shape the reader knows.
PERIOD_FORMATS = ("yyyy-MM", "M/yyyy", "MM-yyyy", "dd/MM/yyyy", "d/M/yyyy", "yyyyMM", "MM yyyy")


def _drawn(number: Column, usual: Column, others: list[Column]) -> Column:
    """The variant with the drawn number, or the usual text."""
    chosen = F.when(number == 0, others[0])
    for i, other in enumerate(others[1:], start=1):
        chosen = chosen.when(number == i, other)
    return chosen.otherwise(usual)


def _named_month(month: Column, turn: Column, between: str) -> Column:
    """The month by one of its names, in turn, and the year."""
    names = F.element_at(F.array(*[F.array(*map(F.lit, group)) for group in MONTH_NAMES]), F.month(month))
    return F.concat(F.get(names, (turn % F.size(names)).cast("int")), F.lit(between), F.year(month).cast("string"))


class MappedStar(StarTables):
    """The four views over one date range, each built when a job first asks for it."""

    def __init__(
        self, source: MappedTables, since: date | None, until: date | None, prevention_since: date | None
    ):
        self._source, self._range = source, (since, until)
        self._prevention_range = (prevention_since, until)

    @cached_property
    def clientes(self) -> DataFrame:
        return self._source.clientes()

    @cached_property
    def casos(self) -> DataFrame:
        return self._source.casos(*self._range)

    @cached_property
    def facturacion(self) -> DataFrame:
        return self._source.facturacion(*self._range)

    @cached_property
    def prevencion(self) -> DataFrame:
        return self._source.prevencion(*self._prevention_range)
