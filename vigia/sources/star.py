"""The star schema: one dimension of clients and three facts."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from vigia import schemas
from vigia.business import RATE_TARGET_BY_CLASS, Targets


class StarTables:
    """What the jobs use: the four tables as attributes."""

    clientes: DataFrame
    casos: DataFrame
    facturacion: DataFrame
    prevencion: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {
            "clientes": self.clientes,
            "facturacion": self.facturacion,
            "casos": self.casos,
            "prevencion": self.prevencion,
        }

    #: Whether facts hold clients that ``clientes`` does not.
    restricted = False

    def fact(self, name: str) -> DataFrame:
        """A fact for a job that shrinks it first and then joins it to ``clientes``."""
        return getattr(self, name)

    def with_clients(self, clientes: DataFrame) -> RestrictedStar:
        """Restrict the dimension and, with it, every fact."""
        return RestrictedStar(self, clientes)


class RestrictedStar(StarTables):
    """The star of some clients.

    The ids of a portfolio of at most ``MAX_PUSHED`` clients are counted once and applied at the scan of a fact,
    before anything is aggregated or moved: as a list that reaches the Parquet reader (row group bounds and
    Bloom filters) where the reader takes lists of that length, else as a broadcast semi join.
    For a larger portfolio ``fact`` gives whole facts, so a job moves one row per client and not every case, and
    the choice is applied where the job meets the clients.
    The attributes ``casos``, ``facturacion`` and ``prevencion`` are filtered row by row in each case.
    """

    restricted = True
    #: Ids of a broadcast choice; at some 30 bytes an id about 3 MB.
    MAX_PUSHED = 100_000

    def __init__(self, base: StarTables, clientes: DataFrame):
        self._base, self.clientes = base, clientes

    def fact(self, name: str) -> DataFrame:
        return self._pushed(self._base.fact(name))

    @cached_property
    def _chosen(self) -> tuple[DataFrame, int]:
        """The ids, and how many there are up to one beyond the bound."""
        ids = self.clientes.select("id_cliente").filter(F.col("id_cliente").isNotNull()).distinct()
        return ids, ids.limit(self.MAX_PUSHED + 1).count()

    @cached_property
    def _listed(self) -> list:
        """The ids of a portfolio short enough for a filter of the Parquet reader, else none."""
        ids, n = self._chosen
        most = int(ids.sparkSession.conf.get("spark.sql.parquet.pushdown.inFilterThreshold"))
        return [row.id_cliente for row in ids.collect()] if n <= min(most, self.MAX_PUSHED) else []

    def _pushed(self, fact: DataFrame) -> DataFrame:
        ids, n = self._chosen
        if n > self.MAX_PUSHED:
            return fact
        if self._listed:
            return fact.filter(F.col("id_cliente").isin(*self._listed))
        return fact.join(F.broadcast(ids), "id_cliente", "left_semi")

    def _of_clients(self, name: str) -> DataFrame:
        return self.fact(name).join(self.clientes.select("id_cliente"), "id_cliente", "left_semi")

    @cached_property
    def casos(self) -> DataFrame:
        return self._of_clients("casos")

    @cached_property
    def facturacion(self) -> DataFrame:
        return self._of_clients("facturacion")

    @cached_property
    def prevencion(self) -> DataFrame:
        return self._of_clients("prevencion")


@dataclass(frozen=True)
class Star(StarTables):
    clientes: DataFrame
    casos: DataFrame
    facturacion: DataFrame
    prevencion: DataFrame


def read_star(spark: SparkSession, folder: str) -> Star:
    """Read the four warehouse tables from Parquet with their declared schemas."""
    return Star(
        clientes=spark.read.schema(schemas.CLIENTES).parquet(f"{folder}/clientes"),
        casos=spark.read.schema(schemas.CASOS).parquet(f"{folder}/casos"),
        facturacion=spark.read.schema(schemas.FACTURACION).parquet(f"{folder}/facturacion"),
        prevencion=spark.read.schema(schemas.PREVENCION).parquet(f"{folder}/prevencion"),
    )


# Columns after the month that spread a fact over tasks; the last ones split a very large client.
_LAYOUT = {
    "casos": ("id_cliente", "id_caso"),
    "facturacion": ("id_cliente",),
    "prevencion": ("id_cliente", "fecha", "participantes"),
}


def write_star(star: StarTables, folder: str) -> None:
    """Store the four tables; facts are laid out by month, the column every job filters on, and by client within it.

    Parquet Bloom filters on ``id_cliente`` let a short list of clients skip row groups.
    """
    star.clientes.write.mode("overwrite").parquet(f"{folder}/clientes")
    for name, columns in _LAYOUT.items():
        order = ["periodo", *columns]
        (star.tables()[name].repartitionByRange(*order).sortWithinPartitions(*order)
         .write.mode("overwrite").option("parquet.bloom.filter.enabled#id_cliente", "true").partitionBy("periodo").parquet(f"{folder}/{name}"))


def target_table(spark: SparkSession, targets: Targets | None = None) -> DataFrame:
    """Rate target per risk class as a table."""
    by_class = targets.rate_by_class if targets else RATE_TARGET_BY_CLASS
    return spark.createDataFrame(sorted(by_class.items()), "clase_riesgo INT, meta_tasa DECIMAL(9,4)")


def targets_from_table(table: DataFrame, targets: Targets | None = None) -> Targets:
    """Take the class targets from a table the business maintains (one row per class, any class).

    A repeated class or a missing target is an error that names the class.
    """
    rows = table.groupBy("clase_riesgo").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.col("meta_tasa").cast("decimal(9,4)")).alias("meta_tasa")
    ).limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"La tabla de metas tiene más de {MAX_CLASSES} clases")
    for row in rows:
        if row.n > 1:
            raise ValueError(f"Clase de riesgo repetida en la tabla de metas: {row.clase_riesgo}")
        if row.clase_riesgo is None or row.meta_tasa is None:
            raise ValueError(f"Clase de riesgo sin meta en la tabla de metas: {row.clase_riesgo}")
    return replace(targets or Targets(), rate_by_class={r.clase_riesgo: r.meta_tasa for r in rows})


#: Targets become one expression; a table of more classes than this is a mistake.
MAX_CLASSES = 1000
