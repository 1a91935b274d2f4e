"""Stored snapshots and control results, partitioned by cut-off date.

A day of snapshots is written to a version folder of its own, and a small pointer file names the version
that is read. Readers resolve the pointers first; replacing a pointer is one rename, so they see the
old day whole or the new day whole, also when the job that writes it fails or is repeated half-way.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from vigia.durable import remove

SNAPSHOT_SCHEMA = (
    "id_cliente STRING, nombre STRING, sector STRING, clase_riesgo INT, casos_mes BIGINT, "
    "graves_mes BIGINT, casos_mes_ant_mismo_corte BIGINT, variacion_casos BIGINT, "
    "variacion_casos_pct DOUBLE, casos_mes_ant_completo BIGINT, periodo_trabajadores DATE, "
    "trabajadores_activos INT, tasa_incidencia DOUBLE, actividades_prevencion_30d BIGINT, "
    "participantes_prevencion_30d BIGINT, clasificacion STRING, fecha_proceso TIMESTAMP, fecha_corte DATE"
)
CONTROL_SCHEMA = (
    "control STRING, descripcion STRING, severidad STRING, valor DOUBLE, esperado DOUBLE, "
    "resultado STRING, fecha_ejecucion TIMESTAMP, fecha_corte DATE"
)
STAGED, PUBLISHED, HISTORY = "preparado", "publicado", "historial_controles"
POINTERS = "punteros"
TABLES = {STAGED: SNAPSHOT_SCHEMA, PUBLISHED: SNAPSHOT_SCHEMA, HISTORY: CONTROL_SCHEMA}


@dataclass(frozen=True)
class SnapshotStore:
    """Folders of the staged and published snapshots and of the control history."""

    spark: SparkSession
    folder: str

    @classmethod
    def open(cls, spark: SparkSession, folder: str) -> SnapshotStore:
        """The store in ``folder``; a table that was never written reads as empty."""
        return cls(spark, folder)

    def _read(self, name: str) -> DataFrame:
        try:
            return self.spark.read.schema(TABLES[name]).parquet(f"{self.folder}/{name}")
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], TABLES[name])

    def _pointers(self, name: str) -> dict[str, str]:
        """The version served for each day: one small file a day."""
        try:
            found = self.spark.read.text(f"{self.folder}/{name}/{POINTERS}").select("value", F.col("_metadata.file_name").alias("day")).collect()
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        return {row.day: row.value for row in found}

    def _versions(self, name: str) -> DataFrame:
        """The served versions of all days, read by day: filters on the day skip the folders of the others."""
        base = f"{self.folder}/{name}"
        paths = [f"{base}/fecha_corte={day}/version={version}" for day, version in self._pointers(name).items()]
        if not paths:
            return self.spark.createDataFrame([], TABLES[name])
        schema = self.spark.createDataFrame([], TABLES[name]).schema.add("version", "string")
        return self.spark.read.schema(schema).option("basePath", base).parquet(*paths).drop("version")

    def _replace_day(self, frame: DataFrame, name: str, cutoff: date) -> None:
        """The named day holds the frame's rows of that day, and nothing else, also if there are none.

        The version served before stays for those who are reading it; older ones are deleted.
        """
        rows = frame.filter(F.col("fecha_corte") == F.lit(cutoff)).drop("fecha_corte")
        version, before = uuid.uuid4().hex, self._pointers(name).get(str(cutoff))
        day = f"{self.folder}/{name}/fecha_corte={cutoff}"
        rows.write.parquet(f"{day}/version={version}")
        self._point(name, cutoff, version)
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(day)
        for status in folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder):
            found = status.getPath().getName()
            if found not in (f"version={version}", f"version={before}"):
                remove(self.spark, status.getPath().toString())

    def _point(self, name: str, cutoff: date, version: str) -> None:
        """Serve a version from now on: the pointer is written aside and renamed over the old one."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path
        pointer, aside = path(f"{self.folder}/{name}/{POINTERS}/{cutoff}"), path(f"{self.folder}/{name}/{POINTERS}/.{version}")
        out = aside.getFileSystem(conf).create(aside, True)
        out.write(bytearray(version.encode()))
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.getFileSystem(conf).getUri(), conf)
        options = self.spark.sparkContext._gateway.new_array(getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 1)
        options[0] = getattr(jvm, "org.apache.hadoop.fs.Options$Rename").OVERWRITE
        context.rename(aside, pointer, options)

    def staged(self) -> DataFrame:
        return self._versions(STAGED)

    def published(self) -> DataFrame:
        return self._versions(PUBLISHED)

    def history(self) -> DataFrame:
        return self._read(HISTORY)

    def stage(self, snapshot: DataFrame, cutoff: date) -> None:
        self._replace_day(snapshot, STAGED, cutoff)

    def publish(self, snapshot: DataFrame, cutoff: date) -> None:
        self._replace_day(snapshot, PUBLISHED, cutoff)

    def served_day(self) -> date | None:
        """The last published day: what readers see until a later one is published."""
        return self.published().agg(F.max("fecha_corte").alias("d")).head().d

    def append_history(self, controls: DataFrame) -> None:
        (controls.coalesce(1).write.mode("append").partitionBy("fecha_corte")
         .parquet(f"{self.folder}/{HISTORY}"))
