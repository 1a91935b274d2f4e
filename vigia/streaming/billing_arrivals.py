"""Validation of billing files as they arrive in a folder.

Uniqueness is judged within a file, so no state crosses files, and late or future
months are rejected with a reason by the rules instead of being dropped by a
watermark. The stream tracks which paths are new. It takes a path once, whatever its content, so a ledger
keeps what was validated of each path, its time and length: a file that was replaced under its name since then is
validated again and its earlier results go. All files of a trigger are validated together, each as a load of its own.
"""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from vigia.business import BillingLimits
from vigia.plans.billing_quality import validate_loads
from vigia.sources.billing_file import clear_load, load_name, read_billing_files, write_unreadable

FILE_SCHEMA = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"
FILES = {"pathGlobFilter": "*.csv", "recursiveFileLookup": "true"}
LEDGER = "path STRING, modificationTime TIMESTAMP, length BIGINT, carga DATE, anotado TIMESTAMP"


def _ledger(spark: SparkSession, folder: str) -> DataFrame:
    """The last entry of each path."""
    try:
        entries = spark.read.schema(LEDGER).parquet(f"{folder}/libro")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        entries = spark.createDataFrame([], LEDGER)
    last = F.max_by(F.struct("modificationTime", "length", "carga"), "anotado").alias("_ultima")
    return entries.groupBy("path").agg(last).select("path", "_ultima.*")


def corrected_files(spark: SparkSession, incoming: str, checkpoint: str) -> DataFrame:
    """path, modificationTime, length, carga: validated files that have another time or length now, with the date of their last load."""
    listed = spark.read.format("binaryFile").schema(FILE_SCHEMA).options(**FILES).load(incoming).select("path", "modificationTime", "length")
    known = _ledger(spark, checkpoint).select("path", F.struct("modificationTime", "length").alias("_antes"), "carga")
    now = F.struct("modificationTime", "length")
    return listed.join(known, "path").where(now != F.col("_antes")).drop("_antes")


def validate_arrivals(
    spark: SparkSession,
    incoming: str,
    output: str,
    checkpoint: str,
    load_date: date | None = None,
    limits: BillingLimits = BillingLimits(),
) -> StreamingQuery:
    """Validate every file that is new or was replaced since it was validated, and stop when none is left.

    Results stand side by side by load date and file (the path below ``incoming``); a
    batch that runs again after a failure replaces its own, and a corrected file those of its last load. Files that cannot be read
    are recorded. The load date is fixed when the stream starts, so a batch that is
    repeated later is judged by the same date. The listing is made by path, time and length; contents are read by the reader only.
    """
    day = load_date or date.today()

    def validate(files: DataFrame) -> None:
        # What a trigger takes is what the file source itself lists on the driver.
        rows = sorted(map(tuple, files.select("path", "modificationTime", "length").collect()))
        if not rows:
            return
        session = files.sparkSession
        read = read_billing_files(session, [path for path, _, _ in rows], incoming)
        write_unreadable(read.problems, day, output)
        validate_loads(read.records.join(read.problems, "archivo", "left_anti"), day, output, limits)
        # Noted last: a run that fails before this validates the files again.
        entries = session.createDataFrame([(*row, day) for row in rows], LEDGER.removesuffix(", anotado TIMESTAMP"))
        entries.withColumn("anotado", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{checkpoint}/libro")

    changed = corrected_files(spark, incoming, checkpoint)
    for path, carga in sorted(map(tuple, changed.select("path", "carga").collect())):
        clear_load(spark, output, carga, load_name(path, incoming))
    validate(changed)

    # The content column is not selected, so files are listed and not read here.
    arrivals = (
        spark.readStream.format("binaryFile").schema(FILE_SCHEMA).options(**FILES)
        .load(incoming).select("path", "modificationTime", "length")
    )
    return (
        arrivals.writeStream.foreachBatch(lambda batch, _batch_id: validate(batch))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
