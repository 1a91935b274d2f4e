from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from vigia.functions import text

IDS = {
    "cLi_00431": "CLI-0431", "\t431 ": "CLI-0431", "CLI 431": "CLI-0431", "431": "CLI-0431", "CLI-77120": "CLI-77120",
    "00000000431": "CLI-0431", "CLI-123456": "CLI-123456", "CLI431": "CLI-0431",
    "": None, "000": None, "CLI-": None, "CLI--5": None, "4 31": None, "431X": None, "#REF!": None, "1234567": None,
}
MARCH = date(2025, 3, 1)
PERIODS = {
    "2025-03-31": MARCH, "2025-3-9": MARCH, "2025/3": MARCH, "2025-03": MARCH, "3/2025": MARCH, "03-2025": MARCH, "3 2025": MARCH,
    "31/03/2025": MARCH, "1/3/2025": MARCH, "20253": MARCH, "202503": MARCH, " MARZO 2025 ": MARCH, "Mar-2025": MARCH, "mar/2025": MARCH,
    "29/02/2024": date(2024, 2, 1), "set-2026": date(2026, 9, 1),
    "": None, "pendiente": None, "00/2025": None, "2025-13": None, "29/02/2025": None, "0000-03": None, "mar2025": None,
    "marz 2025": None, "setiembre 2026": None, "2025-03-01T00": None,
}
NUMBERS = {
    "10": 10.0, "12.5": 12.5, "-3": -3.0, " 7 ": 7.0, "1e3": 1000.0, ".5": 0.5, "5.": 5.0, "+4": 4.0,
    "": None, "doce": None, "N/A": None, "$ 1.200.000": None, "1,000": None, "1_000": None,
    "12d": None, "12f": None, "NaN": None, "0x10": None, "inf": float("inf"), "-Infinity": float("-inf"),
}


@pytest.mark.parametrize(
    ("reader", "cases"),
    [(text.client_id, IDS), (text.period, PERIODS), (text.number, NUMBERS)],
    ids=["ids", "periods", "numbers"],
)
def test_readers(spark, reader, cases):
    frame = spark.createDataFrame([(t,) for t in cases], "t STRING")
    read = frame.withColumn("s", text.strip(F.col("t"))).select("t", reader(F.col("s")).alias("v"))
    assert {row.t: row.v for row in read.collect()} == cases


def test_every_month_name(spark):
    names = [n for group in text.MONTH_NAMES for n in group]
    assert len(names) == 25
    frame = spark.createDataFrame([(f"{n} 2026",) for n in names], "t STRING")
    months = {r.t.split()[0]: r.m for r in frame.select("t", F.month(text.period(F.col("t"))).alias("m")).collect()}
    for number, group in enumerate(text.MONTH_NAMES, start=1):
        assert {months[n] for n in group} == {number}


def test_missing_text_is_blank(spark):
    row = spark.range(1).select(text.strip(F.lit(None).cast("string")).alias("v")).head()
    assert row.v == ""
