"""The distributed ranks against the built-in window functions, through every branch."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import Window, functions as F

from vigia.operators.lookup import LookupLimits
from vigia.operators.ranking import dense_rank_desc, percent_ranks

BRANCHES = {
    "all values are hot": LookupLimits(),
    "no value is hot": LookupLimits(hot_keys=0),
    "values over a quarter are hot": LookupLimits(hot_keys=4),
}


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the rows share one value, some are NULL, the rest are spread."""
    n = F.col("id")
    return spark.range(3000).select(
        n, (n % 5).cast("int").alias("grupo"),
        F.when(n % 3 == 0, 7.25).when(n % 41 == 0, F.lit(None)).otherwise(F.pmod(F.xxhash64("id"), F.lit(900)) / 8)
        .alias("a"),
        F.when(n % 2 == 0, 0).otherwise(n % 11).alias("b"),
        F.when(n % 3 == 0, Decimal("10.50")).when(n % 29 == 0, F.lit(None)).otherwise(
            (F.pmod(F.xxhash64("id"), F.lit(700)) / 100).cast("decimal(28,2)")).alias("costo"),
    )


@pytest.mark.parametrize("limits", BRANCHES.values(), ids=BRANCHES.keys())
def test_percent_rank(rows, limits):
    got = percent_ranks(rows, {"a": "pa", "b": "pb"}, limits)
    want = rows.select(
        "id",
        F.percent_rank().over(Window.orderBy(F.col("a").asc_nulls_first())).alias("wa"),
        F.percent_rank().over(Window.orderBy("b")).alias("wb"))
    joined = got.join(want, "id")
    assert joined.count() == 3000
    assert joined.filter("pa != wa OR pb != wb OR pa IS NULL OR pb IS NULL").count() == 0
    assert got.columns == [*rows.columns, "pa", "pb"]


@pytest.mark.parametrize("limits", BRANCHES.values(), ids=BRANCHES.keys())
def test_dense_rank(rows, limits):
    got = dense_rank_desc(rows, "grupo", "costo", "r", limits)
    want = rows.select(
        "id",
        F.dense_rank().over(Window.partitionBy("grupo").orderBy(F.col("costo").desc_nulls_last())).alias("w"))
    joined = got.join(want, "id")
    assert joined.count() == 3000
    assert joined.filter("r != w OR r IS NULL").count() == 0
    assert got.columns == [*rows.columns, "r"]


@pytest.mark.parametrize("limits", BRANCHES.values(), ids=BRANCHES.keys())
def test_few_rows(spark, limits):
    one = spark.createDataFrame([(1, 5.0)], "grupo INT, v DOUBLE")
    assert percent_ranks(one, {"v": "p"}, limits).head().p == 0.0
    assert dense_rank_desc(one, "grupo", "v", "r", limits).head().r == 1
    none = one.filter("v < 0")
    assert percent_ranks(none, {"v": "p"}, limits).count() == 0
    assert dense_rank_desc(none, "grupo", "v", "r", limits).count() == 0


def test_missing_groups_and_exact_types(spark):
    """NULL is a group like any other, and neighbouring values beyond 2^53 stay apart."""
    big = 9007199254740992
    rows = spark.createDataFrame(
        [(1, None, big, Decimal("1.10")), (2, None, big + 1, Decimal("1.11")), (3, 1, None, None), (4, None, None, None)],
        "id INT, grupo INT, v BIGINT, d DECIMAL(38,2)")
    for limits in BRANCHES.values():
        dense = {r.id: r.r for r in dense_rank_desc(rows, "grupo", "v", "r", limits).collect()}
        assert dense == {1: 2, 2: 1, 3: 1, 4: 3}
        got = {r.id: (r.p, r.q) for r in percent_ranks(rows, {"v": "p", "d": "q"}, limits).collect()}
        assert got == {1: (2 / 3, 2 / 3), 2: (1.0, 1.0), 3: (0.0, 0.0), 4: (0.0, 0.0)}
