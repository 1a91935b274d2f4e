from __future__ import annotations

from pathlib import Path
from types import SimpleNamespace

import pytest

from vigia.durable import SETTING, Workspace, scratch_path, shared_folder
from vigia.sources.billing_file import read_billing_file


def _tables(spark) -> set[Path]:
    return {p.parent for p in Path(shared_folder(spark).removeprefix("file:")).rglob("_SUCCESS")}


def test_a_workspace_leaves_only_what_its_result_reads(spark):
    before = _tables(spark)
    with Workspace(spark) as work:
        first = work.stored(spark.range(10), "first")
        second = work.stored(first.selectExpr("id * 2 AS id"), "second", instead_of=(first,))
        assert len(_tables(spark) - before) == 1
        result = work.kept(second.where("id > 10"), "result")
    assert len(_tables(spark) - before) == 1 and sorted(r.id for r in result.collect()) == [12, 14, 16, 18]


def test_a_failed_job_leaves_nothing(spark):
    before = _tables(spark)
    with pytest.raises(Exception, match="no more"), Workspace(spark) as work:
        kept = work.stored(spark.range(3), "kept")
        work.stored(kept.selectExpr("raise_error('no more') AS x"), "failing")
    assert _tables(spark) == before


def test_the_billing_reader_keeps_one_table(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("id_cliente,periodo,trabajadores_activos,valor_contrato\n1,2026-09,10,5\n")
    before = _tables(spark)
    assert read_billing_file(spark, str(path)).count() == 1
    left = {p.name.rsplit("-", 1)[0] for p in _tables(spark) - before}
    assert left == {"facturacion-texto", "cargas-ilegibles"}


@pytest.mark.parametrize("master, folder, refused", [
    ("yarn", "file:/tmp/warehouse", True), ("spark://a:7077", "/tmp/warehouse", True), ("yarn", "hdfs://a/warehouse", False), ("local[8]", "file:/tmp/w", False)])
def test_a_folder_of_one_machine_is_refused_on_a_cluster(master, folder, refused):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda _: None)
    settings = {"spark.sql.warehouse.dir": folder}
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: settings.get(key, default)), sparkContext=context)
    if refused:
        with pytest.raises(ValueError, match=SETTING):
            scratch_path(session, "x")
    else:
        assert scratch_path(session, "x").startswith(f"{folder}/_intermediate/x-")
