from __future__ import annotations

import io
import json
import random
from datetime import date
from pathlib import Path

import pandas as pd
import pytest

from vigia.business import BillingLimits
from vigia.operators import ordinal
from vigia.operators.lookup import LookupLimits, lookup
from vigia.plans import billing_quality as bq
from vigia.sources import billing_file
from vigia.sources.billing_file import BillingFileError, read_billing_file, read_billing_files
from vigia.sources.mapped import MappedTables
from vigia.streaming.billing_arrivals import validate_arrivals

LOAD = date(2026, 9, 26)
HEADER = "id_cliente,periodo,trabajadores_activos,valor_contrato\n"


def judge(spark, rows, load_date=LOAD):
    schema = "fila_origen BIGINT, id_cliente STRING, periodo STRING, trabajadores_activos STRING, valor_contrato STRING"
    raw = spark.createDataFrame([(n, *row) for n, row in enumerate(rows, start=2)], schema)
    return bq.apply_rules(bq.normalize_billing(raw), load_date)


def rules_by_line(judged):
    return {r.fila_origen: r.reglas_incumplidas for r in bq.split_rejected(judged).collect()}


# One line just inside and one just outside each rule; the second breaks that rule and no other.
EDGES = {
    "COM_01": (("7", "2026-09", "3", "9"), ("  ", "2026-09", "3", "9")),
    "COM_02": (("8", "2026-09", "3", "9"), ("8", "\t", "3", "9")),
    "COM_03": (("9", "2026-09", "1", "9"), ("10", "2026-09", " ", "9")),
    "COM_04": (("11", "2026-09", "3", "0"), ("12", "2026-09", "3", "")),
    "VAL_01": (("999999", "2026-09", "3", "9"), ("1000000", "2026-09", "3", "9")),
    "VAL_02": (("14", "30/09/2026", "3", "9"), ("14", "31/09/2026", "3", "9")),
    "VAL_03": (("16", "2026-09", "3.0", "9"), ("17", "2026-09", "3.25", "9")),
    "VAL_04": (("18", "2026-09", "50000", "9"), ("19", "2026-09", "50001", "9")),
    "VAL_05": (("20", "2026-09", "3", "1.5e2"), ("21", "2026-09", "3", "1,5")),
    "VAL_06": (("22", "2026-09", "3", "5000000000"), ("23", "2026-09", "3", "5000000000.01")),
    "CON_01": (("24", "2026-09", "0", "0"), ("25", "2026-09", "0", "0.01")),
    "OPO_01": (("26", "2026-09", "3", "9"), ("26", "2026-10", "3", "9")),
    "OPO_02": (("28", "2026-08", "3", "9"), ("28", "2026-07", "3", "9")),
}


@pytest.mark.parametrize("code", EDGES)
def test_both_sides_of_a_rule(spark, code):
    judged = judge(spark, EDGES[code])
    assert rules_by_line(judged) == {3: code}
    assert [(r.fila_origen, r.fecha_carga) for r in bq.split_valid(judged, LOAD).collect()] == [(2, LOAD)]


def test_every_rule_has_a_check():
    assert set(bq.CHECKS) == set(bq.CODES) and {c[0] for c in bq.CHECKS.values()} == set(bq.KINDS)


def test_repeated_keys(spark):
    judged = judge(spark, [
        ("31", "2026-08", "4", "70"), ("CLI_31", "ago-2026", "4.0", "7e1"),   # one version, two spellings
        ("31", "2026-09", "4", "70"), ("31", "09/2026", "5", "70"),          # two versions
        ("32", "2026-08", "4", "70"),
    ])
    assert rules_by_line(judged) == {3: "UNI_01", 4: "UNI_02", 5: "UNI_02"}


def test_scores_round_halves_to_even(spark):
    rows = [("", "2026-09", "1", "5")] + [(str(n), "2026-09", "1", "5") for n in range(1, 32)]
    report = bq.load_report(judge(spark, rows), LOAD, "a.csv").head()
    assert report.pct_rechazo == 0.0312 and report.score_por_dimension.completitud == 0.9688


def test_files_are_judged_one_by_one(spark):
    schema = "archivo STRING, fila_origen BIGINT, id_cliente STRING, periodo STRING, trabajadores_activos STRING, valor_contrato STRING"
    raw = spark.createDataFrame([(f, 2 + n, "1", "2026-09", "1", w) for f in "ab" for n, w in enumerate("55")] + [("c", 2, "1", "2026-09", "1", "6")], schema)
    judged = bq.apply_rules(bq.normalize_billing(raw), LOAD)
    assert {(r.archivo, r.fila_origen) for r in bq.split_rejected(judged).collect()} == {("a", 3), ("b", 3)}
    assert {r.archivo: r.total_registros for r in bq.load_report(judged, LOAD).collect()} == {"a": 2, "b": 2, "c": 1}


def test_duplicate_versions_with_missing_figures(spark):
    judged = judge(spark, [
        ("1", "2026-09", "", "5"), ("1", "2026-09", "10", "5"),      # one version: the later line repeats
        ("2", "2026-09", "", "5"), ("2", "2026-09", "", "5"),        # no version at all
        ("3", "2026-09", "x", "5"), ("3", "2026-09", "10", "5"), ("3", "2026-09", "10", "6"),
    ])
    assert rules_by_line(judged) == {
        2: "COM_03", 3: "UNI_01", 4: "COM_03", 5: "COM_03",
        6: "VAL_03; UNI_02", 7: "UNI_02", 8: "UNI_02"}


def test_first_line_survives_uniqueness_even_if_another_rule_rejects_it(spark):
    judged = judge(spark, [("1", "2026-09", "0", "5"), ("1", "2026-09", "0", "5")])
    assert rules_by_line(judged) == {2: "CON_01", 3: "UNI_01; CON_01"}


def test_rows_without_key_are_never_duplicates(spark):
    judged = judge(spark, [("", "2026-09", "1", "5")] * 3 + [("7", "", "1", "5")] * 3 + [("7", "1900-01", "1", "5")])
    lines = rules_by_line(judged)
    assert set(lines.values()) == {"COM_01", "COM_02", "OPO_02"} and len(lines) == 7


def test_lateness_counts_from_the_first_of_the_month(spark):
    rows = [("1", "2026-07", "1", "5"), ("2", "2026-08", "1", "5")]
    assert rules_by_line(judge(spark, rows, date(2026, 8, 31))) == {2: "OPO_02"}
    assert rules_by_line(judge(spark, rows, date(2026, 8, 30))) == {}


def test_limits_and_infinite_numbers(spark):
    judged = judge(spark, [
        ("1", "2026-09", "50000", "5000000000"), ("2", "2026-09", "50001", "5000000001"),
        ("3", "2026-09", "inf", "inf"), ("4", "2026-09", "1e300", "-0.01"), ("5", "2026-09", "1.0", "0")])
    assert rules_by_line(judged) == {
        3: "VAL_04; VAL_06", 4: "VAL_03; VAL_06", 5: "VAL_04; VAL_06"}


@pytest.mark.parametrize(
    "spread", [LookupLimits(), LookupLimits(hot_keys=0), LookupLimits(hot_keys=4)],
    ids=["broadcast", "shuffled", "hot keys broadcast"])
def test_one_key_with_a_third_of_the_file(spark, spread):
    """The same judgement through every branch; the hot key never meets the others in a shuffle."""
    raw = spark.range(0, 3000, 1, 4).selectExpr(
        "id AS fila_origen",
        "CASE WHEN id % 3 = 0 THEN '1' WHEN id % 7 = 0 THEN '' ELSE CAST(2 + id DIV 4 AS STRING) END AS id_cliente",
        "'2026-09' AS periodo", "IF(id % 5 = 1, '9', '10') AS trabajadores_activos", "'5' AS valor_contrato")
    judged = bq.apply_rules(bq.normalize_billing(raw), LOAD, spread=spread)
    groups: dict[str, list[tuple[int, str]]] = {}
    for r in raw.collect():
        groups.setdefault(r.id_cliente, []).append((r.fila_origen, r.trabajadores_activos))
    expected = {}
    for client, lines in groups.items():
        versions = {w for _, w in lines}
        for n, (line, _) in enumerate(sorted(lines)):
            expected[line] = (client != "" and len(versions) == 1 and n > 0, client != "" and len(versions) > 1)
    assert {r.fila_origen: (r.UNI_01, r.UNI_02) for r in judged.collect()} == expected
    assert sum(u2 for _, u2 in expected.values()) > 1000 and sum(u1 for u1, _ in expected.values()) > 50


def test_report_adds_up(spark):
    judged = judge(spark, [
        ("cli-1", "09/2026", "10", "5"), ("CLI-0002", "2026-09-01", "", ""), ("CLI-0003", "2026-09-15", "1", "5"),
        ("x", "2026-09-01", "1", "5")])
    report = bq.load_report(judged, LOAD, "archivo.csv").head()
    assert (report.total_registros, report.validos, report.rechazados) == (4, 2, 2)
    assert report.pct_rechazo == 0.5 and report.estado_carga == "BLOQUEADA"
    assert report.score_por_dimension.asDict() == {
        "completitud": 0.75, "validez": 0.75, "unicidad": 1.0, "consistencia": 1.0, "oportunidad": 1.0}
    assert report.correcciones_de_formato.asDict() == {"id_cliente": 1, "periodo": 2}
    assert {r.regla for r in report.rechazos_por_regla} == set(bq.CODES)
    at_limit = bq.load_report(judged, LOAD, "archivo.csv", BillingLimits(max_reject_share=0.5)).head()
    assert at_limit.estado_carga == "APROBADA"


def test_file_reading(spark, tmp_path):
    path = tmp_path / "facturacion.csv"
    path.write_text(
        '\ufeff ID_Cliente ,Periodo,otra,trabajadores_activos,VALOR_CONTRATO\n'
        '"CLI-0001",2026-09-01,a,10,"1 ""x"", 2"\n'
        '\n'
        ' cli-2 ,,b,"",\\5\n', encoding="utf-8")
    rows = [tuple(r) for r in read_billing_file(spark, str(path)).orderBy("fila_origen").collect()]
    assert rows == [
        (2, "CLI-0001", "2026-09-01", "10", '1 "x", 2'),
        (3, " cli-2 ", "", "", "\\5"),
    ]


def test_unusable_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_billing_file(spark, str(tmp_path / "nada.csv"))
    short = tmp_path / "corto.csv"
    short.write_text("id_cliente,periodo\n1,2\n")
    with pytest.raises(BillingFileError, match="trabajadores_activos.*valor_contrato"):
        read_billing_file(spark, str(short))
    for content in ("id_cliente,periodo,trabajadores_activos,valor_contrato\n", ""):
        empty = tmp_path / "vacio.csv"
        empty.write_text(content)
        with pytest.raises(BillingFileError, match="registros"):
            read_billing_file(spark, str(empty))


def _read(spark, path):
    return [tuple(r) for r in read_billing_file(spark, str(path)).orderBy("fila_origen").collect()]


def test_damaged_records_make_a_file_unreadable(spark, tmp_path):
    """A decimal comma and a quote that never closes; a short line is only incomplete."""
    for n, (line, problem) in enumerate({
        "4,2026-09,10,1500,75": "Fila 3: más campos", '4,"2026-09,10,5': "Fila 3: comillas", '4,2026-09,1,"5""': "Fila 3: comillas",
    }.items()):
        path = tmp_path / f"malo-{n}.csv"
        path.write_text(HEADER + "1,2026-09,1,5\n" + line + "\n2,2026-09,1,5\n")
        with pytest.raises(BillingFileError, match=problem):
            read_billing_file(spark, str(path))
    short = tmp_path / "incompleto.csv"
    short.write_text(HEADER + '1,2026-09\n2,2026-09,"1,5",9\n')
    assert _read(spark, short) == [(2, "1", "2026-09", "", ""), (3, "2", "2026-09", "1,5", "9")]


def test_quotes_and_line_breaks_as_in_the_reports_of_users(spark, tmp_path):
    """A stray quote is text, a quoted field may go on in the next lines, and both are judged by the rules."""
    path = tmp_path / "comillas.csv"
    path.write_text(HEADER + 'CLI-0001,2026-08-01,5",20\nCLI-0002,2026-08-01,10,"5\n6"\n \t\n"CLI-""3""",2026-08,"1"0,"\n\n"\n4,2026-08,1,5\n')
    assert _read(spark, path) == [
        (2, "CLI-0001", "2026-08-01", '5"', "20"), (3, "CLI-0002", "2026-08-01", "10", "5\n6"),
        (4, 'CLI-"3"', "2026-08", "10", "\n\n"), (5, "4", "2026-08", "1", "5")]
    judged = bq.apply_rules(bq.normalize_billing(read_billing_file(spark, str(path))), date(2026, 8, 20))
    assert rules_by_line(judged) == {2: "VAL_03", 3: "VAL_05", 4: "COM_04; VAL_01"}


def _untidy_csv(seed: int, records: int) -> str:
    draw = random.Random(seed)
    pieces = ["a", "1", ",", '"', '""', "\n", "\n\n", " ", "é", "x,y", '",', '\n"']

    def cell():
        text = "".join(draw.choice(pieces) for _ in range(draw.randrange(5)))
        if draw.random() < 0.6:
            return '"' + text.replace('"', '""') + '"' + draw.choice(["", "", "z", 'q"r'])
        return draw.choice(["b", "cd"]) + text.replace(",", "").replace("\n", "") + draw.choice(["", '"s'])

    rows = []
    for n in range(records):
        rows.append(",".join([f"id{n}", *[cell() for _ in range(3)]]))
        if draw.random() < 0.1:
            rows.append(draw.choice(["", "  "]))
    return HEADER + "\n".join(rows) + "\n"


@pytest.mark.parametrize("seed", (1, 2, 5))
def test_records_over_many_splits_equal_reading_in_one_go(spark, tmp_path, seed):
    """Files cut into splits of 60 bytes: most splits begin inside a record, many inside quotes."""
    content = _untidy_csv(seed, 40)
    try:
        expected = pd.read_csv(io.StringIO(content), dtype=str, keep_default_na=False)
    except pd.errors.ParserError as problem:
        expected = problem
    path = tmp_path / "cortes.csv"
    path.write_text(content, encoding="utf-8", newline="")
    options = {"spark.sql.files.maxPartitionBytes": "60", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in options}
    for k, v in options.items():
        spark.conf.set(k, v)
    try:
        if isinstance(expected, Exception):
            with pytest.raises(BillingFileError):
                read_billing_file(spark, str(path))
        else:
            rows = _read(spark, path)
            assert rows == [(i + 2, *r) for i, r in enumerate(expected.itertuples(index=False, name=None))]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_the_text_is_scanned_once(spark, tmp_path, monkeypatch):
    """All that is read after the first stored table are stored tables."""
    path = tmp_path / "a.csv"
    path.write_text(HEADER + '1,2026-09,10,"5\n"\n')
    reads = []
    reader = type(spark.read)
    text = reader.text
    monkeypatch.setattr(reader, "text", lambda self, *a, **k: (reads.append(a), text(self, *a, **k))[1])
    plans = []
    for frame in (read_billing_file(spark, str(path)), bq.validate_billing(spark, str(path), LOAD, str(tmp_path / "o")).judged):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
    assert len(reads) == 2 and not any("FileScan text" in plan for plan in plans)


def test_every_file_has_its_own_column_order(spark, tmp_path):
    folder = tmp_path / "carga"
    folder.mkdir()
    (folder / "1.csv").write_text(HEADER + "1,2026-09,10,1500\n")
    (folder / "2.csv").write_text("valor_contrato,trabajadores_activos,id_cliente,periodo\n2500,20,2,2026-08\n")
    rows = [tuple(r) for r in read_billing_file(spark, str(folder)).orderBy("fila_origen").collect()]
    assert rows == [(2, "1", "2026-09", "10", "1500"), (3, "2", "2026-08", "20", "2500")]
    (folder / "3.csv").write_text("id_cliente,periodo,trabajadores_activos\n1,2026-09,3\n")
    with pytest.raises(BillingFileError, match="3.csv.*valor_contrato"):
        read_billing_file(spark, str(folder))


def test_line_numbers_over_many_splits_and_files(spark, tmp_path):
    folder = tmp_path / "carga"
    folder.mkdir()
    total = 0
    for part in range(3):
        lines = ["id_cliente,periodo,trabajadores_activos,valor_contrato"]
        for _ in range(4000 + 1000 * part):
            lines.append(f"{total},2026-09,1,{'9' * (total % 17)}")
            total += 1
        (folder / f"parte-{part}.csv").write_text("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        frame = read_billing_file(spark, str(folder))
        wrong = frame.filter("fila_origen != CAST(id_cliente AS BIGINT) + 2").count()
        assert (frame.count(), wrong) == (total, 0)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def _reports(folder: Path) -> dict[str, dict]:
    found = {}
    for path in folder.rglob("reporte_calidad/**/*.json"):
        text = path.read_text(encoding="utf-8").strip()
        if text:
            found[str(path.parent)] = json.loads(text)
    return found


def test_validation_writes_everything_once(spark, tmp_path):
    source = tmp_path / "facturacion.csv"
    source.write_text(HEADER + "1,2026-09,10,5\n cli-2 ,2026-09,,5\n3,2026-09,1,5\n")
    out = tmp_path / "salidas"
    for _ in range(2):
        result = bq.validate_billing(spark, str(source), LOAD, str(out), BillingLimits(max_reject_share=0.4))
    assert result.approved
    assert spark.read.parquet(str(out / "facturacion_validos")).count() == 2
    rejected = spark.read.option("header", True).option("ignoreLeadingWhiteSpace", False).csv(
        str(out / "facturacion_rechazados")).collect()
    assert [(r.fila_origen, r.id_cliente, r.reglas_incumplidas) for r in rejected] == [("3", " cli-2 ", "COM_03")]
    assert spark.read.option("header", True).csv(str(out / "resumen_reglas")).count() == 15
    (where, report), = _reports(out).items()
    assert "carga=2026-09-26" in where and "origen=facturacion.csv" in where
    assert (report["fecha_carga"], report["archivo"]) == ("2026-09-26", "facturacion.csv")
    assert report["estado_carga"] == "APROBADA" and len(report["rechazos_por_regla"]) == 15
    assert "mínimo" not in report["notas"][0] and "dimensión" in report["notas"][0]


def test_loads_stand_side_by_side(spark, tmp_path):
    out = str(tmp_path / "salidas")
    for name, workers in (("a.csv", "10"), ("b.csv", "20"), ("a.csv", "-1")):
        (tmp_path / name).write_text(HEADER + f"1,2026-09,{workers},0\n")
        bq.validate_billing(spark, str(tmp_path / name), LOAD, out)
    valid = spark.read.parquet(f"{out}/facturacion_validos").collect()
    assert [(r.origen, r.trabajadores_activos) for r in valid] == [("b.csv", 20)]   # the new run of a.csv has no valid row
    rejected = spark.read.option("header", True).csv(f"{out}/facturacion_rechazados").collect()
    assert [(r.origen, r.reglas_incumplidas) for r in rejected] == [("a.csv", "VAL_04")]
    assert spark.read.json(f"{out}/reporte_calidad").count() == 2


def test_arriving_files_are_validated_once_each(spark, tmp_path):
    incoming, out, state = tmp_path / "entrada", tmp_path / "salida", tmp_path / "estado"
    incoming.mkdir()

    def run():
        query = validate_arrivals(spark, str(incoming), str(out), str(state), LOAD)
        query.awaitTermination(120)
        assert query.exception() is None

    (incoming / "a.csv").write_text(HEADER + "1,2026-09,10,5\n")
    (incoming / "otros").mkdir()
    (incoming / "otros" / "a.csv").write_text(HEADER + "2,2026-09,10,5\n")
    (incoming / "b.csv").write_text("periodo\n1\n")
    run()
    (incoming / "c.csv").write_text(HEADER + "1,2026-09,10,5\n1,2026-09,10,6\n")
    run()
    states = {v["archivo"]: v["estado_carga"] for v in _reports(out).values()}
    assert states == {"a.csv": "APROBADA", "otros/a.csv": "APROBADA", "c.csv": "BLOQUEADA"}
    errors = [p.read_text() for p in (out / "cargas_con_error").rglob("*.json")]
    assert any("Faltan columnas" in e for e in errors)


def test_a_corrected_file_is_validated_again(spark, tmp_path):
    """The same name with other content: results are replaced, those of files left alone are not touched."""
    incoming, out, state = tmp_path / "entrada", tmp_path / "salida", tmp_path / "estado"
    incoming.mkdir()

    def run(day=LOAD):
        query = validate_arrivals(spark, str(incoming), str(out), str(state), day)
        query.awaitTermination(120)
        assert query.exception() is None
        valid = spark.read.schema("id_cliente STRING, trabajadores_activos INT, carga DATE, origen STRING").parquet(f"{out}/facturacion_validos")
        return sorted((r.origen, str(r.carga), r.id_cliente, r.trabajadores_activos) for r in valid.collect())

    (incoming / "a.csv").write_text(HEADER + "1,2026-09,10,5\n")
    (incoming / "b c.csv").write_text(HEADER + "1,2026-09,11,5\n")
    first = [("a.csv", "2026-09-26", "CLI-0001", 10), ("b c.csv", "2026-09-26", "CLI-0001", 11)]
    assert run() == first and run() == first
    before = {p: p.stat().st_mtime_ns for p in (out / "facturacion_validos").rglob("*b c.csv*/*.parquet")}
    (incoming / "a.csv").write_text(HEADER + "1,2026-09,77,5\n2,2026-09,5,5\n")
    assert run() == [("a.csv", "2026-09-26", "CLI-0001", 77), ("a.csv", "2026-09-26", "CLI-0002", 5), first[1]]
    assert before == {p: p.stat().st_mtime_ns for p in (out / "facturacion_validos").rglob("*b c.csv*/*.parquet")} and before
    (incoming / "a.csv").write_text("periodo\n1\n")
    (incoming / "d.csv").write_text(HEADER + "4,2026-09,4,4\n")
    assert run(date(2026, 9, 27)) == [first[1], ("d.csv", "2026-09-27", "CLI-0004", 4)]
    assert len(list((out / "cargas_con_error").rglob("*.json"))) == 1


@pytest.mark.parametrize("key_bits", [1, 64, bq.KEY_BITS])
def test_only_suspected_rows_look_their_key_up(spark, monkeypatch, key_bits):
    """A map that is too small moves more rows and changes no verdict; with the usual one single keys stay where they are."""
    rows = [(str(n), "2026-09", "1", "5") for n in range(1, 401)] + [("7", "2026-09", "1", "5"), ("8", "2026-09", "2", "5"), ("", "2026-09", "1", "5"), ("", "2026-09", "1", "5")]
    moved = []
    monkeypatch.setattr(bq, "lookup", lambda keyed, *rest: moved.append(keyed.count()) or lookup(keyed, *rest))
    schema = "fila_origen BIGINT, id_cliente STRING, periodo STRING, trabajadores_activos STRING, valor_contrato STRING"
    raw = spark.createDataFrame([(n, *row) for n, row in enumerate(rows, start=2)], schema)
    judged = bq.apply_rules(bq.normalize_billing(raw), LOAD, key_bits=key_bits)
    assert rules_by_line(judged) == {402: "UNI_01", 9: "UNI_02", 403: "UNI_02", 404: "COM_01", 405: "COM_01"}
    assert moved == [402] if key_bits == 1 else 4 <= moved[0] < 40 if key_bits == 64 else moved == [4]


def test_billing_is_arranged_before_it_is_text(spark, tmp_path):
    """Sorted or moved as months and figures it has the same rows, in the order of the text's line numbers."""
    spark.range(40).selectExpr("id AS o_orderkey", "id % 5 AS o_custkey").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(400).selectExpr(
        "id % 40 AS l_orderkey", "CAST(1 + id % 7 AS DOUBLE) AS l_quantity", "id + 0.25D AS l_extendedprice",
        "CAST(make_date(1995 + id % 6, 1 + id % 12, 3) AS TIMESTAMP_NTZ) AS l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet")
    tables, seen = MappedTables(spark, str(tmp_path)), []

    def arranged(rows, line):
        seen.append(rows.columns)
        return rows.orderBy(line)

    ordered = [tuple(r) for r in tables.raw_billing(arranged).collect()]
    assert seen == [["id_cliente", "periodo", "trabajadores_activos", "valor_contrato"]]
    assert len(ordered) >= 60 and ordered == sorted(map(tuple, tables.raw_billing().collect()))
    cents = {r.valor_contrato for r in tables.facturacion().collect()}
    assert sum(cents) and all(v.as_tuple().exponent == -2 for v in cents)


def test_text_is_stored_compactly(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + '1,2026-09,1,"5\n6"\n')
    assert all(path.endswith(".zstd.parquet") for path in read_billing_files(spark, [str(tmp_path / "a.csv")]).records.inputFiles())


def test_only_splits_with_open_lines_are_sorted(spark, tmp_path, monkeypatch):
    """Splits of whole lines, quoted fields included, are summed up without a sort, also when they begin inside quotes."""
    folder = tmp_path / "carga"
    folder.mkdir()
    plain = [f'{n},2026-09,"1",{n % 7}' for n in range(1, 301)]
    (folder / "1.csv").write_text(HEADER + "\n".join(plain) + "\n")
    # One field of 200 lines: the splits within it keep the state they are given, the last one closes it.
    field = "\n".join(f"linea {n}" for n in range(200))
    (folder / "2.csv").write_text(HEADER + f'401,2026-09,1,"{field}"\n' + "\n".join(plain) + "\n")
    sorted_lines, states = [], ordinal._with_states
    monkeypatch.setattr(ordinal, "_with_states", lambda lines, starts: "_e0" in starts and sorted_lines.append(lines.count()) or states(lines, starts))
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.minPartitionNum")}
    try:
        for k, v in zip(before, ("700", "1"), strict=True):
            spark.conf.set(k, v)
        rows = [tuple(r) for r in read_billing_file(spark, str(folder)).orderBy("fila_origen").collect()]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    cells = [(str(n), "2026-09", "1", str(n % 7)) for n in range(1, 301)]
    assert rows == [(n, *row) for n, row in enumerate([*cells, ("401", "2026-09", "1", field), *cells], start=2)]
    # Of 803 lines those of the one split in which the field opens.
    assert len(sorted_lines) == 1 and 0 < sorted_lines[0] < 100


def test_results_are_written_without_a_sort_by_load(spark, tmp_path, monkeypatch):
    """Few loads are written side by side; with more than may be open the rows are the same, and the session's setting comes back."""
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before, seen = spark.conf.get(setting), []
    writer = type(spark.range(1).write)
    for kind in ("csv", "parquet"):
        write = getattr(writer, kind)
        monkeypatch.setattr(writer, kind, lambda self, *a, _write=write, **k: (seen.append(int(self._spark.conf.get(setting))), _write(self, *a, **k))[1])
    loads = 3 * billing_file.OPEN_LOADS
    rows = spark.range(0, 10 * loads, 1, 1).selectExpr(
        "id AS fila_origen", f"concat('f', id % {loads}, '.csv') AS archivo", "DATE'2026-09-26' AS fecha_carga", "'\n\"' AS texto")
    billing_file.write_rejected(rows, str(tmp_path))
    billing_file.write_valid(rows, str(tmp_path))
    assert seen == [billing_file.OPEN_LOADS] * 2 and spark.conf.get(setting) == before
    schema = "fila_origen BIGINT, archivo STRING, texto STRING, carga DATE, origen STRING"
    expected = [(n, f"f{n % loads}.csv", '\n"', LOAD, f"f{n % loads}.csv") for n in range(10 * loads)]
    csv = spark.read.schema("fila_origen BIGINT, archivo STRING, fecha_carga DATE, texto STRING, carga DATE, origen STRING").options(
        header=True, multiLine=True, escape='"').csv(f"{tmp_path}/facturacion_rechazados")
    for read in (csv, spark.read.schema(schema).parquet(f"{tmp_path}/facturacion_validos")):
        assert sorted(tuple(r) for r in read.select("fila_origen", "archivo", "texto", "carga", "origen").collect()) == expected
    with pytest.raises(Exception, match="roto"):
        billing_file.write_valid(rows.selectExpr("fecha_carga", "archivo", "raise_error('roto') AS x"), str(tmp_path))
    assert spark.conf.get(setting) == before
