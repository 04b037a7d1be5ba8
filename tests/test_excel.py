"""Workbooks: round trips, shared strings, odd cells."""

import random
import zipfile

import pytest
from pyspark.sql import functions as F

from cladespark.sources import excel, text


def test_round_trip(spark, tmp_path):
    rng = random.Random(1)
    words = ["", "plain", "<tag> & 'quotes'", " lead and trail ", "line\nbreak\r", "tab\t", "_x0041_", "bell\x07", "\U0001f600 é", "_x005F_", None]
    rows = [(i, rng.choice(words), rng.choice([0.1, -3.5, 1e300, None]), rng.choice([True, False, None])) for i in range(400)]
    df = spark.createDataFrame(rows, "k int, w string, x double, b boolean").repartition(3)
    excel.write_tables(df, str(tmp_path / "out"), rows=70)
    assert len(list((tmp_path / "out").glob("*.xlsx"))) == 3 and not list((tmp_path / "out").glob("_temp*"))
    got = sorted((int(r.k), r.w, None if r.x is None else float(r.x), r.b) for r in excel.tables(spark, str(tmp_path / "out")).collect())
    assert got == sorted((k, w, x, None if b is None else str(b)) for k, w, x, b in rows)
    sheets = excel.cells(spark, str(tmp_path / "out")).select("file", "sheet").distinct().count()
    assert sheets > 3
    assert excel.tables(spark, str(tmp_path / "out"), "Sheet2").count() <= 3 * 69
    excel.write_tables(df.filter("k < 0"), str(tmp_path / "out"))
    again = excel.tables(spark, str(tmp_path / "out"))
    assert again.columns == ["k", "w", "x", "b"] and again.count() == 0


def workbook(path, sheets, shared=()):
    with zipfile.ZipFile(path, "w") as book:
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{excel.MAIN}" xmlns:r="{excel.LINKS}"><sheets>' + "".join(f'<sheet name="{n}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(sheets)) + "</sheets></workbook>")
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{excel.PACKAGE}/relationships">' + "".join(f'<Relationship Id="r{i}" Target="{"/xl/" if i % 2 else ""}worksheets/s{i}.xml"/>' for i in range(len(sheets))) + "</Relationships>")
        for i, rows in enumerate(sheets.values()):
            book.writestr(f"xl/worksheets/s{i}.xml", f'<worksheet xmlns="{excel.MAIN}"><cols/><sheetData>{rows}</sheetData></worksheet>')
        if shared:
            book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{excel.MAIN}">{"".join(shared)}</sst>')


def test_cells_as_other_tools_write_them(spark, tmp_path):
    shared = ["<si><t>probe</t></si>", "<si><r><t>se</t></r><r><t xml:space='preserve'>q </t></r><rPh><t>no</t></rPh></si>", "<si><t>A</t></si>"]
    one = '<row r="2"><c r="A2" t="s"><v>0</v></c><c r="C2" t="s"><v>1</v></c><c r="D2" t="s"><v>0</v></c></row><row r="5"><c r="AB5"><v>7</v></c><c r="AC5" t="e"><v>#N/A</v></c></row><row r="6"><c r="A6" t="s"><v>2</v></c><c r="C6" t="str"><f>x</f><v>ACGT</v></c><c r="D6"><v>1E-3</v></c></row>'
    two = '<row r="1"><c r="A1" t="inlineStr"><is><t>probe</t></is></c><c r="B1" t="inlineStr"><is><t>code</t></is></c></row><row><c t="b"><v>1</v></c><c><v>9</v></c></row><row r="9"/>'
    workbook(tmp_path / "a.xlsx", {"One": one, "Two": two, "Empty": ""}, shared)
    got = excel.cells(spark, str(tmp_path / "a.xlsx"), "One").orderBy("row").collect()
    assert [(r.row, r.cells) for r in got] == [(2, ["probe", None, "seq ", "probe"]), (5, [None] * 27 + ["7", "#N/A"]), (6, ["A", None, "ACGT", "1E-3"])]
    table = excel.tables(spark, str(tmp_path))
    assert set(table.columns) == {"probe", "column 2", "seq ", "probe.1", "code"}
    assert sorted((tuple(r.asDict().get(c) for c in ("probe", "seq ", "probe.1", "code")) for r in table.collect()), key=str) == sorted([(None, None, None, None), ("A", "ACGT", "1E-3", None), ("True", None, None, "9"), (None, None, None, None)], key=str)
    assert excel.tables(spark, str(tmp_path), "Empty").count() == 0
    with pytest.raises(FileNotFoundError):
        excel.ExcelReader({"path": str(tmp_path / "none.xlsx")}).partitions()


def test_matrix_of_a_workbook(spark, tmp_path):
    df = spark.createDataFrame([("a", 0.0, 1.5), ("b", 1.5, 0.0)], "name string, a double, b double").coalesce(1)
    excel.write_tables(df, str(tmp_path / "m"))
    got = text.matrix(spark, str(tmp_path / "m" / "*.xlsx"), "dist").collect()
    assert sorted(tuple(r) for r in got) == [("a", "a", 0.0), ("a", "b", 1.5), ("b", "a", 1.5), ("b", "b", 0.0)]


def test_many_sheets_share_tasks(spark, tmp_path):
    path = str(tmp_path / "books")
    excel.write_tables(spark.range(1200).select("id", F.lit("x").alias("x")).coalesce(2), path, rows=3)
    tasks = excel.ExcelReader({"path": path}).partitions()
    assert sum(len(t.sheets) for t in tasks) == 600 and len(tasks) < 400
    got = excel.tables(spark, path).collect()
    assert sorted(int(r.id) for r in got) == list(range(1200)) and {r.x for r in got} == {"x"}
