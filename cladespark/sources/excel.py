"""Excel workbooks (.xlsx: zipped XML) as a Spark data source that reads and writes.

A workbook's sheets are tasks of their own, or share one where they are many; rows are streamed through the XML parser, of which only the shared strings are held. Every cell
is text, as it stands in the file; cells that a row leaves out are null. Written files, one for each task, have a
heading row in each sheet and go on in a further sheet after ROWS rows. Letters that XML can't hold are escaped as the format does it.
"""

from __future__ import annotations

import dataclasses
import itertools
import re
import uuid
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from .. import reach_workers
from .bgzf import listed, opened

#: Rows of a sheet with its heading: the format's limit. Rows that are handed on at once.
ROWS, AT_ONCE = 1_048_576, 5000
#: Beyond so many sheets, a task reads several of a workbook.
TASKS = 200

# Fixed values of the format.
MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
LINKS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006"
SHEET_TYPE = "application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"
BOOK_TYPE = "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"


def column_number(reference: str) -> int:
    """0 for A1, 27 for AB9."""
    number = 0
    for letter in reference.rstrip("0123456789"):
        number = number * 26 + ord(letter) - 64
    return number - 1


def unescaped(text: str) -> str:
    return re.sub(r"_x([0-9A-Fa-f]{4})_", lambda m: chr(int(m[1], 16)), text)


def escaped(text: str) -> str:
    marked = re.sub(r"_(?=x[0-9A-Fa-f]{4}_)", "_x005F_", text)
    return escape(re.sub(r"[\x00-\x08\x0b-\x1f￾￿]", lambda m: f"_x{ord(m[0]):04X}_", marked))


def texts_of(element: ElementTree.Element) -> str:
    """The text of a string, whose runs may differ in style; phonetic marks are left out."""
    parts = [t.text or "" for t in element.findall(f"{{{MAIN}}}t")] + [t.text or "" for r in element.findall(f"{{{MAIN}}}r") for t in r.findall(f"{{{MAIN}}}t")]
    return unescaped("".join(parts))


def sheets_of(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    """Name and part of each sheet, in order."""
    links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    found = ElementTree.fromstring(book.read("xl/workbook.xml")).findall(f"{{{MAIN}}}sheets/{{{MAIN}}}sheet")
    part = lambda target: target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    return [(s.get("name"), part(links[s.get(f"{{{LINKS}}}id")])) for s in found]


def shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    out = []
    with book.open("xl/sharedStrings.xml") as stream:
        for _, element in ElementTree.iterparse(stream):
            if element.tag == f"{{{MAIN}}}si":
                out.append(texts_of(element))
                element.clear()
    return out


def rows_of(book: zipfile.ZipFile, part: str, shared: list[str]) -> Iterator[tuple[int, list[str | None]]]:
    """Number (from 1) and cells of each row that a sheet has."""
    number = 0
    with book.open(part) as stream:
        for event, element in ElementTree.iterparse(stream, ("start", "end")):
            if event == "start" and element.tag == f"{{{MAIN}}}sheetData":
                data = element
            if event != "end" or element.tag != f"{{{MAIN}}}row":
                continue
            number = int(element.get("r") or number + 1)
            cells: list[str | None] = []
            for cell in element:
                at = column_number(cell.get("r")) if cell.get("r") else len(cells)
                kind, value, inline = cell.get("t"), cell.findtext(f"{{{MAIN}}}v"), cell.find(f"{{{MAIN}}}is")
                if kind == "inlineStr":
                    value = "" if inline is None else texts_of(inline)
                elif value is not None:
                    value = shared[int(value)] if kind == "s" else str(value != "0") if kind == "b" else unescaped(value) if kind == "str" else value
                cells += [None] * (at + 1 - len(cells))
                cells[at] = value
            yield number, cells
            data.clear()  # rows that are done


class Sheet(InputPartition):
    """Sheets of a workbook for one task: name and part of the first, and those that follow."""

    def __init__(self, path: str, name: str, part: str, more: list[tuple[str, str]] = ()):
        self.path, self.name, self.part = path, name, part
        self.sheets = [(name, part), *more]


class ExcelReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.sheet, self.first = options["path"], options.get("sheet"), options.get("first") == "true"

    def partitions(self) -> list[Sheet]:
        out = []
        for path, _ in listed(self.path, ".xlsx"):
            system, inner = opened(path)
            with system.open_input_file(inner) as stream, zipfile.ZipFile(stream) as book:
                out += [(path, name, part) for name, part in sheets_of(book) if self.sheet is None or name == self.sheet]
        # a task reads its workbook's list of parts: tasks for single sheets would take time by the square of their number
        many, tasks = max(1, len(out) // TASKS), []
        for path, own in itertools.groupby(out, lambda x: x[0]):
            named = [x[1:] for x in own]
            tasks += [Sheet(path, *named[i], named[i + 1 : i + many]) for i in range(0, len(named), many)]
        return tasks or [Sheet("", "", "")]

    def read(self, partition: Sheet) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        system, inner = opened(partition.path)

        def handed(name: str, rows: list[tuple[int, list[str | None]]]) -> pa.RecordBatch:
            n = len(rows)
            columns = [pa.array([partition.path] * n, pa.string()), pa.array([name] * n, pa.string()), pa.array([r for r, _ in rows], pa.int32()), pa.array([c for _, c in rows], pa.list_(pa.string()))]
            return pa.RecordBatch.from_arrays(columns, ["file", "sheet", "row", "cells"])

        with system.open_input_file(inner) as stream, zipfile.ZipFile(stream) as book:
            shared = shared_strings(book)
            for name, part in partition.sheets:
                held = []
                for row in rows_of(book, part, shared):
                    held.append(row)
                    if len(held) == AT_ONCE or self.first:
                        yield handed(name, held)
                        held = []
                    if self.first:
                        break
                if held:
                    yield handed(name, held)


@dataclasses.dataclass
class Written(WriterCommitMessage):
    name: str | None


class ExcelWriter(DataSourceArrowWriter):
    """A workbook for each task, under names of the attempt until all are written."""

    def __init__(self, options: dict, schema: StructType, overwrite: bool):
        self.path, self.overwrite, self.run = options["path"].rstrip("/"), overwrite, uuid.uuid4().hex
        self.rows = int(options.get("rows", ROWS))
        self.heading = [f.name for f in schema]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        context = TaskContext.get()
        name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}-{self.run[:8]}.xlsx"
        system, folder = opened(f"{self.path}/_temporary-{self.run}")
        rows = (row for batch in iterator for row in zip(*(c.to_pylist() for c in batch.columns)))
        first = next(rows, None)
        if first is None and context.partitionId():  # the first task writes a heading in any case
            return Written(None)
        system.create_dir(folder, recursive=True)
        with system.open_output_stream(f"{folder}/{name}") as stream, zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED) as book:
            sheets, left = 0, first is not None
            while left or not sheets:
                sheets += 1
                with book.open(f"xl/worksheets/sheet{sheets}.xml", "w", force_zip64=True) as sheet:
                    sheet.write(f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{MAIN}"><sheetData>'.encode())
                    sheet.write(row_xml(self.heading))
                    for _ in range(self.rows - 1):
                        if not left:
                            break
                        sheet.write(row_xml(first))
                        first = next(rows, None)
                        left = first is not None
                    sheet.write(b"</sheetData></worksheet>")
            numbers = range(1, sheets + 1)
            types = "".join(f'<Override PartName="/xl/worksheets/sheet{n}.xml" ContentType="{SHEET_TYPE}"/>' for n in numbers)
            book.writestr("[Content_Types].xml", f'<Types xmlns="{PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{BOOK_TYPE}"/>{types}</Types>')
            book.writestr("_rels/.rels", f'<Relationships xmlns="{PACKAGE}/relationships"><Relationship Id="rId1" Type="{LINKS}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
            named = "".join(f'<sheet name={quoteattr(f"Sheet{n}")} sheetId="{n}" r:id="rId{n}"/>' for n in numbers)
            book.writestr("xl/workbook.xml", f'<workbook xmlns="{MAIN}" xmlns:r="{LINKS}"><sheets>{named}</sheets></workbook>')
            links = "".join(f'<Relationship Id="rId{n}" Type="{LINKS}/worksheet" Target="worksheets/sheet{n}.xml"/>' for n in numbers)
            book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{PACKAGE}/relationships">{links}</Relationships>')
        return Written(name)

    def commit(self, messages: list[Written | None]) -> None:
        system, folder = opened(self.path)
        system.create_dir(folder, recursive=True)
        if self.overwrite:
            for path, _ in listed(self.path, ".xlsx"):
                system.delete_file(opened(path)[1])
        for name in (m.name for m in messages if m and m.name):
            system.move(f"{folder}/_temporary-{self.run}/{name}", f"{folder}/{name}")
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        system, folder = opened(f"{self.path}/_temporary-{self.run}")
        if system.get_file_info(folder).type.name == "Directory":
            system.delete_dir(folder)


def row_xml(values: tuple | list) -> bytes:
    """A row; nulls are left out as empty cells, numbers and texts are such."""
    cells = []
    for value in values:
        if value is None:
            cells.append("<c/>")
        elif isinstance(value, bool):
            cells.append(f'<c t="b"><v>{int(value)}</v></c>')
        elif isinstance(value, int) or isinstance(value, float) and value - value == 0:
            cells.append(f"<c><v>{value!r}</v></c>")
        else:
            cells.append(f'<c t="inlineStr"><is><t xml:space="preserve">{escaped(str(value))}</t></is></c>')
    return f"<row>{''.join(cells)}</row>".encode()


class ExcelSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "excel"

    def schema(self) -> str:
        return "file string, sheet string, row int, cells array<string>"

    def reader(self, schema: StructType) -> ExcelReader:
        return ExcelReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> ExcelWriter:
        return ExcelWriter(self.options, schema, overwrite)


def cells(spark: SparkSession, path: str, sheet: str | None = None, first: bool = False) -> DataFrame:
    """file, sheet, row, cells of the workbooks of a path; of each sheet's first row alone, if ``first``."""
    reach_workers(spark)
    spark.dataSource.register(ExcelSource)
    source = spark.read.format("excel").option("first", str(first).lower())
    return (source.option("sheet", sheet) if sheet is not None else source).load(path)


def tables(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """The tables of all sheets, one below the other, columns by the names in the first row of each; all text.

    Columns that a sheet lacks are null, those without a name are called by their place, and of equal names the later ones get a number.
    """
    found = cells(spark, path, sheet)
    heads = cells(spark, path, sheet, first=True).select("file", "sheet", F.col("row").alias("first"), F.col("cells").alias("heading"))
    body = found.join(F.broadcast(heads), ["file", "sheet"]).filter("row > first")  # a row for each sheet
    out = None
    for (heading,) in sorted((tuple(r) for r in heads.select("heading").distinct().collect()), key=str):  # the kinds of headings
        names: list[str] = []
        for at, name in enumerate(heading):
            name = name or f"column {at + 1}"
            names.append(name if name not in names else f"{name}.{names.count(name)}" if f"{name}.{names.count(name)}" not in names else f"{name}.{at + 1}")
        own = body.filter(F.col("heading").eqNullSafe(F.array(*(F.lit(x).cast("string") for x in heading)))).select(*(F.get("cells", F.lit(at)).alias(name) for at, name in enumerate(names)))
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    return out if out is not None else spark.createDataFrame([], "`column 1` string")


def write_tables(df: DataFrame, path: str, mode: str = "overwrite", rows: int = ROWS) -> None:
    """Workbooks of a table, one for each of its parts."""
    spark = df.sparkSession
    reach_workers(spark)
    spark.dataSource.register(ExcelSource)
    df.write.format("excel").option("rows", rows).mode(mode).save(path)
