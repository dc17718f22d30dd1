"""Word and Excel files, which are zipped XML: text of documents, rows of workbooks and workbooks of rows."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

WORD = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
SHEET_ROWS = 1_048_576


def paragraph(p: ElementTree.Element) -> str:
    signs = {f"{WORD}tab": "\t", f"{WORD}br": "\n", f"{WORD}cr": "\n"}
    return "".join(e.text or "" if e.tag == f"{WORD}t" else signs.get(e.tag, "") for e in p.iter())


def docx_text(data: bytes | None) -> str:
    """A line for each paragraph; ``''`` for what can't be read."""
    try:
        with zipfile.ZipFile(io.BytesIO(data or b"")) as z:
            root = ElementTree.fromstring(z.read("word/document.xml"))
    except (zipfile.BadZipFile, KeyError, ElementTree.ParseError, RuntimeError, ValueError):
        return ""
    body = root.find(f"{WORD}body")
    return "\n".join(paragraph(p) for p in (root if body is None else body).iter(f"{WORD}p"))


@F.pandas_udf(StringType())
def document_text(data: pd.Series) -> pd.Series:
    """``docx_text`` of a binary column."""
    return pd.Series([docx_text(x) for x in data], dtype=object)


def column_number(reference: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", reference)[0]:
        n = 26 * n + ord(c) - 64
    return n - 1


def sheet_rows(data: bytes, sheet: str | None = None) -> Iterator[list[str | None]]:
    """Rows of a workbook's sheet, the first if none is named; empty cells are null."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = z.namelist()
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in si.iter(f"{SHEET}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{SHEET}si")]
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        sheets = [(s.get("name"), targets[s.get(RELATION)]) for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{SHEET}sheet")]
        place = next(t for n, t in sheets if sheet is None or n == sheet)
        root = ElementTree.fromstring(z.read(place.lstrip("/") if place.startswith("/") else f"xl/{place}"))
    for row in root.iter(f"{SHEET}row"):
        out: list[str | None] = []
        for cell in row.iter(f"{SHEET}c"):
            at = column_number(cell.get("r")) if cell.get("r") else len(out)
            out += [None] * (at + 1 - len(out))
            value = cell.find(f"{SHEET}v")
            if cell.get("t") == "inlineStr":
                out[at] = "".join(t.text or "" for t in cell.iter(f"{SHEET}t"))
            elif value is not None and value.text is not None:
                out[at] = shared[int(value.text)] if cell.get("t") == "s" else {"1": "True", "0": "False"}.get(value.text) if cell.get("t") == "b" else value.text
        yield out


def workbook(sheets: dict[str, tuple[Sequence[str], Sequence[Sequence]]]) -> bytes:
    """The bytes of a workbook with a header and rows in each sheet."""

    def cell(x) -> str:
        if x is None:
            return "<c/>"
        if isinstance(x, bool) or not isinstance(x, (int, float)):
            text = re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "", str(x))
            return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>'
        return f"<c><v>{x}</v></c>"

    main, office = SHEET[1:-1], "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package, kind = "http://schemas.openxmlformats.org/package/2006", "application/vnd.openxmlformats-officedocument.spreadsheetml"
    numbered, out = list(enumerate(sheets, 1)), io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        parts = "".join(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="{kind}.worksheet+xml"/>' for k, _ in numbered)
        z.writestr("[Content_Types].xml", f'<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/>{parts}</Types>')
        z.writestr("_rels/.rels", f'<Relationships xmlns="{package}/relationships"><Relationship Id="r1" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{package}/relationships">' + "".join(f'<Relationship Id="r{k}" Type="{office}/worksheet" Target="worksheets/sheet{k}.xml"/>' for k, _ in numbered) + "</Relationships>")
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{office}"><sheets>' + "".join(f'<sheet name="{escape(n)}" sheetId="{k}" r:id="r{k}"/>' for k, n in numbered) + "</sheets></workbook>")
        for k, name in numbered:
            header, rows = sheets[name]
            lines = "".join(f"<row>{''.join(map(cell, r))}</row>" for r in [header, *rows])
            z.writestr(f"xl/worksheets/sheet{k}.xml", f'<worksheet xmlns="{main}"><sheetData>{lines}</sheetData></worksheet>')
    return out.getvalue()


def xlsx(spark: SparkSession, path: str, columns: Sequence[str], sheet: str | None = None) -> DataFrame:
    """Rows of workbooks under ``columns``, which are looked up in each one's header; all are strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data in zip(batch.column("path").to_pylist(), (x.as_py() for x in batch.column("content")), strict=True):
                rows = sheet_rows(data, sheet)
                header = {name: k for k, name in enumerate(next(rows, []))}
                value = lambda r, c: r[header[c]] if c in header and header[c] < len(r) else None  # noqa: B023, E731
                found = [[value(r, c) for c in columns] for r in rows]
                cols = list(zip(*found, strict=True)) or [[]] * len(columns)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols] + [pa.array([at] * len(found), pa.string()), pa.array(range(len(found)), pa.int32())], [*columns, "source_file", "ord"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").option("recursiveFileLookup", True).load(path).select("path", "content")
    return files.mapInArrow(run, ", ".join(f"`{c}` string" for c in columns) + ", source_file string, ord int")


def write_workbook(spark: SparkSession, path: str, **sheets: DataFrame) -> None:
    """One workbook of small reports; a report beyond what a sheet holds is refused, not cut."""
    held = {}
    for name, rows in sheets.items():
        got = rows.limit(SHEET_ROWS).collect()
        if len(got) >= SHEET_ROWS:
            raise ValueError(f"{name} has more rows than a sheet holds")
        held[name] = (rows.columns, got)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, True)
    out.write(workbook(held))
    out.close()
