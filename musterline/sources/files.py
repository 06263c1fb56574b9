"""Readers and writers of roster files."""

from __future__ import annotations

import io
import re
import warnings
import zipfile
from collections.abc import Iterable, Iterator
from itertools import chain, islice
from pathlib import Path
from xml.etree import ElementTree

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def snake(name: str) -> str:
    return re.sub(r"[^0-9a-z]+", "_", name.strip().lower()).strip("_")


def _sheets(book: zipfile.ZipFile) -> list[str]:
    found = (n for n in book.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n))
    return sorted(found, key=lambda n: int(re.search(r"(\d+)\.xml", n)[1]))


def _elements(stream, tag: str) -> Iterator[ElementTree.Element]:
    """Whole elements of a name one by one; what was read is dropped, so a long part is never held."""
    parents = []
    for event, element in ElementTree.iterparse(stream, ("start", "end")):
        if event == "start":
            parents.append(element)
            continue
        parents.pop()
        if element.tag == tag:
            yield element
            element.clear()
            if parents:
                parents[-1].remove(element)


def sheet_rows(data: bytes, sheet: int | None = None) -> Iterator[list[str | None]]:
    """The cells of one sheet (1: the first; by default the second if there is one) of a workbook as text, row by row."""
    with zipfile.ZipFile(io.BytesIO(data)) as book:
        names, strings = _sheets(book), []
        if "xl/sharedStrings.xml" in book.namelist():
            with book.open("xl/sharedStrings.xml") as part:
                strings = ["".join(t.text or "" for t in item.iter(f"{_MAIN}t")) for item in _elements(part, f"{_MAIN}si")]
        with book.open(names[min(sheet or 2, len(names)) - 1]) as part:
            for row in _elements(part, f"{_MAIN}row"):
                cells: list[str | None] = []
                for cell in row.iter(f"{_MAIN}c"):
                    letters, at = re.match(r"[A-Z]+", cell.get("r", "")), 0
                    for letter in letters[0] if letters else "":
                        at = at * 26 + ord(letter) - 64
                    cells += [None] * (at - 1 - len(cells))
                    value = cell.find(f"{_MAIN}v")
                    text = "".join(t.text or "" for t in cell.iter(f"{_MAIN}t")) or None if value is None else value.text
                    cells.append(strings[int(text)] if cell.get("t") == "s" and text is not None else text)
                yield cells


def _below_header(rows: Iterator[list[str | None]], header: str | None) -> list[str] | None:
    """The columns that the header names, after which ``rows`` stand at the first row below it; None if there is no header."""
    for row in rows:
        if header is None or row and row[0] and header.lower() in row[0].lower():
            names: list[str] = []
            for i, cell in enumerate(row):
                name = snake(cell or f"x{i + 1}")
                names.append(name if name not in names else f"{name}_{i + 1}")
            return names
    return None


MOST_COLUMNS = 16_384  # a sheet has no more columns than this
BATCH = 1_000  # rows that are handed over together


def read_sheets(spark: SparkSession, path: str, sheet: int | None = None, header: str | None = None) -> DataFrame:
    """The workbooks under ``path`` as text columns, with the file each row is of in ``file``; by default their second sheets where they have one.

    Tasks read the files, and each sheet as a stream; the driver sees the headers only. Columns are those of all headers, in the order
    of the first file that has them, null in other files; a name that a header repeats gets its number. ``header`` is a word in
    the header's first cell, by default it is the first row. A workbook without a header, or without any row, is an error.
    """
    import pyarrow as pa

    books = spark.read.format("binaryFile").load(path).select("path", "content")

    def heads(batches):
        for batch in batches:
            for name, data in zip(batch.column(0), batch.column(1)):
                yield pa.RecordBatch.from_pylist([{"file": name.as_py(), "names": _below_header(sheet_rows(data.as_py(), sheet), header)}], schema=head_shape)

    head_shape = pa.schema([("file", pa.string()), ("names", pa.list_(pa.string()))])
    found = books.mapInArrow(heads, "file string, names array<string>")
    columns = found.select("file", F.posexplode_outer("names")).groupBy("col").agg(F.min(F.struct("file", "pos")).alias("first")).orderBy("first").limit(MOST_COLUMNS + 2).collect()
    bare = [r["first"]["file"] for r in columns if r["col"] is None]
    if bare or not columns:
        raise ValueError(f"no header with {header!r} in the first column of {bare[0]}" if bare else f"no workbooks under {path}")
    if len(columns) > MOST_COLUMNS:
        raise ValueError(f"the headers name more than {MOST_COLUMNS} columns")
    every = [r["col"] for r in columns]
    if "file" in every:
        raise ValueError("a workbook has a column 'file' of its own")
    shape = pa.schema([(c, pa.string()) for c in ["file", *every]])

    def bodies(batches):
        for batch in batches:
            for name, data in zip(batch.column(0), batch.column(1)):
                rows, file = sheet_rows(data.as_py(), sheet), name.as_py()
                names = _below_header(rows, header)
                while part := list(islice(rows, BATCH)):
                    cells = {c: [r[i] if i < len(r) else None for r in part] for i, c in enumerate(names)}
                    none = [None] * len(part)
                    yield pa.RecordBatch.from_pydict({"file": [file] * len(part), **{c: cells.get(c, none) for c in every}}, schema=shape)

    return books.mapInArrow(bodies, ", ".join(f"`{c}` string" for c in ["file", *every]))


def read_sheet(spark: SparkSession, path: str, sheet: int | None = None, header: str | None = None) -> DataFrame:
    """``read_sheets`` of one workbook, without the column ``file``."""
    return read_sheets(spark, path, sheet, header).drop("file")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Text columns of a csv or xlsx file, by its extension."""
    kind = path.rsplit(".", 1)[-1].lower()
    if kind == "xlsx":
        return read_sheet(spark, path)
    if kind != "csv":
        raise ValueError(f"{path} is neither csv nor xlsx")
    return spark.read.csv(path, header=True)


def embedded_json(html: Column, start: str, schema: str) -> Column:
    """A JSON object that a page assigns to the script variable ``start``."""
    return F.from_json(F.nullif(F.regexp_extract(html, rf"(?s){re.escape(start)}\s*=\s*(\{{.*?\}});", 1), F.lit("")), schema)


def write_report(df: DataFrame, path: str, kind: str = "csv") -> None:
    """A report in one of the formats csv, parquet, json and xlsx.

    A workbook is one file on a disk of the driver's, written as rows come, a partition at a time; more rows than a sheet can have are an error.
    """
    if kind == "xlsx":
        write_sheet(chain([df.columns], (list(r) for r in df.toLocalIterator())), path)
        return
    if kind not in ("csv", "parquet", "json"):
        raise ValueError(f"unknown report format {kind!r}")
    df.write.mode("overwrite").format(kind).options(**({"header": "true"} if kind == "csv" else {})).save(path)


MOST_ROWS = 1 << 20  # of a sheet


def write_sheet(rows: Iterable[list], path: str) -> None:
    """A workbook of one sheet, texts and numbers as they are."""
    from xml.sax.saxutils import escape

    def cell(value) -> str:
        if value is None:
            return "<c/>"
        if isinstance(value, (int, float)) and not isinstance(value, bool):
            return f"<c><v>{value}</v></c>"
        return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(str(value))}</t></is></c>'

    main = _MAIN.strip("{}")
    package, office = "http://schemas.openxmlformats.org/package/2006", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    kinds = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    parts = {
        "[Content_Types].xml": f'<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{kinds}.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="{kinds}.worksheet+xml"/></Types>',
        "_rels/.rels": f'<Relationships xmlns="{package}/relationships"><Relationship Id="r1" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{office}"><sheets><sheet name="report" sheetId="1" r:id="r1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{package}/relationships"><Relationship Id="r1" Type="{office}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
    }
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as book:
        start = '<?xml version="1.0" encoding="UTF-8"?>'
        for name, text in parts.items():
            book.writestr(name, start + text)
        with book.open("xl/worksheets/sheet1.xml", "w", force_zip64=True) as part:
            part.write(f'{start}<worksheet xmlns="{main}"><sheetData>'.encode())
            for n, row in enumerate(rows):
                if n == MOST_ROWS:
                    raise ValueError(f"a sheet has at most {MOST_ROWS} rows")
                part.write(f"<row>{''.join(map(cell, row))}</row>".encode())
            part.write(b"</sheetData></worksheet>")


def write_summary(summary: DataFrame, path: str) -> None:
    """A report as csv, parquet or xlsx by the path's extension; other extensions are errors."""
    kind = path.rsplit(".", 1)[-1].lower()
    write_report(summary, path, kind)


def write_details(results: dict[str, DataFrame], folder: str, consolidate: DataFrame | None = None, kind: str = "csv") -> list[str]:
    """One report per check that found something, and the consolidated table if given; names what was written."""
    written = []
    for name, rows in results.items():
        if not rows.isEmpty():
            write_report(rows, f"{folder}/{name}.{kind}", kind)
            written.append(name)
    if consolidate is not None:
        write_report(consolidate, f"{folder}/consolidated.{kind}", kind)
        written.append("consolidated")
    return written


def write_failures(df: DataFrame, checks: dict[str, Column], folder: str, kind: str = "csv", by: str = "check") -> dict[str, int]:
    """The rows that fail each check, written in one pass over ``df`` under ``folder``/``by``=name; how many each check found.

    A row goes to every check it fails; a condition that is null fails none. Checks that find nothing get no folder and count 0.
    The counts are taken while the rows are written. A table that has a column ``by`` is an error.
    """
    if by in df.columns:
        raise ValueError(f"the table has a column {by!r} of its own")
    failed = {name: F.coalesce(c, F.lit(False)) for name, c in checks.items()}
    if not failed:
        return {}
    counted = Observation()
    seen = df.observe(counted, *[F.count_if(c).alias(name) for name, c in failed.items()])
    names = F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in failed.items()]))
    rows = seen.withColumn(by, F.explode(names))
    rows.write.mode("overwrite").partitionBy(by).format(kind).options(**({"header": "true"} if kind == "csv" else {})).save(folder)
    return {name: counted.get[name] for name in failed}


def file_name(state: str, prefix: str, extension: str) -> str:
    return f"{state}_{prefix}.{extension}"


def expect_files(paths: list[str], step: str | None = None) -> None:
    """An error that names the files that are not there, and the step that should have written them."""
    missing = [p for p in paths if not Path(p).exists()]
    if missing:
        raise FileNotFoundError(f"missing expected output files{f' for {step}' if step else ''}:\n" + "\n".join(missing))


def made_folder(path: str) -> str:
    """The folder, made with its parents where it is not there."""
    Path(path).mkdir(parents=True, exist_ok=True)
    return path


def check_schools(df: DataFrame) -> None:
    """An error for a table that cannot be geocoded: no name or state column, or only null names; absent helpful columns give a warning."""
    missing = [c for c in ("school_name", "state") if c not in df.columns]
    if missing:
        raise ValueError("missing columns: " + ", ".join(missing))
    helpful = [c for c in ("addr_clean", "city", "zip", "county_std") if c not in df.columns]
    if helpful:
        warnings.warn("columns that help geocoding are missing: " + ", ".join(helpful), stacklevel=2)
    if df.where("school_name is not null").isEmpty():
        raise ValueError("all school names are null")
