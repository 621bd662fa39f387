"""Files in and out: CSV of unknown dialect, spreadsheets, text blocks, catalogues, and the sinks."""

from __future__ import annotations

import csv
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENCODINGS = ("utf-8-sig", "utf-16", "cp1252", "latin-1")
PROBE = 20_000


def located(path: str, *folders: str) -> str:
    """The path as it is, or in one of the folders; spreadsheets and CSV of sources lie beside their catalogue."""
    bare = path.removeprefix("file://").removeprefix("file:")
    return next((p for p in (bare, *(os.path.join(f, bare) for f in folders)) if os.path.exists(p)), bare)


def head_of(spark: SparkSession, path: str, size: int = PROBE) -> bytes:
    """The first bytes of a file or of the first file of a folder, through Hadoop, so any file system will do."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if system.getFileStatus(place).isDirectory():
        place = sorted((s.getPath() for s in system.listStatus(place) if not s.getPath().getName().startswith(("_", "."))), key=str)[0]
    stream = system.open(place)
    try:
        return bytes(b & 0xFF for b in jvm.org.apache.commons.io.IOUtils.toByteArray(jvm.org.apache.commons.io.input.BoundedInputStream(stream, size)))
    finally:
        stream.close()


def dialect_of(head: bytes, separators: str = ",;\t|", required: list[str] | None = None) -> tuple[str, str]:
    """(encoding, separator): the first that give a header with several columns, or with all that are required."""
    for encoding in ENCODINGS:
        if (encoding == "utf-16") != head.startswith((b"\xff\xfe", b"\xfe\xff")):
            continue
        try:
            first = head.decode(encoding, "strict" if len(head) < PROBE else "ignore").splitlines()[0]
        except (UnicodeDecodeError, IndexError):
            continue
        for separator in separators:
            names = [n.strip().lower() for n in next(csv.reader([first], delimiter=separator))]
            if all(r.lower() in names for r in required) if required else len(names) > 1:
                return encoding.replace("-sig", ""), separator
    if required:
        raise ValueError(f"no dialect shows the columns {required}")
    return "utf-8", sniffed(head)


def sniffed(head: bytes) -> str:
    try:
        return csv.Sniffer().sniff(head.decode("utf-8", "replace"), delimiters=",;\t|").delimiter
    except csv.Error:
        return ","


def read_csv(spark: SparkSession, path: str, header: bool = True, required: list[str] | None = None, separators: str = ",;\t|") -> DataFrame:
    """All-string columns of a CSV whose encoding and separator are found from its first bytes; bad lines are dropped with a header, and kept without."""
    encoding, separator = dialect_of(head_of(spark, path), separators, required)
    western = encoding in ("cp1252", "latin-1")  # Spark reads no cp1252; as ISO 8859-1 each byte comes through, and its signs are put right after
    reader = spark.read.option("header", header).option("sep", separator).option("encoding", "iso-8859-1" if western else encoding).option("quote", '"').option("escape", '"').option("multiLine", encoding == "utf-16")
    df = reader.option("mode", "DROPMALFORMED" if header else "PERMISSIVE").csv(path)
    if encoding == "cp1252":
        signs = {chr(b): bytes([b]).decode("cp1252") for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}
        df = df.select(*[F.translate(F.col(f"`{c}`"), "".join(signs), "".join(signs.values())).alias(c.translate(str.maketrans(signs))) for c in df.columns])
    return df.toDF(*[c.lstrip("\ufeff") for c in df.columns])


def sheet_rows(content: bytes) -> list[list[str | None]]:
    """The rows of the first sheet of an XLSX file, as text."""
    import io
    import re
    import xml.etree.ElementTree as ET
    import zipfile

    local = lambda e: e.tag.rsplit("}", 1)[-1]
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = z.namelist()
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in si.iter() if local(t) == "t") for si in ET.fromstring(z.read("xl/sharedStrings.xml")) if local(si) == "si"]
        first = sorted((n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.findall(r"\d+", n)[0]))[0]
        rows = []
        for row in (e for e in ET.fromstring(z.read(first)).iter() if local(e) == "row"):
            cells: list[str | None] = []
            for cell in (e for e in row if local(e) == "c"):
                at = 0
                for c in re.match("[A-Z]+", cell.get("r", "A"))[0]:
                    at = at * 26 + ord(c) - 64
                cells += [None] * (at - len(cells))
                value = next(("".join(t.text or "" for t in e.iter() if local(t) in ("v", "t")) for e in cell if local(e) in ("v", "is")), None)
                cells[at - 1] = shared[int(value)] if cell.get("t") == "s" and value else value
            rows.append(cells)
        return rows


def sheet_bytes(rows: list[list[str | None]]) -> bytes:
    """An XLSX file with one sheet of texts."""
    import io
    import zipfile
    from xml.sax.saxutils import escape

    def cell(at: int, value: str | None) -> str:
        name = ""
        at += 1
        while at:
            at, rest = divmod(at - 1, 26)
            name = chr(65 + rest) + name
        return "" if value is None else f'<c r="{name}1" t="inlineStr"><is><t xml:space="preserve">{escape(value)}</t></is></c>'

    body = "".join("<row>" + "".join(cell(i, v) for i, v in enumerate(r)) + "</row>" for r in rows)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/worksheets/sheet1.xml", f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{body}</sheetData></worksheet>')
    return out.getvalue()


def to_xlsx(df: DataFrame) -> DataFrame:
    """content: spreadsheets with a header that hold the rows of `df` as text, one for each batch of rows."""
    names = df.columns

    def books(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield pd.DataFrame({"content": [sheet_bytes([names, *batch.astype(object).where(batch.notna(), None).values.tolist()])]})

    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in names]).mapInPandas(books, "content binary")


def xlsx_rows(books: DataFrame, names: list[str], header: bool = True) -> DataFrame:
    """The rows of the first sheets of spreadsheets (content) as text columns; rows that are too short are filled with null."""
    width = len(names)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch.content:
                data = sheet_rows(bytes(content))[1 if header else 0 :]
                yield pd.DataFrame([(r + [None] * width)[:width] for r in data], columns=range(width)).astype(object)

    return books.select("content").mapInPandas(rows, ", ".join(f"`_c{i}` string" for i in range(width))).toDF(*names)


def read_xlsx(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """All-string columns of the first sheets of XLSX files; the first file's header names them, without one _c0, _c1 ..."""
    books = spark.read.format("binaryFile").load(path)
    first = sheet_rows(bytes(books.orderBy("path").select("content").first()[0]))
    width = max(map(len, first), default=0)
    names = [(x or f"_c{i}") for i, x in enumerate(first[0] + [None] * (width - len(first[0])))] if header and first else [f"_c{i}" for i in range(width)]
    return xlsx_rows(books, names, header)


def read_table(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """Parquet, spreadsheet or CSV by the ending of the path."""
    low = path.lower().rstrip("/")
    if low.endswith(".parquet"):
        return spark.read.parquet(path)
    return read_xlsx(spark, path, header) if low.endswith((".xlsx", ".xlsm")) else read_csv(spark, path, header)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """value: the blocks of a text file, parted by empty lines."""
    return spark.read.text(path, lineSep="\n\n").where(F.length(F.trim("value")) > 0)


def catalogue_of(text: str) -> list[dict]:
    """The enabled sources of a YAML catalogue; a list, or a list under `sources`."""
    import yaml

    data = yaml.safe_load(text) or []
    entries = data.get("sources", []) if isinstance(data, dict) else data
    return [e for e in entries if e.get("enabled", True)]


def read_catalogue(path: str) -> list[dict]:
    with open(path, encoding="utf-8") as f:
        return catalogue_of(f.read())


def write_csv(df: DataFrame, path: str, quote_all: bool = False, append: bool = False, single: bool = False, fields: list[str] | None = None) -> int:
    """CSV with header in a folder; the number of rows written, observed on the way. single: one file, for small results only."""
    from pyspark.sql import Observation

    seen = Observation()
    out = (df.select(*fields) if fields else df).observe(seen, F.count(F.lit(1)).alias("rows"))
    (out.coalesce(1) if single else out).write.mode("append" if append else "overwrite").option("header", True).option("quoteAll", quote_all).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return seen.get["rows"]
