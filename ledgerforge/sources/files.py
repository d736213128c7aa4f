"""Files as documents: hashed, typed by their bytes, and read into pages and sheets.

Readers are pluggable functions of a file's bytes; those for PDF and XLSX use
the standard library only. A file that can't be read has its error instead of
pages, never a failed job.
"""

from __future__ import annotations

import io
import re
import zipfile
import zlib
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerforge.functions.text import mime_of, sniff_content


def scan_folder(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, filename, sha256, mime, size, modified, content) of all files below a folder, hidden ones left out.

    The type is that of the content, else of the extension.
    """
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return f.where(~name.startswith(".")).select("path", name.alias("filename"), F.sha2("content", 256).alias("sha256"), mime_of(F.lit(None).cast("string"), name, F.col("content")).alias("mime"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"), "content")


def from_base64(uploads: DataFrame, name: str = "name", data: str = "data_b64", declared: str | None = None) -> DataFrame:
    """Uploaded files like scanned ones: path is the name; what can't be decoded has null content."""
    content = F.try_to_binary(F.col(data), F.lit("base64"))
    mime = mime_of(F.col(declared) if declared else F.lit(None).cast("string"), F.col(name), F.col("content"))
    u = uploads.withColumn("content", content)
    return u.select(F.col(name).alias("path"), F.col(name).alias("filename"), F.sha2("content", 256).alias("sha256"), mime.alias("mime"), F.length("content").cast("bigint").alias("size"), F.current_timestamp().alias("modified"), "content")


def first_copies(files: DataFrame) -> DataFrame:
    """(sha256, path) of the earliest file of each content; the rest are duplicates."""
    return files.groupBy("sha256").agg(F.min_by("path", F.struct("modified", "path")).alias("path"))


def read_text(content: bytes) -> list[str]:
    return [content.decode("utf-8", "replace")]


def read_pdf(content: bytes) -> list[str]:
    """The text of each page that shows any with simple fonts; pages in the order of their objects."""
    objects = {int(m[1]): m[2] for m in re.finditer(rb"(?s)(\d+) \d+ obj(.*?)endobj", content)}

    def stream(body: bytes) -> bytes:
        m = re.search(rb"(?s)stream\r?\n(.*?)\r?\n?endstream", body)
        if not m:
            return b""
        return zlib.decompress(m[1]) if b"FlateDecode" in body[: m.start()] else m[1]

    pages = []
    for body in objects.values():
        if not re.search(rb"/Type\s*/Page(?![a-zA-Z])", body):
            continue
        c = re.search(rb"/Contents\s*(\[[^\]]*\]|\d+ \d+ R)", body)
        refs = [int(x) for x in re.findall(rb"(\d+) \d+ R", c[1])] if c else []
        pages.append("\n".join(_shown(stream(objects.get(r, b""))) for r in refs))
    return pages


def _shown(ops: bytes) -> str:
    lines, line = [], ""
    for m in re.finditer(rb"\((?P<s>(?:\\.|[^\\()])*)\)|(?P<op>T\*|Td|TD|TJ|Tj|'|ET)", ops):
        if m["s"] is not None:
            line += re.sub(rb"\\([()\\])", rb"\1", m["s"]).decode("latin-1")
        elif m["op"] in (b"T*", b"Td", b"TD", b"'", b"ET") and line:
            lines.append(line)
            line = ""
    return "\n".join([*lines, line] if line else lines)


_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}


def read_xlsx(content: bytes, most_rows: int = 25) -> list[dict]:
    """name, row_count, columns (first row) and up to ``most_rows`` rows as text of each sheet."""
    z = zipfile.ZipFile(io.BytesIO(content))
    shared = []
    if "xl/sharedStrings.xml" in z.namelist():
        shared = ["".join(t.text or "" for t in si.iterfind(".//m:t", _NS)) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iterfind("m:si", _NS)]
    names = [s.get("name") for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iterfind(".//m:sheet", _NS)]
    files = sorted((n for n in z.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.findall(r"\d+", n)[0]))
    out = []
    for name, file in zip(names, files):
        rows = []
        for row in ElementTree.fromstring(z.read(file)).iterfind(".//m:row", _NS):
            cells: list[str] = []
            for c in row.iterfind("m:c", _NS):
                v = c.find("m:v", _NS)
                text = "".join(t.text or "" for t in c.iterfind(".//m:t", _NS)) if c.get("t") == "inlineStr" else (v.text if v is not None else "") or ""
                at = 0
                for ch in re.sub(r"\d", "", c.get("r") or ""):
                    at = at * 26 + ord(ch) - 64
                cells += [""] * (max(at - 1, len(cells)) - len(cells))
                cells.append(shared[int(text)] if c.get("t") == "s" and text else text)
            rows.append(cells)
        out.append({"name": name, "row_count": len(rows), "columns": rows[0] if rows else [], "rows_preview": rows[:most_rows]})
    return out


#: Readers of pages by type; more can be passed to ``extract``.
READERS: dict[str, Callable[[bytes], list[str]]] = {"application/pdf": read_pdf, "text/plain": read_text}
XLSX = "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet"

EXTRACTED = "sha256 string, path string, kind string, pages array<struct<page:int,text:string>>, sheets array<struct<name:string,row_count:int,columns:array<string>,rows_preview:array<array<string>>>>, error string"


def extract(files: DataFrame, readers: dict[str, Callable[[bytes], list[str]]] | None = None) -> DataFrame:
    """The pages or sheets of files; kind unsupported without a reader, error where the reader failed."""
    how = {**READERS, **(readers or {})}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for sha, path, mime, content in zip(pdf["sha256"], pdf["path"], pdf["mime"], pdf["content"]):
                kind, pages, sheets, error = "unsupported", None, None, None
                try:
                    if mime == XLSX:
                        kind, sheets = "xlsx", read_xlsx(content)
                    elif mime in how:
                        kind, pages = mime.split("/")[-1].replace("plain", "text"), [{"page": i, "text": t} for i, t in enumerate(how[mime](content), 1)]
                    elif mime.startswith("image/"):
                        kind = "image"
                except Exception as e:  # one bad file must not stop the others
                    error = f"{type(e).__name__}: {e}"[:300]
                rows.append((sha, path, kind, pages, sheets, error))
            yield pd.DataFrame(rows, columns=["sha256", "path", "kind", "pages", "sheets", "error"])

    return files.select("sha256", "path", "mime", "content").mapInPandas(run, EXTRACTED)
