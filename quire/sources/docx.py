"""DOCX containers by the standard library: paragraphs and tables in body order, pictures, styles, validation."""

from __future__ import annotations

import hashlib
import io
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
BODY = "word/document.xml"


def problem(raw: bytes) -> str | None:
    """Why a file is no DOCX container; null if it is one."""
    try:
        with zipfile.ZipFile(io.BytesIO(raw)) as z:
            return None if BODY in z.namelist() else "no document part"
    except zipfile.BadZipFile:
        return "no zip container"


def styles(z: zipfile.ZipFile) -> dict[str, str]:
    """Style ids and their names."""
    if "word/styles.xml" not in z.namelist():
        return {}
    out = {}
    for s in ElementTree.fromstring(z.read("word/styles.xml")).iter(f"{W}style"):
        name = s.find(f"{W}name")
        if name is not None:
            out[s.get(f"{W}styleId", "")] = name.get(f"{W}val", "")
    return out


def text_of(node: ElementTree.Element) -> str:
    parts = []
    for x in node.iter():
        if x.tag == f"{W}t":
            parts.append(x.text or "")
        elif x.tag == f"{W}tab":
            parts.append("\t")
        elif x.tag in (f"{W}br", f"{W}cr"):
            parts.append("\n")
    return "".join(parts).strip()


def blocks(raw: bytes) -> Iterator[dict]:
    """Paragraphs and tables as they stand in the body; broken containers give nothing."""
    if problem(raw):
        return
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        named, body = styles(z), ElementTree.fromstring(z.read(BODY)).find(f"{W}body")
        for seq, node in enumerate(body if body is not None else []):
            row = {"seq": seq, "kind": None, "style": None, "text": "", "rows": None, "images": [x.get(f"{R}embed") for x in node.iter(f"{A}blip") if x.get(f"{R}embed")], "page_breaks": sum(x.get(f"{W}type") == "page" for x in node.iter(f"{W}br"))}
            if node.tag == f"{W}p":
                style = node.find(f"{W}pPr/{W}pStyle")
                key = style.get(f"{W}val", "") if style is not None else ""
                yield row | {"kind": "paragraph", "style": named.get(key, key), "text": text_of(node)}
            elif node.tag == f"{W}tbl":
                rows = [[" ".join(filter(None, (text_of(p) for p in c.iter(f"{W}p")))) for c in r.findall(f"{W}tc")] for r in node.findall(f"{W}tr")]
                yield row | {"kind": "table", "rows": rows}


def images(raw: bytes) -> Iterator[dict]:
    """Pictures by relationship id, with their digest."""
    if problem(raw):
        return
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        names = set(z.namelist())
        if "word/_rels/document.xml.rels" not in names:
            return
        for rel in ElementTree.fromstring(z.read("word/_rels/document.xml.rels")):
            target = "word/" + rel.get("Target", "").lstrip("/").removeprefix("word/")
            if rel.get("Type", "").endswith("/image") and target in names:
                content = z.read(target)
                yield {"rid": rel.get("Id"), "name": target.rpartition("/")[2], "sha256": hashlib.sha256(content).hexdigest(), "content": content}


BLOCKS = pa.schema([("path", pa.string()), ("seq", pa.int32()), ("kind", pa.string()), ("style", pa.string()), ("text", pa.string()), ("rows", pa.list_(pa.list_(pa.string()))), ("images", pa.list_(pa.string())), ("page_breaks", pa.int32())])
IMAGES = pa.schema([("path", pa.string()), ("rid", pa.string()), ("name", pa.string()), ("sha256", pa.string()), ("content", pa.binary())])


def _each(spark: SparkSession, path: str, read, schema: pa.Schema, ddl: str) -> DataFrame:
    def run(batches):
        for batch in batches:
            for file, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if rows := [{"path": file, **row} for row in read(raw.as_py())]:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.docx").load(path).select("path", "content").mapInArrow(run, ddl)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return _each(spark, path, blocks, BLOCKS, "path string, seq int, kind string, style string, text string, rows array<array<string>>, images array<string>, page_breaks int")


def read_images(spark: SparkSession, path: str) -> DataFrame:
    return _each(spark, path, images, IMAGES, "path string, rid string, name string, sha256 string, content binary")
