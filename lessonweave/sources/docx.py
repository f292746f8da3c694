"""Word documents as blocks: each file is one row of ``binaryFile`` and becomes its paragraphs and tables."""

from __future__ import annotations

import io
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
_R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def read_docx(spark: SparkSession, path: str) -> DataFrame:
    """(path, idx, kind, text, images, cells): ``kind`` is ``p`` or ``table``; a one-column table is its
    paragraphs. A file that is no Word document gives one row of kind ``error``."""
    schema = "path string, idx int, kind string, text string, images array<string>, cells array<array<string>>"
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.docx").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(p, i, *block) for p, content in zip(*(c.to_pylist() for c in batch.columns), strict=True) for i, block in enumerate(blocks_of(content))]
            types = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.list_(pa.string()))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["path", "idx", "kind", "text", "images", "cells"])

    return files.mapInArrow(run, schema)


def blocks_of(content: bytes) -> list[tuple]:
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            body = ET.fromstring(z.read("word/document.xml")).find(f"{_W}body")
            links = {}
            if "word/_rels/document.xml.rels" in z.namelist():
                links = {r.get("Id"): r.get("Target") for r in ET.fromstring(z.read("word/_rels/document.xml.rels"))}
    except (zipfile.BadZipFile, KeyError, ET.ParseError) as e:
        return [("error", str(e), [], None)]
    return list(_walk(body, links)) if body is not None else []


def _walk(container: ET.Element, links: dict) -> Iterator[tuple]:
    for e in container:
        if e.tag == f"{_W}p":
            yield ("p", _text(e), [links.get(b.get(f"{_R}embed"), "") for b in e.iter(f"{_A}blip")], None)
        elif e.tag == f"{_W}tbl":
            rows = [r.findall(f"{_W}tc") for r in e.findall(f"{_W}tr")]
            if all(len(r) == 1 for r in rows):
                for r in rows:
                    yield from _walk(r[0], links)
            else:
                yield ("table", None, [], [["\n".join(_text(p) for p in c.iter(f"{_W}p")) for c in r] for r in rows])
        elif e.tag == f"{_W}sdt":
            inner = e.find(f"{_W}sdtContent")
            if inner is not None:
                yield from _walk(inner, links)


def _text(p: ET.Element) -> str:
    """Runs in order; raised and lowered runs keep their tags, breaks and tabs become white space."""
    out = []
    for r in p.iter(f"{_W}r"):
        own = "".join({f"{_W}t": x.text or "", f"{_W}tab": "\t", f"{_W}br": "\n"}.get(x.tag, "") for x in r)
        align = r.find(f"{_W}rPr/{_W}vertAlign")
        tag = {"superscript": "sup", "subscript": "sub"}.get(align.get(f"{_W}val")) if align is not None else None
        out.append(f"<{tag}>{own}</{tag}>" if tag and own else own)
    return "".join(out)
