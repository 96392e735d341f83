"""Word files (.docx): paragraphs with style and table place, and both views of tracked changes."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from ..shipping import arrow_udf

# Fixed value: the namespace of word-processing markup.
W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
#: Files above this size are refused, as is markup with a document type.
LARGEST = 32 << 20

_MARK = StructType([StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("kind", StringType())])
#: Formatting that a run can switch on, as the mark it makes.
MARKS = {W + "b": "b", W + "i": "i", W + "u": "u", W + "strike": "s"}
_OFF = ("0", "false", "none")
_PARAGRAPH = StructType([StructField("pos", IntegerType()), StructField("style", StringType()), StructField("row", IntegerType()), StructField("accepted", StringType()), StructField("rejected", StringType()), StructField("level", IntegerType()), StructField("marks", ArrayType(_MARK))])


def read_document(data: bytes) -> list[dict]:
    """Paragraphs in order: text with all tracked changes accepted, and with all rejected."""
    if len(data) > LARGEST:
        raise ValueError("too-large")
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        markup = z.read("word/document.xml")
    if b"<!DOCTYPE" in markup:
        raise ValueError("doctype")
    out: list[dict] = []

    def formats(run) -> list[str]:
        found = run.find(W + "rPr")
        on = [] if found is None else [MARKS[x.tag] for x in found if x.tag in MARKS and x.get(W + "val") not in _OFF]
        script = None if found is None else found.find(W + "vertAlign")
        return on + ([] if script is None else [{"superscript": "sup", "subscript": "sub"}.get(script.get(W + "val"), "")])

    def text(node, views, inserted, deleted, marks):
        for child in node:
            tag = child.tag
            if tag == W + "r":
                start = len("".join(views[0]))
                text_of_run(child, views, inserted, deleted, marks)
                end = len("".join(views[0]))
                for kind in formats(child) if end > start else ():
                    if kind and marks and marks[-1]["kind"] == kind and marks[-1]["end"] == start:
                        marks[-1]["end"] = end
                    elif kind:
                        marks.append({"start": start, "end": end, "kind": kind})
            else:
                text_of_run([child], views, inserted, deleted, marks)

    def text_of_run(node, views, inserted, deleted, marks):
        for child in node:
            tag = child.tag
            if tag in (W + "ins", W + "moveTo"):
                text(child, views, True, deleted, marks)
            elif tag in (W + "del", W + "moveFrom"):
                text(child, views, inserted, True, marks)
            elif tag in (W + "t", W + "delText", W + "tab", W + "br"):
                piece = {W + "tab": "\t", W + "br": "\n"}.get(tag, child.text or "")
                if not deleted:
                    views[0].append(piece)
                if not inserted:
                    views[1].append(piece)
            elif tag not in (W + "pPr", W + "rPr"):
                text(child, views, inserted, deleted, marks)

    def walk(node, row):
        for child in node:
            if child.tag == W + "p":
                views = ([], [])
                style = child.find(f"{W}pPr/{W}pStyle")
                level = child.find(f"{W}pPr/{W}numPr/{W}ilvl")
                marks: list[dict] = []
                text(child, views, False, False, marks)
                number = None if level is None else int(level.get(W + "val", "0"))
                out.append({"pos": len(out), "style": None if style is None else style.get(W + "val"), "row": row, "accepted": "".join(views[0]), "rejected": "".join(views[1]), "level": number, "marks": marks})
            elif child.tag == W + "tr":
                walk(child, (row or 0) + 1 if row is not None else 0)
            else:
                walk(child, row)

    body = ElementTree.fromstring(markup).find(W + "body")
    walk(body if body is not None else [], None)
    return out


_CHANGE = re.compile(r"\{(\+\+|--)(.*?)\1\}")


def write_document(paragraphs: list[str]) -> bytes:
    """A minimal file with these paragraphs, for fixtures: "# " makes a bold heading, {++new++} and {--old--}
    are tracked changes."""

    def run(t: str, tag: str = "t", bold: bool = False) -> str:
        return f'<w:r>{"<w:rPr><w:b/></w:rPr>" * bold}<w:{tag} xml:space="preserve">{escape(t)}</w:{tag}></w:r>' if t else ""

    def paragraph(p: str) -> str:
        heading = p.startswith("# ")
        p, made, at = p[2:] if heading else p, "", 0
        for m in _CHANGE.finditer(p):
            made += run(p[at : m.start()], bold=heading)
            made += f"<w:ins>{run(m[2])}</w:ins>" if m[1] == "++" else f"<w:del>{run(m[2], 'delText')}</w:del>"
            at = m.end()
        return "<w:p>" + '<w:pPr><w:pStyle w:val="Heading1"/></w:pPr>' * heading + made + run(p[at:], bold=heading) + "</w:p>"

    body = "".join(map(paragraph, paragraphs))
    stream = io.BytesIO()
    with zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("word/document.xml", f'<?xml version="1.0" encoding="UTF-8"?><w:document xmlns:w="{W[1:-1]}"><w:body>{body}</w:body></w:document>')
    return stream.getvalue()


def write_folder(files: DataFrame, folder: str, name: str) -> None:
    """Write each row's content as <name>.docx below a folder that all executors reach."""

    def write(batches):
        from pyarrow import fs

        store, top = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        store.create_dir(top, recursive=True)
        for batch in batches:
            for n, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with store.open_output_stream(f"{top}/{n}.docx") as out:
                    out.write(content)
            yield batch.select([0])

    kind = StructType([f for f in files.schema.fields if f.name == name])
    files.select(name, "content").mapInArrow(write, kind).write.format("noop").mode("overwrite").save()


def _read(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    def one(data):
        try:
            return read_document(bytes(data))
        except (ValueError, KeyError, zipfile.BadZipFile, ElementTree.ParseError):
            return None

    for s in parts:
        yield s.map(one, na_action="ignore")


def _write(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in parts:
        yield s.map(lambda t: write_document(t.split("\n")), na_action="ignore")


paragraphs = arrow_udf(_read, ArrayType(_PARAGRAPH))
as_word_file = arrow_udf(_write, "binary")


def read_folder(spark: SparkSession, path: str) -> DataFrame:
    """path, sha256 and paragraphs (null: refused) of all .docx files below a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.docx").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.sha2("content", 256).alias("sha256"), paragraphs(F.col("content")).alias("paragraphs"))
