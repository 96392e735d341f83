"""Document bundles (JSON with a tree of sections): entries, flattened sections, references, free text."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from ..functions.hashing import strict_json
from ..shipping import arrow_udf

DEPTH = 48

_SECTION = StructType(
    [StructField("path", StringType()), StructField("depth", IntegerType()), StructField("pos", IntegerType()), StructField("parent", StringType()), StructField("code", StringType()), StructField("title", StringType()), StructField("div", StringType())]
)
_LEAF = StructType([StructField("path", StringType()), StructField("text", StringType())])


def walk_sections(resource: dict) -> list[dict]:
    """All sections below a composition in document order, each with its path; nothing is skipped."""
    out, todo = [], [("", "section", resource, 0)]
    while todo:
        parent, name, node, depth = todo.pop()
        if node is not resource:
            code = node.get("code") if isinstance(node.get("code"), dict) else {}
            codings = [c.get("code") for c in code.get("coding", []) if isinstance(c, dict)]
            text = node.get("text") if isinstance(node.get("text"), dict) else {}
            out.append({"path": name, "depth": depth - 1, "pos": len(out), "parent": parent or None, "code": codings[0] if len(codings) == 1 else None, "title": node.get("title"), "div": text.get("div")})
        prefix = "" if node is resource else name + "."
        inner = [(("" if node is resource else name), f"{prefix}section[{i}]", s, depth + 1) for i, s in enumerate(node.get("section") or []) if isinstance(s, dict)]
        if depth < DEPTH:
            todo += reversed(inner)
    return out


def _sections(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    def one(text):
        try:
            bundle = strict_json(text)
        except (ValueError, TypeError):
            return None
        first = next((e.get("resource") for e in bundle.get("entry", []) if e.get("resource", {}).get("resourceType") == "Composition"), None)
        return walk_sections(first) if first else []

    for s in parts:
        yield s.map(one, na_action="ignore")


sections_of = arrow_udf(_sections, ArrayType(_SECTION))


def leaves_of(value, path: str = "") -> list[dict]:
    """Every string of a JSON value with its path."""
    out, todo = [], [(path, value)]
    while todo:
        at, v = todo.pop()
        if isinstance(v, str):
            out.append({"path": at, "text": v})
        elif isinstance(v, dict):
            todo += [(f"{at}.{k}" if at else k, x) for k, x in reversed(v.items())]
        elif isinstance(v, list):
            todo += [(f"{at}[{i}]", x) for i, x in reversed(list(enumerate(v)))]
    return out


def _leaves(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in parts:
        yield s.map(lambda t: leaves_of(json.loads(t)), na_action="ignore")


leaves = arrow_udf(_leaves, ArrayType(_LEAF))


def flatten(bundles: DataFrame) -> DataFrame:
    """bundle_id, version_id and one row a section of (bundle_id, version_id, json)."""
    return bundles.select("bundle_id", "version_id", F.explode(sections_of(F.col("json"))).alias("s")).select("bundle_id", "version_id", "s.*")


def references(bundles: DataFrame) -> DataFrame:
    """bundle_id, reference, resolved: every reference string, and whether an entry has that fullUrl."""
    found = bundles.select("bundle_id", F.explode(leaves(F.col("json"))).alias("l"))
    refs = found.filter(F.col("l.path").endswith(".reference")).select("bundle_id", F.col("l.text").alias("reference"))
    urls = found.filter(F.col("l.path").rlike(r"^entry\[[0-9]+\]\.fullUrl$")).select("bundle_id", F.col("l.text").alias("reference"), F.lit(True).alias("hit")).distinct()
    return refs.join(urls, ["bundle_id", "reference"], "left").select("bundle_id", "reference", F.col("hit").isNotNull().alias("resolved"))


def as_bundle(doc_id: Column, text: Column) -> Column:
    """A bundle whose sections are the lines of a text: test and fixture source."""
    section = F.transform(
        F.split(text, "\n"),
        lambda x, i: F.struct(F.concat(F.lit("Section "), i.cast("string")).alias("title"), F.struct(F.lit("generated").alias("status"), F.concat(F.lit("<div>"), x, F.lit("</div>")).alias("div")).alias("text")),
    )
    url = lambda kind: F.concat(F.lit(f"urn:{kind}:"), doc_id.cast("string"))
    head = F.struct(url("composition").alias("fullUrl"), F.struct(F.lit("Composition").alias("resourceType"), F.struct(url("product").alias("reference")).alias("subject"), section.alias("section")).alias("resource"))
    return F.to_json(F.struct(F.lit("Bundle").alias("resourceType"), F.lit("document").alias("type"), F.array(head).alias("entry")))
