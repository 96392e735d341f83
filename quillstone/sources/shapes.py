"""Shapes of JSON: the paths of its keys, its depth and its size, walked without recursion."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql.types import ArrayType, StringType

from ..shipping import arrow_udf

DEPTH, NODES = 48, 200_000
_STRING = re.compile(r'"(?:[^"\\]|\\.)*"')


def paths_of(value) -> list[str]:
    """The distinct paths of all keys; items of a list share one path."""
    out, todo = {}, [("", value)]
    while todo:
        at, v = todo.pop()
        if isinstance(v, dict):
            for k, x in v.items():
                path = f"{at}.{k}" if at else k
                out[path] = None
                todo.append((path, x))
        elif isinstance(v, list):
            todo += [(f"{at}[]", x) for x in v]
    return sorted(out)


def shape_of(text: str) -> str:
    """fits, too-deep, too-many-nodes or not-json. Depth is counted on the text, so deep text is never parsed."""
    depth = 0
    for c in _STRING.sub("", text):
        depth += (c in "[{") - (c in "]}")
        if depth > DEPTH:
            return "too-deep"
    try:
        value = json.loads(text)
    except ValueError:
        return "not-json"
    nodes, todo = 0, [value]
    while todo:
        v = todo.pop()
        nodes += 1
        if nodes > NODES:
            return "too-many-nodes"
        todo += v.values() if isinstance(v, dict) else v if isinstance(v, list) else ()
    return "fits"


def _paths(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in parts:
        yield s.map(lambda t: paths_of(json.loads(t)), na_action="ignore")


def _shapes(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in parts:
        yield s.map(shape_of, na_action="ignore")


key_paths = arrow_udf(_paths, ArrayType(StringType()))
json_shape = arrow_udf(_shapes, "string")
