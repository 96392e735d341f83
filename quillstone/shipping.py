"""Makes this package importable in Python workers that do not have it installed."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import pandas_udf

ROOT = os.path.dirname(os.path.abspath(__file__))
_SENT = "quillstone.shipped"


def ship(spark: SparkSession) -> None:
    """Send the package to the executors once per application, as Spark sends --py-files."""
    context = spark.sparkContext
    if getattr(context, _SENT, None):
        return
    path = os.path.join(tempfile.mkdtemp(), "quillstone.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(ROOT):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("quillstone", os.path.relpath(full, ROOT)))
    context.addPyFile(path)
    setattr(context, _SENT, True)


#: Characters and bytes that a column function is given at once, if one row does not hold more.
SLICE = 1 << 20


def slices(parts, most: int = SLICE):
    """The same rows in order, in parts of at most ``most`` characters, so that what is made of a whole Arrow batch
    (up to 10,000 rows of any length) is never held at once."""
    for part in parts:
        columns = part if isinstance(part, tuple) else (part,)
        cuts, held = [0], 0
        for i, row in enumerate(zip(*columns)):
            size = sum(len(v) for v in row if hasattr(v, "__len__"))
            if held and held + size > most:
                cuts.append(i)
                held = 0
            held += size
        for a, b in zip(cuts, [*cuts[1:], len(columns[0])]):
            piece = tuple(c.iloc[a:b] for c in columns)
            yield piece if isinstance(part, tuple) else piece[0]


def arrow_udf(function, kind):
    """A column function over an Arrow UDF (iterator of series to iterator of series), made when it is
    first used, with the package at hand in the workers. The function meets its rows in ``slices``."""
    made = []

    @functools.wraps(function)
    def sliced(parts):
        return function(slices(parts))

    def call(*columns):
        ship(SparkSession.active())
        if not made:
            made.append(pandas_udf(sliced, kind))
        return made[0](*columns)

    call.__doc__ = function.__doc__
    return call


def map_arrow(df: DataFrame, function, schema: str) -> DataFrame:
    """df.mapInArrow with the package at hand in the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def map_pandas(df: DataFrame, function, schema: str) -> DataFrame:
    """df.mapInPandas with the package at hand in the workers."""
    ship(df.sparkSession)
    return df.mapInPandas(function, schema)
