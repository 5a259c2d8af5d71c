"""Column helpers shared by the corpus operators."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable
from pathlib import Path

import rungworks
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from rungworks.session import scratch_path

#: White space of all word rules: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]+"
_SPACE_CHARS = " \t\n\x0b\x0c\r"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once however often ``body`` names it.

    A plain column used inside a lambda would be worked out again for every element.
    """
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Words of a text: what white space separates.  Null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def without_space(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), _SPACE_CHARS, "")


def collapsed(text: Column) -> Column:
    """The text with each run of white space as one space.  Null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def free_name(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted names, each made longer until no column of ``df`` has it (case ignored)."""
    taken = {c.lower() for c in df.columns}
    names = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        names.append(name)
    return names


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the Python of tasks this package, wherever the driver found it: once per application.

    The package goes as a zip file through the shared folder, from where Spark adds it to
    the path of every task.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(rungworks.__file__).parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    path = scratch_path(spark, "package") + ".zip"
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(context._jsc.hadoopConfiguration()).create(target)
    out.write(packed.getvalue())
    out.close()
    context.addPyFile(path)
    _shipped.add(context.applicationId)
