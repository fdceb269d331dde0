"""Change records to changelog rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.convert import Converter
from tidewell.operators.envelope import row_by_name
from tidewell.spec import KIND, SUB, TableSpec

INSERT, BEFORE, AFTER, DELETE = "+I", "-U", "+U", "-D"


def _entry(kind: str, sub: int, row: Column) -> Column:
    return F.struct(F.lit(kind).alias(KIND), F.lit(sub).alias(SUB), row.alias("_row"))


def expand_changelog(frame: DataFrame, op: str = "op", before: str = "before",
                     after: str = "after", strict: bool = False) -> DataFrame:
    """One changelog row per row image.

    ``c`` and ``r`` give ``+I`` of the new image, ``d`` gives ``-D`` of the old
    one, ``u`` gives ``-U`` then ``+U``, told apart by ``_sub``. Other ops give
    nothing, or fail the job when ``strict``. The image's fields become columns.
    """
    code = F.col(op)
    old, new = F.col(before), F.col(after)
    images = F.when(code.isin("c", "r"), F.array(_entry(INSERT, 0, new))).when(
        code == "d", F.array(_entry(DELETE, 0, old))).when(
        code == "u", F.array(_entry(BEFORE, 0, old), _entry(AFTER, 1, new)))
    if strict:
        images = images.otherwise(F.raise_error(
            F.concat(F.lit("unsupported op "), F.coalesce(code, F.lit("null")))))
    carried = [c for c in frame.columns if c not in (before, after)]
    return frame.select(*carried, F.explode(images).alias("_image")).select(
        *carried, f"_image.{KIND}", f"_image.{SUB}", "_image._row.*")
