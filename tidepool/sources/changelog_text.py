"""Changelog rows written as delimited text: the row kind first, then the columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.operators.changelog import ROW_KINDS

TYPES = {"INT": "int", "VARCHAR": "string", "STRING": "string"}


def decode_changelog(
    df: DataFrame, columns: Sequence[tuple[str, str]], delimiter: str = "|", value: str = "value",
    kinds: Sequence[str] = ("INSERT", "DELETE"),
) -> DataFrame:
    """``INSERT|Alice|12`` to ``op`` and typed columns; an unknown row kind fails the job."""
    for name, kind in columns:
        if kind.upper() not in TYPES:
            raise ValueError(f"column {name}: type {kind} is not supported, use INT or VARCHAR")
    parts = F.split(F.col(value), "[" + delimiter.replace("\\", "\\\\") + "]" if len(delimiter) == 1 else delimiter)
    known = F.create_map(*[F.lit(x) for k in kinds for x in (k, ROW_KINDS[k])])
    op = F.coalesce(known[parts[0]], F.raise_error(F.concat(F.lit("row kind not supported: "), parts[0])))
    return df.select(op.alias("op"), *[
        parts[i].cast(TYPES[kind.upper()]).alias(name) for i, (name, kind) in enumerate(columns, start=1)])
