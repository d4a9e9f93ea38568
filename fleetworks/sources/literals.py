"""Reference rows written in code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def _sql(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def literal_frame(spark: SparkSession, schema: str, rows: Sequence[Sequence]) -> DataFrame:
    """A small frame from Python values, as an inline table.

    The optimizer knows the exact size of an inline table, so joins to it broadcast without a hint.
    """
    columns = [c.strip().split(" ", 1) for c in schema.split(";")]
    body = ", ".join("(" + ", ".join(_sql(v) for v in row) + ")" for row in rows)
    names = ", ".join(name for name, _ in columns)
    casts = ", ".join(f"CAST({name} AS {kind}) AS {name}" for name, kind in columns)
    return spark.sql(f"SELECT {casts} FROM VALUES {body} AS t({names})")
