"""Output columns of each query: one specification for the Spark and the SQL side.

``name:kind`` pairs; kinds are b bigint, d double, r double rounded to six places,
s string, t date, c instant as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def columns(spec: str) -> list[tuple[str, str]]:
    return [tuple(item.split(":")) for item in spec.split()]


def _instant(c: Column) -> Column:
    """Text to the microsecond, whose trailing zeros Spark leaves out."""
    text = c.cast("timestamp_ntz").cast("string")
    return F.concat(F.substring(text, 1, 19), F.lit("."), F.rpad(F.substring(text, 21, 6), 6, "0"))


def shape(df: DataFrame, spec: str) -> DataFrame:
    kinds = {
        "b": lambda c: c.cast("long"), "d": lambda c: c.cast("double"),
        "r": lambda c: F.round(c.cast("double"), 6), "s": lambda c: c.cast("string"),
        "t": lambda c: c.cast("date"),
        "c": _instant}
    return df.select(*(kinds[kind](F.col(name)).alias(name) for name, kind in columns(spec)))


def shape_sql(body: str, spec: str) -> str:
    kinds = {
        "b": "CAST({0} AS BIGINT)", "d": "CAST({0} AS DOUBLE)",
        "r": "round(CAST({0} AS DOUBLE), 6)", "s": "CAST({0} AS VARCHAR)",
        "t": "CAST({0} AS DATE)", "c": "strftime(CAST({0} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f')"}
    cells = ", ".join(f"{kinds[kind].format(name)} AS {name}" for name, kind in columns(spec))
    return f"SELECT {cells} FROM ({body}) AS answer"
