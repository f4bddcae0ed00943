"""Fixed-length sequences of day rows, one sequence per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayledger.operators.days import _row_order

STEPS = 6
#: Days left of the days that training and back-tests look at: all but December 31.
BEFORE_YEAR_END = (1, 365)


def _vector(features: Sequence[str]):
    return F.array(*(F.col(f).cast("double") for f in features))


def trailing_windows(rows: DataFrame, features: Sequence[str], steps: int = STEPS,
                     anchors: tuple[int, int] | None = None,
                     by: Sequence[str] = ("guest_id",)) -> DataFrame:
    """The last ``steps`` rows up to every active day of a guest, or of what ``by`` names; with
    ``anchors`` only up to days with that many days left.

    One window frame per guest instead of one self-join per day of the year. Where trips
    overlap, a day has several rows; its last row is the anchor and gives the label.
    """
    order = Window.partitionBy(*by).orderBy(*_row_order(rows))
    frame = order.rowsBetween(-(steps - 1), Window.currentRow)
    label = [F.col("label")] if "label" in rows.columns else []
    windows = (rows.select(*by, "day", "days_left", *label,
                           F.collect_list(_vector(features)).over(frame).alias("sequence"),
                           F.lead("day").over(order).alias("_next"))
               .where(F.col("_next").isNull() | (F.col("_next") != F.col("day"))))
    if anchors is not None:
        windows = windows.where(F.col("days_left").between(*anchors))
    return windows.withColumn("length", F.size("sequence")).drop("_next")


def chunks(rows: DataFrame, features: Sequence[str], steps: int = STEPS) -> DataFrame:
    """Consecutive, non-overlapping runs of ``steps`` rows per guest; the last may be short.

    The label is that of the last row in the run. A group never holds more than ``steps``
    rows.
    """
    order = Window.partitionBy("guest_id").orderBy(*_row_order(rows))
    numbered = rows.withColumn("_n", F.row_number().over(order) - 1)
    label = ([F.max_by("label", "_n").alias("label")] if "label" in rows.columns else [])
    return (numbered.withColumn("chunk", F.floor(F.col("_n") / steps).cast("int"))
            .groupBy("guest_id", "chunk")
            .agg(F.sort_array(F.collect_list(F.struct("_n", _vector(features).alias("x"))))
                 .alias("_rows"), *label)
            .withColumn("sequence", F.transform("_rows", lambda r: r["x"]))
            .withColumn("length", F.size("sequence"))
            .drop("_rows"))


def padded(sequences: DataFrame, width: int, steps: int = STEPS, pad: float = 0.0) -> DataFrame:
    """Sequences of exactly ``steps`` rows, filled up behind the real ones."""
    filler = F.array_repeat(F.lit(float(pad)), width)
    return sequences.withColumn(
        "sequence", F.concat("sequence", F.array_repeat(filler, F.lit(steps) - F.size("sequence"))))
