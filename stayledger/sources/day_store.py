"""Player days at rest: a table by month and day, to which one day after the other is added.

A run of a day reads the ledger of that day only; what came before is read from here.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayledger.functions.codes import midnight
from stayledger.operators.ledger import player_days

SCHEMA = ("player_id string, credits decimal(28,4), gaming_credits decimal(28,4), "
          "non_gaming_credits decimal(28,4), property_credits decimal(28,4), month string, day date")


def put_days(ledger: DataFrame, path: str, first: date, last: date, property: str) -> None:
    """Write the player days from ``first`` to ``last``; those days are replaced, others stay.

    A rerun of a day gives the same table. A day that had rows before and has none now keeps its
    old ones. Rows are dealt by day and player, so a day with very many players has many files.
    """
    after = last + timedelta(days=1)
    items = ledger.where((F.col("ts") >= midnight(first.year, first.month, first.day))
                         & (F.col("ts") < midnight(after.year, after.month, after.day)))
    placed = player_days(items, property).withColumn("month", F.date_format("day", "yyyy-MM"))
    fields = [f.strip().split(" ", 1) for f in SCHEMA.replace("(28,4)", "(28;4)").split(",")]
    (placed.select(*(F.col(name).cast(kind.replace(";", ",")) for name, kind in fields))
     .repartitionByRange("day", "player_id").sortWithinPartitions("day", "player_id")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("month", "day").parquet(path))


def read_days(spark: SparkSession, path: str) -> DataFrame:
    """The player days, in place of a ledger; conditions on ``day`` choose the folders to read."""
    return spark.read.schema(SCHEMA).parquet(path)
