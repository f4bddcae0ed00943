"""Building blocks that keep hot keys from landing in one task.

Aggregates combine before the shuffle and joins are split at run time by AQE, but a
window never splits its partition. The helpers here compute the window results in two
levels: over small time buckets, and over the totals of those buckets.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


#: Milestones of the blocks that are open, innermost last.
_written: list[list[tuple[SparkSession, str]]] = []


def tune(spark: SparkSession) -> SparkSession:
    """Let AQE split skewed join partitions even where that costs one more exchange."""
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        return named
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="stayledger-"))
    return sc.getCheckpointDir()


def work_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "frame") -> DataFrame:
    """Compute once and cut the lineage, for frames that are read several times.

    Written as Parquet in the shared folder, so that lost executors cost no recomputation
    and readers still prune columns and know the size.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    if _written:
        _written[-1].append((df.sparkSession, path))
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def milestones() -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Delete what ``materialize`` writes inside the block when the block ends.

    The block gets a function that writes a result like ``materialize``, but for the code around
    the block: it stays when the block ends, and goes with the enclosing block if there is one.
    Frames that are built on anything else written inside must be used or written before.
    """
    _written.append([])

    def result(df: DataFrame, name: str) -> DataFrame:
        inner = _written.pop()
        try:
            return materialize(df, name)
        finally:
            _written.append(inner)

    try:
        yield result
    finally:
        for spark, path in _written.pop():
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def keys_of(df: DataFrame, *keys: str) -> DataFrame:
    """Keys for the right side of a semi or anti join, a few copies of each at most.

    AQE splits a hot key of the left side only if the right side is shuffled for the join itself.
    Distinct keys lie where their aggregation has put them, so there is no such shuffle. Here
    the aggregation goes by key and a part of the input, and the join deals its rows anew.
    """
    return df.select(*keys, (F.spark_partition_id() % 8).alias("_part")).distinct().select(*keys)


def running_total(df: DataFrame, key: str, ts: str, value: str, out: str, crowd: int = 1_000_000) -> DataFrame:
    """Running sum per key up to and including rows of the same instant; rows without a key or an
    instant go, but values without an instant count first. There is no sum where a minute has had
    no value so far.

    A key of at most ``crowd`` rows is one group of a window, so its rows are shuffled once. The
    few keys with more, of which there is at most one for each ``crowd`` rows, are broadcast, and
    their rows go through ``_total_by_levels``. ``df`` is read three times.
    """
    df = df.where(F.col(key).isNotNull())
    crowded = F.broadcast(df.groupBy(key).agg(F.count("*").alias("_rows")).where(F.col("_rows") > crowd).select(key))
    so_far = Window.partitionBy(key).orderBy(ts).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    valued = F.max(F.when(F.col(value).isNotNull(), F.col(ts))).over(so_far)
    few = df.join(crowded, key, "left_anti").withColumn("_total", F.when(
        F.date_trunc("minute", valued) == F.date_trunc("minute", ts), F.sum(value).over(so_far))).where(F.col(ts).isNotNull())
    many = _total_by_levels(df.join(crowded, key, "left_semi"), key, ts, value, "_total")
    names = [key, ts, *(c for c in df.columns if c not in (key, ts))]
    return few.select(*names, F.col("_total").alias(out)).unionByName(many.select(*names, F.col("_total").alias(out)))


def _total_by_levels(df: DataFrame, key: str, ts: str, value: str, out: str) -> DataFrame:
    """``running_total`` of crowded keys. Rows of an instant are summed before any window. A key is
    spread over its hours and their minutes: a window orders the hours of a key, the minutes
    of an hour or the instants of a minute.
    """
    instants = df.groupBy(key, ts).agg(F.sum(value).alias("_total")).withColumns({
        "_hour": F.date_trunc("hour", ts), "_minute": F.date_trunc("minute", ts)})
    back = Window.unboundedPreceding
    hours = instants.groupBy(key, "_hour").agg(F.sum("_total").alias("_total")).select(
        key, "_hour", F.sum("_total").over(
            Window.partitionBy(key).orderBy("_hour").rowsBetween(back, -1)).alias("_hours"))
    minutes = instants.groupBy(key, "_hour", "_minute").agg(F.sum("_total").alias("_total")).select(
        key, "_hour", "_minute", F.sum("_total").over(
            Window.partitionBy(key, "_hour").orderBy("_minute").rowsBetween(back, -1)).alias("_minutes"))
    inside = Window.partitionBy(key, "_hour", "_minute").orderBy(ts).rowsBetween(back, Window.currentRow)
    running = (instants.join(minutes, [key, "_hour", "_minute"]).join(hours, [key, "_hour"])
               .select(key, ts, (F.coalesce("_hours", F.lit(0)) + F.coalesce("_minutes", F.lit(0))
                                 + F.sum("_total").over(inside)).alias(out)))
    return df.join(running, [key, ts])


def previous_instant(df: DataFrame, key: str, ts: str, out: str, first: Column,
                     ties: list[str]) -> DataFrame:
    """``lag(ts)`` per key with a default for the first row, computed per day and over days."""
    tagged = df.withColumn("_day", F.to_date(ts))
    days = tagged.groupBy(key, "_day").agg(F.max(ts).alias("_last"))
    earlier = days.select(
        key, "_day",
        F.lag("_last").over(Window.partitionBy(key).orderBy("_day")).alias("_earlier"))
    inside = Window.partitionBy(key, "_day").orderBy(ts, *ties)
    return (tagged.join(earlier, [key, "_day"])
            .withColumn(out, F.coalesce(F.lag(ts).over(inside), "_earlier", first))
            .drop("_day", "_earlier"))
