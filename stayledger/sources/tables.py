"""Reading and writing of tables, snapshots, scalers and the run log."""

from __future__ import annotations

from pyspark.ml.feature import MinMaxScalerModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayledger.schemas import conform


def read(spark: SparkSession, source: str, schema: T.StructType | None = None,
         fmt: str = "parquet") -> DataFrame:
    """A path in the given format, or with ``fmt="table"`` a catalog table."""
    df = spark.read.table(source) if fmt == "table" else spark.read.format(fmt).load(source)
    return df if schema is None else conform(df, schema)


def newest_snapshot(spark: SparkSession, root: str) -> str:
    """Path of the child folder whose name sorts last, as dated folders do."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
    dated = [n for n in names if not n.startswith(("_", "."))]
    if not dated:
        raise FileNotFoundError(f"no snapshot below {root}")
    return f"{root.rstrip('/')}/{max(dated)}"


def latest_rows(df: DataFrame, snapshot: str) -> DataFrame:
    """Rows of the newest snapshot in a table that keeps them all."""
    newest = df.agg(F.max(snapshot).alias(snapshot))
    # A single row, so the lookup never needs the large side shuffled.
    return df.join(F.broadcast(newest), snapshot, "left_semi")


def newest_partition(spark: SparkSession, path: str, column: str) -> DataFrame:
    """Rows of the newest snapshot of a table partitioned by ``column``. The name comes from the
    folders, so no row of the table is read for it and the scan opens one partition."""
    folder = newest_snapshot(spark, path)
    rows = spark.read.option("basePath", path).parquet(path)
    return rows.where(F.col(column) == F.lit(folder.rsplit("=", 1)[1]).cast(rows.schema[column].dataType))


def write_by_year(df: DataFrame, path: str, ts: str) -> None:
    """Write as Parquet, one folder per calendar year, so that year filters prune. Years with rows
    in ``df`` are replaced, all others stay as they are."""
    (df.withColumn("calendar_year", F.year(ts)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("calendar_year").parquet(path))


def write_snapshot(df: DataFrame, path: str, column: str) -> None:
    """Add or replace the snapshots that ``df`` holds in a table partitioned by ``column``."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path))


def write_observed(df: DataFrame, path: str, step: str, ts: str) -> DataFrame:
    """Overwrite as Parquet and return the freshness row of what was written, which the tasks of
    the write have counted: no second job and no second reading."""
    seen = Observation(step)
    write(df.observe(seen, F.max(ts).cast("timestamp_ntz").alias("latest"), F.count(F.lit(1)).alias("row_count")), path)
    row = seen.get
    return df.sparkSession.createDataFrame(
        [(step, row["latest"], row["row_count"])], "step string, latest timestamp_ntz, row_count long")


def write(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.mode("overwrite").format(fmt).save(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def save_table(df: DataFrame, name: str, fmt: str = "parquet", path: str | None = None) -> None:
    writer = df.write.mode("overwrite").format(fmt)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def save_scaler(model: MinMaxScalerModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_scaler(path: str) -> MinMaxScalerModel:
    return MinMaxScalerModel.load(path)


def freshness(df: DataFrame, step: str, ts: str) -> DataFrame:
    """Latest instant and number of rows of a refreshed table."""
    return df.agg(F.max(ts).cast("timestamp_ntz").alias("latest"),
                  F.count("*").alias("row_count")).select(
        F.lit(step).alias("step"), "latest", "row_count")


def log_run(entry: DataFrame, path: str) -> None:
    """Append freshness rows to the run log."""
    stamped = entry.select("step", F.localtimestamp().alias("logged_at"), "latest", "row_count")
    stamped.coalesce(1).write.mode("append").parquet(path)
