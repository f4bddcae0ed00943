"""Scaling, sampling, splitting and encoding of model rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    MinMaxScaler, MinMaxScalerModel, OneHotEncoder, StringIndexer, VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayledger.functions.codes import hash_bucket, promo_trip_bucket
from stayledger.operators.scale import materialize

BUCKETS = 1000

#: Inputs of the trip models.
ENCODED_FEATURES = (
    "days_left", "credits", "gaming_credits", "non_gaming_credits", "gender_index", "age",
    "location_vector", "local_share", "lodger_share", "target_credits", "top_tier",
    "gaming_share", "non_gaming_share", "hist_credits", "hist_first_trip_age", "hist_trips")


def _assembled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    numeric = df.select("*", *(F.col(f).cast("double").alias(f"_{f}") for f in features))
    return VectorAssembler(inputCols=[f"_{f}" for f in features], outputCol="_x").transform(
        numeric).drop(*(f"_{f}" for f in features))


def fit_scaler(df: DataFrame, features: Sequence[str]) -> MinMaxScalerModel:
    """Smallest and largest value of every feature; a constant one scales to one half."""
    return MinMaxScaler(inputCol="_x", outputCol="_scaled").fit(
        _assembled(df.select(*features), features))


def apply_scaler(model: MinMaxScalerModel, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Adds ``<feature>_scaled``; values outside the fitted range leave [0, 1]."""
    scaled = model.transform(_assembled(df, features)).withColumn(
        "_scaled", vector_to_array("_scaled"))
    return scaled.select(*df.columns, *(F.col("_scaled")[i].alias(f"{f}_scaled")
                                        for i, f in enumerate(features)))


def scaled_names(features: Sequence[str]) -> list[str]:
    return [f"{f}_scaled" for f in features]


def thin_out_negatives(rows: DataFrame, drop_share: float, salt: str = "269") -> DataFrame:
    """Drop a share of the guests that never have a positive row, chosen by id hash."""
    dropped = (rows.groupBy("guest_id").agg(F.sum("label").alias("_positives"))
               .where(F.col("_positives") == 0)
               .where(hash_bucket("guest_id", salt, BUCKETS) < round(drop_share * BUCKETS)))
    return rows.join(dropped.select("guest_id"), "guest_id", "left_anti")


def balance(rows: DataFrame, key: str = "guest_id", salt: str = "balance") -> DataFrame:
    """Thin the larger class out to about the size of the smaller one, by id hash."""
    counts = (rows.where(F.col("label").isin(0, 1)).groupBy("label")
              .agg(F.count("*").alias("_n")))
    # Two rows at most, so each may look up the other through a broadcast.
    other = counts.select((1 - F.col("label")).alias("label"), F.col("_n").alias("_other"))
    sizes = F.broadcast(counts.join(F.broadcast(other), "label"))
    keep = hash_bucket(key, salt, BUCKETS) * F.col("_n") < F.least("_n", "_other") * BUCKETS
    return rows.join(sizes, "label").where(keep).drop("_n", "_other")


def guest_split(rows: DataFrame, train_share: float = 0.8, salt: str = "split") -> DataFrame:
    """Train or test side by guest, so that a guest's sequences never straddle the sides."""
    side = hash_bucket("guest_id", salt, BUCKETS) < round(train_share * BUCKETS)
    return rows.withColumn("side", F.when(side, "train").otherwise("test"))


def encode(rows: DataFrame) -> DataFrame:
    """Locations one-hot and genders indexed by frequency, assembled into ``features``.

    The indexes are tables that are joined, so no task and no driver holds all values.
    """
    for column, index in (("location", "location_index"), ("gender", "gender_index")):
        known = materialize(category_index(rows, column).select(column, F.col("idx").cast("double").alias(index)), "index")
        rows = rows.join(known, column)
    one_hot = OneHotEncoder(inputCol="location_index", outputCol="location_vector").fit(rows)
    return VectorAssembler(inputCols=list(ENCODED_FEATURES), outputCol="features",
                           handleInvalid="keep").transform(one_hot.transform(rows))


def trainable(rows: DataFrame) -> DataFrame:
    return rows.dropna(subset=["location"]).where(F.col("target_credits") != -1)


def trip_training_set(rows: DataFrame, balanced: bool = True) -> DataFrame:
    """First- or second-trip rows as feature vectors with a class of trips needed."""
    kept = materialize(trainable(rows), "trainable")
    numeric = (balance(kept) if balanced else kept).withColumns(
        {c: F.col(c).cast("double") for c in ENCODED_FEATURES
         if c not in ("gender_index", "location_vector")})
    return (encode(numeric)
            .withColumn("label", promo_trip_bucket("success_trips"))
            .select("guest_id", "features", "label"))


def category_index(rows: DataFrame, column: str, range_values: int = 50_000) -> DataFrame:
    """Index of each value by falling frequency, equal ones in alphabetical order.

    Values are dealt into ranges of that order. A value's index is its place in the range after
    the totals of the ranges before; the only window over everything has a row for each range.
    """
    counts = materialize(rows.dropna(subset=[column]).groupBy(column).agg(F.count("*").alias("rows")), "counts")
    ranges = -(-counts.count() // range_values) or 1
    dealt = materialize(counts.repartitionByRange(ranges, F.desc("rows"), column).withColumn(
        "_range", F.spark_partition_id()), "ranges")
    totals = dealt.groupBy("_range").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    first = totals.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(F.desc("rows"), column)) - 1
    return dealt.join(F.broadcast(first), "_range").select(
        column, "rows", (F.col("_first") + place).cast("long").alias("idx"))


def profile(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """Count, mean, standard deviation and range of every feature, one row each."""
    stats = ("n", "mean", "stddev", "lowest", "highest")
    cells = []
    for f in features:
        x = F.col(f).cast("double")
        values = (F.count(x), F.avg(x), F.stddev_samp(x), F.min(x), F.max(x))
        cells.append(F.struct(F.lit(f).alias("feature"),
                              *(v.alias(s) for v, s in zip(values, stats))))
    return rows.agg(F.array(*cells).alias("_cells")).select(F.inline("_cells"))
