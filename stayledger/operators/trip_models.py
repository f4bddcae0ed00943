"""Trip-level model rows: after the first trip, after the second, and at every trip."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayledger.functions.codes import day, midnight, next_target, target_credits
from stayledger.operators.scale import keys_of

_SO_FAR = ("guest_id", "days_left", "credits", "gaming_credits", "non_gaming_credits", "gender",
           "age", "location")


def without_guests(df: DataFrame, *groups: DataFrame) -> DataFrame:
    for group in groups:
        df = df.join(keys_of(group, "guest_id"), "guest_id", "left_anti")
    return df


def first_trip_features(numbered: DataFrame, combined: DataFrame, special: DataFrame,
                        hist_special: DataFrame, year: int) -> DataFrame:
    """First trip of the year next to the prior year's history."""
    first = numbered.where(F.col("trip_no") == 1).select(
        "guest_id", F.date_diff(day(year, 12, 31), "trip_start").alias("days_left"),
        "credits", "gaming_credits", "non_gaming_credits", "gender", "age", "location",
        next_target("credits").alias("target_credits"))
    return without_guests(first, special, hist_special).join(combined, "guest_id")


def second_trip_features(numbered: DataFrame, combined: DataFrame, year: int) -> DataFrame:
    """First two trips together, of guests not promoted within them."""
    early = (numbered.where(F.col("changed_at").isNotNull())
             .groupBy("guest_id", "changed_at").agg(F.max("trip_no").alias("trips_to_promo"))
             .where(F.col("trips_to_promo") <= 2))
    two = (numbered.where(F.col("trip_no") <= 2).groupBy("guest_id")
           .agg(F.max("trip_start").alias("trip_start"),
                *(F.sum(c).alias(c) for c in ("credits", "gaming_credits", "non_gaming_credits")),
                *(F.max(c).alias(c) for c in ("age", "gender", "location")))
           .withColumn("days_left", F.date_diff(day(year, 12, 31), "trip_start"))
           .select(*_SO_FAR))
    return (without_guests(two, early).join(combined, "guest_id")
            .withColumn("target_credits", target_credits("top_tier"))
            .where(F.col("target_credits") > 0))


def label_by_promotion(features: DataFrame, natural: DataFrame, trips_used: int) -> DataFrame:
    """1 for guests whose first natural promotion took more trips than were used, else 0."""
    first = Window.partitionBy("guest_id").orderBy("changed_at")
    success = (natural.where(F.col("trips") > trips_used)
               .withColumn("_n", F.row_number().over(first)).where(F.col("_n") == 1)
               .select("guest_id", F.col("trips").alias("success_trips"), "changed_at"))
    return (features.join(success, "guest_id", "left")
            .withColumn("label", F.when(F.col("changed_at").isNull(), 0).otherwise(1))
            .drop("changed_at"))


def promotion_chain(natural: DataFrame, first) -> DataFrame:
    """Natural promotions with the one before.

    A guest has no more of them than trips, since each is the next one of some trip.
    """
    prev = F.lag("changed_at").over(Window.partitionBy("guest_id").orderBy("changed_at"))
    return natural.withColumn("prev_changed_at", F.coalesce(prev, first))


def trips_to_promotion(numbered: DataFrame, natural: DataFrame, combined: DataFrame,
                       special: DataFrame, hist_special: DataFrame, year: int) -> DataFrame:
    """Every trip with the trips left to the next natural promotion, -2 when there is none.

    The promotion's own trip is dropped, and so are guests already above their target.
    """
    trips = (without_guests(
        numbered.select(
            "guest_id", "trip_no", "running_credits", "age", "gender", "trip_start", "trip_end",
            F.date_diff(day(year, 12, 31), "trip_start").alias("days_left")),
        special, hist_special).join(combined, "guest_id"))
    spans = promotion_chain(natural, midnight(year, 1, 1)).select(
        F.col("guest_id").alias("_guest"), "promo_tier", "changed_at", "prev_changed_at")
    start = F.col("trip_start").cast("timestamp_ntz")
    labelled = trips.join(
        spans, (F.col("guest_id") == F.col("_guest")) & (start >= F.col("prev_changed_at"))
        & (start <= F.col("changed_at")), "left").drop("_guest")
    back = Window.partitionBy("guest_id", "changed_at").orderBy(
        F.desc("trip_start"), F.desc("trip_end"), F.desc("trip_no"))
    return (labelled
            .withColumn("label", F.when(F.col("changed_at").isNotNull(), F.row_number().over(back))
                        .otherwise(-1) - 1)
            .where(F.col("label") != 0)
            .withColumn("tier", F.coalesce("promo_tier", "top_tier"))
            .withColumn("target_credits", target_credits("tier", otherwise=0))
            .where(F.col("hist_credits") < F.col("target_credits"))
            .drop("promo_tier", "top_tier"))
