"""Per-guest history of a year and the split into earned and special promotions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayledger.functions.codes import (
    DROP_IN, EARNED, IN_HOUSE, LOCAL, coded_number, day, midnight, target_credits)
from stayledger.operators.scale import keys_of, materialize
from stayledger.operators.trips import REASONS

PERIOD = ["guest_id", "calendar_year", "changed_at"]
ROLES = ("tier_label", "tier_sub_label", "change_label", "change_sub_label")
_SUMS = ("trips", "trip_days", "credits", "gaming_credits", "non_gaming_credits",
         "lodger_trips", "local_trips", "drop_in_trips")


def _with_tier_and_target(df: DataFrame) -> DataFrame:
    return (df.withColumn("trip_tier", F.coalesce("promo_tier", coded_number("tier")))
            .withColumn("target_credits", target_credits("trip_tier"))
            .where(F.col("target_credits") != -1))


def customer_history(trips: DataFrame, promoted: DataFrame, year: int) -> DataFrame:
    """Trips of a year per guest and promotion: all trips up to the promotion's day.

    A trip counts for every later promotion, and trips after the last promotion form a
    period of their own. The pairs of trips and promotions are never built: totals run over
    the trip days of a guest, and a promotion reads the total that holds on its day. Of the
    trips at most one row per guest, player and day is left before they are placed by player.
    """
    who = ["guest_id", "player_id"]

    def lodged(status: str):
        return F.sum(F.when(F.col("lodging") == status, 1).otherwise(0))

    by_day = (
        trips.dropna(subset=["age", "gender"])
        .where(F.col("trip_start").between(day(year, 1, 1), day(year, 12, 31)))
        .groupBy(*who, F.col("trip_start").alias("on"))
        .agg(F.count("*").alias("trips"),
             F.sum(F.date_diff("trip_end", "trip_start") + 1).alias("trip_days"),
             *(F.sum(c).alias(c) for c in ("credits", "gaming_credits", "non_gaming_credits")),
             lodged(IN_HOUSE).alias("lodger_trips"), lodged(LOCAL).alias("local_trips"),
             lodged(DROP_IN).alias("drop_in_trips"), F.min("tier").alias("tier"))
        .repartition("player_id"))

    order = Window.partitionBy(*who).orderBy("on")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = by_day.select(
        "guest_id", F.col("player_id").alias("_player"), F.col("on").alias("_from"),
        F.coalesce(F.lead("on").over(order), day(year + 1, 1, 1)).alias("_until"),
        *(F.sum(c).over(so_far).alias(c) for c in _SUMS),
        F.min("tier").over(so_far).alias("tier"), F.min("on").over(so_far).alias("first_trip"))
    # Months spread a player with very many promotions and keep the comparisons few.
    months = F.sequence(F.month("_from"), F.month(F.date_sub("_until", 1)))
    on = F.to_date("changed_at")
    reached = ((F.col("player_id") == F.col("_player")) & (F.month(on) == F.col("_month"))
               & (on >= F.col("_from")) & (on < F.col("_until")))
    promoted_part = (
        promoted.where((on >= day(year, 1, 1)) & (on <= day(year, 12, 31)))
        .join(running.withColumn("_month", F.explode(months)), reached)
        .groupBy("guest_id", "changed_at")
        .agg(*(F.sum(c).alias(c) for c in _SUMS), F.min("first_trip").alias("first_trip"),
             F.min("tier").alias("tier"), F.max("tier_before").alias("promo_tier"),
             *(F.max(r).alias(r) for r in REASONS)))

    last = promoted.groupBy("player_id").agg(F.max(on).alias("_last"))
    open_part = (
        by_day.join(last, "player_id", "left")
        .where(F.col("_last").isNull() | (F.col("on") > F.col("_last")))
        .groupBy("guest_id")
        .agg(*(F.sum(c).alias(c) for c in _SUMS), F.min("on").alias("first_trip"),
             F.min("tier").alias("tier")))
    return _with_tier_and_target(
        promoted_part.unionByName(open_part, allowMissingColumns=True)
        .withColumn("calendar_year", F.lit(year))
        .withColumn("first_trip_age", F.date_diff(day(year, 12, 31), "first_trip"))
        .drop("first_trip"))


def trip_rollup_by_promotion(trips: DataFrame) -> DataFrame:
    """Trips per guest and next promotion, from trips that carry at most that promotion."""
    return _with_tier_and_target(
        trips.groupBy(*PERIOD).agg(
            F.count("*").alias("trips"), F.sum("credits").alias("credits"),
            F.sum("gaming_credits").alias("gaming_credits"),
            F.sum("non_gaming_credits").alias("non_gaming_credits"),
            F.min("tier").alias("tier"), F.max("tier_before").alias("promo_tier"),
            F.max("tier_after").alias("tier_after"), *(F.max(r).alias(r) for r in REASONS)))


def with_reason_labels(periods: DataFrame, enum: DataFrame) -> DataFrame:
    """Promoted periods with the label of each of their four reason codes."""
    labels = enum.groupBy("enum_value").agg(F.max("label").alias("label"))
    out = periods.where(F.col("changed_at").isNotNull())
    for code, role in zip(REASONS, ROLES):
        named = labels.select(F.col("enum_value").alias(code), F.col("label").alias(role))
        out = out.join(named, code, "left")
    return out


def earned_only(labelled: DataFrame, year: int) -> DataFrame:
    """No reason label but the ordinary one, and not on the yearly reset of February 1."""
    out = labelled.where(F.to_date("changed_at") != day(year, 2, 1))
    for role in ROLES:
        out = out.where(F.col(role).isNull() | (F.col(role) == EARNED))
    return out


def set_tier_activity(activity: DataFrame, year: int) -> DataFrame:
    """Tiers set by hand in a year."""
    return (activity.where(F.col("activity_type") == "Set Tier")
            .where((F.col("created_at") >= midnight(year, 1, 1))
                   & (F.col("created_at") < midnight(year + 1, 1, 1)))
            .select(F.col("loyalty_id").cast("string").alias("player_id"), "created_at"))


def _with_player(earned: DataFrame, xref: DataFrame) -> DataFrame:
    return earned.join(xref.select("guest_id", "player_id"), "guest_id", "left")


def natural_promotions_of_history(history: DataFrame, enum: DataFrame, xref: DataFrame,
                                  activity: DataFrame, year: int,
                                  share: float = 0.8) -> DataFrame:
    """Earned promotions not set by hand at that instant, with most of the target credited."""
    by_hand = set_tier_activity(activity, year).withColumnRenamed("created_at", "changed_at")
    earned = (with_reason_labels(history, enum)
              .withColumn("earned_share",
                          F.col("credits").cast("double") / F.col("target_credits")))
    return (_with_player(earned_only(earned, year), xref)
            .join(keys_of(by_hand, "player_id", "changed_at"), ["player_id", "changed_at"], "left_anti")
            .where(F.col("earned_share") > share))


def natural_promotions(rollup: DataFrame, enum: DataFrame, xref: DataFrame,
                       activity: DataFrame, year: int) -> DataFrame:
    """Earned promotions of guests whose tier was never set by hand in the year."""
    by_hand = keys_of(set_tier_activity(activity, year), "player_id")
    earned = earned_only(with_reason_labels(rollup, enum), year)
    return _with_player(earned, xref).join(by_hand, "player_id", "left_anti")


def special_only_guests(labelled: DataFrame, natural: DataFrame) -> DataFrame:
    """Promoted guests without a natural promotion."""
    return (labelled.select("guest_id").distinct()
            .join(keys_of(natural, "guest_id"), "guest_id", "left_anti"))


_BEST = ("gaming_credits", "non_gaming_credits", "credits", "trips", "trip_days",
         "first_trip_age", "lodger_trips", "local_trips")


def promoted_history(natural: DataFrame) -> DataFrame:
    """Largest period of each guest before a natural promotion, one tier up."""
    return natural.groupBy("guest_id").agg(
        (F.max("trip_tier") + 1).alias("top_tier"), *(F.max(c).alias(c) for c in _BEST))


def unpromoted_history(history: DataFrame) -> DataFrame:
    """Largest period of each guest without a promotion at its end."""
    return (history.where(F.col("changed_at").isNull()).groupBy("guest_id")
            .agg(F.max("trip_tier").alias("top_tier"), *(F.max(c).alias(c) for c in _BEST)))


def combined_history(promoted: DataFrame, unpromoted: DataFrame) -> DataFrame:
    """One row per guest: sums of both parts and ratios of sums, 0 where the whole is 0."""
    def ratio(part: str, whole: str):
        return F.coalesce(F.try_divide(F.sum(part).cast("double"), F.sum(whole).cast("double")),
                          F.lit(0.0))

    return promoted.unionByName(unpromoted).groupBy("guest_id").agg(
        F.max("top_tier").alias("top_tier"),
        ratio("gaming_credits", "credits").alias("gaming_share"),
        ratio("non_gaming_credits", "credits").alias("non_gaming_share"),
        F.sum("credits").alias("hist_credits"),
        F.sum("trips").alias("hist_trips"),
        F.sum("trip_days").alias("hist_trip_days"),
        F.max("first_trip_age").alias("hist_first_trip_age"),
        ratio("lodger_trips", "trips").alias("lodger_share"),
        ratio("local_trips", "trips").alias("local_share"))


def guest_history(history: DataFrame, enum: DataFrame, xref: DataFrame, activity: DataFrame,
                  year: int, share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(combined history, guests with special promotions only) of a year."""
    natural = materialize(
        natural_promotions_of_history(history, enum, xref, activity, year, share), "natural")
    combined = combined_history(promoted_history(natural), unpromoted_history(history))
    return combined, special_only_guests(with_reason_labels(history, enum), natural)


def year_promotions(rollup: DataFrame, enum: DataFrame, xref: DataFrame, activity: DataFrame,
                    year: int) -> tuple[DataFrame, DataFrame]:
    """(natural promotions, guests with special promotions only) of the model year."""
    natural = materialize(natural_promotions(rollup, enum, xref, activity, year), "natural")
    return natural, special_only_guests(with_reason_labels(rollup, enum), natural)
