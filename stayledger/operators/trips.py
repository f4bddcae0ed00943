"""Credits, demographics and promotions of trips."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayledger.functions.codes import day, midnight
from stayledger.operators.ledger import of_years, player_days, with_guest
from stayledger.operators.scale import previous_instant
from stayledger.operators.visits import TRIP_KEYS

REASONS = ("tier_reason", "tier_sub_reason", "change_reason", "change_sub_reason")


def trip_credits(trips: DataFrame, ledger: DataFrame, xref: DataFrame, year: int) -> DataFrame:
    """Credits of a year earned on the days of trips that start in it.

    ``trips`` holds one row per guest, start and end day, as the roll-up leaves it.

    The ledger arrives as player days, so a guest brings at most one row per day and
    player to the join, and the sums stay exact.
    """
    starts = trips.where((F.col("trip_start") >= day(year, 1, 1))
                         & (F.col("trip_start") < day(year + 1, 1, 1)))
    return credits_within(starts, of_years(ledger, year), xref)


def credits_within(trips: DataFrame, ledger: DataFrame, xref: DataFrame) -> DataFrame:
    days = with_guest(player_days(ledger), xref).alias("d")
    t = trips.alias("t")
    inside = ((F.col("t.guest_id") == F.col("d.guest_id"))
              & F.col("d.day").between(F.col("t.trip_start"), F.col("t.trip_end")))
    return (t.join(days, inside)
            .groupBy("d.guest_id", "d.player_id", "t.trip_id", "t.trip_start", "t.trip_end",
                     "t.property", F.col("t.start_tier").alias("tier"))
            .agg(F.sum("d.credits").alias("credits"),
                 F.sum("d.gaming_credits").alias("gaming_credits"),
                 F.sum("d.non_gaming_credits").alias("non_gaming_credits")))


def with_demographics(trips: DataFrame, demo: DataFrame, *, since: date | None = None,
                      until: date | None = None,
                      columns: tuple[str, ...] = ("gender", "age", "location", "lodging",
                                                  "tenure")) -> DataFrame:
    """Trips with what is known about their guest; bounds on the start prune ``demo``."""
    known = demo
    if since is not None:
        known = known.where(F.col("trip_start") >= F.lit(since))
    if until is not None:
        known = known.where(F.col("trip_start") <= F.lit(until))
    return trips.join(known.select(*TRIP_KEYS, *columns), TRIP_KEYS)


def _described(df: DataFrame) -> DataFrame:
    return (df.withColumn("calendar_year", F.year("trip_start"))
            .dropna(subset=["age", "gender"]))


def with_later_promotions(trips: DataFrame, promoted: DataFrame, year: int) -> DataFrame:
    """Trips with every promotion of the year that follows them; one row for each.

    Inner join and unmatched trips apart, because only an inner join is split at run time
    when a player on its right side has very many rows.
    """
    p = promoted.withColumn("prev_changed_at", midnight(year, 1, 1)).withColumnRenamed(
        "player_id", "_player")
    start = F.col("trip_start").cast("timestamp_ntz")
    follows = (F.col("player_id") == F.col("_player")) & start.between(
        F.col("prev_changed_at"), F.col("changed_at"))
    last = promoted.groupBy("player_id").agg(F.max("changed_at").alias("_last"))
    none_follows = (F.col("_last").isNull() | (start > F.col("_last"))
                    | (start < midnight(year, 1, 1)))
    unmatched = trips.join(last, "player_id", "left").where(none_follows).drop("_last")
    return _described(trips.join(p, follows).drop("_player").unionByName(
        unmatched, allowMissingColumns=True))


def with_promotion_ranges(trips: DataFrame, promoted: DataFrame, year: int) -> DataFrame:
    """Trips with the first and last promotion of the year that follows them and how many do: what
    ``with_later_promotions`` says in a row for each pair, in a row for each trip.

    A trip starts at a midnight, so promotions are counted per player and day first; a player
    brings at most a year of days to the window, beside the days on which trips start. Running
    counts over both, from the end of the year back, are the ranges.
    """
    at = F.col("changed_at")
    on = (promoted.where((at >= midnight(year, 1, 1)) & (at < midnight(year + 1, 1, 1)))
          .groupBy("player_id", F.to_date("changed_at").alias("_day"))
          .agg(F.count("*").alias("_n"), F.min("changed_at").alias("_first"), F.max("changed_at").alias("_last")))
    inside = (F.col("trip_start") >= day(year, 1, 1)) & (F.col("trip_start") < day(year + 1, 1, 1))
    starts = trips.where(inside).select("player_id", F.col("trip_start").alias("_day")).distinct()
    later = Window.partitionBy("player_id").orderBy("_day").rangeBetween(Window.currentRow, Window.unboundedFollowing)
    ranges = (on.unionByName(starts, allowMissingColumns=True).select(
        "player_id", F.col("_day").alias("trip_start"), F.col("_n").isNull().alias("_trip"),
        F.min("_first").over(later).alias("first_promoted_at"), F.max("_last").over(later).alias("last_promoted_at"),
        F.coalesce(F.sum("_n").over(later), F.lit(0)).alias("later_promotions")).where("_trip").drop("_trip"))
    return _described(trips.join(ranges, ["player_id", "trip_start"], "left").withColumn(
        "later_promotions", F.coalesce("later_promotions", F.lit(0))))


def promotion_spans(promoted: DataFrame, year: int) -> DataFrame:
    """Promotions with the instant of the one before, else the start of the year."""
    return previous_instant(promoted, "player_id", "changed_at", "prev_changed_at",
                            midnight(year, 1, 1), ["tier_before", "tier_after", *REASONS])


def with_next_promotion(trips: DataFrame, promoted: DataFrame, year: int) -> DataFrame:
    """Trips with the promotion whose span, from the promotion before it, holds their start.

    A trip starts at a midnight, so only the midnights of a span can match. Spans without
    one are left out: those that remain are at most one per player and day, apart from
    promotions stamped at midnight exactly.
    """
    before, after = F.col("prev_changed_at"), F.col("changed_at")
    first = F.when(before == F.to_date(before).cast("timestamp_ntz"), F.to_date(before)).otherwise(
        F.date_add(F.to_date(before), 1))
    spans = (promotion_spans(promoted, year)
             .withColumnsRenamed({"player_id": "_player"})
             .withColumn("_first", first).withColumn("_last", F.to_date(after))
             .where(F.col("_first") <= F.col("_last")))
    holds = (F.col("player_id") == F.col("_player")) & F.col("trip_start").between(
        F.col("_first"), F.col("_last"))
    return _described(trips.join(spans, holds, "left").drop("_player", "_first", "_last"))


def number_trips(trips: DataFrame) -> DataFrame:
    """Trip number and running credits of each guest; trips of one day share the total."""
    per_guest = Window.partitionBy("guest_id")
    order = ["trip_start", "trip_end", "player_id", F.col("changed_at").asc_nulls_last(),
             "tier_before", "tier_after", *REASONS]
    return trips.withColumns({
        "trip_no": F.row_number().over(per_guest.orderBy(*order)),
        "running_credits": F.sum("credits").over(
            per_guest.orderBy("trip_start").rangeBetween(
                Window.unboundedPreceding, Window.currentRow))})
