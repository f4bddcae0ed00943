"""Visits, trips and guest cohorts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayledger.functions.codes import day
from stayledger.operators.ledger import credits_at, with_guest

TRIP_KEYS = ["guest_id", "trip_start", "trip_end"]


def visit_base(visits: DataFrame, *, first_month: date = date(2016, 1, 1),
               home_site_group: str = "LAS", excluded_segment: str = "Convention") -> DataFrame:
    """Visits outside the excluded segment, flagged by site; an unknown segment stays."""
    segment = F.col("segment")
    return (visits.where(F.col("month") >= F.lit(first_month))
            .where(segment.isNull() | (segment != excluded_segment))
            .withColumn("site", F.when(F.col("site_group") == home_site_group, "Vegas")
                        .otherwise("Region")))


def roll_up_trips(base: DataFrame, *, online_brand: str, until: date,
                  include_until: bool = False, since: date | None = None) -> DataFrame:
    """One row per guest, start and end day, without visits to the online brand."""
    start = F.col("trip_start")
    cap = start <= F.lit(until) if include_until else start < F.lit(until)
    if since is not None:
        cap = cap & (start >= F.lit(since))
    return (base.where(F.col("property") != online_brand).where(cap)
            .groupBy(*TRIP_KEYS)
            .agg(F.count("department").alias("departments"),
                 F.max("property").alias("property"),
                 F.max("gaming_days").alias("gaming_days"),
                 F.max("start_tier").alias("start_tier"))
            .withColumn("trip_id", F.concat_ws(
                "_", *(F.col(k).cast("string") for k in TRIP_KEYS))))


def at_property(trips: DataFrame, name: str) -> DataFrame:
    return trips.where(F.col("property").contains(name))


def starting_in(trips: DataFrame, year: int) -> DataFrame:
    return trips.where(F.col("trip_start").between(day(year, 1, 1), day(year, 12, 31)))


def returning_guests(property_trips: DataFrame, year: int) -> DataFrame:
    """Guests with a trip in the year and in the year before, found in one aggregation."""
    seen = F.year("trip_start")
    return (property_trips
            .where(F.col("trip_start").between(day(year - 1, 1, 1), day(year, 12, 31)))
            .groupBy("guest_id")
            .agg(F.max(seen).alias("_last"), F.min(seen).alias("_first"))
            .where(F.col("_last") > F.col("_first"))
            .select("guest_id"))


def new_guest_trips(property_trips: DataFrame, year: int) -> DataFrame:
    """Trips of the year by guests without a trip in the year before."""
    known = starting_in(property_trips, year - 1).select("guest_id").distinct()
    return starting_in(property_trips, year).join(known, "guest_id", "left_anti")


def property_credits(ledger: DataFrame, xref: DataFrame, name: str) -> DataFrame:
    """Credits per player, in all and at one property; player days bring those of theirs."""
    here = F.sum("property_credits") if "property_credits" in ledger.columns else credits_at(name)
    return with_guest(
        ledger.groupBy("player_id").agg(F.sum("credits").alias("total_credits"),
                                        here.alias("property_credits")), xref)


def dominant_guests(ledger: DataFrame, xref: DataFrame, name: str,
                    share: float = 0.8) -> DataFrame:
    """Guests who earn more than a share of their credits at the property."""
    threshold = F.col("total_credits") * F.lit(share).cast("decimal(5,4)")
    return (property_credits(ledger, xref, name)
            .where(F.col("property_credits") > threshold).select("guest_id").distinct())


def guests_with_credits(ledger: DataFrame, xref: DataFrame, name: str,
                        min_credits: float = 0) -> DataFrame:
    """Guests with more than an amount of credits earned at the property."""
    return (property_credits(ledger, xref, name)
            .where(F.col("property_credits") > F.lit(min_credits).cast("decimal(18,4)"))
            .select("guest_id").distinct())


def trips_of(trips: DataFrame, *cohorts: DataFrame) -> DataFrame:
    """Trips of the guests that belong to every cohort; trips are never multiplied."""
    guests = cohorts[0]
    for other in cohorts[1:]:
        guests = guests.join(other, "guest_id", "left_semi")
    return trips.join(guests, "guest_id", "left_semi")


def in_house_on(trips: DataFrame, on: date) -> DataFrame:
    return trips.where((F.col("trip_start") <= F.lit(on)) & (F.col("trip_end") >= F.lit(on)))


def win_loss(visits: DataFrame) -> DataFrame:
    """Net gaming revenue per trip."""
    return visits.groupBy(*TRIP_KEYS).agg(F.sum("net_gaming_revenue").alias("win_loss"))
