"""Credit ledger: one row per credited purse item, on the local wall clock."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayledger.functions.codes import day, lob_group, midnight, to_pacific
from stayledger.operators.scale import materialize, running_total

POINTS_PER_CREDIT = Decimal(10000)


def live(df: DataFrame) -> DataFrame:
    return df.where(F.col("delete_flag") == "N")


def loyalty_ids(id_map: DataFrame, id_kind: str = "PlayerId") -> DataFrame:
    return (live(id_map).where(F.col("id_kind") == id_kind)
            .select("member_id", F.col("loyalty_id").cast("string").alias("player_id")))


def build_ledger(activity: DataFrame, items: DataFrame, locations: DataFrame, id_map: DataFrame,
                 policies: DataFrame, year: int, *, system_user_prefix: str,
                 policy_prefix: str = "Tier Credits", id_kind: str = "PlayerId",
                 whole_last_day: bool = False, rules: str = "table") -> DataFrame:
    """Live credit items of one local calendar year, on the clock of ``rules``.

    The year ends with the first instant of December 31 unless ``whole_last_day`` is set.
    """
    last = (F.col("ts") < midnight(year + 1, 1, 1) if whole_last_day
            else F.col("ts") <= midnight(year, 12, 31))
    # The bounds on the raw instant are implied by those on the local one (seven or eight
    # hours earlier); unlike them they reach the scan.
    raw_from = midnight(year, 1, 1) + F.expr("INTERVAL '7' HOUR")
    raw_to = midnight(year + 1, 1, 1) + F.expr("INTERVAL '8' HOUR")
    acts = (live(activity)
            .where(F.col("activity_status") != "Error")
            .where(F.col("activity_at").between(raw_from, raw_to))
            .withColumn("ts", to_pacific("activity_at", rules))
            .where(F.col("ts") >= midnight(year, 1, 1)).where(last)
            .select("activity_id", "member_id", "location_id", "ts",
                    lob_group("lob", "user_id", system_user_prefix).alias("lob_group")))
    credit_policies = live(policies).where(F.col("policy_name").startswith(policy_prefix))
    credited = (live(items)
                .join(credit_policies.select("policy_id"), "policy_id")
                .select("activity_id",
                        (F.col("accrued_points").cast("decimal(20,0)") / POINTS_PER_CREDIT)
                        .cast("decimal(18,4)").alias("credits")))
    sites = live(locations).select("location_id", "site_name")
    return (acts.join(credited, "activity_id")
            .join(loyalty_ids(id_map, id_kind), "member_id")
            .join(sites, "location_id", "left")
            .select("player_id", "ts", "credits", "site_name", "lob_group"))


def with_guest(df: DataFrame, xref: DataFrame) -> DataFrame:
    """Bridge from player ids to guest ids."""
    return df.join(xref.select("player_id", "guest_id"), "player_id")


def of_years(ledger: DataFrame, first: int, last: int | None = None) -> DataFrame:
    """Rows of a ledger or of player days in whole calendar years, as a range that reaches the
    scan."""
    if "day" in ledger.columns:
        return ledger.where(F.col("day").between(day(first, 1, 1), day(last or first, 12, 31)))
    return ledger.where((F.col("ts") >= midnight(first, 1, 1))
                        & (F.col("ts") < midnight((last or first) + 1, 1, 1)))


def player_days(ledger: DataFrame, property: str | None = None) -> DataFrame:
    """Credits per player and local day, with ``property`` also those earned there.

    Interval joins, cohorts and day features only need this grain. It is combined before any
    shuffle, and leaves at most one row per player and day, however many items a player
    has. Player days are returned as they are, so operators take them in place of a ledger.
    """
    if "day" in ledger.columns:
        return ledger

    def of(group: str):
        return F.sum(F.when(F.col("lob_group") == group, F.col("credits")).otherwise(0))

    here = [] if property is None else [credits_at(property).alias("property_credits")]
    return ledger.groupBy("player_id", F.to_date("ts").alias("day")).agg(
        F.sum("credits").alias("credits"),
        of("Gaming").alias("gaming_credits"),
        of("Non-Gaming").alias("non_gaming_credits"), *here)


def credits_at(property: str) -> Column:
    """Credits earned at a property; an unknown site counts as elsewhere."""
    return F.sum(F.when(F.col("site_name").contains(property), F.col("credits")).otherwise(0))


def ledger_running(ledger: DataFrame, xref: DataFrame) -> DataFrame:
    """Every ledger row with the guest's credits up to its instant."""
    rows = materialize(with_guest(ledger, xref), "guest_ledger")  # joined once, read three times
    return running_total(rows, "guest_id", "ts", "credits", "running_credits")
