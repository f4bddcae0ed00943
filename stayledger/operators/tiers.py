"""Tier-change history of the members."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayledger.functions.codes import TIERS, midnight, tier_ordinal, to_pacific
from stayledger.operators.ledger import live, loyalty_ids


def _members(members: DataFrame, tiers: DataFrame, id_map: DataFrame) -> DataFrame:
    return (live(members).select("member_id", "enrolled_at")
            .join(live(tiers).select(
                "member_id", "level_name", "achieved_at", F.col("reason").alias("tier_reason"),
                F.col("sub_reason").alias("tier_sub_reason")), "member_id")
            .join(loyalty_ids(id_map), "member_id"))


def _history(history: DataFrame) -> DataFrame:
    return live(history).where(F.col("member_id").isNotNull()).select(
        "member_id", "prev_level", "new_level", "assigned_at",
        F.col("reason").alias("change_reason"), F.col("sub_reason").alias("change_sub_reason"))


def _changes(df: DataFrame, tier_from: Column, tier_to: Column, changed_at: Column) -> DataFrame:
    return df.select(
        "member_id", "player_id", "enrolled_at", tier_from.alias("tier_from"),
        tier_to.alias("tier_to"), changed_at.alias("changed_at"),
        F.coalesce("level_name", F.lit("NA")).alias("current_tier"),
        F.coalesce("achieved_at", midnight(9999, 12, 31)).alias("current_tier_at"),
        "tier_reason", "tier_sub_reason", "change_reason", "change_sub_reason")


def members_without_history(members: DataFrame, tiers: DataFrame, history: DataFrame,
                            id_map: DataFrame) -> DataFrame:
    """Members never moved: the current level stands for both ends of the change."""
    known = _history(history).select("member_id").distinct()
    base = _members(members, tiers, id_map).join(known, "member_id", "left_anti")
    unknown = F.lit(None).cast("string")
    return _changes(
        base.withColumns({"change_reason": unknown, "change_sub_reason": unknown}),
        F.col("level_name"), F.col("level_name"), F.col("achieved_at"))


def members_with_history(members: DataFrame, tiers: DataFrame, history: DataFrame,
                         id_map: DataFrame) -> DataFrame:
    """One row per recorded change; missing levels count as the lowest tier.

    An inner join from the history side, so that a member with very many changes can be
    split at run time.
    """
    lowest = F.lit(TIERS[0])
    return _changes(
        _history(history).join(_members(members, tiers, id_map), "member_id"),
        F.coalesce("prev_level", lowest), F.coalesce("new_level", "prev_level", lowest),
        F.coalesce("assigned_at", "achieved_at"))


def with_survivor(changes: DataFrame, merged: DataFrame) -> DataFrame:
    """Member that a merged member lives on in, else the member itself."""
    into = live(merged).select(F.col("victim_id").alias("member_id"), "survivor_id")
    return (changes.join(into, "member_id", "left")
            .withColumn("survivor_id", F.coalesce("survivor_id", "member_id")))


def build_tier_history(members: DataFrame, tiers: DataFrame, history: DataFrame,
                       id_map: DataFrame, merged: DataFrame, rules: str = "table") -> DataFrame:
    """All distinct tier changes on the clock of ``rules``, with the surviving player id."""
    changes = (members_without_history(members, tiers, history, id_map)
               .unionByName(members_with_history(members, tiers, history, id_map))
               .distinct())
    survivors = loyalty_ids(id_map).select(
        F.col("member_id").alias("survivor_id"),
        F.col("player_id").cast("long").alias("survivor_player_id"))
    return (with_survivor(changes, merged).join(survivors, "survivor_id")
            .select("player_id", to_pacific("enrolled_at", rules).alias("enrolled_at"),
                    "tier_from", "tier_to", to_pacific("changed_at", rules).alias("changed_at"),
                    "current_tier", to_pacific("current_tier_at", rules).alias("current_tier_at"),
                    "survivor_player_id", "tier_reason", "tier_sub_reason", "change_reason",
                    "change_sub_reason"))


def ranked_changes(tier_history: DataFrame) -> DataFrame:
    return tier_history.withColumns({
        "tier_before": tier_ordinal("tier_from"), "tier_after": tier_ordinal("tier_to")})


def promotions(tier_history: DataFrame, year: int, whole_last_day: bool = False) -> DataFrame:
    """Upward changes of a year into one of the named tiers, up to the start of December 31
    or with ``whole_last_day`` to its end."""
    last = (F.col("changed_at") < midnight(year + 1, 1, 1) if whole_last_day
            else F.col("changed_at") <= midnight(year, 12, 31))
    return (ranked_changes(tier_history)
            .where((F.col("tier_before") < F.col("tier_after")) & (F.col("tier_after") != 5))
            .where(F.col("changed_at") >= midnight(year, 1, 1)).where(last)
            .select("player_id", "tier_before", "tier_after", "changed_at", "tier_reason",
                    "tier_sub_reason", "change_reason", "change_sub_reason"))


def changes_of_guests(tier_history: DataFrame, xref: DataFrame, guests: DataFrame,
                      year: int) -> DataFrame:
    """Tier changes of a year by the guests of a cohort."""
    in_year = tier_history.where(F.col("changed_at") >= midnight(year, 1, 1)).where(
        F.col("changed_at") < midnight(year + 1, 1, 1))
    return (ranked_changes(in_year)
            .join(xref.select("player_id", "guest_id"), "player_id")
            .join(guests.select("guest_id").distinct(), "guest_id", "left_semi")
            .select("guest_id", "changed_at", "tier_from", "tier_to", "tier_before",
                    "tier_after"))
