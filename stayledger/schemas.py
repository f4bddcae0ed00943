"""Column contracts of the logical tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S, _L, _I, _D = T.StringType(), T.LongType(), T.IntegerType(), T.DateType()
_TS, _X, _CREDITS = T.TimestampNTZType(), T.DoubleType(), T.DecimalType(18, 4)


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


ACTIVITY = _table(
    activity_id=_S, member_id=_S, location_id=_S, activity_at=_TS, activity_status=_S,
    activity_type=_S, lob=_S, user_id=_S, loyalty_id=_S, created_at=_TS, delete_flag=_S)
ACCRUAL_ITEM = _table(activity_id=_S, policy_id=_S, accrued_points=_L, delete_flag=_S)
MEMBER_ID_MAP = _table(member_id=_S, loyalty_id=_S, id_kind=_S, delete_flag=_S)
PURSE_POLICY = _table(policy_id=_S, policy_name=_S, delete_flag=_S)
LOCATION = _table(location_id=_S, site_name=_S, delete_flag=_S)
MEMBER = _table(member_id=_S, enrolled_at=_TS, delete_flag=_S)
MEMBER_TIER = _table(
    member_id=_S, level_name=_S, achieved_at=_TS, reason=_S, sub_reason=_S, delete_flag=_S)
MEMBER_TIER_HISTORY = _table(
    member_id=_S, prev_level=_S, new_level=_S, assigned_at=_TS, reason=_S, sub_reason=_S,
    delete_flag=_S)
MERGED_MEMBER = _table(victim_id=_S, survivor_id=_S, delete_flag=_S)
REASON_ENUM = _table(enum_value=_S, label=_S)
LEDGER = _table(player_id=_S, ts=_TS, credits=_CREDITS, site_name=_S, lob_group=_S)
TIER_HISTORY = _table(
    player_id=_S, enrolled_at=_TS, tier_from=_S, tier_to=_S, changed_at=_TS, current_tier=_S,
    current_tier_at=_TS, survivor_player_id=_L, tier_reason=_S, tier_sub_reason=_S,
    change_reason=_S, change_sub_reason=_S)
MEMBER_XREF = _table(player_id=_S, guest_id=_L)
VISIT = _table(
    guest_id=_L, property=_S, department=_S, trip_start=_D, trip_end=_D, start_tier=_S,
    gaming_days=_I, site_group=_S, month=_D, segment=_S, net_gaming_revenue=_X)
TRIP_DEMO = _table(
    guest_id=_L, trip_start=_D, trip_end=_D, gender=_S, age=_I, location=_S, lodging=_S, tenure=_I)
CUSTOMER_PROFILE = _table(guest_id=_L, game_type=_S, enrolled_on=_D)
REGIONAL_PROFILE = _table(guest_id=_L, worth_18m=_X)
LINKED_ACCOUNT = _table(player_id=_S, account_id=_S, credits_earned=_CREDITS)

#: Contracts of the tables that the nightly refresh reads.
SOURCES = {
    "activity": ACTIVITY, "accrual_item": ACCRUAL_ITEM, "location": LOCATION, "member_id_map": MEMBER_ID_MAP,
    "purse_policy": PURSE_POLICY, "member": MEMBER, "member_tier": MEMBER_TIER,
    "member_tier_history": MEMBER_TIER_HISTORY, "merged_member": MERGED_MEMBER}

def _only(table: T.StructType, *left_out: str) -> T.StructType:
    return T.StructType([f for f in table.fields if f.name not in left_out])


#: Contracts of the tables that training and the daily run read; the ledger may be player days.
PLAN_SOURCES = {
    "visit": _only(VISIT, "net_gaming_revenue"), "ledger": LEDGER, "member_xref": MEMBER_XREF, "trip_demo": TRIP_DEMO,
    "tier_history": _only(TIER_HISTORY, "enrolled_at", "current_tier", "current_tier_at", "survivor_player_id"),
    "reason_enum": REASON_ENUM, "activity": _only(ACTIVITY, "activity_id", "member_id", "location_id", "activity_at",
                                                  "activity_status", "lob", "user_id", "delete_flag")}

#: Model inputs of a returning guest, one row per active day.
RETURNING_FEATURES = (
    "credits", "days_left", "day_no", "running_credits", "trip_length", "trip_day",
    "lodging_code", "top_tier", "gaming_share", "non_gaming_share", "hist_credits",
    "hist_trips", "hist_trip_days", "hist_first_trip_age", "lodger_share", "local_share",
    "target_credits")
#: Model inputs of a guest without a prior year.
NEW_GUEST_FEATURES = (
    "credits", "days_left", "day_no", "running_credits", "trip_length", "trip_day",
    "lodging_code", "lodger_share", "local_share", "target_credits")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project a source onto a logical table: case-insensitive names, declared types."""
    actual = {name.lower(): name for name in df.columns}
    missing = [f.name for f in schema.fields if f.name not in actual]
    if missing:
        raise ValueError(f"source lacks columns {missing}")
    return df.select(*(F.col(actual[f.name]).cast(f.dataType).alias(f.name) for f in schema.fields))
