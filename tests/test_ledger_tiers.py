from decimal import Decimal

import pytest

from stayledger.operators import ledger, tiers
from tests.helpers import bag, d, ledger as make_ledger, table, ts, xref


def source(spark, activity_at="2024-05-01 20:00:00", status="Posted", act_flag="N",
           loc_flag="N", item_flag="N", policy="Tier Credits A", kind="PlayerId"):
    activity = table(
        spark, "activity_id string, member_id string, location_id string, "
        "activity_at timestamp_ntz, activity_status string, lob string, user_id string, "
        "delete_flag string",
        ("a", "m", "l", ts(activity_at), status, "Hotel", "u", act_flag))
    return (activity,
            table(spark, "activity_id string, policy_id string, accrued_points bigint, "
                  "delete_flag string", ("a", "p", 123456, item_flag)),
            table(spark, "location_id string, site_name string, delete_flag string",
                  ("l", "Site", loc_flag)),
            table(spark, "member_id string, loyalty_id string, id_kind string, "
                  "delete_flag string", ("m", "77", kind, "N")),
            table(spark, "policy_id string, policy_name string, delete_flag string",
                  ("p", policy, "N")))


def build(spark, year=2024, whole=False, **kw):
    df = ledger.build_ledger(*source(spark, **kw), year, system_user_prefix="SYS",
                             whole_last_day=whole)
    return [tuple(r) for r in df.collect()]


def test_ledger_row(spark):
    assert build(spark) == [("77", ts("2024-05-01 13:00:00"), Decimal("12.3456"), "Site",
                             "Non-Gaming")]


@pytest.mark.parametrize("kw", [
    {"status": None}, {"status": "Error"}, {"act_flag": "Y"}, {"item_flag": "Y"},
    {"policy": "Points"}, {"kind": "Other"}, {"activity_at": "2024-01-01 07:59:59"}])
def test_ledger_leaves_out(spark, kw):
    assert build(spark, **kw) == []


def test_deleted_location_only_loses_its_name(spark):
    assert build(spark, loc_flag="Y")[0][3] is None


def test_year_ends_with_the_first_instant_of_its_last_day(spark):
    midnight, after = "2024-12-31 08:00:00", "2024-12-31 08:00:01"
    assert len(build(spark, activity_at=midnight)) == 1
    assert build(spark, activity_at=after) == []
    assert len(build(spark, activity_at=after, whole=True)) == 1
    assert len(build(spark, activity_at="2025-01-01 07:59:59", whole=True)) == 1
    assert build(spark, activity_at="2025-01-01 08:00:00", whole=True) == []
    assert len(build(spark, activity_at="2024-01-01 08:00:00")) == 1


def test_player_days_sum_exactly(spark):
    rows = make_ledger(
        spark, ("1", "2024-01-02 23:59:59", "0.1", "S", "Gaming"),
        ("1", "2024-01-02 00:00:00", "0.2", "S", "Other"),
        ("1", "2024-01-03 00:00:00", "5", "S", "Non-Gaming"))
    assert bag(ledger.player_days(rows), "day", "credits", "gaming_credits",
               "non_gaming_credits") == [
        (d("2024-01-02"), Decimal("0.3000"), Decimal("0.1000"), Decimal("0.0000")),
        (d("2024-01-03"), Decimal("5.0000"), Decimal("0.0000"), Decimal("5.0000"))]


def members(spark):
    return (table(spark, "member_id string, enrolled_at timestamp_ntz, delete_flag string",
                  ("a", ts("2020-01-01 00:00:00"), "N"), ("b", ts("2020-01-01 00:00:00"), "N")),
            table(spark, "member_id string, level_name string, achieved_at timestamp_ntz, "
                  "reason string, sub_reason string, delete_flag string",
                  ("a", "Gold", ts("2021-01-01 00:00:00"), "r", None, "N"),
                  ("b", None, None, None, None, "N")),
            table(spark, "member_id string, prev_level string, new_level string, "
                  "assigned_at timestamp_ntz, reason string, sub_reason string, "
                  "delete_flag string",
                  ("b", None, None, ts("2022-07-01 12:00:00"), "x", "y", "N"),
                  ("b", None, None, ts("2022-07-01 12:00:00"), "x", "y", "N"),
                  ("a", "Gold", "Pearl", ts("2022-07-01 12:00:00"), "x", "y", "Y")),
            table(spark, "member_id string, loyalty_id string, id_kind string, "
                  "delete_flag string", ("a", "1", "PlayerId", "N"), ("b", "2", "PlayerId", "N")),
            table(spark, "victim_id string, survivor_id string, delete_flag string",
                  ("b", "a", "N"), ("a", "zz", "Y")))


def test_tier_history(spark):
    got = bag(tiers.build_tier_history(*members(spark)), "player_id", "tier_from", "tier_to",
              "changed_at", "current_tier", "current_tier_at", "survivor_player_id",
              "change_reason")
    assert got == [
        ("1", "Gold", "Gold", ts("2020-12-31 16:00:00"), "Gold", ts("2020-12-31 16:00:00"), 1,
         None),
        ("2", "Sapphire", "Sapphire", ts("2022-07-01 05:00:00"), "NA",
         ts("9999-12-30 16:00:00"), 1, "x")]


def test_promotions_go_up_and_not_into_the_fifth(spark):
    history = table(
        spark, "player_id string, tier_from string, tier_to string, changed_at timestamp_ntz, "
        "tier_reason string, tier_sub_reason string, change_reason string, "
        "change_sub_reason string",
        *((str(i), a, b, ts(t), None, None, None, None) for i, (a, b, t) in enumerate([
            ("Sapphire", "Pearl", "2024-05-01 00:00:00"), ("Pearl", "Sapphire", "2024-05-01 00:00:00"),
            ("Gold", "Invited", "2024-05-01 00:00:00"), ("Pearl", "Gold", "2024-12-31 00:00:00"),
            ("Pearl", "Gold", "2024-12-31 00:00:01"), ("Pearl", "Gold", "2023-12-31 23:00:00")])))
    assert [r.player_id for r in tiers.promotions(history, 2024).orderBy("player_id").collect()] \
        == ["0", "3"]


def test_changes_of_guests_do_not_multiply(spark):
    history = table(spark, "player_id string, tier_from string, tier_to string, "
                    "changed_at timestamp_ntz", ("1", "Pearl", "Gold", ts("2024-05-01 00:00:00")))
    guests = table(spark, "guest_id bigint", (5,), (5,))
    assert tiers.changes_of_guests(history, xref(spark, ("1", 5)), guests, 2024).count() == 1
